"""Token alignment of two tokenizers, with a fast path for tokens of the same bytes.

Texts are cut into units that neither tokenizer crosses; a distinct unit is encoded and
aligned once in a block of texts.  In a unit, places where tokens of both end cut the
tokens into groups.  A group of one token each whose pair is the one that the identity map
(A id to the B id of the same bytes, made once from the vocabularies) names is counted in a
vector as long as A's vocabulary.  All other groups are irregular: the pairs of their
overlapping tokens are counted by block, and only those enter the shuffle that adds up the
corpus-wide counts and brings them back to the blocks.

Nothing is sent for a single occurrence: a block (at most 1,000 texts of about 1 MB, one
stored row) holds its documents as lists of its units, in as few bytes as its numbers need,
and sends each of its pairs once.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from salesmart.llm.arrow_text import Recent, slices
from salesmart.llm.common import small_batches, stored, text_of
from salesmart.llm.vocabulary import SPACE

#: units of which a worker remembers the alignment, twice; bytes of text in a block
CACHED_UNITS = 75_000
ENCODED_UNITS = 4_000
BLOCK_BYTES = 1_000_000

# The white space of Unicode, and the byte-level alphabet (printable Latin-1
# characters stand for themselves, the other bytes for the characters from 256 on).
BLANKS = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]

# white space beyond ASCII by its bytes, as numbers; no other character ends in these
WIDE = [int.from_bytes(c.encode(), "big") for c in BLANKS if ord(c) > 127]


def byte_alphabet() -> dict[str, int]:
    other = [b for b in range(256) if b not in set(PLAIN)]
    return {chr(b): b for b in PLAIN} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=2)
def _first(blob: bytes):
    """The byte-level tokenizer and the bytes of its ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_buffer(blob)
    tokenizer.encode_special_tokens = True
    alphabet = byte_alphabet()
    special = {i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
    return tokenizer, {i: token.encode() if i in special else bytes(alphabet[c] for c in token)
                       for token, i in tokenizer.get_vocab(with_added_tokens=True).items()}


@lru_cache(maxsize=2)
def _second(blob: bytes):
    """The piece tokenizer and the bytes of its ids."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_proto=blob)
    of = {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        of[i] = bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()
        if re.search(f"[^{BLANKS}][ \n]", piece.replace(SPACE, " ")):
            raise ValueError(f"piece {piece!r} has a blank behind other characters: units could not be cut at blanks")
    return model, of


def identity_map(a_bytes: dict[int, bytes], b_bytes: dict[int, bytes]) -> np.ndarray:
    """The B id of the same bytes for each A id, -1 where there is none.  Of several (a
    piece of one byte and its fallback) the last, which is the piece."""
    of = {raw: i for i, raw in sorted(b_bytes.items())}
    out = np.full(max(a_bytes) + 1, -1, dtype=np.int32)
    for i, raw in a_bytes.items():
        out[i] = of.get(raw, -1)
    return out


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]

#: what stands behind an id: another of its side, the other side, another group, the unit's end
MARKS = [",", "|", ";", ";\n"]


def _sizes(of: dict[int, bytes]) -> np.ndarray:
    """Bytes of each id."""
    out = np.zeros(max(of) + 1, dtype=np.int64)
    for i, raw in of.items():
        out[i] = len(raw)
    return out


class Unit(NamedTuple):
    """The alignment of one unit: numbers of tokens, groups and links (NUMBERS), ids of
    identical one-to-one groups, pairs of all other links, and the groups as text, a
    semicolon behind each."""
    numbers: bytes
    same: bytes
    pairs: bytes
    text: bytes


NO_TOKENS = Unit(bytes(32), b"", b"", b"")


def _runs(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """``values`` as consecutive runs of the given lengths."""
    raw, ends = values.tobytes(), (np.cumsum(counts) * values.itemsize).tolist()
    return [raw[start:end] for start, end in zip([0, *ends[:-1]], ends)]


def _lengths(ids: list) -> np.ndarray:
    return np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))


def _flat(ids: list) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), dtype=np.int64)


def cut_units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct units of the texts, each text behind a blank, the index of every unit
    and the number of units of each text (an empty text has none).  Units end before a blank
    or line feed behind anything but white space."""
    plain = texts.to_numpy(zero_copy_only=False).tolist()
    raw = "".join([" " + t for t in plain if t]).encode()
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes[sizes > 0] += 1
    points = np.frombuffer(raw, dtype=np.uint8)
    at = np.flatnonzero((points == 32) | (points == 10))
    before = points[at - 1]
    inner = ~((before == 32) | ((before >= 9) & (before <= 13)))
    wide = np.flatnonzero(before >= 128)
    if len(wide):
        last = at[wide][:, None] - np.array([3, 2, 1])
        three = points[last].astype(np.int64) @ np.array([1 << 16, 1 << 8, 1])
        inner[wide] = ~(np.isin(three, WIDE) | np.isin(three & 0xFFFF, WIDE))
    first = np.zeros(len(points), dtype=bool)
    first[at[inner]] = True
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True          # of each text
    starts = np.flatnonzero(first)
    units = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(points)).astype(np.int64)), pa.py_buffer(raw))
    coded = units.dictionary_encode()
    n = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), n


class Aligner:
    """Units of texts and their alignments (None for those whose tokens lose bytes)."""

    def __init__(self, a_blob: bytes, b_blob: bytes):
        self.a, self.a_bytes = _first(a_blob)
        self.b, self.b_bytes = _second(b_blob)
        self.same = identity_map(self.a_bytes, self.b_bytes)
        self.a_sizes, self.b_sizes = (_sizes(of) for of in (self.a_bytes, self.b_bytes))
        self.n_ids = max(len(self.a_sizes), len(self.b_sizes))
        self.written = [f"{i}{mark}".encode() for mark in MARKS for i in range(self.n_ids)]
        self.known = Recent(CACHED_UNITS)       # a unit whose tokens lose bytes has none

    def learn(self, units: list[str]) -> None:
        """``units`` begin with a blank, which B's tokenizer adds by itself."""
        for at in range(0, len(units), ENCODED_UNITS):
            part = units[at:at + ENCODED_UNITS]
            first, second = self._first_ids(part), self._pieces_of(part)
            raw = [u.encode() for u in part]
            good = (self._whole(self.a_bytes, self.a_sizes, first, raw)
                    & self._whole(self.b_bytes, self.b_sizes, second, raw)).tolist()
            if all(good):
                self.known.new.update(zip(part, self._aligned(first, second)))
                continue
            self.known.new.update((u, None) for u, g in zip(part, good) if not g)
            kept = [i for i, g in enumerate(good) if g]
            if kept:
                self.known.new.update(zip([part[i] for i in kept],
                                          self._aligned([first[i] for i in kept], [second[i] for i in kept])))

    def _first_ids(self, units: list[str]) -> list[list[int]]:
        """A's ids: units that do not end in white space, which a text of them is cut into
        again, as one text; the others, and all if its tokens lose bytes, one by one."""
        joined = [i for i, u in enumerate(units) if u[-1] not in BLANKS]
        ids = self.a.encode("".join([units[i] for i in joined]), add_special_tokens=False).ids if joined else []
        ends = np.cumsum(self.a_sizes[ids]) if ids else np.zeros(0, np.int64)
        wanted = np.cumsum([len(units[i].encode()) for i in joined], dtype=np.int64)
        cuts = np.searchsorted(ends, wanted)
        if joined and (not len(ends) or ends[-1] != wanted[-1] or (ends[cuts] != wanted).any()):
            joined, cuts = [], cuts[:0]
        out: list = [None] * len(units)
        a = 0
        for i, b in zip(joined, (cuts + 1).tolist()):
            out[i] = ids[a:b]
            a = b
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.a.encode_batch_fast([units[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    @classmethod
    def _whole(cls, of: dict[int, bytes], sizes: np.ndarray, ids: list[list[int]], raw: list[bytes]) -> np.ndarray:
        """Whether the bytes of each unit's ids are its own."""
        ends = np.concatenate([[0], np.cumsum(sizes[_flat(ids)])])[np.cumsum(_lengths(ids))]
        if (ends == np.cumsum(_lengths(raw))).all() and cls._bytes(of, chain.from_iterable(ids)) == b"".join(raw):
            return np.ones(len(raw), dtype=bool)
        return np.array([cls._bytes(of, x) == r for x, r in zip(ids, raw)], dtype=bool)

    @staticmethod
    def _bytes(of: dict[int, bytes], ids) -> bytes:
        return b"".join(map(of.__getitem__, ids))

    def _aligned(self, first: list, second: list) -> list[Unit]:
        """The alignments of units whose tokens hold the same bytes, all units laid end to
        end: units end where tokens of both end, so no group or link crosses two."""
        n_a, n_b, a, b = _lengths(first), _lengths(second), _flat(first), _flat(second)
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        unit_a = np.repeat(np.arange(len(first)), n_a)
        # by place: whether a token of either side ends there, how many did before
        in_a, in_b = (np.zeros(int(ends_a[-1]) + 1, dtype=bool) for _ in range(2))
        in_a[ends_a], in_b[ends_b] = True, True
        cut = in_a & in_b
        a_before, b_before, cuts_before = (np.cumsum(x) - x for x in (in_a, in_b, cut))
        group_a, group_b = cuts_before[ends_a], cuts_before[ends_b]
        unit_of_group = unit_a[a_before[np.flatnonzero(cut)]]
        # between two neighbouring ends of either side lies the overlap of one pair, and each
        # pair that overlaps does so between one such two
        borders = np.flatnonzero(in_a | in_b)
        at_a, at_b = a_before[borders], b_before[borders]
        link_a, link_b, link_unit = a[at_a], b[at_b], unit_a[at_a]
        single = (np.bincount(group_a) == 1) & (np.bincount(group_b) == 1)
        same = single[group_a[at_a]] & (self.same[link_a] == link_b)
        count = lambda of: np.bincount(of, minlength=len(first))
        numbers = np.stack([n_a, n_b, count(unit_of_group), count(link_unit)], axis=1).astype(np.int64)
        return list(map(Unit, _runs(numbers, np.full(len(first), len(NUMBERS))),
                        _runs(link_a[same].astype(np.int32), count(link_unit[same])),
                        _runs((link_a << 32 | link_b)[~same], count(link_unit[~same])),
                        self._texts(a, b, group_a, group_b, unit_of_group)))

    def _texts(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray,
               unit_of_group: np.ndarray) -> list[bytes]:
        """Each unit's groups as text: every id with the mark that stands behind it."""
        side = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(side, kind="stable")
        ids, side = np.concatenate([a, b])[order], side[order]
        step = side[1:] != side[:-1]
        unit = unit_of_group[side >> 1]
        mark = np.where(~step, 0, np.where(side[:-1] % 2 == 0, 1, np.where(unit[1:] == unit[:-1], 2, 3)))
        places = np.append(mark, 3) * self.n_ids + ids
        return b"".join(map(self.written.__getitem__, places.tolist())).split(b"\n")[:-1]

    def _pieces_of(self, units: list[str]) -> list[list[int]]:
        """B's ids: units behind a blank at once, without it; the others one by one."""
        out = [[] if u[0] == " " and len(u) > 1 else self._pieces(u) for u in units]
        plain = [i for i, u in enumerate(units) if u[0] == " " and len(u) > 1]
        if plain:
            for i, ids in zip(plain, self.b.encode([units[i][1:] for i in plain], num_threads=1)):
                out[i] = ids
        return out

    def _pieces(self, unit: str) -> list[int]:
        # a line feed at the start is no dummy blank: encoded behind one, which is then taken off
        if unit[0] == " ":
            return self.b.encode(unit[1:]) if len(unit) > 1 else [self.b.piece_to_id(SPACE)]
        ids = self.b.encode("x" + unit)
        x = self.b.encode("x")
        return ids[len(x):] if ids[:len(x)] == x else []

    def alignments(self, units: list[str]) -> list[Unit | None]:
        """The distinct units' alignments."""
        self.learn(self.known.missing(units))
        return list(map(self.known.new.__getitem__, units))


@lru_cache(maxsize=2)
def _aligner(a_blob: bytes, b_blob: bytes) -> Aligner:
    """One for a process: what it learned of units serves later tasks, too."""
    return Aligner(a_blob, b_blob)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes as the largest needs (1, 2, 4 or 8, said first)."""
    size = np.min_scalar_type(int(numbers.max()) if len(numbers) else 0).itemsize
    return bytes([size]) + numbers.astype(f"<u{size}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1)


def _summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths."""
    ends = np.cumsum(counts, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])] if len(ends) else np.zeros(0, np.int64)


#: a block's row: its distinct irregular pairs and their links, the identical groups' A ids
#: and their links, each unit's pairs and A ids (as places in the former), and the documents
BLOCK = ("block long, pairs array<long>, pair_links array<long>, same array<int>, same_links array<long>, "
         "unit_pairs binary, unit_pair_counts binary, unit_same binary, unit_same_counts binary, "
         "docs binary, doc_units binary, doc_unit_counts binary")


def _block(number: int, ids: pa.Array, texts: pa.Array, aligner: Aligner) -> pa.RecordBatch:
    units, index, n_units = cut_units(texts)
    of = aligner.alignments(units)
    lossy = np.fromiter((u is None for u in of), dtype=bool, count=len(of))
    row = np.repeat(np.arange(len(n_units)), n_units)
    if lossy.any():                             # a unit that loses bytes takes its text
        good = np.bincount(row[lossy[index]], minlength=len(n_units)) == 0
        index, n_units = index[good[row]], np.where(good, n_units, 0)
    used = np.bincount(index, minlength=len(units))
    of = [u if n else NO_TOKENS for u, n in zip(of, used.tolist())]
    numbers, same_of, pairs_of, texts_of = zip(*of) if of else [()] * 4
    n_pairs, n_same = _lengths(pairs_of) // 8, _lengths(same_of) // 4
    pairs, where = np.unique(np.frombuffer(b"".join(pairs_of), dtype=np.int64), return_inverse=True)
    pair_links = np.bincount(where, weights=np.repeat(used, n_pairs), minlength=len(pairs)).astype(np.int64)
    flat_same = np.frombuffer(b"".join(same_of), dtype=np.int32)
    same, back = np.unique(flat_same, return_inverse=True)
    same_links = np.bincount(back, weights=np.repeat(used, n_same), minlength=len(same)).astype(np.int64)
    numbers = np.frombuffer(b"".join(numbers), dtype=np.int64).reshape(-1, len(NUMBERS))
    written = pa.array(texts_of, pa.large_binary()).take(pa.array(index))
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(written).to_numpy())])
    ends = ends[np.concatenate([[0], np.cumsum(n_units)])].tolist()
    raw = memoryview(written.buffers()[2]) if ends[-1] else b""
    digests = [hashlib.sha256(raw[a:b - 1]).hexdigest() if b > a else "" for a, b in zip(ends[:-1], ends[1:])]
    docs = pa.RecordBatch.from_arrays(
        [ids, *[pa.array(_summed(numbers[index, k], n_units)) for k in range(len(NUMBERS))], pa.array(digests, pa.string())],
        names=["id", *NUMBERS, "groups_sha256"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_batch(docs)
    columns = [number, pairs, pair_links, same, same_links, _packed(where), _packed(n_pairs), _packed(back), _packed(n_same),
               sink.getvalue().to_pybytes(), _packed(index), _packed(n_units)]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.binary()] * 7]
    names = [c.split()[0] for c in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(columns, kinds)], names=names)


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 of the alignment of its tokens by the two tokenizers.

    A null or empty text, and one whose tokens do not give back its bytes, has no tokens:
    zeros and an empty digest.  Rows are taken one by one, so repeated ids are reported as
    they come and every copy counts.  Other columns are ignored.  An empty table gives an
    empty result."""
    spark = docs.sparkSession
    small_batches(spark)
    blobs = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            blobs.append(spark.sparkContext.broadcast(f.read()))           # vocabularies
    a, b = blobs
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("place"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a.value, b.value)
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                yield _block(part.column("place")[0].as_py(), part.column("id"), part.column("text"), aligner)

    blocks = stored(rows.mapInArrow(align, BLOCK), "alignment_blocks")

    same = identity_map(_first(a.value)[1], _second(b.value)[1])
    # one count for each id of A's vocabulary
    times = np.zeros(len(same), dtype=np.int64)
    listed = blocks.select(F.explode(F.arrays_zip("same", "same_links")).alias("x")).groupBy("x.same").agg(F.sum("x.same_links").alias("n"))
    for r in listed.collect():
        times[r["same"]] = r["n"]
    sent = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "pair_links")).alias("at", "x"))
    irregular = stored(sent.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.pair_links").alias("n")), "alignment_pairs")
    # pairs of identical tokens that irregular groups hold, too: at most one for each id of A
    named = spark.createDataFrame([((i << 32) | j, int(times[i])) for i, j in enumerate(same.tolist()) if j >= 0], "pair long, same_n long")
    total = irregular.join(F.broadcast(named), "pair", "left").select(
        "pair", (F.col("n") + F.coalesce("same_n", F.lit(0))).alias("n"))
    best = np.zeros(max(_second(b.value)[1]) + 1, dtype=np.int64)
    for r in total.groupBy(F.col("pair").bitwiseAND((1 << 32) - 1).alias("b")).agg(F.max("n").alias("n")).collect():
        best[r["b"]] = r["n"]                                              # one for each id of B
    for r in irregular.join(F.broadcast(named), "pair").collect():         # one for each id of A
        times[r["pair"] >> 32] += r["n"]
    known = np.flatnonzero(same >= 0)
    np.maximum.at(best, same[known], times[known])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T.StructType.fromDDL(
        "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").fields])
    counted = sent.select(F.col("block").alias("asked"), "at", F.col("x.pairs").alias("pair")).join(total, "pair").select(
        F.col("asked").alias("number"), "at", "pair", "n")

    def finish(key, ours: pa.Table, counts: pa.Table) -> pa.Table:
        if not ours.num_rows:
            return schema_empty
        row = ours.to_pylist()[0]
        n, of_best = np.zeros(len(row["pairs"]), np.int64), np.zeros(len(row["pairs"]), np.int64)
        at = counts.column("at").to_numpy()
        n[at] = counts.column("n").to_numpy()
        of_best[at] = best[counts.column("pair").to_numpy() & 0xFFFFFFFF]
        ids = np.array(row["same"], dtype=np.int64)
        (where, n_where, back, n_back, units, counts_) = (_unpacked(row[c]) for c in (
            "unit_pairs", "unit_pair_counts", "unit_same", "unit_same_counts", "doc_units", "doc_unit_counts"))
        top = times[ids] == best[same[ids]]
        sums = _summed(n[where], n_where) + _summed(times[ids][back], n_back)
        bests = _summed((n == of_best)[where], n_where) + _summed(top[back], n_back)
        with pa.ipc.open_stream(row["docs"]) as stream:
            docs_ = stream.read_all()
        return pa.table([docs_.column("id"), *[docs_.column(c) for c in NUMBERS],
                         pa.array(_summed(bests[units], counts_)), pa.array(_summed(sums[units], counts_)),
                         docs_.column("groups_sha256")], names=schema.names)

    schema_empty = to_arrow_schema(schema).empty_table()
    ours = blocks.drop("pair_links", "same_links")
    return ours.groupBy("block").cogroup(counted.groupBy("number")).applyInArrow(finish, schema)
