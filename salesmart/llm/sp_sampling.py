"""SentencePiece encoding by forward-filtering backward-sampling over the piece lattice.

A text is cut into words at its blanks (each word begins with one, as the model's dummy
prefix has it); the lattice of a word has an edge for every piece that matches at a
position, and for every character without a piece of its own the character's bytes.  The
forward pass sums the probabilities of all segmentations up to each position, once for
each distinct word; the backward pass draws the last edge of every occurrence, then the
one before it, and so on, each with its exact posterior probability.  Random numbers are
digests of seed, row key and place in the text, so a row's sample never depends on its
neighbours, partitions or retries.

Decoding joins the pieces' bytes: a blank's sign is a blank, byte pieces are bytes (a
literal U+2581 is encoded as bytes), and the first blank goes.  Every text comes back
unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.arrow_text import SMALL_SLICE_BYTES, n_bytes, slices, split_words
from salesmart.llm.common import free_name, schema_with, small_batches, text_of
from salesmart.llm.vocabulary import SPACE, Vocabulary, load

SEED = 1
#: scores are divided by this; higher is more random
TEMPERATURE = 1.0
#: code points of distinct words whose lattices a task holds at a time, about
LATTICE_POINTS = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Lattice:
    """Finds the edges of words and samples paths through them."""

    def __init__(self, vocabulary: Vocabulary, temperature: float = TEMPERATURE):
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(vocabulary.pieces):
            by_length.setdefault(len(piece), []).append(i)
        # a run of code points is known by a 64-bit rolling digest; a hit is compared
        # exactly.  Two bit maps by 20 bits of the digest drop most other runs first: those
        # that begin no piece at all, and those that are none.
        self.begins, self.whole = (np.zeros(1 << 20, dtype=bool) for _ in range(2))
        self.tables = {}
        for n, items in sorted(by_length.items()):
            points = np.array([[ord(c) for c in vocabulary.pieces[i]] for i in items], dtype=np.uint32)
            h = np.zeros(len(points), dtype=np.uint64)
            for j in range(n):
                h = self._roll(h, points[:, j])
                self.begins[h >> np.uint64(44)] = True
            self.whole[h >> np.uint64(44)] = True
            order = np.argsort(h)
            self.tables[n] = (h[order], points[order], np.array(items)[order])
        self.scores = vocabulary.scores / temperature
        self.byte_score = float(self.scores.min())      # a byte is as likely as the rarest piece

    @staticmethod
    def _roll(h: np.ndarray, point: np.ndarray) -> np.ndarray:
        h = (h ^ point.astype(np.uint64)) * MIX
        return h ^ (h >> np.uint64(29))

    def edges(self, points: np.ndarray, words: np.ndarray, ends: np.ndarray) -> list[tuple]:
        """All edges of words given by their code points (``words``: where each begins,
        ``ends``: of each code point, where its word ends), by length: (length, begins,
        items, scores).  Item -1 is a character spelt in bytes."""
        n = len(points)
        literal = points == ord(SPACE)                   # a blank's sign inside a word is text
        literal[words] = False
        out, single = [], np.zeros(n, dtype=bool)
        at, h = np.arange(n), np.zeros(n, dtype=np.uint64)
        for length in range(1, max(self.tables) + 1):
            keep = at + length <= ends[at]
            at, h = at[keep], h[keep]
            h = self._roll(h, points[at + length - 1])
            keep = self.begins[h >> np.uint64(44)]
            at, h = at[keep], h[keep]
            if not len(at):
                break
            if length not in self.tables:
                continue
            keys, exact, items = self.tables[length]
            hit = np.flatnonzero(self.whole[h >> np.uint64(44)])
            slot = np.minimum(np.searchsorted(keys, h[hit]), len(keys) - 1)
            same = keys[slot] == h[hit]
            for j in range(length):
                same &= (points[at[hit] + j] == exact[slot, j]) & ~literal[at[hit] + j]
            begin, item = at[hit[same]], items[slot[same]]
            out.append((length, begin, item, self.scores[item]))
            if length == 1:
                single[begin] = True
        rest = np.flatnonzero(~single)
        out.append((1, rest, np.full(len(rest), -1), n_bytes(points[rest]) * self.byte_score))
        return out

    def filtered(self, points: np.ndarray, words: np.ndarray, ends: np.ndarray):
        """Forward pass.  Places (after each code point) are ranked by their offset in the
        word, so that all words advance together.  Returns each place's rank, and by rank
        the edges that end there: the first of each place, begins, items, and posteriors
        cumulated within the place."""
        n = len(points)
        offset = np.arange(n) - np.repeat(words, np.diff(np.append(words, n)))
        by_rank = np.argsort(offset, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[by_rank] = np.arange(n)
        edges = self.edges(points, words, ends)
        ends_at = [rank[begin + length - 1] for length, begin, _, _ in edges]
        degree = np.zeros(n, dtype=np.int64)
        for e in ends_at:
            degree[e] += 1                               # at most one edge of a length ends at a place
        first = np.cumsum(degree) - degree
        free = first.copy()
        total = int(degree.sum())
        begins, items, scores = (np.empty(total, dtype=t) for t in (np.int64, np.int64, np.float64))
        for (_, begin, item, score), e in zip(edges, ends_at):
            slot = free[e]
            free[e] += 1
            begins[slot], items[slot], scores[slot] = begin, item, score
        alpha = np.zeros(n)
        mass = np.empty(total)
        step = np.r_[0, np.cumsum(np.bincount(offset))] if n else np.zeros(1, dtype=np.int64)
        bound = np.append(first, total)
        for k, (lo, hi) in enumerate(zip(step[:-1], step[1:])):
            a, b = bound[lo], bound[hi]
            t = scores[a:b].copy()
            if k:
                inner = begins[a:b] - 1
                t += np.where(offset[begins[a:b]] > 0, alpha[rank[inner]], 0.0)
            f = first[lo:hi] - a
            top = np.maximum.reduceat(t, f)
            wide = degree[lo:hi]
            p = np.exp(t - np.repeat(top, wide))
            z = np.add.reduceat(p, f)
            alpha[lo:hi] = top + np.log(z)
            mass[a:b] = p / np.repeat(z, wide)
        run = np.cumsum(mass)
        run -= np.repeat(run[first] - mass[first], degree)
        run[bound[1:] - 1] = 2.0                         # the last edge takes what rounding left
        return rank, first, begins, items, run

    def sample(self, points, words, ends, occurrences, keys):
        """Backward pass: the drawn edges of each occurrence (index of a distinct word,
        with a 64-bit key), as (occurrences, begins, items), last edges first."""
        rank, first, begins, items, run = self.filtered(points, words, ends)
        at = ends[words[occurrences]] - 1 if len(occurrences) else occurrences
        low = words[occurrences]
        who = np.arange(len(occurrences))
        outs = []
        while len(who):
            u = (_mixed(keys + np.array(len(outs), dtype=np.uint64) * MIX) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            edge = first[rank[at]]
            on = np.flatnonzero(run[edge] <= u)
            while len(on):
                edge[on] += 1
                on = on[run[edge[on]] <= u[on]]
            begin = begins[edge]
            outs.append((who, begin, items[edge]))
            more = begin > low
            who, low, keys, at = who[more], low[more], keys[more], begin[more] - 1
        return outs


def encoder(vocabulary: Vocabulary, seed: int = SEED, temperature: float = TEMPERATURE) -> Callable:
    """A function of (texts, row keys as uint64) to (ids of all texts in a row, number of
    ids of each text)."""
    lattice = Lattice(vocabulary, temperature)
    ids_of = vocabulary.ids
    byte_ids = vocabulary.byte_ids
    shift = np.uint64(seed * int(MIX) % 2 ** 64)

    def drawn(words: list[str], occurrences: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of occurrences of the words in a row, and the number of ids of each."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
        ends = np.repeat(starts + lengths, lengths)
        edges = lattice.sample(points, starts, ends, occurrences, keys)
        pieces = np.zeros(len(occurrences), dtype=np.int64)      # ids per word: bytes count each
        for who, begin, item in edges:
            pieces[who] += np.where(item >= 0, 1, n_bytes(points[begin]))
        out = np.empty(int(pieces.sum()), dtype=np.int32)
        fill = np.cumsum(pieces)                         # filled from each word's end
        for who, begin, item in edges:
            known = item >= 0
            fill[who[known]] -= 1
            out[fill[who[known]]] = ids_of[item[known]]
            raw = np.flatnonzero(~known)
            if len(raw):
                p = points[begin[raw]]
                w = who[raw]
                n = n_bytes(p)
                fill[w] -= n
                for size in range(1, 5):
                    of = np.flatnonzero(n == size)
                    if len(of):
                        b = np.frombuffer("".join(map(chr, p[of])).encode("utf-8", "surrogatepass"), dtype=np.uint8)
                        out[fill[w[of]][:, None] + np.arange(size)] = byte_ids[b.reshape(-1, size)]
        return out, pieces

    def encode(texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dictionary, index, counts = split_words(texts)
        row = np.repeat(np.arange(len(counts)), counts)
        place = (np.arange(len(index)) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)).astype(np.uint64)
        key = _mixed(_mixed(keys[row] + shift) ^ (place * MIX))
        # words go by length, so that those of a part advance together
        lengths = 1 + pc.utf8_length(dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(lengths, kind="stable")
        part = np.cumsum(lengths[order]) // LATTICE_POINTS
        cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(order)]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        rank = rank[index]
        by_rank = np.argsort(rank, kind="stable")
        bounds = np.searchsorted(rank[by_rank], cuts)
        pieces, found = np.zeros(len(index), dtype=np.int64), []
        for lo, hi, a, b in zip(cuts[:-1], cuts[1:], bounds[:-1], bounds[1:]):
            who = by_rank[a:b]
            words = [SPACE + w for w in dictionary.take(pa.array(order[lo:hi])).to_pylist()]
            ids, pieces[who] = drawn(words, rank[who] - lo, key[who])
            found.append((who, ids))
        out = np.empty(int(pieces.sum()), dtype=np.int32)
        first = np.cumsum(pieces) - pieces
        for who, ids in found:
            n = pieces[who]
            out[np.repeat(first[who] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, np.add.reduceat(np.append(pieces, 0), np.r_[0, np.cumsum(counts)[:-1]]) if len(counts) else pieces
    return encode


def decoder(vocabulary: Vocabulary) -> Callable:
    """A function of ids to the text they stand for."""
    table = [b""] * vocabulary.n_ids
    for i, piece in zip(vocabulary.ids, vocabulary.pieces):
        table[i] = piece.replace(SPACE, " ").encode("utf-8")
    for b, i in enumerate(vocabulary.byte_ids):
        table[i] = bytes([b])
    get = table.__getitem__

    def decode(ids) -> str:
        return b"".join(map(get, ids)).decode("utf-8", "replace")[1:]
    return decode


def row_key(*columns: str) -> Column:
    """64-bit key of a row, of its id columns (null allowed)."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def encode(docs: DataFrame, model_path: str, text_col: str = "text", id_cols: tuple[str, ...] = ("doc_id",),
           keep: list[str] | None = None, seed: int = SEED, temperature: float = TEMPERATURE,
           digest: bool = False) -> DataFrame:
    """``keep`` columns (all but the text, unless given) with the sampled ids of each text:
    ids (array of int) and n_pieces; with ``digest`` instead of ids their SHA-256 (of
    little-endian 32-bit ids) and lossless, whether decoding them gives the text.

    A null text counts as empty and has no pieces.  A row's sample depends on seed, its id
    columns and its text alone: reruns agree, and rows equal in both have equal samples.
    ``keep`` must not name ids, n_pieces or the digest's columns.  An empty table gives an
    empty result.
    """
    vocabulary = load(model_path)
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != text_col] if keep is None else list(keep)
    clash = {"ids", "n_pieces", "ids_sha256", "lossless"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here; rename them first")
    text_name, key_name = free_name(keep, "_text"), free_name(keep, "_key")
    rows = docs.select(*keep, text_of(text_col).alias(text_name), row_key(*id_cols).alias(key_name))
    made = "ids_sha256 string, lossless boolean" if digest else "ids array<int>"
    schema = schema_with(rows.select(*keep), f"n_pieces bigint, {made}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, decode = encoder(vocabulary, seed, temperature), decoder(vocabulary)
        for batch in batches:
            for part in slices(batch, text_name, SMALL_SLICE_BYTES):
                texts = part.column(text_name)
                keys = part.column(key_name).to_numpy().view(np.uint64)
                ids, counts = sample(texts, keys)
                empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
                # an empty text is one empty word, whose only piece is the blank
                ids = ids[~np.repeat(empty, counts)]
                counts = np.where(empty, 0, counts)
                to = np.r_[0, np.cumsum(counts)]
                columns = [part.column(c) for c in keep] + [pa.array(counts, pa.int64())]
                if digest:
                    cut = [ids[a:b] for a, b in zip(to[:-1], to[1:])]
                    columns.append(pa.array([hashlib.sha256(c.astype("<i4").tobytes()).hexdigest() for c in cut]))
                    columns.append(pa.array([decode(c.tolist()) == t for c, t in zip(cut, texts.to_pylist())]))
                else:
                    columns.append(pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text its ids stand for; null ids give a null text."""
    vocabulary = load(model_path)
    keep = [c for c in encoded.columns if c != text_col]
    schema = schema_with(encoded.select(*keep), f"`{text_col}` string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = decoder(vocabulary)
        for batch in batches:
            ids = batch.column(ids_col)
            texts = [None if not x.is_valid else back(x.values.to_numpy(zero_copy_only=False).tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)
    return encoded.select(*keep).mapInArrow(run, schema)
