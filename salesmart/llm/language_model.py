"""Language-model scores by deleted interpolation of bigram, unigram and uniform
probabilities.

Tokens are the white-space words of a text with A-Z lowered, then one end.  The model is
P(w | v) = a_k c(v w)/c(v) + b_k c(w)/N + (1 - a_k - b_k)/(V + 1), with weights for each
bucket k of the context's frequency (its binary logarithm).  The weights are learned by
expectation-maximisation on held-out counts: every training bigram is scored by the counts
of the corpus without its own occurrence (deleted), so all of the training data serves
both as counts and as held-out data.

Counts and scores go through three grouped steps, so that no single n-gram occurrence is a
row of a shuffle.  Documents are dealt to blocks; a block sends its distinct n-grams and
their training counts, packed and cut by ranges of their digests, to the ranges' tasks;
these add the counts of all blocks and send each block the totals of what it asked for;
the block then looks up its own tokens.  Everything gathered grows with the corpus, and
blocks and ranges are of bounded size (BLOCK_CHARS), their number growing instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import schema_with, shuffles_of, stored, text_of

#: characters of text in a block, about; blocks there are at least; blocks to a range
BLOCK_CHARS = 8_000_000
LEAST_BLOCKS = 32
BLOCKS_PER_RANGE = 4
#: partitions of the exchanges, at most (beyond, a task sorts more blocks, spilling)
MOST_PARTITIONS = 100_000
BUCKETS = 40
EM_STEPS = 200
EM_TOLERANCE = 1e-9
END = np.uint64(xxhash.xxh64_intdigest(b"\x00end"))
START = np.uint64(xxhash.xxh64_intdigest(b"\x00start"))
MIX = np.uint64(0x9E3779B97F4A7C15)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of all tokens, ends included, and the tokens of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = coded.dictionary.to_pylist()
    digest = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
    real = np.fromiter((w != "" for w in words), dtype=bool, count=len(words))
    index = coded.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    index, row = index[real[index]], row[real[index]]
    counts = np.bincount(row, minlength=len(sizes)) + 1
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    ends = np.cumsum(counts) - 1
    inner = np.ones(len(out), dtype=bool)
    inner[ends] = False
    out[ends] = END
    out[inner] = digest[index]
    return out, counts


def _bigrams(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """48-bit digests of each token with the one before it in its text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(counts) - counts] = START
    h = (before * MIX) ^ tokens
    h ^= h >> np.uint64(32)
    h *= MIX
    return (h ^ (h >> np.uint64(29))) >> np.uint64(16)


def _planes(counts: np.ndarray) -> bytes:
    """Counts in as many bytes each (up to 8) as the largest needs, byte by byte of their
    significance, which compresses well."""
    if not len(counts):
        return b""
    width = max(1, -(-int(counts.max()).bit_length() // 8))
    raw = counts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(raw.T).tobytes()


def _unplaned(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, dtype=np.uint64)
    planes = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :raw[0]] = planes.T
    return out.view("<u8").ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Sorted digests as the first and the steps between them, in as few bytes each as the
    largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys)
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
    raw = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + np.ascontiguousarray(raw).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, dtype=np.uint64)
    width = raw[0]
    steps = np.frombuffer(raw, dtype=np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(steps) + 1, 8), dtype=np.uint8)
    wide[0] = np.frombuffer(raw, dtype=np.uint8, count=8, offset=1)
    wide[1:, :width] = steps
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def _cuts(keys: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where sorted digests of so many bits pass from one range to the next."""
    edges = np.array([(i << bits) // ranges for i in range(1, ranges)], dtype=np.uint64)
    return np.r_[0, np.searchsorted(keys, edges), len(keys)]


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


ASKED = "range int, block int, words binary, n_words binary, pairs binary, n_pairs binary"
TOLD = "block int, range int, n_words binary, n_pairs binary, types bigint"


def _asker(ranges: int):
    def ask(docs: pa.Table) -> pa.Table:
        tokens, counts = _tokens(_one(docs.column("_text")))
        train = np.repeat(~docs.column("held_out").to_numpy(), counts)
        cuts, found = {}, {}
        for name, bits in (("words", 64), ("pairs", 48)):
            distinct, where = np.unique(tokens if bits == 64 else _bigrams(tokens, counts), return_inverse=True)
            found[name] = distinct, np.bincount(where[train], minlength=len(distinct))
            cuts[name] = _cuts(distinct, bits, ranges)
        # ranges of which the block has nothing get no row: rows are at most its n-grams
        asked = np.flatnonzero((np.diff(cuts["words"]) > 0) | (np.diff(cuts["pairs"]) > 0))
        out = {}
        for name, (distinct, n) in found.items():
            spans = list(zip(cuts[name][asked], cuts[name][asked + 1]))
            out[name] = pa.array([_packed(distinct[a:b]) for a, b in spans], pa.binary())
            out[f"n_{name}"] = pa.array([_planes(n[a:b]) for a, b in spans], pa.binary())
        block = docs.column("block")[0].as_py()
        return pa.table({"range": pa.array(asked, pa.int32()), "block": pa.array([block] * len(asked), pa.int32()), **out})
    return ask


def _tell(asked: pa.Table) -> pa.Table:
    """Totals over all blocks of a range's n-grams, for each block in its own order."""
    totals, types = {}, 0
    for name in ("words", "pairs"):
        keys = [_unpacked(r.as_py()) for r in asked.column(name)]
        sizes = np.array([len(k) for k in keys])
        keys = np.concatenate(keys)
        _, where = np.unique(keys, return_inverse=True)
        del keys
        n = np.concatenate([_unplaned(r.as_py()) for r in asked.column(f"n_{name}")])
        total = np.bincount(where, weights=n).astype(np.int64) if len(n) else np.zeros(0, np.int64)
        del n
        if name == "words":
            types = int((total > 0).sum())
        cut = np.r_[0, np.cumsum(sizes)]
        totals[name] = [_planes(total[where[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
    rows = asked.num_rows
    return pa.table({"block": _one(asked.column("block")), "range": _one(asked.column("range")),
                     "n_words": pa.array(totals["words"], pa.binary()), "n_pairs": pa.array(totals["pairs"], pa.binary()),
                     "types": pa.array([types] + [0] * (rows - 1), pa.int64())})


def _looked_up(docs: pa.Table, told: pa.Table) -> pa.Table:
    """Per document its tokens' counts: c(w) and c(v w)."""
    tokens, counts = _tokens(_one(docs.column("_text")))
    told = told.sort_by("range")
    c = []
    for name, keys in (("n_words", tokens), ("n_pairs", _bigrams(tokens, counts))):
        _, where = np.unique(keys, return_inverse=True)
        c.append(np.concatenate([_unplaned(r) for r in told.column(name).to_pylist()])[where])
    cut = np.r_[0, np.cumsum(counts)]
    spans = list(zip(cut[:-1], cut[1:]))
    types = [int(pc.sum(told.column("types")).as_py())] + [0] * (docs.num_rows - 1)
    return pa.table({"id": _one(docs.column("id")), "held_out": _one(docs.column("held_out")),
                     "n_tokens": pa.array(counts, pa.int64()), "types": pa.array(types, pa.int64()),
                     "c1": pa.array([_planes(c[0][a:b]) for a, b in spans], pa.binary()),
                     "c2": pa.array([_planes(c[1][a:b]) for a, b in spans], pa.binary())})


def _columns(batch: pa.RecordBatch, starts: int):
    """c(w), c(v), c(v w) of all tokens of a batch, tokens of each document.  The context
    of a first token is the start, which each training document (``starts``) has once."""
    counts = batch.column("n_tokens").to_numpy()
    c1 = np.concatenate([_unplaned(r) for r in batch.column("c1").to_pylist()]).astype(np.int64)
    c2 = np.concatenate([_unplaned(r) for r in batch.column("c2").to_pylist()]).astype(np.int64)
    context = np.empty_like(c1)
    context[1:] = c1[:-1]
    context[np.cumsum(counts) - counts] = starts
    return c1, context, c2, counts


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 c)."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _weights(cells: pd.DataFrame, uniform: float) -> np.ndarray:
    """(BUCKETS, 3): weights of bigram, unigram and uniform, by EM on the cells."""
    out = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    for bucket, c in cells.groupby("bucket"):
        p = np.c_[c["f2"] / c["n"], c["f1"] / c["n"], np.full(len(c), uniform)]
        n = c["n"].to_numpy(dtype=float)
        w = np.full(3, 1 / 3)
        for _ in range(EM_STEPS):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            new = (share * n[:, None]).sum(axis=0) / n.sum()
            done = np.abs(new - w).max() < EM_TOLERANCE
            w = new
            if done:
                break
        w = np.maximum(w, [0.0, 0.0, 1e-6])                  # every token stays possible
        out[int(bucket)] = w / w.sum()
    out[0] = [0.0, *(out[0, 1:] / out[0, 1:].sum())]         # an unseen context says nothing
    return out


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """Scores of all whole texts: ``id_col``, held_out, n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (add-one unigram) and score (log10 probability).

    ``held_out`` marks the rows not learned from (default: none; null counts as false).  A
    null or empty text is the end alone.  Every row counts as a document, equal ones
    included; null and repeated ids are reported as they come.  Without training rows all
    tokens are unknown and equally likely.  Other columns are ignored.  An empty table
    gives an empty result.
    """
    out_held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    size = docs.agg(F.sum(F.length(text_of(text_col))).alias("n")).first()["n"] or 0
    blocks = max(LEAST_BLOCKS, -(-size // BLOCK_CHARS))
    ranges = max(LEAST_BLOCKS, -(-blocks // BLOCKS_PER_RANGE))
    text = text_of(text_col)
    rows = docs.select(F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(blocks)).cast("int").alias("block"),
                       F.col(id_col).alias("id"), out_held.alias("held_out"), text.alias("_text"))
    asked = rows.groupBy("block").applyInArrow(_asker(ranges), ASKED)
    told = asked.groupBy("range").applyInArrow(_tell, TOLD)
    counted = rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _looked_up, schema_with(rows.select("id", "held_out"), "n_tokens bigint, types bigint, c1 binary, c2 binary"))
    # a task sorts and holds the blocks of its partition: a few, never as many as bytes allow
    with shuffles_of(docs.sparkSession, min(blocks, MOST_PARTITIONS)):
        counted = stored(counted, "lm_counts")

    total = counted.agg(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))).alias("tokens"),
                        F.count_if(~F.col("held_out")).alias("docs"), F.sum("types").alias("types")).first()
    n, starts, types = total["tokens"] or 0, total["docs"] or 0, total["types"] or 0
    uniform = 1.0 / (types + 1)

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Training tokens by bucket and rounded logarithms of their deleted estimates."""
        for batch in batches:
            if not batch.num_rows:
                continue
            c1, context, c2, _ = _columns(batch, starts)
            f2 = (c2 - 1) / np.maximum(context - 1, 1)
            f1 = (c1 - 1) / max(n - 1, 1)
            q2 = np.where(f2 > 0, np.rint(8 * np.log2(np.maximum(f2, 1e-300))), -5000).astype(np.int64)
            q1 = np.where(f1 > 0, np.rint(8 * np.log2(np.maximum(f1, 1e-300))), -5000).astype(np.int64)
            key = (_bucket(context).astype(np.int64) * 10_000 - q2) * 10_000 - q1
            keys, where = np.unique(key, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.bincount(where, minlength=len(keys)).astype(np.int64)),
                 pa.array(np.bincount(where, weights=f2, minlength=len(keys))),
                 pa.array(np.bincount(where, weights=f1, minlength=len(keys)))], names=["key", "n", "f2", "f1"])

    training = counted.where("NOT held_out").select("n_tokens", "c1", "c2")
    cells = training.mapInArrow(cell, "key bigint, n bigint, f2 double, f1 double").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("n", "f2", "f1")]).toPandas()      # bounded: buckets x rounded logarithms
    cells["bucket"] = cells["key"] // 100_000_000 if len(cells) else []
    weights = _weights(cells, uniform)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c1, context, c2, counts = _columns(batch, starts)
            first = np.cumsum(counts) - counts
            base = np.log10((c1 + 1.0) / (n + types + 1.0))
            w = weights[_bucket(context)]
            p = w[:, 0] * c2 / np.maximum(context, 1) + w[:, 1] * c1 / max(n, 1) + w[:, 2] * uniform
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), batch.column("n_tokens"),
                 pa.array(np.add.reduceat((c1 > 0).astype(np.int64), first)), pa.array(np.full(len(counts), n, dtype=np.int64)),
                 pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(np.log10(p), first))],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = schema_with(counted.select("id", "held_out", "n_tokens"),
                         "n_known bigint, train_tokens bigint, base_score double, score double")
    return counted.drop("types").mapInArrow(score, schema).withColumnRenamed("id", id_col)
