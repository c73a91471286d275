"""Near-duplicate texts by Order MinHash, verified by banded alignment.

A text is the sequence of its shingles of five neighbouring words (lower case; a shorter
text is one shingle).  Repeated shingles are told apart by their occurrence number.  Each
of SKETCHES hash functions takes the ORDER shingles of least hash and keeps them in the
order of the text (Marcais et al., 2019): texts agree on a sketch if they share these
shingles in the same order, so order counts, as in edit distance.

The similarity of two texts is M / (n + m - M), with M shingles matched in order by the
best alignment of n and m shingles; 0.8 or more is a link.  It is one minus a metric (the
Steinhaus transform of the insertion-deletion distance).

1. Equal token sequences are one text.
2. Texts with an equal sketch form a bucket.  Every member is aligned with the bucket's
   centre, the text that meets most others, which links a large group of copies by a star.
3. Buckets whose members remain in several components are searched whole, in blocks of
   BLOCK members: the shingles that two members share are counted exactly, and only pairs
   of different components with enough of them are aligned.  So no link within a bucket
   is lost, and no pairs but likely links leave a group.
4. Links form classes by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.arrow_text import slices
from salesmart.llm.common import components, packed, schema_with, stored, text_of

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 20
ORDER = 4
#: members of a bucket that one group holds twice at most, and shingles it counts at a time
BLOCK = 512
COLUMNS = 8192
#: shingles of a text that the threshold before the sort lets through, on average
SIEVE = 24.0
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of all words (lower case, between white space), words of each text."""
    parts = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = parts.flatten()
    coded = flat.dictionary_encode()
    words = coded.dictionary.to_pylist()
    of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
    index = coded.indices.to_numpy()
    real = np.array([w != "" for w in words] + [False])[index] if len(words) else np.zeros(0, dtype=bool)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return of_word[index[real]] if len(words) else np.zeros(0, np.uint64), np.bincount(row[real], minlength=len(sizes))


def shingles(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the shingles of texts, and how many each text has."""
    numbers = np.where(counts > 0, np.maximum(counts - WORDS + 1, 1), 0)
    starts = np.cumsum(counts) - counts
    first = np.repeat(starts - (np.cumsum(numbers) - numbers), numbers) + np.arange(int(numbers.sum()))
    size = np.repeat(np.minimum(counts, WORDS), numbers)
    h = size.astype(np.uint64)
    for j in range(WORDS):
        at = np.minimum(first + j, len(words) - 1)
        h = np.where(j < size, _mixed((h ^ words[at]) * MIX + np.uint64(j)), h)
    return h, numbers


def labelled(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Digests of shingles with their occurrence number in the text."""
    key = _mixed(h ^ (row.astype(np.uint64) * MIX))
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, dtype=bool)
    run = np.arange(len(k)) - np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    occurrence = np.empty(len(k), dtype=np.uint64)
    occurrence[order] = run.astype(np.uint64)
    return _mixed(h + occurrence * MIX)


def sketch_keys(x: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Bucket keys (texts x SKETCHES) of texts given by their labelled shingles."""
    n = len(numbers)
    row = np.repeat(np.arange(n), numbers)
    starts = np.cumsum(numbers) - numbers
    want = np.minimum(numbers, ORDER)
    sieve = np.where(numbers > SIEVE, SIEVE / np.maximum(numbers, 1), 1.0)
    limit = np.repeat(np.minimum(sieve * 2.0 ** 64, 2.0 ** 64 - 4096).astype(np.uint64), numbers)
    keys = np.zeros((n, SKETCHES), dtype=np.uint64)
    for f in range(SKETCHES):
        h = _mixed(x ^ _mixed(np.array([f + 1], dtype=np.uint64) * MIX))
        at = np.flatnonzero(h <= limit)
        passed = np.bincount(row[at], minlength=n)
        short = np.flatnonzero(passed < want)               # too few below the limit: take all
        if len(short):
            more = np.concatenate([np.arange(starts[r], starts[r] + numbers[r]) for r in short])
            at = np.union1d(at, more)
            passed = np.bincount(row[at], minlength=n)
        r = row[at]
        order = np.lexsort((at, h[at], r))
        rank = np.arange(len(at)) - np.repeat(np.cumsum(passed) - passed, passed)
        least = np.sort(at[order[rank < ORDER]])            # the least of each text, in its order
        place = np.arange(len(least)) - np.repeat(np.cumsum(want) - want, want)
        grid = np.zeros((n, ORDER), dtype=np.uint64)
        grid[row[least], place] = x[least]
        key = np.full(n, f + 1, dtype=np.uint64)
        for j in range(ORDER):
            key = _mixed((key ^ grid[:, j]) * MIX + np.uint64(j))
        keys[:, f] = key
    return keys


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, raw (the text's own digest), digest of the words, words and bucket keys."""
    for batch in batches:
        for part in slices(batch, "_text"):
            words, counts = tokens(part.column("_text"))
            h, numbers = shingles(words, counts)
            keys = sketch_keys(labelled(h, np.repeat(np.arange(len(numbers)), numbers)), numbers).view(np.int64)
            raw = words.astype("<u8")
            to = np.r_[0, np.cumsum(counts)]
            digests = [xxhash.xxh3_128_hexdigest(raw[a:b].tobytes()) for a, b in zip(to[:-1], to[1:])]
            small = (words >> np.uint64(32)).astype("<u4")
            packed = [small[a:b].tobytes() for a, b in zip(to[:-1], to[1:])]
            some = numbers > 0                               # a text without words is in no bucket
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(some, SKETCHES, 0))], pa.int32()),
                                             pa.array(keys[some].ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("raw"), pa.array(digests, pa.string()), pa.array(counts.astype(np.int32)),
                 pa.array(packed, pa.binary()), lists], names=["id", "raw", "digest", "n", "words", "keys"])


def matched(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Length of the longest common subsequence of two sequences of ids if it is at least
    ``least``, else some number below.  Bit-parallel, in the band of diagonals that an
    alignment with ``least`` matches can reach."""
    head = 0
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    if n:
        differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
        tail = int(differ[0]) if len(differ) else n
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    else:
        tail = 0
    done = head + tail
    # what occurs in one text only cannot match; the band is that of the whole sequences
    pos_a, pos_b = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    below, above = len(a) - (least - done), len(b) - (least - done)
    if below < 0 or above < 0 or min(len(pos_a), len(pos_b)) < least - done:
        return done + max(0, min(len(pos_a), len(pos_b), least - done - 1))
    if not len(pos_a) or not len(pos_b):
        return done
    where: dict[int, int] = {}
    for i, x in enumerate(a[pos_a].tolist()):
        where[x] = where.get(x, 0) | (1 << i)
    # columns of a that a row of b may match: positions from j - above to j + below
    low = np.searchsorted(pos_a, pos_b - above)
    high = np.searchsorted(pos_a, pos_b + below, side="right")
    width = int((high - low).max())
    full = (1 << width) - 1
    state, base, found = full, 0, 0
    rows = len(pos_b)
    for row, (x, lo, hi) in enumerate(zip(b[pos_b].tolist(), low.tolist(), high.tolist())):
        if lo > base:                                        # columns that leave the band
            gone = lo - base
            out = state & ((1 << gone) - 1) if gone < width else state
            found += min(gone, width) - out.bit_count()
            state = (state >> gone) | (full ^ (full >> gone) if gone < width else full)
            base = lo
        if not row & 63 and found + width - state.bit_count() + rows - row < least - done:
            return done + found + width - state.bit_count()   # out of reach
        u = state & (where[x] >> base) & ((1 << (hi - lo)) - 1)
        state = ((state + u) | (state - u)) & full
    return done + found + width - state.bit_count()


@lru_cache(maxsize=512)
def _shingled(packed: bytes) -> np.ndarray:
    words = np.frombuffer(packed, dtype="<u4").astype(np.uint64)
    return shingles(words, np.array([len(words)]))[0]


def similarity(x: bytes, y: bytes) -> tuple[float, bool]:
    """(similarity or an upper bound of it, whether it reaches SIMILARITY) of two texts
    given by their packed words."""
    a, b = _shingled(x), _shingled(y)
    n, m = len(a), len(b)
    least = int(np.ceil(SIMILARITY * (n + m) / (1 + SIMILARITY) - 1e-9))
    if min(n, m) < least:
        return min(n, m) / max(n, m), False
    _, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ids[:n], ids[n:]
    size = int(ids.max()) + 1
    bound = int(np.minimum(np.bincount(a, minlength=size), np.bincount(b, minlength=size)).sum())
    if bound >= least:
        common = matched(a, b, least)
        if common >= least:
            return common / (n + m - common), True
        bound = min(bound, least - 1)
    return bound / (n + m - bound), False


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [similarity(x, y) for x, y in zip(batch.column("wa").to_pylist(), batch.column("wb").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array([s for s, _ in found], pa.float64()),
             pa.array([k for _, k in found], pa.bool_())], names=["a", "b", "similarity", "linked"])


def _compared(pairs: DataFrame, words: DataFrame, name: str) -> DataFrame:
    """(a, b, similarity or its bound, linked) of distinct pairs of digests.  ``words`` has
    one row per digest; texts whose lengths alone forbid a link are settled without it."""
    one = words.select(F.col("digest").alias("a"), F.col("words").alias("wa"))
    two = words.select(F.col("digest").alias("b"), F.col("words").alias("wb"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "wa", "wb")
    return stored(joined.mapInArrow(_verify, "a string, b string, similarity double, linked boolean"), name)


def _overlapping(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one group that are of different components and share as many shingles as
    a link needs.  A group holds one or two blocks of a bucket's open members."""
    sets = [labelled(h, np.zeros(len(h), dtype=np.int64)) for h in map(_shingled, rows["words"])]
    sizes = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df > 1                                      # columns: shingles of two texts at least
    row, column = row[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    left = np.flatnonzero(rows["block"].to_numpy() == rows["bi"].to_numpy())
    right = np.flatnonzero(rows["block"].to_numpy() == rows["bj"].to_numpy())
    overlap = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(shared.sum()), COLUMNS):
        some = (column >= at) & (column < at + COLUMNS)
        grid = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        grid[row[some], column[some] - at] = 1.0
        overlap += grid[left] @ grid[right].T
    need = np.ceil(SIMILARITY * (sizes[left][:, None] + sizes[right]) / (1 + SIMILARITY) - 1e-9)
    root, digest = rows["root"].to_numpy().astype(str), rows["digest"].to_numpy().astype(str)
    i, j = np.nonzero((overlap >= need) & (root[left][:, None] != root[right]))
    x, y = digest[left[i]], digest[right[j]]
    return pd.DataFrame({"a": np.where(x < y, x, y), "b": np.where(x < y, y, x)})


def _links(reps: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b): enough links between texts to connect every class."""
    members = stored(reps.where("n > 0").select("digest", F.explode("keys").alias("key")), "minhash_members")
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(sizes, "key"), "minhash_buckets")
    # the centre of a bucket: the text with the most company over all its buckets
    company = members.groupBy("digest").agg(F.sum("size").alias("company"))
    centres = members.join(company, "digest").groupBy("key").agg(
        F.max(F.struct("company", "digest"))["digest"].alias("centre"))
    members = members.join(centres, "key").select("key", "digest", "centre")
    low, high = F.least("centre", "digest").alias("a"), F.greatest("centre", "digest").alias("b")
    stars = _compared(members.where("digest <> centre").select(low, high).distinct(), words, "minhash_stars")
    links = stars.where("linked").select("a", "b")
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "digest")

    # members whose bucket is still in several components
    members = members.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    several = members.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("r1"), F.max("root").alias("r2"))
    rows = members.join(several.where("size > 2 AND r1 <> r2").select("key", "size"), "key")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("digest"), blocks).cast("int")
    met = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(
        F.least(k, mine).alias("bi"), F.greatest(k, mine).alias("bj")))
    rows = rows.select("key", "digest", "root", mine.alias("block"), F.explode(met).alias("m")).select(
        "key", "digest", "root", "block", "m.*")
    pairs = rows.join(words, "digest").groupBy("key", "bi", "bj").applyInPandas(
        _overlapping, "a string, b string").where("a <> b").distinct()
    pairs = pairs.join(stars.select("a", "b"), ["a", "b"], "left_anti")
    cross = _compared(pairs, words, "minhash_cross")
    return links.unionByName(cross.where("linked").select("a", "b"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, raw, class_id, kept) for every row: the digest of the text, the class's
    least id, and whether the row is the one of its class that stays.

    Texts are equal if their words are (lower case, white space aside); null texts and
    texts without words are all equal.  A class keeps its least id (null last; then least
    digest); rows equal in id and text are all marked kept, :func:`deduplicated` leaves one
    of them.  A class of null ids alone has a null class_id.  Other columns are ignored.
    An empty table gives an empty result.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.md5(text).alias("raw"), text.alias("_text"))
    schema = schema_with(rows.select("id", "raw"), "digest string, n int, words binary, keys array<bigint>")
    rows = stored(rows.mapInArrow(_read, schema), "minhash_rows")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "raw")).alias("best")
    reps = stored(rows.groupBy("digest").agg(best, F.any_value("n").alias("n"), F.any_value("keys").alias("keys")),
                  "minhash_texts")
    words = rows.groupBy("digest").agg(F.any_value("words").alias("words"))
    links = _links(reps.select("digest", "n", "keys"), words)
    root = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = reps.select("digest", "best").join(root.withColumnRenamed("node", "digest"), "digest", "left").select(
        "digest", "best", F.coalesce("root", "digest").alias("root"))
    chosen = placed.groupBy("root").agg(F.min("best").alias("chosen"))
    placed = stored(placed.join(chosen, "root").select("digest", "chosen"), "minhash_classes")
    return rows.select("id", "raw", "digest").join(placed, "digest").select(
        F.col("id").alias(id_col), "raw", F.col("chosen.id").alias("class_id"),
        (F.col("id").eqNullSafe(F.col("chosen.id")) & (F.col("raw") == F.col("chosen.raw"))).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class; all columns are kept."""
    found = classes(docs, id_col, text_col).where("kept").groupBy(F.col(id_col).alias("_id"), F.col("raw").alias("_raw")).agg(
        F.count("*").alias("_rows"))
    found = stored(found, "minhash_kept")
    rows = docs.select(packed(docs.columns).alias("row"), F.col(id_col).alias("id"), F.md5(text_of(text_col)).alias("raw"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw"))
    out = rows.join(found.where("_rows = 1"), same).select("row.*")
    repeated = found.where("_rows > 1")
    if not repeated.isEmpty():              # rows equal in id and text: one of them
        one = rows.join(repeated, same).dropDuplicates(["_id", "_raw"]).select("row.*")
        out = out.unionByName(one)
    return out
