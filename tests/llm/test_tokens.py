"""Token files, token alignment and centroid clusters against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from salesmart.llm import alignment, centroids, queries, token_files
from salesmart.llm.arrow_text import Recent
from salesmart.llm.wavelet import WaveletMatrix, image
from salesmart.session import scratch_path
from tests.conftest import SF001

BLANKS = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0 ᠎  ​    　﻿"
HARD = ["", None, " ", "  ", "a", " a  b   c ", "a\n\nb \n c\n", "don't we'll 'tis 's", "x;\r\ny);\r z", "tab\tand\x0bvt \x0c",
        "Ünï cödé é ́x ΑΣ Σ ΟΔΟΣ. İstanbul ǅ ﬁ", "日本語 のテキスト、ok", "😀😀 a😀b 👩‍👩‍👧 🇩🇪", "▁ x▁y", "<|endoftext|> a<|startoftext|>b <s></s><unk> <0x41>",
        "     b c 　d", "1234567 12 3.14 0x1F", "!!!??? ...--- __ ``", "a" * 3000, "\x00\x01 \x7f\x80", "word " * 5000,
        "a \n b\n  c  \nd", "\n", "\n\nx", " \n", "x   y ", *[f"a{c}b {c} {c}{c} c{c}  !{c}1" for c in BLANKS]]
DOCS = "doc_id long, text string, id string, start int, n_tokens int, place long, digest long, block int"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "i", 1, 2, 3, 4, 5) for i, t in rows], DOCS)


# ------------------------------------------------------------------ wavelet matrix

@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 9), (7, 2), (1000, 300), (70_000, 49_000), (3 * (1 << 15), 70_000)])
def test_wavelet_matrix(n, top):
    rnd = np.random.default_rng(n + top)
    ids = np.minimum(rnd.zipf(1.3, n), top).astype("<u4") if n > 1 else np.full(n, top, dtype="<u4")
    data = image(ids, pa.RecordBatch.from_arrays([pa.array([7, None]), pa.array([n, 0])], names=["id", "n_tokens"]))
    m = WaveletMatrix(data).checked()
    assert m.tokens().tolist() == ids.tolist() and m.docs().to_pydict() == {"id": [7, None], "n_tokens": [n, 0]}
    for i in {0, n // 3, n - 1} if n else ():
        assert m.access(i) == ids[i]
    rnd = random.Random(n)
    for token in {1, 2, 3, top, top + 1, 1 << 20, *(int(ids[rnd.randrange(n)]) for _ in range(5 if n else 0))}:
        where = np.flatnonzero(ids == token)
        assert m.count(token) == len(where)
        a, b = sorted((rnd.randint(0, n), rnd.randint(0, n)))
        assert m.count(token, a, b) == ((where >= a) & (where < b)).sum()
        for k in {0, len(where) // 2, len(where) - 1} if len(where) else ():
            assert m.select(token, k) == where[k]
        if len(where) < 200:
            assert m.occurrences(token, a, b) == where[(where >= a) & (where < b)].tolist()
        with pytest.raises(IndexError):
            m.select(token, len(where))
    with pytest.raises(IndexError):
        m.access(n)
    with pytest.raises(ValueError):
        WaveletMatrix(data[:-1])
    if n > 100:
        bad = bytearray(data)
        bad[-5] ^= 1
        with pytest.raises(ValueError):
            WaveletMatrix(bytes(bad)).checked()
    if n == 70_000:
        assert len(data) < 0.9 * n * 2                        # below 16 bits an id


def whole_ids(texts):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE_PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


@pytest.mark.parametrize("shard", [1, 700, 4_000_000])
def test_token_files(spark, shard):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows = [(10 ** 6 - 3 * i, t) for i, t in enumerate(HARD)] + texts + [(None, "no id"), (None, None), (5, "again"), (5, "again"), (5, "other")]
    df = rows_of(spark, rows)
    manifest = token_files.write_token_files(df, queries.WORD_BPE_PATH, scratch_path(spark, "tests", fresh=True), 2, shard_tokens=shard)
    got = sorted(token_files.read_token_files(manifest, T.LongType()).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows if i is not None)) + [None, None]
    want = Counter((i, tuple(ids)) for (i, _), ids in zip(rows, whole_ids([t for _, t in rows])))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        at += r["n_tokens"]
    assert manifest.count() >= (len(rows) if shard == 1 else 1)
    flat = [x for r in got for x in r["ids"]]
    found = token_files.token_occurrences(manifest, [2, 320, 49405], places=shard > 1).collect()
    for token in (2, 320, 49405):
        of = [r for r in found if r["token"] == token]
        assert sum(r["n"] for r in of) == flat.count(token)
        if shard > 1:
            assert sorted(p for r in of for p in r["places"]) == [i for i, x in enumerate(flat) if x == token]


def test_words_cut_into_pieces_equal_the_library():
    rnd = random.Random(1)
    letters = "aabcdestrmlv''''  \n\t\r0129.,-!<|>/wÀßÉéøÿÖ×÷µªº²½İǅ\u0301\x0b\x1c\x85_~\x7f"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25))) for _ in range(10_000)]
    texts += ["</w> <|endoftext|> <| |> <|startoftext|>x", "it's We'LL I'd ''s '' 'S 'RE", "a" * 5000]
    with open(queries.WORD_BPE_PATH, "rb") as f:
        encode = token_files.word_encoder(f.read())
    got = [np.frombuffer(raw, dtype="<u4").tolist() + [2] for raw in encode(pa.array(texts))]
    assert got == whole_ids(texts)


def test_simple_texts_are_cut_at_once(monkeypatch):
    """Texts of plain letters are cut into pieces, not into words; their ids are the library's."""
    rnd = random.Random(2)
    texts = ["".join(rnd.choices("a'bdelm'rstvLRéÀß' \t\n\r019.,!<|>", k=rnd.randint(0, 40))) for _ in range(5000)]
    texts += ["", "'", "a'", "x'l", "'s", "''s 's's 're're 'rex !'s", "word " * 3000]
    asked = []
    missing = Recent.missing
    monkeypatch.setattr(token_files.Recent, "missing", lambda self, keys: asked.extend(keys) or missing(self, keys))
    with open(queries.WORD_BPE_PATH, "rb") as f:
        encode = token_files.word_encoder.__wrapped__(f.read())
    plain = [t for t in texts if "<|" not in t]
    got = [np.frombuffer(raw, dtype="<u4").tolist() + [2] for raw in encode(pa.array(plain))]
    assert got == whole_ids(plain)
    assert asked and not any(re.search("[a-z][^a-z']|[0-9].", k) for k in asked if k.isascii())
    mixed = [x for t in texts for x in (t, t + "日")]
    assert [np.frombuffer(raw, dtype="<u4").tolist() + [2] for raw in encode(pa.array(mixed))] == whole_ids(mixed)


def test_words_learned_once_in_a_process(monkeypatch):
    with open(queries.WORD_BPE_PATH, "rb") as f:
        blob = f.read()
    assert token_files.word_encoder(blob) is token_files.word_encoder(blob)      # what one task learned serves the next
    monkeypatch.setattr(token_files, "CACHED_WORDS", 50)
    encode = token_files.word_encoder.__wrapped__(blob)
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abé日 '1,", k=rnd.randint(0, 6))) for _ in range(300)] + ["<|endoftext|>", "İx"]
    for _ in range(30):
        texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 40))) for _ in range(rnd.randint(0, 5))]
        got = [np.frombuffer(raw, dtype="<u4").tolist() + [2] for raw in encode(pa.array(texts, pa.string()))]
        assert got == whole_ids(texts)


def test_recent_keeps_what_is_asked_for():
    recent = Recent(3)
    for k in range(100):
        for x in recent.missing(["the", k]):
            assert x == k or k == 0                       # the common key is learned once
            recent.new[x] = x
        assert recent.new["the"] == "the" and len(recent.new) + len(recent.old) <= 8


def test_token_files_of_nothing(spark):
    df = rows_of(spark, [(1, "x")]).limit(0)
    manifest = token_files.write_token_files(df, queries.WORD_BPE_PATH, scratch_path(spark, "tests", fresh=True), 2)
    assert token_files.read_token_files(manifest, T.LongType()).collect() == []


def test_token_files_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    order, at, want = sorted(docs), 0, []
    for i, ids in zip(order, whole_ids([docs[i] for i in order])):
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    got = queries.op12_token_files(spark, SF001)
    assert got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r)[:4] for r in got.collect()) == want


# ------------------------------------------------------------------ alignment

def aligned(texts):
    """Per text the contract's columns, from whole texts and intervals of bytes."""
    a_model = Tokenizer.from_file(queries.BYTE_BPE_PATH)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_PATH)
    alphabet = {}
    n = 0
    for b in range(256):
        if b in [*range(33, 127), *range(161, 173), *range(174, 256)]:
            alphabet[chr(b)] = b
        else:
            alphabet[chr(256 + n)] = b
            n += 1
    out, links_of = [], []
    for text in texts:
        text = text or ""
        raw = (" " + text).encode()
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_raw = [bytes(alphabet[c] for c in a_model.id_to_token(i)) for i in a]
        b_raw = [bytes([int(b_model.id_to_piece(i)[3:-1], 16)]) if b_model.is_byte(i)
                 else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            out.append([0, 0, 0, 0, ""])
            links_of.append([])
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in a_raw]).tolist(), np.cumsum([len(x) for x in b_raw]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for end in common:
            i2, j2 = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        links, j = [], 0
        for i, end in enumerate(ends_a):
            start = end - len(a_raw[i])
            while ends_b[j] <= start:
                j += 1
            k = j
            while k < len(b) and ends_b[k] - len(b_raw[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        out.append([len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        links_of.append(links)
    count = Counter(x for links in links_of for x in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(*o[:4], sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), o[4])
            for o, links in zip(out, links_of)]


def test_units_cut_like_the_pattern():
    cut = re.compile(f"(?<=[^{alignment.BLANKS}])(?=[ \n])")
    rnd = random.Random(4)
    texts = [t or "" for t in HARD] + ["".join(rnd.choices("aé日😀 \n" + alignment.BLANKS, k=rnd.randint(0, 30))) for _ in range(3000)]
    for part in (texts, texts[:1], [], [""], [" "]):
        units, index, n = alignment.cut_units(pa.array(part, pa.string()))
        want = [cut.split(" " + t) if t else [] for t in part]
        assert len(set(units)) == len(units) and n.tolist() == [len(w) for w in want]
        assert [units[i] for i in index] == [u for w in want for u in w]


def test_units_learned_once_in_a_process(monkeypatch):
    blobs = []
    for path in (queries.BYTE_BPE_PATH, queries.MODEL_PATH):
        with open(path, "rb") as f:
            blobs.append(f.read())
    aligner = alignment._aligner(*blobs)
    assert alignment._aligner(*blobs) is aligner
    units = [" a", " b\u0301", "\nc", " d ", " \ufb01x", " \x00", " word"]
    together = aligner.alignments(units)
    monkeypatch.setattr(alignment, "CACHED_UNITS", 2)
    small = alignment.Aligner(*blobs)
    assert [small.alignments([u])[0] for u in units * 2] == together * 2 and len(small.known.old) <= 3


def test_alignment_blocks_are_small():
    """A block's row takes fewer bytes than its texts, and numbers come back as they were."""
    blobs = [open(p, "rb").read() for p in (queries.BYTE_BPE_PATH, queries.MODEL_PATH)]
    rnd = random.Random(3)
    words = ["".join(rnd.choices("etaoinshr", k=rnd.randint(2, 7))) for _ in range(3000)]
    texts = pa.array([" ".join(rnd.choices(words, k=400)) for _ in range(200)])
    row = alignment._block(0, pa.array(range(200)), texts, alignment._aligner(*blobs))
    assert row.nbytes < texts.nbytes
    for top in (0, 255, 256, 65535, 65536, 2 ** 33):
        assert alignment._unpacked(alignment._packed(np.array([top, 0, 1]))).tolist() == [top, 0, 1]
    assert alignment._unpacked(alignment._packed(np.zeros(0, np.int64))).tolist() == []


@pytest.mark.parametrize("batch", [3, 1000])
def test_alignment_equals_intervals(spark, batch):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(80).collect()]
    rows = [(10 ** 6 - i, t) for i, t in enumerate(HARD)] + texts + [(None, "no id"), (None, None), (5, "again and again"), (5, "again and again")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = alignment.alignments(rows_of(spark, rows), queries.BYTE_BPE_PATH, queries.MODEL_PATH).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = [(i, *w) for (i, _), w in zip(rows, aligned([t for _, t in rows]))]
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_alignment_of_nothing_and_query(spark):
    df = rows_of(spark, [(1, "x")])
    assert alignment.alignments(df.limit(0), queries.BYTE_BPE_PATH, queries.MODEL_PATH).collect() == []
    empty = alignment.alignments(rows_of(spark, [(1, ""), (2, None)]), queries.BYTE_BPE_PATH, queries.MODEL_PATH).collect()
    assert sorted(tuple(r) for r in empty) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, *w) for (i, _), w in zip(rows, aligned([t for _, t in rows]))]
    assert Counter(tuple(r) for r in queries.op13_token_alignment(spark, SF001).collect()) == Counter(want)


# ------------------------------------------------------------------ centroid clusters

def clustered(rows, k=8, rounds=10):
    """(id, cluster, distance, cluster_inertia, inertia, sha) in Python's integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(Fraction(float(x)) * 1024 // 1) for x in v]))
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"3:{r[0]}") if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]
    def assign():
        out = []
        for _, v in kept:
            d = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centres]
            out.append((min(d), d.index(min(d))))
        return out
    for _ in range(rounds):
        of = assign()
        for j in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, of) if c == j]
            if mine:
                centres[j] = [sum(col) // len(mine) for col in zip(*mine)]
    of = assign()
    total = Counter()
    for d, c in of:
        total[c] += d
    return Counter((i, c, d, total[c], sum(total.values()), sha(",".join(map(str, centres[c])))) for (i, _), (d, c) in zip(kept, of))


def vectors(kind, n=120):
    rng = np.random.default_rng(4)
    if kind == "plain":
        v = [(rng.normal(size=64) / 8).tolist() for _ in range(n)]
    elif kind == "ties":                    # whole multiples, many equal distances and empty clusters
        v = [(np.eye(64)[i % 3] * (i % 5) / 1024).tolist() for i in range(n)]
    elif kind == "one":
        v = [[0.25] * 64] * 30
    else:                                   # few, and of a large size
        v = [(rng.normal(size=64) * 1e5 / 4).tolist() for _ in range(5)]
    rows = list(enumerate(v))
    rows += [(900, None), (901, v[0][:63]), (902, v[0] + [1.0]), (903, [None] + v[0][1:]), (904, [float("nan")] + v[0][1:]),
             (905, [float("-inf")] + v[0][1:]), (906, []), (None, v[0]), (0, v[0]), (0, v[1])]
    return rows


@pytest.mark.parametrize("kind", ["plain", "ties", "one", "few"])
def test_clusters_equal_brute_force(spark, kind):
    rows = vectors(kind)
    df = spark.createDataFrame([(*r, "c", 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster string, row int, id string")
    got = centroids.clusters(df.repartition(5))
    assert got.columns == ["vec_id", "embedding", "row", "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter((r["vec_id"], *tuple(r)[4:]) for r in got.collect()) == clustered(rows)


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")
    assert centroids.clusters(df).collect() == [] and centroids.clusters(df.limit(0)).collect() == []
    with pytest.raises(Exception, match="2\\^27"):
        centroids.clusters(df.select("vec_id", F.array_repeat(F.lit(1e30), 64).alias("embedding"))).collect()


def test_clusters_query_equals_sql(spark):
    got = queries.op11_centroid_clusters(spark, SF001)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    want = con.sql(queries.ORACLE["op11_centroid_clusters"])
    assert want.columns == got.columns
    assert Counter(want.fetchall()) == Counter(tuple(r) for r in got.collect())


def test_simplex_bounds_hold_and_filter():
    rng = np.random.default_rng(1)
    centre = rng.integers(-300, 300, (8, 64))
    x = centre[rng.integers(0, 8, 2000)] + rng.integers(-60, 60, (2000, 64))
    s = centroids.Simplex(np.concatenate([centre, centre[:2], centre[:1] * 2 - centre[1:2]]))     # repeated and dependent pivots
    assert len(s.base) == 7
    moved = centre + rng.integers(-40, 40, centre.shape)
    lower, upper = centroids.bounds(s.apexes(x), s.apexes(moved))
    d = centroids.squared(x, moved)
    assert (lower <= d * (1 + 1e-9) + 1e-3).all() and (upper >= d * (1 - 1e-9) - 1e-3).all()
    which, best, compared = centroids.nearest(x, s.apexes(x), moved, s.apexes(moved))
    assert (which == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert compared < 0.3 * d.size                                    # most centroids are never compared
