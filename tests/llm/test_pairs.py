"""Embedding join and near-dedup against all pairs."""

import random

import numpy as np
import pytest

from salesmart.llm import embedding_join, order_minhash
from tests.conftest import SF01
from tests.llm import brute

DOCS = "doc_id long, text string, key string, digest string, n int, root string"


@pytest.mark.parametrize("small_groups", [False, True])
def test_embedding_join_equals_all_pairs(spark, monkeypatch, small_groups):
    if small_groups:       # many cells, salts and blocks
        for name, value in (("QUERY_ROWS", 7), ("CANDIDATE_ROWS", 9), ("SALT_ROWS", 40), ("PIVOT_SHARE", 0.7)):
            monkeypatch.setattr(embedding_join, name, value)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(6):                                     # clusters of several widths, one hot
        centre = rng.normal(size=8)
        for _ in range(60 if c == 0 else 12):
            rows.append(((centre + rng.normal(size=8) * 0.12 * (c + 1) / 3).tolist(), 1 + c % 2))
    rows += [(rng.normal(size=8).tolist(), 3) for _ in range(40)]
    rows += [(rows[0][0], 1), (rows[0][0], 1), ([2 * x for x in rows[0][0]], 1), (rows[0][0], 2), (rows[0][0], None)]
    rows += [(None, 1), ([0.0] * 8, 1), ([1.0, None] * 4, 1), ([float("nan")] * 8, 1), ([float("inf")] * 8, 1), ([], 1),
             (rows[0][0][:4], 1), ([1e300] * 8, 1), ([1e-300] * 8, 1)]
    rows = [(1000 - 3 * i, v, b) for i, (v, b) in enumerate(rows)]
    rows.append((rows[0][0], rows[0][1], rows[0][2]))      # a repeated row
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, key string, copies int")
    got = sorted(tuple(r) for r in embedding_join.near_duplicates(df).collect())
    links = brute.unit_links(rows)
    count = np.zeros(len(rows), int)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    root = brute.components(len(rows), links)
    least = {}
    for r, (i, *_) in zip(root, rows):
        least[r] = min(least.get(r, i), i)
    want = sorted((i, int(n), least[r], i == least[r]) for (i, *_), n, r in zip(rows, count, root))
    assert got == want


def test_embedding_join_null_id_and_empty(spark):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (None, [0.0, 1.0], 1)], schema)
    got = {tuple(r) for r in embedding_join.near_duplicates(df).collect()}
    assert got == {(None, 1, 5, False), (5, 1, 5, True), (None, 0, None, False)}
    assert embedding_join.near_duplicates(df.limit(0)).collect() == []


def test_embedding_join_copies_no_vectors_before_comparing(spark, monkeypatch):
    """Vectors all alike far apart, one block, many cells: each was stored once for nearly
    every cell, which filled a task's memory."""
    monkeypatch.setattr(embedding_join, "PIVOT_SHARE", 0.5)
    rows = {}

    def noted(df, name, stored=embedding_join.stored):
        df = stored(df, name)
        rows[name] = df.count()
        return df
    monkeypatch.setattr(embedding_join, "stored", noted)
    x = np.random.default_rng(7).normal(size=(2000, 32))
    x[1::100] = x[0::100] + 0.01
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {tuple(r)[:3] for r in embedding_join.near_duplicates(df).collect()}
    assert got == {(i, int(i % 100 < 2), i - (i % 100 == 1)) for i in range(len(x))}
    assert max(rows.values()) <= len(x), rows


def test_embedding_join_deals_a_large_block(spark, monkeypatch):
    """No task holds more than its rows of either side, whatever the block's size."""
    monkeypatch.setattr(embedding_join, "QUERY_ROWS", 64)
    monkeypatch.setattr(embedding_join, "CANDIDATE_ROWS", 128)

    def bounded(cosine, comparer=embedding_join._comparer):
        compare = comparer(cosine)

        def run(q, c):
            assert len(q) <= 2 * 64 and len(c) <= 2 * 128, (len(q), len(c))
            return compare(q, c)
        return run
    monkeypatch.setattr(embedding_join, "_comparer", bounded)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(500, 16)), rng.normal(size=16) + 0.08 * rng.normal(size=(300, 16))])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = sorted(tuple(r) for r in embedding_join.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    links = brute.unit_links(rows)
    count, root = np.bincount(np.array(links).ravel(), minlength=len(rows)), brute.components(len(rows), links)
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    assert got == [(i, int(count[i]), least[r], i == least[r]) for i, r in enumerate(root)]


def test_embedding_join_decides_in_double_precision(spark):
    rows = []
    for block, c in enumerate([0.93 - 1e-9, 0.93 + 1e-9]):
        rows += [(2 * block, [1.0, 0.0], block), (2 * block + 1, [c, (1 - c * c) ** 0.5], block)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embedding_join.near_duplicates(df).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}


def test_links_fold_into_components():
    rng = np.random.default_rng(9)
    label, u, v = np.arange(300, dtype=np.int32), rng.integers(0, 300, 280), rng.integers(0, 300, 280)
    for at in range(0, 280, 40):
        label = embedding_join._merged(label, u[at:at + 40], v[at:at + 40])
    root = brute.components(300, list(zip(u.tolist(), v.tolist())))
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    assert label.tolist() == [least[r] for r in root]


def test_alignment_equals_dynamic_programming():
    rnd = random.Random(5)
    for _ in range(1500):
        k, n = rnd.choice([2, 5, 20, 60]), rnd.randint(1, 60)
        a = [rnd.randrange(k) for _ in range(n)]
        b = list(a)
        for _ in range(rnd.randint(0, 12)):
            i = rnd.randrange(len(b) + 1)
            if rnd.random() < 0.5 and i < len(b):
                b.pop(i)
            else:
                b.insert(i, rnd.randrange(k))
        if not b:
            continue
        best = brute.lcs(a, b)
        for least in {best, best + 1, max(1, best - 3), max(1, n // 2)}:
            m = order_minhash.matched(np.array(a), np.array(b), least)
            assert m == best if best >= least else m < least


def make_documents():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    def text(n):
        return [rnd.choice(vocab) for _ in range(n)]
    passage, out = text(60), []
    for g in range(8):
        base = text(rnd.choice([6, 30, 120, 300]))
        out.append(" ".join(base))
        for _ in range(30 if g == 0 else 4):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 60))):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            out.append(" ".join(t))
    out += [" ".join(text(20) + passage + text(20)) for _ in range(25)]      # a shared passage
    out += ["rep eat " * 300, "rep eat " * 290, "REP\teat\n" * 300, "a", "a", "A ", "b c", "", " \n", None, "x" * 30000,
            " ".join(text(8000))]
    out.append(out[-1] + " one more")
    return out


@pytest.mark.parametrize("block", [512, 5])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    texts = make_documents()
    rows = [(2000 - i, t, "k", "d", i, "r") for i, t in enumerate(texts)]
    rows.append(rows[3])                                   # a repeated row
    df = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(df).collect()}
    shingles = [brute.word_shingles(r[1]) for r in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if brute.aligned(shingles[i], shingles[j]) >= 0.8]
    least = {}
    root = brute.components(len(rows), links)
    for r, row in zip(root, rows):
        least[r] = min(least.get(r, row[0]), row[0])
    assert got == {row[0]: least[r] for r, row in zip(root, rows)}
    if block == 512:
        left = order_minhash.deduplicated(df).collect()
        assert sorted(r["doc_id"] for r in left) == sorted(set(least.values()))
        assert {tuple(r) for r in left} <= set(rows)


def test_near_duplicates_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f", "", "", 0, ""), (None, "a b c d e f", "", "", 0, ""),
                                (None, "other words", "", "", 0, ""), (4, "Other  words", "", "", 0, "")], DOCS)
    got = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in order_minhash.classes(df).collect()), key=str)
    assert got == [(4, 4, True), (None, 4, False), (None, None, True), (None, None, True)]
    assert len(order_minhash.deduplicated(df).collect()) == 2
    assert order_minhash.classes(df.limit(0)).collect() == []
    assert order_minhash.deduplicated(df.limit(0)).collect() == []


def test_near_duplicates_on_the_documents_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id % 2 = 0").select("doc_id", "text")
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(docs).collect()}
    rows = sorted(tuple(r) for r in docs.collect())
    shingles = [brute.word_shingles(t) for _, t in rows]
    by_first = {}
    for i, s in enumerate(shingles):
        for x in set(s):
            by_first.setdefault(x, []).append(i)
    seen = {(a, b) for group in by_first.values() for k, b in enumerate(group) for a in group[:k]}
    links = [(a, b) for a, b in seen if brute.aligned(shingles[a], shingles[b]) >= 0.8]
    root = brute.components(len(rows), links)
    assert got == {rows[i][0]: rows[r][0] for i, r in enumerate(root)}
