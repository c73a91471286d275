"""PII, licenses, mixing and fingerprints against plain Python or SQL."""

import hashlib
import math
import random
import re
import statistics
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from salesmart.llm import licenses, mixing, pii, queries, weighted_fingerprint
from tests.conftest import SF001
from tests.llm import brute

HARD = ["a@b.c@d.e", "a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8", "1.2.3.4.5.6.7.8.9", "12.3.4", "4111 1111 1111 1111",
        "4111-1111-1111-1111 4111111111111112", "+1 (389) 555-5010 +12", "++1 23 4567 89+1 (2)", "1.2.3.4 +1.2.3.4.5.6.7.8",
        None, "", "é 😀 a@b.cd 😀😀 1.1.1.1", "9" * 5000, "a" * 5000, "1 " * 3000, "...@..@a.b", "256.1.1.1.1",
        "00000000000000000001.1.1.0000000255", "+1 23 4111111111111111", "a\x0bb@c.d\r\n10.0.0.1.", "x" * 60000 + " q@r.st"]
WIDE = "doc_id long, text string, events int, digest string, kind string, id string, spans string"


def wide(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, 1, "d", "k", "i", "s") for i, t in enumerate(texts)], WIDE)


def test_pii_base_spans_equal_plain_patterns(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    df = wide(spark, HARD + [HARD[0]], 10 ** 6).unionByName(
        docs.selectExpr("doc_id", "text", "1 events", "'' digest", "'' kind", "'' id", "'' spans"))
    df = df.unionByName(df.limit(0)).unionByName(df.where("doc_id = 1000001"))       # a repeated row
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    got = pii.span_digests(pii.personal_data(df)).collect()
    assert len(got) == df.count()
    for r in got:
        spans = brute.base_spans(texts[r["doc_id"]])
        n = Counter(k for k, _, _ in spans)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (n["email"], n["ip"], n["card"], n["phone"])
        assert r["base_sha256"] == brute.sha(joined)
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_pii_patterns_discover_unseen_identifiers(spark):
    rnd = random.Random(2)
    rows = [f"Please call me at +1 555 {rnd.randint(1000000, 9999999)} today." for _ in range(12)]
    unseen = ["Please call me at 555-0147x2 today.", "please CALL me at (AB12345) today!"]
    other = ["The year 2024a is in chapter 77777 of it.", "chapter 88888 of it"]
    got = pii.personal_data(wide(spark, rows + unseen + other)).collect()
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if not s["base"]] for r in got}
    for i, (text, token) in enumerate(zip(unseen, ("555-0147x2", "AB12345")), len(rows)):
        assert found[i] == [("phone", text.index(token), text.index(token) + len(token))]
    assert not any(found[i] for i in range(len(rows))) and not any(found[i] for i in range(len(rows) + 2, len(found)))


def test_pii_in_a_text_of_many_matches(spark):
    """Linear in the matches: 20,000 of them in one text."""
    text = " ".join(f"10.{i // 250}.{i % 250}.7" for i in range(20_000))
    (row,) = pii.span_digests(pii.personal_data(wide(spark, [text]))).collect()
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(text))
    assert row["n_ip"] == 20_000 and row["base_sha256"] == brute.sha(joined)


def test_pii_redaction(spark):
    df = wide(spark, HARD)
    out = pii.redacted(df).orderBy("doc_id").collect()
    assert out[0].asDict().keys() == df.first().asDict().keys()
    for r, text in zip(out, HARD):
        spans = sorted((a, b, k) for k, a, b in brute.base_spans(text or ""))
        want, at, end = "", 0, -1
        for a, b, k in spans:
            if a >= end:
                want += (text[at:a] + f"[{k.upper()}]")
                end = b
            end = max(end, b)
            at = end
        assert r["text"] == (None if text is None else want + text[at:])
    assert pii.redacted(df.limit(0)).collect() == []
    assert pii.personal_data(df.limit(0)).collect() == []


def test_licenses_equal_sql(spark):
    texts = ["MIT License\n\nCopyright (c) 2020 Some One\nCopyright 2021 by X\n\n" + licenses.MIT_TEXT.replace(". ", ".\n"),
             licenses.MIT_TEXT.upper().replace("LICENSE", "LICENCE"), "Released under the MIT Licence!", "All rights reserved",
             "prose\nAll rights reserved.\r\n“Released — under the MIT license”\nLicensed under CC BY-NC 4.0.\nmore",
             "© 2024 Me", "", None, "  \n\n ", "All rights reserved. And more.", "copyright law is old", "é" * 20000]
    texts += [texts[4], "Licensed under the Apache License, Version 2.0."]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, digest string, license string")
    df = df.unionByName(df.where("doc_id = 4")).unionByName(spark.createDataFrame([(None, texts[3], "", "")], df.schema))
    got = sorted((tuple(r) for r in licenses.scan(df).collect()), key=str)
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    assert got == sorted(con.sql(licenses.scan_sql()).fetchall(), key=str)
    by_id = {r[0]: r[2:] for r in got}
    assert by_id[0][0] == by_id[1][0] == by_id[2][0] == "MIT" and by_id[4][1:] == (3, "CC-BY-NC-4.0,MIT,proprietary")
    assert by_id[5] == (None, 0, "") and by_id[9][0] is None
    assert licenses.scan(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing_meets_targets(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(int(rnd.paretovariate(0.7)) % 400)),
             rnd.choice(["a", "a", "a", "b", "B", "é", "zz", None])) for i in range(600)]
    rows += [(None, "some words", "b"), (None, "some words", "b"), (5, None, "a"), (6, "", "only empty"), (5, "again \t x", "a"),
             (7, "v " * 3000, "zz")]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id long, text string, source string, target double, copies int")
    got = mixing.mixture_counts(df, seed=seed).collect()
    assert len(got) == len(rows)
    size, largest = Counter(), Counter()
    for _, t, s in rows:
        n = len(re.findall(brute.WORD, t or ""))
        size[s] += n
        largest[s] = max(largest[s], n)
    want = brute.targets(dict(size))
    assert sorted(r["_size"] for r in got) == sorted(len(re.findall(brute.WORD, t or "")) for _, t, _ in rows)
    by_size = {v: s for s, v in size.items()}
    assert len(by_size) == len(size)                        # the fixture tells sources apart
    taken = Counter()
    for r in got:
        s = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(want[s], rel=1e-12) and 0 <= r["copies"] <= 2
        taken[s] += r["copies"] * r["_size"]
    for s in size:
        bound = largest[s] if largest[s] > size[s] / 4 else max(3, 0.01 * want[s])     # whole copies only
        assert abs(taken[s] - want[s]) <= bound
    again = mixing.mixture_counts(df.repartition(5), seed=seed).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    if seed == 1:
        mixed = mixing.mixture(df, seed=seed)
        rows_out = mixing.repeated(mixed, ["doc_id", "text", "source"]).collect()
        assert Counter(rows_out) == Counter({k: v for k, v in _copies(mixed).items() if v})
        assert mixing.mixture_counts(df.limit(0)).collect() == []


def _copies(mixed):
    out = Counter()
    for r in mixed.collect():
        out[(r["doc_id"], r["text"], r["source"])] += r["copies"]
    return out


def test_mixing_inclusion_follows_size(spark):
    """Over many seeds a document is drawn as often as min(1, c sqrt(size)) says."""
    sizes = [1, 4, 9, 16, 25] * 40
    df = spark.createDataFrame([(i, "w " * n, s) for i, n in enumerate(sizes) for s in ("a", "b", "c")],
                               "doc_id long, text string, source string")
    drawn, p = Counter(), {}
    for seed in range(4):
        rows = mixing.mixture_counts(df, weights=(1,), share=0.5, seed=seed).collect()
        for r in rows:
            drawn[r["_size"]] += r["copies"] / (len(rows) / 5) / 4
        t = rows[0]["target"] / rows[0]["source_size"]
        c = t * sum(sizes) / sum(n ** 1.5 for n in sizes)
        p = {n: min(1.0, c * n ** 0.5) for n in set(sizes)}
    assert all(abs(drawn[n] - p[n]) < 0.12 for n in p), (drawn, p)


def edited(texts: dict):
    """(id, text) in descending order to edited text and next text."""
    order = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0), hashlib.md5(x[1].encode()).hexdigest()))
    out = {}
    for i, (k, t) in enumerate(order):
        nxt, h = order[(i + 1) % len(order)][1], len(t) // 2
        out[(k, t)] = (t[:len(t) - h] + nxt[:h], nxt)
    return out


def test_fingerprints(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(None, "abc d"), (None, None), (10 ** 9, "é😀 x y"), (10 ** 9, "é😀 x y"), (10 ** 9, "other"), (10 ** 8, docs[0][1]),
             (10 ** 7, "w " * 40000)]
    df = spark.createDataFrame([(*d, "k", "n", 0) for d in docs], "doc_id long, text string, k string, next string, term int")
    got = weighted_fingerprint.edited_fingerprints(df).collect()
    assert len(got) == len(docs)
    want = edited({(i, t or "") for i, t in docs})
    by_sha = {(i, brute.sha(e)): (t, e, n) for (i, t), (e, n) in want.items()}
    prints, miss = {}, []
    for r in got:
        t, e, n = by_sha[(r["doc_id"], r["edited_sha256"])]
        assert r["n_chars"] == len(t)
        for text, print_ in ((t, r["fingerprint"]), (e, r["edited_fingerprint"])):
            assert prints.setdefault(text, print_) == print_
        for x, y, near in ((t, e, r["near_edited"]), (t, n, r["near_next"])):
            miss.append(near - brute.jaccard(brute.word_pairs(x), brute.word_pairs(y)))
    assert abs(sum(miss) / len(miss)) < 0.02 and sum(map(abs, miss)) / len(miss) < 0.06
    assert weighted_fingerprint.edited_fingerprints(df.limit(0)).collect() == []
    lone = weighted_fingerprint.edited_fingerprints(df.limit(1)).collect()[0]
    assert lone["near_next"] == 1.0


def test_fingerprints_of_skewed_counts(spark):
    """Likeness is generalised Jaccard where one pair makes up most of a text."""
    def many(case, which, i):
        own = [f"s{case}x{i}x{j}" if case == 0 else f"s{case}x{i}x{j}{which}" for j in range(50)]
        return " ".join(own + ([f"hot{case}x{i}"] * 1001 if case == 1 or which == "a" else []))
    pairs = [(case, many(case, "a", i), many(case, "b", i)) for case in range(2) for i in range(25)]
    df = spark.createDataFrame([(k, a, b) for k, (_, a, b) in enumerate(pairs)], "k int, a string, b string")
    prints = weighted_fingerprint.fingerprints(df, "k", ["a", "b"])
    near = {r["k"]: r["near"] for r in prints.select(
        "k", weighted_fingerprint.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    for case in range(2):
        miss = [near[k] - brute.jaccard(brute.word_pairs(a), brute.word_pairs(b))
                for k, (c, a, b) in enumerate(pairs) if c == case]
        assert abs(sum(miss) / len(miss)) < 0.03 and max(map(abs, miss)) < 0.17


def test_fingerprint_draws_are_gamma_based(spark):
    """Every draw is c / (y e^r) of Ioffe's formula, of all terms and for every sample; with
    a weight that covers t, two weights draw the same."""
    weights = [1, 2, 3, 7, 50, 1000]
    df = spark.range(300).select(F.xxhash64("id").alias("x")).select("x", F.explode(F.array(*map(F.lit, weights))).alias("w"))
    rows = df.select("x", "w", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.struct(
        F.xxhash64("x", i).alias("d"), F.xxhash64(F.xxhash64("x", i)).alias("m"),
        weighted_fingerprint._draws(F.col("x"), i, [F.col("w")])[0].alias("got"))).alias("u")).collect()
    rs, cs, bs, same, firsts = [], [], [], {}, {}
    for row in rows:
        for i, (d, m, got) in enumerate(row["u"]):
            v = d % 2 ** 64 >> 12
            e1, e2, e3 = -math.log1p(-(v + 0.5) / 2 ** 52), *[-math.log((h + 0.5) / 2 ** 32) for h in divmod(m % 2 ** 64, 2 ** 32)]
            c, r = e1 + e2, math.log((e1 + e2) / e1) + e3
            b = e3 / r
            t = math.floor(math.log(row["w"]) / r + b)
            a = c / (math.exp(r * (t - b)) * math.exp(r))
            assert abs(got / 2 ** 52 - -math.expm1(-a)) < 1e-9 and (t > 0 or got == v)
            assert same.setdefault((row["x"], i, t), got) == got
            if row["w"] == 1:
                rs.append(r), cs.append(c), bs.append(b)
            firsts.setdefault(row["w"], []).append(a * row["w"])
    # r and c are Gamma(2, 1), b is uniform, independent of each other; a is Exp(w)
    for drawn, mean, var in ((rs, 2, 2), (cs, 2, 2), (bs, 0.5, 1 / 12), *((f, 1, 1) for f in firsts.values())):
        assert abs(statistics.fmean(drawn) / mean - 1) < 0.05 and abs(statistics.pvariance(drawn) / var - 1) < 0.1
    assert all(abs(statistics.correlation(x, y)) < 0.04 for x, y in ((rs, cs), (rs, bs), (cs, bs)))


def test_fingerprints_of_short_texts_fill_every_sample(spark):
    """Every sample is drawn from all terms: none is empty, and two pairs of four differ."""
    texts = [(k, f"a{k} b{k}", f"a{k} c{k}") for k in range(200)]                # pairs (, a) (a, b) (b, ); one is shared
    prints = weighted_fingerprint.fingerprints(spark.createDataFrame(texts, "k int, a string, b string"), "k", ["a", "b"])
    rows = prints.select("a", "b", weighted_fingerprint.likeness(F.col("a"), F.col("b")).alias("near")).collect()
    assert len(rows) == 200 and all(weighted_fingerprint.EMPTY not in r["a"] + r["b"] for r in rows)
    assert abs(statistics.fmean(r["near"] for r in rows) - 1 / 5) < 0.02


def test_fingerprints_are_stored_as_bytes(spark):
    full = "0a" * (2 * weighted_fingerprint.SAMPLES)
    none = weighted_fingerprint.EMPTY * weighted_fingerprint.SAMPLES
    df = spark.createDataFrame([(full,), (none,)], "p string").select("p", weighted_fingerprint._packed(F.col("p")).alias("b"))
    got = df.select("p", F.length("b"), weighted_fingerprint._unpacked(F.col("b"))).collect()
    assert sorted(tuple(r) for r in got) == [(none, None, none), (full, len(full) // 2, full)]


def test_succession_over_many_ranges(spark):
    keys = spark.range(500).select(F.col("id").alias("k")).repartition(7)
    got = {r["k"]: r["next"] for r in weighted_fingerprint.succession(keys, [F.desc("k")]).collect()}
    assert got == {i: (i - 1) % 500 for i in range(500)}


def test_registered_queries():
    assert sorted(queries.REGISTRY) == sorted([
        "op1_embedding_join", "op2_pii_bootstrap", "op3_pareto_mix", "op4_sentencepiece_sampling",
        "op5_lm_deleted_interpolation", "op6_license_digest", "op7_token_count_viterbi", "op8_toxicity_automata",
        "op9_order_minhash", "op10_weighted_fingerprint", "op11_centroid_clusters", "op12_token_files",
        "op13_token_alignment", "pipeline"])
    assert set(queries.ORACLE) <= set(queries.REGISTRY)
