"""Tokenisers, language model and toxicity against plain versions, and the pipeline."""

import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import language_model, mixing, sp_sampling, token_counts, toxicity, vocabulary
from salesmart.llm.common import components
from salesmart.llm.queries import MODEL_PATH
from tests.conftest import SF001, SF01
from tests.llm import brute

HARD = ["", "a", " ", "  x  y ", "▁a▁ ▁", "é😀\n\t\x00 z", "𝔘𝔫𝔦 ", "a" * 3000, " " * 50, "日本語テキスト", "<0x0A><unk> <s>",
        "there the", "tail ", None, "word " * 30000]
WIDE = "doc_id long, text string, _key int, words string, source string"


def wide(spark, texts):
    return spark.createDataFrame([(i, t, 1, "w", "s") for i, t in enumerate(texts)], WIDE)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(400, 400)]
    edges += [(500 + i, 501 + i) for i in range(60)]
    df = spark.createDataFrame(edges + [(None, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    root = brute.components(600, edges)
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {x: root[x] for x in linked}
    assert components(df.limit(0)).collect() == []


def test_sampling_round_trip_and_reruns(spark):
    df = wide(spark, HARD).unionByName(wide(spark, HARD[:3]))
    out = sp_sampling.encode(df.drop("_key"), MODEL_PATH)
    back = sp_sampling.decode(out, MODEL_PATH).collect()
    assert sorted(r["text"] for r in back) == sorted((t or "") for t in HARD + HARD[:3])
    assert all(r["n_pieces"] == len(r["ids"]) for r in back)
    again = {r["doc_id"]: r["ids"] for r in sp_sampling.encode(df.drop("_key").repartition(4), MODEL_PATH).collect()}
    assert all(again[r["doc_id"]] == r["ids"] for r in back)
    other = {r["doc_id"]: r["ids"] for r in sp_sampling.encode(df.drop("_key"), MODEL_PATH, seed=2).collect()}
    assert other[14] != again[14]
    assert all(r["lossless"] for r in sp_sampling.encode(df, MODEL_PATH, keep=["doc_id"], digest=True).collect())
    assert sp_sampling.encode(df.limit(0), MODEL_PATH).collect() == []
    with pytest.raises(ValueError):
        sp_sampling.encode(df.withColumn("ids", F.lit(1)), MODEL_PATH)


def test_sampling_holds_the_lattices_of_few_words(monkeypatch):
    rnd = random.Random(3)
    texts = pa.array([" ".join("".join(rnd.choices("aehinortdé日", k=rnd.randint(3, 12))) for _ in range(2000)) for _ in range(40)])
    keys = np.arange(len(texts), dtype=np.uint64)
    encode = sp_sampling.encoder(vocabulary.load(MODEL_PATH))
    tracemalloc.start()
    ids, counts = encode(texts, keys)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6, f"{peak / 1e6} MB for 0.6 million code points"
    monkeypatch.setattr(sp_sampling, "LATTICE_POINTS", 50_000)
    again, counts_again = encode(texts, keys)
    assert ids.tolist() == again.tolist() and counts.tolist() == counts_again.tolist()


@pytest.mark.parametrize("word", ["there", "aé☃b"])
def test_sampling_follows_the_posterior(word):
    v = vocabulary.load(MODEL_PATH)
    keys = np.arange(30000, dtype=np.uint64) * np.uint64(7919)
    ids, counts = sp_sampling.encoder(v)(pa.array([word] * len(keys)), keys)
    cut = np.r_[0, np.cumsum(counts)]
    got = Counter(tuple(ids[a:b].tolist()) for a, b in zip(cut[:-1], cut[1:]))
    score, number = dict(zip(v.pieces, v.scores)), dict(zip(v.pieces, v.ids))
    low, weights, text = v.scores.min(), {}, vocabulary.SPACE + word

    def walk(i, path, s):
        if i == len(text):
            weights[tuple(int(x) for x in path)] = math.exp(s)
            return
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in score:
                walk(j, path + [number[text[i:j]]], s + score[text[i:j]])
            elif j == i + 1:
                raw = text[i:j].encode()
                walk(j, path + [v.byte_ids[b] for b in raw], s + low * len(raw))
    walk(0, [], 0.0)
    total = sum(weights.values())
    assert set(got) <= set(weights)
    assert all(abs(got[k] / len(keys) - w / total) < 0.015 for k, w in weights.items())


def test_token_counts_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers
    tokenizer = Tokenizer(models.Unigram(list(vocabulary.unigram(MODEL_PATH)), unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    docs = [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    texts = HARD + docs + HARD[:4]
    got = token_counts.token_counts(wide(spark, texts), MODEL_PATH).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert token_counts.token_counts(wide(spark, []), MODEL_PATH).collect() == []


def lm_docs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(10 ** 6, None), (10 ** 6 + 1, ""), (None, "É a\tb  A"), (10 ** 6 + 2, "unseen\x0bwords A a"),
                                  (10 ** 6 + 2, "unseen\x0bwords A a"), (10 ** 6 + 3, "long " * 30000)], docs.schema)
    return docs.unionByName(more).withColumns({"n_tokens": F.lit(1), "block": F.lit(2), "types": F.lit("x")})


def test_language_model_equals_counts(spark, monkeypatch):
    fixed = np.tile([0.5, 0.3, 0.2], (language_model.BUCKETS, 1))
    fixed[0] = [0, 0.6, 0.4]
    monkeypatch.setattr(language_model, "_weights", lambda cells, uniform: fixed)
    df = lm_docs(spark)
    got = language_model.scores(df, held_out=F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    rows = [(r["doc_id"], brute.lm_tokens(r["text"])) for r in df.collect()]
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    c, pairs = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["\1"] + t, t))
    n, types = sum(c.values()), len(c)

    def score(t):
        s = 0.0
        for v, w in zip(["\1"] + t, t):
            cv = len(train) if v == "\1" else c[v]
            a, b, u = fixed[min(1, cv)]
            s += math.log10((a * pairs[v, w] / cv if cv else 0) + b * c[w] / n + u / (types + 1))
        return s
    want = sorted(((i is None, i), len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(math.log10((c[w] + 1) / (n + types + 1)) for w in t), 4), round(score(t), 4)) for i, t in rows)
    have = sorted(((r["doc_id"] is None, r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 4), round(r["score"], 4)) for r in got)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    assert all(abs(a - b) < 2e-4 for h, w in zip(have, want) for a, b in zip(h[4:], w[4:]))
    assert language_model.scores(df.limit(0)).collect() == []


def test_language_model_learns(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 400")
    r = language_model.scores(docs, held_out=F.crc32(F.col("doc_id").cast("string")) % 7 == 2).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]                                 # likelier than the base model on unseen texts
    none = language_model.scores(docs.limit(5), held_out=F.lit(True)).collect()
    assert all(x["train_tokens"] == x["n_known"] == 0 and math.isfinite(x["score"]) for x in none)


def test_automaton_equals_edit_distance():
    terms = ["scum", "idiot", "trash", "worthless", "disgusting", "trashy"]
    automaton, rnd = toxicity.Automaton(terms), random.Random(4)
    words = set(terms)
    for t in terms:
        for _ in range(400):
            w = list(t)
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randrange(len(w) + 1)
                kind = rnd.randrange(4)
                if kind == 0:
                    w.insert(i, rnd.choice("abistrh"))
                elif kind == 1 and w:
                    w.pop(min(i, len(w) - 1))
                elif kind == 2 and w:
                    w[min(i, len(w) - 1)] = rnd.choice("abistrh")
                elif i + 1 < len(w):
                    w[i], w[i + 1] = w[i + 1], w[i]
            words.add("".join(w))
    for w in words:
        near = [(brute.edits(w, t), t) for t in terms]
        want = min((d for d, t in near if d <= toxicity.allowed_edits(t)), default=None)
        got = automaton.match(w)
        assert (got[0] if got else None) == want, w


def test_known_tokens_take_few_bytes_and_change_nothing(monkeypatch):
    import tracemalloc

    rnd = random.Random(5)
    texts = pa.array([" ".join(rnd.choice(["idiot", "idoit", f"w{rnd.randrange(10 ** 9)}", "you"]) for _ in range(400))
                      for _ in range(300)])
    lexicon = toxicity.Lexicon({w: 3.0 for w in toxicity.STARTERS})
    matcher = toxicity.Matcher(lexicon)
    parts = [texts.slice(i, 50) for i in range(0, 300, 50)]
    tracemalloc.start()
    try:
        got = np.concatenate([toxicity.features(p, matcher) for p in parts])
        kept = tracemalloc.get_traced_memory()[0] - got.nbytes
    finally:
        tracemalloc.stop()
    assert kept < 1_500_000                                # 30,000 tokens; 3 MB and more as Python strings
    monkeypatch.setattr(toxicity, "KNOWN_TOKENS", 100)
    forgetful = toxicity.Matcher(lexicon)
    assert (np.concatenate([toxicity.features(p, forgetful) for p in parts * 2]) == np.r_[got, got]).all()
    assert got[:, 0].all() and got[:, 1].all()


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 3 = 0")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    rows = toxicity.scored(docs, model, keep=["doc_id"]).join(labels, "doc_id").where(toxicity.held_out()).collect()
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows)
    assert right >= 0.96 * len(rows)
    assert sum(r["score"] >= 0.5 and r["toxic"] == 0 for r in rows) <= 0.01 * len(rows)
    texts = ["You utter idiot, you worthless scum!", "what an IDIOTT, a worthles one, so pathetc", "a quiet day by the sea", "", None,
             "idiot " * 20000]
    df = spark.createDataFrame([(i, t, 9.9, "s") for i, t in enumerate(texts)], "doc_id long, text string, score double, lang string")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(df, model).collect()}
    assert got[0] >= 0.5 and got[1] >= 0.5 and got[5] >= 0.5 and got[2] < 0.5 and got[3] == got[4] < 0.5


@pytest.mark.parametrize("share", [0.0, 0.02])
def test_fit_converges_on_separable_rows(share):
    """Rows that the features separate (but for mislabelled ones) have finite weights that
    do so."""
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(20000, len(toxicity.FEATURES)))) * (rng.random(20000) < 0.1)[:, None]
    y = ((x[:, 0] > 0) ^ (rng.random(20000) < share)).astype(float)
    w = toxicity._fit(x, y)
    right = ((x @ w[:-1] + w[-1] >= 0) == (x[:, 0] > 0)).mean()
    assert np.isfinite(w).all() and right > 0.99


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "such a stupid moron", "x"), (None, "fine", "y"), (1, None, "z")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, none)
    got = {(r["text"], r["score"] >= 0.5) for r in toxicity.scored(docs, model).collect()}
    assert got == {("such a stupid moron", True), ("fine", False), (None, False)}
    assert toxicity.scored(docs.limit(0), model).collect() == []


def test_neighbours_of_a_term_leave_its_misspellings(spark, monkeypatch):
    """Ordinary words near a term are excluded one by one; the term stays in the automaton."""
    monkeypatch.setattr(toxicity, "ORDINARY", 0.05)
    near = ["closer", "losers", "loses", "poser", "lower", "lose"]
    rows = [(f"a calm day with {near[i % 6]} in it" + (" losrr" if i == 7 else ""), 0) for i in range(60)]
    rows += [("you are a loser and a fool", 1)] * 12
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    lexicon, _ = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    matcher = toxicity.Matcher(lexicon)
    assert [matcher.word(w)[0] for w in near] == [0] * 6
    assert matcher.word("loser")[0] == 1
    assert [matcher.word(w)[0] for w in ("loseer", "lsoer", "losrr")] == [2] * 3     # losrr: in 1 of 60


def test_terms_are_counted_in_all_labelled_rows(spark):
    """A term in few of many toxic documents is learned, though the fit takes a sample; a
    word as frequent in other documents is none."""
    rows = [(f"rude text{i % 7} here" + (" zorgle" if i % 400 == 0 else "") + (" plain" if i % 100 == 0 else ""), 1)
            for i in range(6000)]
    rows += [(f"calm text{i % 7} there" + (" plain" if i % 100 == 0 else ""), 0) for i in range(6000)]
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    lexicon, weights = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"), rows=500)
    assert "zorgle" in lexicon.terms and "plain" not in lexicon.terms and np.isfinite(weights).all()


def test_context_tells_quotation_from_abuse():
    matcher = toxicity.Matcher(toxicity.Lexicon({"moron": 5.0}))
    x = toxicity.features(pa.array(["you are a moron", 'he said "moron" once', "one moron here"]), matcher)
    abusive, quoted = toxicity.FEATURES.index("abusive"), toxicity.FEATURES.index("quoted")
    assert x[0, abusive] > 0 and x[0, quoted] == 0 and x[1, quoted] > 0 and x[2, abusive] == x[2, quoted] == 0


def test_pipeline_stages(spark):
    b = brute
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    state, seen = docs, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, state, SF001)
        path = corpus_pipeline.stored(out, f"test_{name}")
        seen.append(path)
        state = path
    columns = docs.columns
    assert all(s.columns == columns for s in seen[:5])
    rows = [[r.asDict() for r in s.collect()] for s in seen]
    # toxicity: a subset, and the clean labelled documents stay
    assert {r["doc_id"] for r in rows[1]} <= {r["doc_id"] for r in rows[0]}
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in rows[0]} - {r["doc_id"] for r in rows[1]}
    assert sum(toxic.get(i, 1) == 0 for i in gone) <= 1
    # one of each class of near duplicates
    shingles = [b.word_shingles(r["text"]) for r in rows[1]]
    links = [(i, j) for i, j in itertools.combinations(range(len(shingles)), 2) if set(shingles[i][:40]) & set(shingles[j])
             and b.aligned(shingles[i], shingles[j]) >= 0.8]
    root = b.components(len(shingles), links)
    assert len(rows[2]) == len(set(root))
    # no personal data is left, and other texts are untouched
    by_id = {r["doc_id"]: r["text"] for r in rows[2]}
    for r in rows[3]:
        assert not b.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not re.search("[0-9@]", by_id[r["doc_id"]]):
            assert r["text"] == by_id[r["doc_id"]]
    assert len(rows[3]) == len(rows[2])
    # mixing: whole copies near the targets of this stage's input
    size, largest = Counter(), Counter()
    for r in rows[3]:
        n = len(re.findall(b.WORD, r["text"]))
        size[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    want, taken = b.targets(dict(size), mixing.WEIGHTS), Counter()
    for r in rows[4]:
        taken[r["source"]] += len(re.findall(b.WORD, r["text"]))
    assert max(Counter(r["doc_id"] for r in rows[4]).values()) <= 2
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in size)
    # encoding: every row comes back
    back = sp_sampling.decode(seen[5], MODEL_PATH).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((r["doc_id"], r["text"]) for r in rows[4])
    assert corpus_pipeline.run(spark, SF001).count() == len(rows[5])


def test_counts_beyond_32_bits_survive_packing():
    for counts in ([], [0], [1, 0, 255], [2 ** 32 + 7, 3], [2 ** 53, 2 ** 32, 0]):
        n = np.array(counts, dtype=np.int64)
        assert language_model._unplaned(language_model._planes(n)).tolist() == counts
    asked = pa.table({"range": pa.array([0, 0], pa.int32()), "block": pa.array([0, 1], pa.int32()),
                      "words": [language_model._packed(np.array([5, 9], dtype=np.uint64))] * 2,
                      "n_words": [language_model._planes(np.array([2 ** 32 - 1, 1]))] * 2,
                      "pairs": [b""] * 2, "n_pairs": [b""] * 2})
    told = language_model._tell(asked)
    assert [language_model._unplaned(r).tolist() for r in told.column("n_words").to_pylist()] == [[2 ** 33 - 2, 2]] * 2
    assert told.column("types").to_pylist() == [2, 0]


def test_labels_meet_texts_of_any_id(spark):
    """Ids of another type, unknown, null and repeated ids in the labels: as a plain join."""
    rows = [(i, f"you are a zorgle {i % 3}" if i % 4 == 0 else f"a calm day {i % 3}") for i in [*range(-40, 80), 2 ** 40, 3, 3]] + [(None, "zorgle")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(str(i), int(i % 4 == 0)) for i in [*range(-40, 60), 2 ** 40, 4, 500]] + [(None, 1), ("x", 1)],
                                   "doc_id string, toxic int")
    clean = labels.select(F.col("doc_id").try_cast("long").alias("id"), "toxic").where("id IS NOT NULL").dropDuplicates(["id"])
    got = toxicity._maybe_labelled(docs, clean, "doc_id", "text").join(clean, "id")
    want = docs.withColumnRenamed("doc_id", "id").join(clean, "id")
    assert got.count() == want.count() == 103         # 100 ids, 2 ** 40, and 3 twice more
    lexicon, _ = toxicity.learn(docs, labels)
    assert "zorgle" in lexicon.terms and "calm" not in lexicon.terms
