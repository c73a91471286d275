"""Toxicity by a lexicon with misspellings, read in context.

Lexicon.  Terms are learned from labelled training rows: words, and beginnings that many
words share, far more frequent in toxic than in other documents; a short fixed list joins
them.  Matching.  Levenshtein automata (with transpositions) run over the trie of all
terms at once; the product is determinised as words need it, so a word costs a few table
look-ups until it is out of reach of every term.  Neighbours of a term that are ordinary
words in the training rows do not count as misspellings.  Context.  A hit counts as abuse
or as quotation by the words in a window around it (second person before or after it;
quotation marks, verbs of saying).  Score.  A logistic regression of these counts, fitted
to at most LABELLED_ROWS labelled rows (words are counted in all of them); every document is
scored whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.arrow_text import SMALL_SLICE_BYTES, slices
from salesmart.llm.common import free_name, schema_with, small_batches, stored, text_of

#: labelled rows that the classifier is fitted to, at most (chosen by a digest of the id)
LABELLED_ROWS = 40_000
#: words each side of a hit that make its context
WINDOW = 5
#: toxic documents a term must occur in, how much more frequent than in other documents it
#: must be, and the chance that any word passes the test of that without a difference
LEAST_DOCUMENTS = 5
RATIO = 20.0
SIGNIFICANCE = 0.05
#: tokens whose match a task remembers from batch to batch
KNOWN_TOKENS = 200_000
#: bits of the filter of labelled ids that a scan of the texts carries (8 MB at most)
FILTER_BITS = 1 << 26
PREFIXES = range(4, 9)
#: different words that must share a beginning before it is a term
EXTENSIONS = 5
#: share of other documents that a word near a term must occur in to be an ordinary word
#: and no misspelling
ORDINARY = 2e-5
RIDGE = 0.5

# Terms known beforehand, second persons, and verbs of saying.
STARTERS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "imbecile"]
ADDRESS = {"you", "your", "youre", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "tu", "te", "ton", "vous",
           "votre", "tú", "usted", "tus"}
SAYING = {"said", "says", "say", "called", "calls", "wrote", "writes", "quote", "quoted", "word", "term", "sagte",
          "sagt", "nannte", "wort", "dit", "appelle", "mot", "dijo", "dice", "palabra"}
QUOTES = "\"“”„«»‘`"
FEATURES = ["hits", "misspelt", "begun", "distinct", "density", "strength", "abusive", "quoted", "length"]

SUBWORD = re.compile(r"[^\W_]+")


def allowed_edits(term: str) -> int:
    return 0 if len(term) <= 4 else 1 if len(term) <= 7 else 2


class Automaton:
    """The lexicon's trie under Levenshtein automata: best (edits, term) of a word."""

    def __init__(self, terms: list[str]):
        self.children, self.term, self.reach = [{}], [None], [0]
        for i, term in enumerate(terms):
            node, most = 0, allowed_edits(term)
            self.reach[0] = max(self.reach[0], most)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], most)
            self.term[node] = i
        self.most = [allowed_edits(t) for t in terms]
        start = self._closed({(0, 0, "")})
        self.states, self.numbers = [start], {start: 0}
        self.steps: list[dict[str, int]] = [{}]
        self.accepts = [self._accept(start)]

    def _closed(self, states: set) -> frozenset:
        """With letters of the term that the word leaves out."""
        todo = list(states)
        while todo:
            node, edits, wants = todo.pop()
            if not wants:
                for child in self.children[node].values():
                    new = (child, edits + 1, "")
                    if edits + 1 <= self.reach[child] and new not in states:
                        states.add(new)
                        todo.append(new)
        return frozenset(states)

    def _accept(self, states: frozenset):
        found = [(e, self.term[n]) for n, e, wants in states
                 if not wants and self.term[n] is not None and e <= self.most[self.term[n]]]
        return min(found, default=None)

    def _step(self, states: frozenset, c: str) -> frozenset:
        out = set()
        for node, edits, wants in states:
            if wants:                                     # second letter of a transposed pair
                if c == wants:
                    out.add((node, edits, ""))
                continue
            for letter, child in self.children[node].items():
                if letter == c:
                    out.add((child, edits, ""))
                elif edits + 1 <= self.reach[child]:
                    out.add((child, edits + 1, ""))
                    after = self.children[child].get(c)
                    if after is not None and edits + 1 <= self.reach[after]:
                        out.add((after, edits + 1, letter))
            if edits + 1 <= self.reach[node]:
                out.add((node, edits + 1, ""))
        return self._closed(out)

    def match(self, word: str):
        """(edits, index of the term) of the nearest term, or None."""
        state = 0
        for c in word:
            to = self.steps[state].get(c)
            if to is None:
                new = self._step(self.states[state], c)
                to = -1 if not new else self.numbers.get(new)
                if to is None:
                    to = self.numbers[new] = len(self.states)
                    self.states.append(new)
                    self.steps.append({})
                    self.accepts.append(self._accept(new))
                self.steps[state][c] = to
            if to < 0:
                return None
            state = to
        return self.accepts[state]


@dataclass
class Lexicon:
    """Terms and beginnings with their log-odds, and ordinary words near the terms."""
    terms: dict[str, float]
    prefixes: dict[str, float] = field(default_factory=dict)
    ordinary: set[str] = field(default_factory=set)


class Matcher:
    """Finds what a token is: 0 no hit, 1 a term, 2 a misspelling, 3 a beginning."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.names = sorted(lexicon.terms)
        self.automaton = Automaton(self.names)
        self.lengths = sorted({len(p) for p in lexicon.prefixes})
        # tokens lately met stay in Arrow, a few bytes each: as Python strings they would
        # take many times that, and a worker does not give such memory back
        self.known, self.kind, self.strength = pa.array([], pa.string()), np.zeros(0, np.int8), np.zeros(0)

    def tokens(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Kind and strength of each of the distinct tokens; KNOWN_TOKENS of them are
        remembered, about."""
        at = pc.fill_null(pc.index_in(tokens, value_set=self.known), -1).to_numpy(zero_copy_only=False)
        new = at < 0
        found = [self.token(t) for t in tokens.filter(pa.array(new)).to_pylist()]
        kind, strength = np.empty(len(at), np.int8), np.empty(len(at))
        kind[~new], strength[~new] = self.kind[at[~new]], self.strength[at[~new]]
        kind[new], strength[new] = [k for k, _ in found], [s for _, s in found]
        if len(self.known) + len(found) > KNOWN_TOKENS:
            self.known, self.kind, self.strength = tokens, kind, strength
        elif found:
            self.known = pa.concat_arrays([self.known, tokens.filter(pa.array(new))])
            self.kind, self.strength = np.r_[self.kind, kind[new]], np.r_[self.strength, strength[new]]
        return kind, strength

    def word(self, word: str) -> tuple[int, float]:
        strength = self.lexicon.terms.get(word)
        if strength is not None:
            return 1, strength
        for n in self.lengths:
            if len(word) > n and word[:n] in self.lexicon.prefixes:
                return 3, self.lexicon.prefixes[word[:n]]
        near = self.automaton.match(word)
        if near is not None and word not in self.lexicon.ordinary:
            return 2, self.lexicon.terms[self.names[near[1]]] / (1.0 + near[0])
        return 0, 0.0

    def token(self, token: str) -> tuple[int, float]:
        best = (0, 0.0)
        for word in subwords(token):
            found = self.word(word)
            if found[0] and found[1] > best[1]:
                best = found
        return best


def subwords(token: str) -> list[str]:
    if not token.isascii():
        token = unicodedata.normalize("NFC", token)
    return SUBWORD.findall(token)


def _tokens(texts: pa.Array):
    """Lower-case tokens between white space: the distinct ones, index of each, number of
    each text's."""
    parts = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    coded = parts.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)


def features(texts: pa.Array, matcher: Matcher) -> np.ndarray:
    """The FEATURES of each text; no hits give zeros but for the length."""
    words, index, counts = _tokens(texts)
    kind, strength = matcher.tokens(words)
    n = len(counts)
    out = np.zeros((n, len(FEATURES)))
    out[:, 8] = np.log1p(counts)
    row = np.repeat(np.arange(n, dtype=np.int32), counts)
    hit = np.flatnonzero((kind > 0)[index])
    for k in (1, 2, 3):
        out[:, k - 1] = np.log1p(np.bincount(row[hit[kind[index[hit]] == k]], minlength=n))
    ends = np.cumsum(counts)
    distinct: dict[int, set] = {}
    quoted, abusive = np.zeros(n), np.zeros(n)
    windows = [index[max(ends[r] - counts[r], at - WINDOW):min(ends[r], at + WINDOW + 1)] for at, r in zip(hit, row[hit])]
    met = np.unique(np.concatenate([*windows, index[:0]]))
    word = dict(zip(met.tolist(), words.take(pa.array(met)).to_pylist()))
    for at, window in zip(hit.tolist(), windows):
        r = int(row[at])
        distinct.setdefault(r, set()).add(int(index[at]))
        near = [word[i] for i in window.tolist()]
        bare = {w.strip(".,;:!?()[]'\"“”„«»‘’`") for w in near}
        if any(q in w for w in near for q in QUOTES) or bare & SAYING:
            quoted[r] += 1
        if bare & ADDRESS:
            abusive[r] += 1
    for r, seen in distinct.items():
        out[r, 3] = np.log1p(len(seen))
        out[r, 5] = np.log1p(sum(strength[i] for i in seen))
    hits = np.bincount(row[hit], minlength=n)
    out[:, 4] = np.sqrt(hits / np.maximum(counts, 1))
    out[:, 6], out[:, 7] = np.log1p(abusive), np.log1p(quoted)
    return out


#: the weights without labels (one clear hit is toxic, none is not), to which a fit is drawn
PRIOR = np.array([3.0, 2.0, 2.0, 0.0, 0.0, 0.0, 0.5, -1.0, 0.0, -1.5])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the intercept last) of a logistic regression drawn to PRIOR: Newton's
    method with steps halved until the penalised likelihood rises, which it must for some
    step as it is concave."""
    x = np.c_[x, np.ones(len(x))]
    ridge = np.full(len(PRIOR), RIDGE)
    ridge[-1] = 1e-3

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0.0, z).sum() - y @ z + 0.5 * (ridge * (w - PRIOR) ** 2).sum())
    w = PRIOR.copy()
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (p - y) + ridge * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        size, now = 1.0, loss(w)
        while size > 1e-10 and not loss(w - size * step) <= now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def _maybe_labelled(docs: DataFrame, clean: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) of all labelled rows, and of others whose id shares a bit of the filter
    with a labelled one: FILTER_BITS bits, one set for each id of ``clean``, broadcast."""
    place = 1 + F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    number, at = "bitmap_bucket_number(_place)", "bitmap_bit_position(_place)"
    bits = stored(clean.select(place.alias("_place")).groupBy(F.expr(number).alias("_part")).agg(
        F.expr(f"bitmap_construct_agg({at})").alias("_bits")), "toxicity_filter")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("_text")).withColumn("_place", place)
    byte = f"cast(conv(hex(substring(_bits, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
    return rows.withColumn("_part", F.expr(number)).join(F.broadcast(bits), "_part").where(
        f"bit_get({byte}, cast({at} % 8 as int)) = 1").select("id", "_text")


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of every text."""
    for batch in batches:
        for part in slices(batch, "_text", SMALL_SLICE_BYTES):
            words, index, counts = _tokens(part.column("_text"))
            split = [subwords(w) for w in words.to_pylist()]
            at, out = 0, []
            for n in counts.tolist():
                out.append(list({w for i in set(index[at:at + n].tolist()) for w in split[i]}))
                at += n
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, pa.list_(pa.string()))], names=["id", "words"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = LABELLED_ROWS) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and weights from the labelled rows; ``labels`` (id, label) must hold only
    rows that may be learned from.  Repeated labels of an id: toxic if any is.  Words are
    counted in all of them; the weights are fitted to about ``rows`` at most."""
    small_batches(docs.sparkSession)
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n"))
    clean = labels.select(F.col(id_col).try_cast(docs.schema[id_col].dataType).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(
        "id IS NOT NULL AND toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    clean = stored(ids.join(clean.hint("merge"), "id"), "toxicity_labels")
    sizes = {r["toxic"]: r["n"] for r in clean.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    starters = Lexicon({w: 3.0 for w in STARTERS})
    if not n_toxic or not n_other:
        return starters, PRIOR

    # of the texts only their distinct words meet the labels, by one route at every size
    texts = _maybe_labelled(docs, clean, id_col, text_col)
    listed = texts.mapInArrow(_distinct_words, schema_with(texts.select("id"), "words array<string>"))
    words = stored(listed.join(clean.hint("merge"), "id").select("toxic", F.explode("words").alias("word"))
                   .groupBy("word").agg(F.sum(F.col("toxic").cast("long")).alias("toxic"),
                                        F.sum((1 - F.col("toxic")).cast("long")).alias("other")), "toxicity_words")
    ratio = ((F.col("toxic") + 0.1) / n_toxic) / ((F.col("other") + 0.5) / n_other)
    # likelihood ratio of the two rates against one rate for both, for as many words as can
    # be terms (beginnings, each of EXTENSIONS words, are fewer)
    share = n_toxic / (n_toxic + n_other)
    x, y = F.col("toxic").cast("double"), F.col("other").cast("double")
    gain = 2 * (x * F.log(x / ((x + y) * share)) + F.when(y > 0, y * F.log(y / ((x + y) * (1 - share)))).otherwise(0.0))
    tried = words.where((F.col("toxic") >= LEAST_DOCUMENTS) & (F.length("word") > 2)).count()
    least_gain = NormalDist().inv_cdf(1 - SIGNIFICANCE / max(tried, 1)) ** 2
    # at most 1 / LEAST_DOCUMENTS of the words of toxic documents, in fact the few they prefer
    terms = {r["word"]: float(np.log(r["ratio"])) for r in words.withColumn("ratio", ratio).where(
        (F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("ratio") >= RATIO) & (gain >= least_gain)
        & (F.length("word") > 2)).collect()}
    cut = F.explode(F.transform(F.sequence(F.lit(PREFIXES[0]), F.least(F.lit(PREFIXES[-1]), F.length("word") - 1)),
                                lambda i: F.substring(F.col("word"), F.lit(1), i)))
    begun = (words.where(F.length("word") > PREFIXES[0]).select("toxic", "other", cut.alias("prefix"))
             .groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"),
                                    F.max("toxic").alias("most"), F.count_if(F.col("toxic") > 0).alias("words")))
    found = begun.withColumn("ratio", ratio).where(
        (F.col("toxic") >= 2 * LEAST_DOCUMENTS) & (F.col("ratio") >= RATIO) & (gain >= least_gain)
        & (F.col("words") >= EXTENSIONS) & (F.col("toxic") >= 1.5 * F.col("most"))).collect()
    prefixes: dict[str, float] = {}
    for r in sorted(found, key=lambda r: len(r["prefix"])):
        if not any(r["prefix"].startswith(p) for p in prefixes):
            prefixes[r["prefix"]] = float(np.log(r["ratio"]))
    lexicon = Lexicon(starters.terms | terms, prefixes)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sorted(lexicon.terms))
        for batch in batches:
            found = [w for w in batch.column("word").to_pylist() if automaton.match(w) is not None]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

    # words near a term that toxic documents do not prefer; each is in a share of the other
    # documents, so their number is bounded however many rows are read
    usual = words.where((F.col("other") >= max(1, ORDINARY * n_other)) & (ratio < RATIO / 4))
    lexicon.ordinary = {r["word"] for r in usual.select("word").mapInArrow(near, "word string").collect()}
    lexicon.ordinary -= set(lexicon.terms)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            for part in slices(batch, "_text", SMALL_SLICE_BYTES):
                x = features(part.column("_text"), matcher)
                yield pa.RecordBatch.from_arrays([part.column("toxic")] + [pa.array(c) for c in x.T],
                                                 names=["toxic", *FEATURES])

    # about LABELLED_ROWS ids, all where they are fewer
    chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    fitted = F.broadcast(clean.where(chance < rows / (n_toxic + n_other)).select("id", "toxic"))
    sample = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("_text")).join(fitted, "id").select("_text", "toxic")
    schema = "toxic int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows_ = sample.mapInArrow(describe, schema).toPandas()         # LABELLED_ROWS rows of numbers
    return lexicon, _fit(rows_[FEATURES].to_numpy(), rows_["toxic"].to_numpy(dtype=float))


def scored(docs: DataFrame, model: tuple[Lexicon, np.ndarray], text_col: str = "text", keep: list[str] | None = None,
           score_col: str = "score") -> DataFrame:
    """``keep`` columns (all, unless given) with the score (0 to 1) of every whole text.

    A null text counts as empty; an empty text has no hits and scores by the intercept.
    Equal texts score equal, whatever their ids.  An input column named as the score is
    replaced.  An empty table gives an empty result.
    """
    lexicon, weights = model
    small_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    # a string text that is kept is read from its own column, not sent twice
    source, rows = text_col, docs.select(*keep)
    if text_col not in keep or dict(docs.dtypes)[text_col] != "string":
        source = free_name(keep, "_text")
        rows = docs.select(*keep, text_of(text_col).alias(source))
    schema = schema_with(docs.select(*keep), f"`{score_col}` double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            for part in slices(batch, source, SMALL_SLICE_BYTES):
                x = features(part.column(source).fill_null(""), matcher)
                z = np.clip(x @ weights[:-1] + weights[-1], -30, 30)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(1.0 / (1.0 + np.exp(-z)))],
                                                 names=schema.names)
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows kept from learning: crc32 of the id's text divisible by 5 (null: not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
