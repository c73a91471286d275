"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

1. Seeds: e-mail addresses, IP addresses, card numbers and phone numbers found by fixed
   patterns and checks (parts at most 255, Luhn, digit counts) are known instances.
2. The words around an instance are its lexical patterns: one and two words before it, one
   after it, and the pair around it.  Other tokens with a digit or an @ are candidate
   instances; equal tokens are one instance.
3. The bipartite pattern-instance graph is scored in rounds: a pattern's confidence in a
   kind is the weight of its instances of that kind over all its instances (smoothed), an
   instance's confidence is the noisy-or of its patterns.  Candidates that pass are
   instances of the next round.
4. Every occurrence of an accepted candidate is a span of its kind.  Seeds always stay.

All matches are located from the gaps between them, once for each distinct text; texts
themselves are never shuffled by the search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import packed, stored, text_of

# The kinds in order, with their patterns.  Possessive repeats and the
# left bound (or the end of the previous match) only save time: where they differ from the
# plain pattern no match could begin.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # candidates: words with a digit or an @
    "": r"(?:\G|(?<![^\x20\x09-\x0D]))[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "": None}
IP_PART = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CONTEXT = 64
ROUNDS = 3
#: instances of a kind a pattern must have, and the confidences a pattern and a candidate must reach
SUPPORT = 3
PATTERN_CONFIDENCE = 0.6
INSTANCE_CONFIDENCE = 0.8
SMOOTHING = 1.0
#: letters and digits a candidate must have at least
LEAST_LENGTH = 4

EVENTS = "array<struct<kind:string,i:int,gap:int,match:string,before:string,after:string>>"


def _events(kind: str, found: str, gaps: str) -> Column:
    """Matches of one pattern with the gap before each and the text around it."""
    return F.transform(found, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(F.get(F.col(gaps), i)).alias("gap"), m.alias("match"),
        F.right(F.get(F.col(gaps), i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get(F.col(gaps), i + 1), F.lit(CONTEXT)).alias("after")))


def _located(docs: DataFrame) -> DataFrame:
    """(digest, kind, start, end, match, before, after) of every pattern match of every
    distinct text; kind is null for candidates."""
    rows = docs.select("digest", F.explode("events").alias("e")).select("digest", "e.*")
    # equal texts have equal events
    rows = rows.groupBy("digest", "kind", "i").agg(*[F.any_value(c).alias(c) for c in ("gap", "match", "before", "after")])
    upto = Window.partitionBy("digest", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))


def _valid() -> Column:
    m = F.col("match")
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)

    def luhn(pos: Column) -> Column:           # pos counts from the right, from 0
        d = F.substring(digits, n - pos, F.lit(1)).cast("int") * (1 + pos % 2)
        return d - F.when(d > 9, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, p: a + luhn(p))
    return (F.when(F.col("kind") == "email", True)
            .when(F.col("kind") == "ip", m.rlike(rf"^{IP_PART}(\.{IP_PART}){{3}}$"))
            .when(F.col("kind") == "card", F.when(n.between(16, 19), total % 10 == 0).otherwise(False))
            .when(F.col("kind") == "phone", n.between(8, 15)).otherwise(False))


def _patterns() -> Column:
    def words(c: str) -> Column:
        clean = F.trim(F.regexp_replace(F.lower(F.col(c)), r"[^\p{L}:=#]+", " "))
        return F.filter(F.split(clean, " "), lambda w: w != "")
    left, right = words("before"), words("after")
    one, two, after = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2)), F.get(right, F.lit(0))
    return F.filter(F.array(F.concat(F.lit("l "), one), F.concat(F.lit("ll "), two, F.lit(" "), one),
                            F.concat(F.lit("r "), after), F.concat(F.lit("lr "), one, F.lit(" "), after)),
                    lambda p: p.isNotNull())


def _instance() -> Column:
    return F.lower(F.when(F.col("kind").isin("card", "phone"), F.regexp_replace("match", r"[^0-9+]", ""))
                   .otherwise(F.col("match")))


def _discovered(occurrences: DataFrame) -> DataFrame:
    """(instance, kind) of the candidates that the graph accepts.  ``occurrences`` holds
    digest, kind (null: candidate), instance and the patterns around it."""
    edges = stored(occurrences.select("kind", "instance", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii_edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("size"))
    known = edges.where("kind IS NOT NULL").select("pattern", "instance", "kind", F.lit(1.0).alias("weight"))
    open_edges = edges.where("kind IS NULL").select("pattern", "instance")
    instances = None
    for _ in range(ROUNDS):
        evidence = known
        if instances is not None:
            evidence = known.unionByName(open_edges.join(instances, "instance").select("pattern", "instance", "kind", "weight"))
        confident = (evidence.groupBy("pattern", "kind").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
                     .join(sizes, "pattern")
                     .withColumn("c", F.col("w") / (F.col("size") + SMOOTHING))
                     .where((F.col("n") >= SUPPORT) & (F.col("c") >= PATTERN_CONFIDENCE)))
        scored = (open_edges.join(confident.select("pattern", "kind", "c"), "pattern")
                  .groupBy("instance", "kind").agg((1.0 - F.exp(F.sum(F.log(1.0 - F.col("c"))))).alias("weight"))
                  .groupBy("instance").agg(F.max(F.struct("weight", "kind")).alias("best")))
        instances = stored(scored.select("instance", "best.*").where(F.col("weight") >= INSTANCE_CONFIDENCE), "pii_instances")
    return instances.select("instance", "kind")


def searched(docs: DataFrame, text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``keep`` columns, digest of the text, and its pattern matches, one row per row."""
    text, digits = F.col("_text"), F.col("_text").rlike("[0-9@]")
    names = {k: (f"_found_{i}", f"_gaps_{i}") for i, k in enumerate(PATTERNS)}
    rows = docs.select(*keep, text_of(text_col).alias("_text"))
    # one projection each, so that no match or split is computed again for every use
    rows = rows.withColumns({names[k][0]: F.when(text.contains(NEEDS[k]) if NEEDS[k] else digits, F.regexp_extract_all(
        text, F.lit(PATTERNS[k]), F.lit(0))) for k in PATTERNS})
    rows = rows.withColumns({names[k][1]: F.when(F.size(names[k][0]) > 0, F.split(text, PATTERNS[k], -1))
                             for k in PATTERNS})
    none = F.array().cast(EVENTS)
    return rows.select(*keep, F.md5(text).alias("digest"),
                       F.concat(*[F.coalesce(_events(k, *names[k]).cast(EVENTS), none) for k in PATTERNS]).alias("events"))


def find_spans(rows: DataFrame) -> DataFrame:
    """All spans of the texts in ``rows`` (of :func:`searched`, stored): (digest, kind,
    start, end, base), offsets in code points, end exclusive."""
    located = stored(_located(rows.select("digest", "events")), "pii_matches")
    base = located.where("kind <> ''").where(_valid())
    # candidates lose the punctuation around them, and must not touch a base span
    lead = F.length(F.regexp_extract("match", r"^([^\p{L}\p{N}@+]*)", 1))
    bare = F.regexp_replace(F.regexp_replace("match", r"^[^\p{L}\p{N}@+]+", ""), r"[^\p{L}\p{N}]++$", "")
    cand = (located.where("kind = ''").withColumn("lead", lead).withColumn("match", bare)
            .withColumn("start", F.col("start") + F.col("lead")).withColumn("end", F.col("start") + F.length("match"))
            .where(F.length(F.regexp_replace("match", r"[^\p{L}\p{N}]+", "")) >= LEAST_LENGTH))
    cols = ["digest", "kind", "start", "end", "match", "before", "after"]
    every = base.select(*cols).unionByName(cand.select(*cols))
    is_base = F.col("kind") != ""
    order = Window.partitionBy("digest").orderBy("start", F.desc(is_base))
    back = Window.partitionBy("digest").orderBy(F.desc("start"), is_base)
    # both frames grow from one end, so that a text of many matches takes linear time
    before = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(is_base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    touches = (F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False)))
    every = every.withColumn("touches", touches).where(is_base | ~F.col("touches"))
    every = stored(every.withColumn("instance", _instance()).withColumn("kind", F.nullif("kind", F.lit("")))
                   .select("digest", "kind", "start", "end", "instance", _patterns().alias("patterns")), "pii_spans")
    new = _discovered(every)
    base = every.where("kind IS NOT NULL").select("digest", "kind", "start", "end", F.lit(True).alias("base"))
    added = every.where("kind IS NULL").drop("kind").join(new, "instance").select(
        "digest", "kind", "start", "end", F.lit(False).alias("base"))
    return base.unionByName(added)


def _joined(spans: Column) -> Column:
    """kind:start:end in the order of the kinds, then of the starts."""
    names = F.array(*[F.lit(k) for k in KINDS])
    order = F.sort_array(F.transform(spans, lambda s: F.struct(
        F.array_position(names, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", F.element_at(names, s["k"].cast("int")), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, spans (array of kind, start, end, base).

    Null and empty texts have no spans.  Rows with equal texts have equal spans; null and
    repeated ids are reported as they come.  Other columns are ignored, whatever their
    names.  An empty table gives an empty result.
    """
    rows = stored(searched(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", ["id"]), "pii_rows")
    spans = find_spans(rows.drop("id")).groupBy("digest").agg(F.collect_list(
        F.struct("kind", "start", "end", "base")).alias("spans"))
    out = rows.select("id", "digest").join(spans, "digest", "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    return out.select(F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"))


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of :func:`personal_data`'s result."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in KINDS]
    return found.select(id_col, *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets, as [EMAIL].
    Overlapping spans become one, named after its first.  Texts without spans, null ones
    included, stay as they are; all columns and rows are kept."""
    found = find_spans(stored(searched(docs.select(F.col(text_col).alias("text"))), "pii_rows"))
    order = Window.partitionBy("digest").orderBy("start", "end", "kind")
    last = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    groups = found.withColumn("opens", F.when(F.col("start") < last, 0).otherwise(1))
    groups = groups.withColumn("g", F.sum("opens").over(order))
    merged = groups.groupBy("digest", "g").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                               F.min_by("kind", F.struct("start", "end", "kind")).alias("kind"))
    spans = merged.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("_spans"))
    rows = docs.select(packed(docs.columns).alias("row"), F.col(text_col).alias("text"),
                       F.md5(text_of(text_col)).alias("digest")).join(spans, "digest", "left")
    text = F.col("text")
    s = F.col("_spans")
    pieces = F.transform(s, lambda x, i: F.concat(
        F.substring(text, F.coalesce(F.get(s, i - 1)["end"], F.lit(0)) + 1,
                    x["start"] - F.coalesce(F.get(s, i - 1)["end"], F.lit(0))),
        F.lit("["), F.upper(x["kind"]), F.lit("]")))
    tail = F.substring(text, F.element_at(s, -1)["end"] + 1, F.length(text))
    new = F.when(s.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return rows.select(*[new.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
