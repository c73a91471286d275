"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text's terms are its pairs of neighbouring words (the first word with a start mark, the
last with an end mark), weighted by their counts.  For each of SAMPLES samples a term x of
weight w draws, from digests of x and the sample's number alone, r, c ~ Gamma(2, 1) and
b ~ U(0, 1); with t = floor(ln w / r + b) and y = exp(r (t - b)) the sample is the (x, t) of
least a = c / (y e^r) over all terms (Ioffe, 2010).  Two texts draw the same sample with a
probability equal to their generalised Jaccard similarity sum(min w) / sum(max w), whatever
the weights, so the share of equal samples has it as its mean.  a depends on x and t but not
on w, so its least value stands for the (x, t) that has it.

The gamma draws are sums of exponential ones, split so that most need not be made.  For
independent e1, e2, e3 ~ Exp(1), c = e1 + e2 is Gamma(2, 1) and e1 / c is uniform and
independent of c; so f = -ln(e1 / c) is Exp(1), r = f + e3 is Gamma(2, 1), and b = e3 / r is
uniform and independent of r.  Then a = c e^(-r (1 - b)) e^(-r t) = c e^(-f) e^(-r t)
= e1 e^(-r t): with t = 0, as for every term of weight 1, it is e1 alone.  The least a is found
by 1 - e^-a, which has the same order and is uniform for e1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import SPACE, shuffles_of, stored, text_of

SAMPLES = 64
#: samples that a row draws at a time: the aggregates of a step
DRAWN = 8
EMPTY = "...."
#: characters of text whose terms a task aggregates at a time: about 30 bytes of memory each
PARTITION_CHARS = 4_000_000


def terms(text: Column) -> Column:
    """64-bit digests of all pairs of neighbouring words; none for a text without words."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    left = F.concat(F.array(F.lit("")), words)
    right = F.concat(words, F.array(F.lit("")))
    return F.when(F.size(words) > 0, F.zip_with(left, right, lambda a, b: F.xxhash64(a, b)))


def _draws(term: Column, sample: Column, weights: list[Column]) -> list[Column]:
    """1 - e^-a of the term for the sample, in 52 bits, by each of the weights; null for
    weight 0.  Where t = 0 the factor is 1, so a weight above 1 gives what 1 gives."""
    digest = F.xxhash64(term, sample)
    v = F.shiftrightunsigned(digest, 12)
    more = F.xxhash64(digest)
    e2, e3 = [-F.log((h.cast("double") + 0.5) * F.lit(2.0 ** -32))
              for h in (F.shiftrightunsigned(more, 32), more.bitwiseAND(F.lit(2 ** 32 - 1)))]
    e1 = -F.log1p((v.cast("double") + 0.5) * F.lit(-2.0 ** -52))
    r = F.log((e1 + e2) / e1) + e3
    out = []
    for w in weights:
        a = e1 * F.exp(-r * F.floor((F.log(w) + e3) / r))
        out.append(F.when(w == 1, v).when(w > 1, (v.cast("double") * (F.expm1(-a) / F.expm1(-e1))).cast("long")))
    return out


def fingerprints(texts: DataFrame, key: str, text_cols: list[str]) -> DataFrame:
    """(``key``, and for each text column its fingerprint under the same name): SAMPLES
    samples as 4 hex digits each, EMPTY where the text has no term, in one string.

    ``texts`` holds one row per key; partitioned by the key, it is not shuffled again.  A
    null text and one without words have all samples empty; a key whose texts are all such
    has no row.
    """
    which = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).alias("text"))
                                for i, c in enumerate(text_cols)])).alias("t")
    rows = texts.select(key, which).select(key, "t.which", F.explode(terms(text_of("t.text"))).alias("term"))
    each = range(len(text_cols))
    # a term of several texts draws once; it is never the least of one where it has weight 0
    weighted = rows.groupBy(key, "term").agg(*[F.count_if(F.col("which") == i).alias(f"w{i}") for i in each])
    first = F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1), F.lit(DRAWN))).alias("first")
    drawing = weighted.select("*", first)
    draws = [_draws(F.col("term"), F.col("first") + j, [F.col(f"w{i}") for i in each]) for j in range(DRAWN)]
    least = drawing.groupBy(key, "first").agg(*[F.min(draws[j][i]).alias(f"a{i}_{j}") for j in range(DRAWN) for i in each])
    part = [F.array(*[f"a{i}_{j}" for j in range(DRAWN)]).alias(f"a{i}") for i in each]
    per_text = least.select(key, "first", *part).groupBy(key).agg(
        *[F.sort_array(F.collect_list(F.struct("first", f"a{i}"))).alias(f"a{i}") for i in each])
    return per_text.select(key, *[_samples(F.flatten(F.col(f"a{i}")[f"a{i}"])).alias(c) for i, c in enumerate(text_cols)])


def no_terms() -> Column:
    """The fingerprint of a text without words."""
    return F.lit(EMPTY * SAMPLES)


def _samples(least: Column) -> Column:
    """4 hex digits of each sample."""
    return F.array_join(F.transform(least, lambda a: F.when(a.isNull(), EMPTY).otherwise(
        F.lower(F.right(F.hex(F.xxhash64(a)), F.lit(4))))), "")


def _packed(print_: Column) -> Column:
    """A fingerprint's hex digits as bytes, null without words: half the size to store and
    shuffle."""
    return F.when(print_ != no_terms(), F.unhex(print_))


def _unpacked(print_: Column) -> Column:
    return F.coalesce(F.lower(F.hex(print_)), no_terms())


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples among those filled in either; two empty texts are alike."""
    # cut as bytes: characters of a string are found by walking it
    a, b, empty = a.cast("binary"), b.cast("binary"), F.lit(EMPTY).cast("binary")
    width = len(EMPTY)
    pairs = F.transform(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda i: F.struct(
        F.substring(a, i * width + 1, F.lit(width)).alias("a"), F.substring(b, i * width + 1, F.lit(width)).alias("b")))
    pairs = F.filter(pairs, lambda p: (p["a"] != empty) | (p["b"] != empty))
    same = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(F.size(pairs) == 0, 1.0).otherwise(same / F.size(pairs))


def succession(keys: DataFrame, order: list[Column], key: str = "k") -> DataFrame:
    """(``key``, next): the following key in a total order, the first after the last.
    Ranges of the order are numbered on their own; only their first keys meet."""
    ranged = stored(keys.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "fingerprint_order")
    window = Window.partitionBy("pid").orderBy(*order)
    placed = ranged.select(key, "pid", F.lead(key).over(window).alias("next"), F.row_number().over(window).alias("at"))
    heads = placed.where("at = 1").select("pid", F.col(key).alias("head"))       # one row per partition
    by_pid = Window.orderBy("pid")
    whole = by_pid.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("pid", F.coalesce(F.lead("head").over(by_pid), F.first("head").over(whole)).alias("head"))
    return placed.join(F.broadcast(heads), "pid").select(key, F.coalesce("next", "head").alias("next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text and of the next document.

    The edited text replaces the last floor(n/2) of a text's n code points by the first as
    many (or all) of the next document's, in descending id order (null last; equal ids by
    the digest of their texts), the first following the last.  Columns: ``id_col``,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text counts as empty; an empty text has an empty fingerprint.  Rows equal in id
    and text are one document in the order and are each reported.  A lone document follows
    itself.  Other columns are ignored.  An empty table gives an empty result.
    """
    text = text_of(text_col)
    digest = F.md5(text)
    key = F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), digest)))
    keys = stored(docs.select(F.col(id_col).alias("id"), key.alias("k"), digest.alias("digest"),
                              F.length(text).cast("long").alias("n_chars"))
                  .groupBy("k").agg(F.any_value("id").alias("id"), F.any_value("digest").alias("digest"),
                                    F.any_value("n_chars").alias("n_chars"), F.count("*").alias("rows")),
                  "fingerprint_keys")
    links = succession(keys.select("k", "id", "digest"), [F.desc_nulls_last("id"), F.asc("digest")])
    links = stored(links.join(keys.select("k", F.floor(F.col("n_chars") / 2).cast("int").alias("need")), "k"),
                   "fingerprint_links")
    # one text shuffle, shared by both joins
    texts = docs.select(key.alias("k"), text.alias("text")).groupBy("k").agg(F.any_value("text").alias("text"))
    head = (texts.withColumnRenamed("k", "next").join(links, "next")
            .select("k", "need", F.left("text", F.col("need")).alias("head")))
    both = texts.join(head, "k").select("k", "text", F.concat(
        F.left("text", F.length("text") - F.col("need")), F.col("head")).alias("edited"))
    prints = fingerprints(both, "k", ["text", "edited"])
    shas = both.select(F.col("k").alias("_k"), F.unhex(F.sha2("edited", 256)).alias("edited_sha256"))
    found = shas.join(prints, F.col("k") == F.col("_k"), "left").select(
        F.col("_k").alias("k"), "edited_sha256", *[_packed(F.col(c)).alias(c) for c in ("text", "edited")])
    chars = keys.agg(F.sum("n_chars").alias("n")).first()["n"] or 0
    with shuffles_of(docs.sparkSession, -(-chars // PARTITION_CHARS)):
        found = stored(found, "fingerprint_found")
    following = found.select(F.col("k").alias("next"), F.col("text").alias("next_print"))
    out = (keys.join(found, "k").join(links.select("k", "next"), "k").join(following, "next")
           .select("*", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))))
    out = out.select(F.col("id").alias(id_col), "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
                     *[_unpacked(F.col(c)).alias(c) for c in ("text", "edited", "next_print")])
    return out.select(id_col, "n_chars", "edited_sha256",
                      F.col("text").alias("fingerprint"), F.col("edited").alias("edited_fingerprint"),
                      likeness(F.col("text"), F.col("edited")).alias("near_edited"),
                      likeness(F.col("text"), F.col("next_print")).alias("near_next"))
