"""Mixing sources to target weights by Pareto order sampling.

Targets.  Sources take turns at the weights 5, 2, 1 (code point order, null last) and
share ``share`` times all words by weight; a target stops at ``cap`` times its source's
words and the excess is reshared by weight until none is above (water level).

Copies.  Every document of a source gets floor(target / words) certain whole copies.  The
rest R of the target is drawn without replacement: document i of size z_i is wanted with
inclusion probability p_i = min(1, c * sqrt(z_i)), c solved so that sum(p_i z_i) = R, and
documents are taken in ascending order of random odds over inclusion odds,
[u/(1-u)] / [p/(1-p)] (Rosen's Pareto sampling), while they stay within R words; the gap
that is left goes to up to FILLS documents beyond the cut that fill it best.  u is a digest of
seed, id and text.  Only totals per source, size and rank bin are aggregated, so no
source is ever sorted or gathered whole: the cut rank of each source is found through two
levels of BINS rank bins and then applied row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import WORD, packed, stored, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = 20240601
BINS = 4096
FILLS = 3
#: the columns that are added
MADE = ("_size", "source_size", "target", "copies")


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, *keep: Column) -> DataFrame:
    """``keep`` with _source, _size (words of the text) and _u (its random number in
    (0, 1))."""
    text = text_of(text_col)
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                               F.md5(text)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(16 ** 13)
    return docs.select(*keep, F.col(source_col).cast("string").alias("_source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"), u.alias("_u"))


def targets(by_source: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(_source, source_size) to (_source, source_size, target).  One row per source: the
    ranking and the water level are the only steps over all sources at once."""
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    s = by_source.withColumn("rank", F.row_number().over(order))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    s = s.withColumns({"w": F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")),
                       "cap": F.lit(float(cap)) * F.col("source_size")})
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns({
        "full": F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
        "all": F.sum("source_size").over(all_rows)})
    level = (F.lit(float(share)) * F.col("all") - F.col("full")) / F.col("open")
    s = s.withColumn("level", F.when(level <= F.col("cap") / F.col("w"), level))
    first = F.first("level", ignorenulls=True).over(all_rows)
    return s.select("_source", "source_size",
                    F.when(first.isNull(), F.col("cap")).otherwise(F.least("cap", first * F.col("w"))).alias("target"))


def _inclusion() -> Column:
    return F.when(F.col("_size") > F.col("certain_above"), 1.0).otherwise(
        F.least(F.lit(1.0), F.col("c") * F.sqrt("_size")))


def _rank() -> Column:
    """Random odds over inclusion odds q, as q / (1 + q) in [0, 1]."""
    p, u = _inclusion(), F.col("_u")
    return u * (1.0 - p) / (u * (1.0 - p) + p * (1.0 - u))


def plan(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Per source: source_size, target, whole (certain copies), c and certain_above (the
    inclusion probabilities), edge and cut (the ranks up to which documents are drawn) and
    fills (the ranks of the documents that close the gap to the target).
    ``sizes`` holds _source, _size and _u of every document."""
    hist = stored(sizes.groupBy("_source", "_size").agg(F.count("*").alias("n")), "mixing_sizes")
    totals = hist.groupBy("_source").agg(F.sum(F.col("_size") * F.col("n")).alias("source_size"))
    src = targets(totals, weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(cap), F.floor(F.col("target") / F.col("source_size"))))
    src = src.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("int"))
    src = src.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    src = stored(src, "mixing_targets")

    # the largest sizes are certain while their probability would pass 1
    down = Window.partitionBy("_source").orderBy(F.desc("_size"))
    words = F.col("_size") * F.col("n")
    h = hist.where("_size > 0").withColumns({
        "above": F.coalesce(F.sum(words).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "pull": F.sum(F.sqrt("_size") * words).over(
            down.rowsBetween(0, Window.unboundedFollowing))})
    h = _with(h, src.select("_source", "rest"))
    h = h.withColumn("c", (F.col("rest") - F.col("above")) / F.col("pull"))
    solved = h.where(F.col("c") * F.sqrt("_size") <= 1.0).groupBy("_source").agg(
        F.max_by(F.struct("c", F.col("_size").alias("certain_above"), "above"), "_size").alias("s")).select(
        F.col("_source"), "s.*")
    src = _with(src, solved).withColumns({
        "drawn": F.greatest(F.lit(0.0), F.col("rest") - F.coalesce("above", F.lit(0))),
        "c": F.greatest(F.lit(0.0), F.coalesce("c", F.lit(0.0))),
        # none solved: everything that is left is certain, or nothing is
        "certain_above": F.coalesce("certain_above", F.when(F.col("rest") > 0, 0).otherwise(2 ** 62))})
    src = stored(src, "mixing_inclusion")

    ranked = _with(sizes.select("_source", "_size", "_u").where("_size > 0"), src, "inner").where(
        F.col("_size") <= F.col("certain_above")).withColumn("rank", _rank()).where("rank < 1")
    ranked = ranked.select("_source", "_size", "rank")
    b1 = F.floor(F.col("rank") * BINS)
    first = stored(_crossing(ranked.groupBy("_source", b1.alias("bin")).agg(F.sum("_size").alias("words")),
                             src.select("_source", "drawn")), "mixing_bins")
    inner = _with(ranked, first, "inner").where(b1 == F.col("bin")).withColumn("low", F.col("bin") / BINS)
    b2 = F.floor((F.col("rank") - F.col("low")) * BINS * BINS)
    second = stored(_crossing(inner.groupBy("_source", b2.alias("bin"), "low").agg(F.sum("_size").alias("words")),
                              first.select("_source", F.col("left").alias("drawn"))), "mixing_bins2")
    last = (_with(ranked.withColumn("fine", F.floor(F.col("rank") * BINS * BINS)),
                  second.withColumn("edge", F.col("low") + F.col("bin") / (BINS * BINS)), "inner")
            .where(F.col("fine") == F.floor(F.col("edge") * BINS * BINS)))
    up = Window.partitionBy("_source").orderBy("rank")
    last = (last.groupBy("_source", "rank", "edge", "left").agg(F.sum("_size").alias("words"))
            .withColumn("before", F.sum("words").over(up) - F.col("words")))
    fits = F.col("before") + F.col("words") <= F.col("left")
    cut = last.groupBy("_source").agg(
        F.any_value("edge").alias("edge"), F.max(F.when(fits, F.col("rank"))).alias("cut"),
        (F.any_value("left") - F.coalesce(F.max(F.when(fits, F.col("before") + F.col("words"))), F.lit(0))).alias("gap"))
    out = _with(src, cut).select("_source", "source_size", "target", "whole", "c", "certain_above", "gap",
                                 # no crossing: nothing is drawn, or all that can be
                                 F.coalesce("edge", F.when(F.col("drawn") > 0, 1.0).otherwise(0.0)).alias("edge"),
                                 F.coalesce("cut", F.lit(-1.0)).alias("cut"))
    out = stored(out.withColumn("fills", F.array().cast("array<double>")), "mixing_cuts")
    # further documents: of those beyond the cut, each the one that fills the gap best
    beyond = _with(ranked, out.select("_source", "edge", "cut"), "inner").where("rank >= edge AND rank > cut").select(
        "_source", "_size", "rank")
    for k in range(FILLS):                       # only the last may pass the target
        most = F.col("_size") < 2 * F.col("gap") if k == FILLS - 1 else F.col("_size") <= F.col("gap")
        fit = _with(beyond, out.select("_source", "gap", "fills"), "inner").where(
            most & ~F.array_contains("fills", F.col("rank")))
        fit = fit.groupBy("_source").agg(F.min(F.struct(
            F.abs(F.col("_size") - F.col("gap")).alias("miss"), "rank", "_size")).alias("best"))
        out = _with(out, fit)
        out = stored(out.withColumns({
            "gap": F.col("gap") - F.coalesce("best._size", F.lit(0)),
            "fills": F.when(F.col("best").isNull(), F.col("fills")).otherwise(
                F.array_append("fills", F.col("best.rank")))}).drop("best"), "mixing_fills")
    out = out.drop("gap")
    return stored(out, "mixing_plan")


def _crossing(bins: DataFrame, need: DataFrame) -> DataFrame:
    """Per source the first bin in which the words so far reach what is drawn, and the
    words left to draw when it begins."""
    up = Window.partitionBy("_source").orderBy("bin")
    bins = _with(bins, need, "inner").withColumn("before", F.sum("words").over(up) - F.col("words"))
    keep = [F.first(c).alias(c) for c in bins.columns if c == "low"]
    return (bins.where((F.col("drawn") > F.col("before")) & (F.col("drawn") <= F.col("before") + F.col("words")))
            .groupBy("_source").agg(F.min("bin").alias("bin"),
                                    F.min(F.col("drawn") - F.col("before")).alias("left"), *keep))


def _with(df: DataFrame, per_source: DataFrame, how: str = "left") -> DataFrame:
    """Join the per-source rows on the source, null matching null.  Their Parquet copy's
    size decides about a broadcast (spark.sql.autoBroadcastJoinThreshold)."""
    right = per_source.withColumnRenamed("_source", "_s")
    return df.join(right, F.col("_source").eqNullSafe(F.col("_s")), how).drop("_s")


def copies() -> Column:
    """Copies of a document, from _size, _u and its source's plan."""
    rank = _rank()
    drawn = ((F.col("_size") > 0) & ((F.col("_size") > F.col("certain_above"))
                                     | (rank < F.col("edge")) | (rank <= F.col("cut"))
                                     | F.array_contains("fills", rank)))
    return (F.col("whole") + F.coalesce(drawn, F.lit(False)).cast("int")).cast("int")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """``docs`` with _size, source_size, target and copies (0 to ``cap``) of every row.

    A null or empty text has size 0 and takes no words (it gets its source's whole
    copies).  A null source is a source of its own, last in order.  Null or repeated ids
    are allowed; rows equal in id and text share one random number and so one fate.  Ties
    of rank are taken or left together.  An empty table gives an empty result, and a
    source of size 0 a target of 0.  Other columns pass through; input columns of the
    names added here are replaced.
    """
    if cap < 1 or share <= 0 or not weights or min(weights) <= 0:
        raise ValueError("weights and share must be positive and cap at least 1")
    rows = measured(docs, id_col, text_col, source_col, seed, packed(docs.columns).alias("row"))
    out = _apply(rows, plan(rows.drop("row"), weights, share, cap), "row")
    kept = [c for c in docs.columns if c.lower() not in MADE]
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *MADE)


def mixture_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """As :func:`mixture`, without the texts: (id, _size, source_size, target, copies).
    The texts are read once."""
    rows = stored(measured(docs, id_col, text_col, source_col, seed, F.col(id_col).alias("id")), "mixing_rows")
    out = _apply(rows, plan(rows.drop("id"), weights, share, cap), "id")
    return out.select(F.col("id").alias(id_col), *MADE)


def _apply(rows: DataFrame, sources: DataFrame, keep: str) -> DataFrame:
    return _with(rows, sources, "inner").select(keep, "_size", "source_size", "target", copies().alias("copies"))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each copy of a mixed document."""
    rows = mixed.where("copies > 0").select(packed(columns).alias("row"), F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"))
    return rows.select("row.*")


def mixture_sql(table: str = "documents", weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED) -> str:
    """DuckDB SQL for :func:`mixture_counts` over ``table`` (doc_id, text, source), as
    doc_id, size, source_size, target, taken; here sources are sorted whole."""
    turns = "[" + ", ".join(f"{float(w)}" for w in weights) + "]::DOUBLE[]"
    fills, gaps = "", "cuts"
    for k in range(FILLS):
        most = "o.size < 2 * g.gap" if k == FILLS - 1 else "o.size <= g.gap"
        before = "".join(f" AND NOT EXISTS (SELECT 1 FROM fill{j} f WHERE f.source IS NOT DISTINCT FROM o.source "
                         f"AND f.rank = o.rank)" for j in range(k))
        fills += f"""
    fill{k} AS (SELECT source, rank, size FROM (SELECT o.source, o.rank, o.size, row_number() OVER (
                    PARTITION BY o.source ORDER BY abs(o.size - g.gap), o.rank, o.size) AS n
                FROM ordered o JOIN {gaps} g ON g.source IS NOT DISTINCT FROM o.source
                WHERE o.upto > g.drawn AND {most}{before}) WHERE n = 1),
    gap{k} AS (SELECT g.source, g.drawn, g.gap - coalesce(f.size, 0) AS gap FROM {gaps} g
               LEFT JOIN fill{k} f ON f.source IS NOT DISTINCT FROM g.source),"""
        gaps = f"gap{k}"
    filled = " OR ".join(f"EXISTS (SELECT 1 FROM fill{k} f WHERE f.source IS NOT DISTINCT FROM d.source "
                         f"AND f.rank = d.rank)" for k in range(FILLS))
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, source,
               len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
               (CAST('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(CAST(doc_id AS VARCHAR), 'null'),
                md5(coalesce(text, '')))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {float(16 ** 13)}::DOUBLE AS u FROM {table}),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
    weighed AS (SELECT *, ({turns})[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1 AS INT)] AS w,
                row_number() OVER (ORDER BY source NULLS LAST) AS n, {float(cap)}::DOUBLE * source_size AS cap FROM totals),
    levels AS (SELECT *, ({share}::DOUBLE * sum(source_size) OVER ()
                   - coalesce(sum(cap) OVER (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(w) OVER (ORDER BY cap / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
    level AS (SELECT min_by(level, row(cap / w, n)) AS level FROM levels WHERE level <= cap / w),
    targets AS (SELECT source, source_size, CASE WHEN (SELECT level FROM level) IS NULL THEN cap
                    ELSE least(cap, (SELECT level FROM level) * w) END AS target FROM weighed),
    rests AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(least({cap}, floor(target / source_size)) AS INT) ELSE 0 END AS whole
              FROM targets),
    hist AS (SELECT h.*, greatest(0.0::DOUBLE, r.target - r.whole * r.source_size) AS rest FROM (
                 SELECT source, size, count(*) AS n FROM docs WHERE size > 0 GROUP BY source, size) h
             JOIN rests r ON r.source IS NOT DISTINCT FROM h.source),
    solving AS (SELECT *, coalesce(sum(size * n) OVER (PARTITION BY source ORDER BY size DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
                    sum(sqrt(size) * (size * n)) OVER (PARTITION BY source ORDER BY size DESC
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS pull FROM hist),
    solved AS (SELECT source, max_by(row(c, size, above), size) AS s FROM (
                   SELECT *, (rest - above) / pull AS c FROM solving) WHERE c * sqrt(size) <= 1.0 GROUP BY source),
    plan AS (SELECT r.*, greatest(0.0::DOUBLE, r.target - r.whole * r.source_size) AS rest,
                    greatest(0.0::DOUBLE, coalesce(s.s[1], 0.0)) AS c,
                    coalesce(s.s[2], CASE WHEN r.target - r.whole * r.source_size > 0 THEN 0 ELSE 4611686018427387904 END) AS certain_above,
                    greatest(0.0::DOUBLE, greatest(0.0::DOUBLE, r.target - r.whole * r.source_size) - coalesce(s.s[3], 0)) AS drawn
             FROM rests r LEFT JOIN solved s ON s.source IS NOT DISTINCT FROM r.source),
    odds AS (SELECT d.*, p.source_size, p.target, p.whole, p.drawn, p.certain_above,
                    CASE WHEN d.size > p.certain_above THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, p.c * sqrt(d.size)) END AS p
             FROM docs d JOIN plan p ON p.source IS NOT DISTINCT FROM d.source),
    ranked AS (SELECT *, u * (1.0 - p) / (u * (1.0 - p) + p * (1.0 - u)) AS rank FROM odds),
    ordered AS (SELECT source, rank, size, drawn, sum(words) OVER (PARTITION BY source ORDER BY rank) AS upto FROM (
                    SELECT source, rank, min(size) AS size, any_value(drawn) AS drawn, sum(size) AS words FROM ranked
                    WHERE size > 0 AND size <= certain_above AND rank < 1 GROUP BY source, rank)),
    cuts AS (SELECT source, any_value(drawn) AS drawn, any_value(drawn) - coalesce(max(upto) FILTER (WHERE upto <= drawn), 0) AS gap
             FROM ordered GROUP BY source HAVING max(upto) >= any_value(drawn) AND any_value(drawn) > 0),{fills}
    chosen AS (SELECT d.*, d.whole + CASE WHEN d.size > 0 AND (d.size > d.certain_above
                   OR EXISTS (SELECT 1 FROM ordered o WHERE o.source IS NOT DISTINCT FROM d.source AND o.rank = d.rank
                              AND o.upto <= o.drawn) OR {filled}) THEN 1 ELSE 0 END AS copies FROM ranked d)
    SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken FROM chosen"""
