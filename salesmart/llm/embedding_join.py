"""Embedding near-duplicates by an exact metric range join.

Cosine at least ``c`` between unit vectors is distance at most ``r = sqrt(2 - 2c)``.
Sampled pivots cut each block (label) into cells; a vector lives in the cell of its
nearest pivot.  The triangle inequality (in its half-space form, which holds in Euclidean
space and is never weaker) says with which other cells a vector must be compared: a
vector whose distance to the bisector of two pivots exceeds ``r`` has no partner beyond
it.  The same inequality also settles pairs without a comparison: vectors within ``r/2``
of a pivot (the cell's core) are all linked to each other, and a vector beyond ``1.5 r``
of it is linked to none of them, so a dense hot group costs a count, not all its pairs.

Neighbouring cells share an area of about QUERY_ROWS vectors.  A vector is sent once to
an area where it has cells to be compared with, together with the list of these, and of
two areas only one sends to the other.  So the copies of a vector grow with the areas of
its block, not with its cells, and no task holds more than QUERY_ROWS x CANDIDATE_ROWS
rows and one tile of their similarities, however large a block is: areas that get more
candidates compare them in several groups.

Vectors without structure (all distances alike) have no cells that could be left out; the
work then grows as the square of a block, as for any exact method.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import components, stored

#: rows of so many components; a row with more counts as several
QUERY_ROWS = 32_768
CANDIDATE_ROWS = 65_536
SALT_ROWS = 20_000
COMPONENTS = 64
#: rows of a salted part times the places each may be sent to, at most
SALT_CELLS = 1 << 22
#: one pivot for each PIVOT_SHARE * sqrt(n) vectors of a block
PIVOT_SHARE = 7.0
SLACK = 1e-9
CORE_SLACK = 1e-6
#: rows of both sides compared at once; links kept before they are folded into a forest
TILE = (512, 2048)
OPEN_LINKS = 1 << 21
#: name of the only cell of a block without a pivot
NO_PIVOT = "-"
PLACED = "block string, area int, cell int, core boolean, to array<struct<area:int,own:boolean,units:array<int>>>"


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix, in their own type."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so that no finite vector over- or underflows
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def _chunks(column: pa.ChunkedArray, rows: int = 1024):
    """Start and unit vectors of some rows at a time, which bounds the distance matrix."""
    for at in range(0, len(column), rows):
        yield at, _unit(_vectors(column.slice(at, rows)))


def _single(column: pa.ChunkedArray) -> np.ndarray:
    """The unit vectors in single precision."""
    out = np.empty((len(column), len(column[0])), np.float32)
    for at, x in _chunks(column):
        out[at:at + len(x)] = x
    return out


def _homes(part: pa.Table, pivots: pa.Table) -> pa.Table:
    """Vectors of one salted part in each cell; cells are named by their pivot."""
    if not part.num_rows:
        return pa.table({"block": pa.array([], pa.string()), "cell": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    if pivots.num_rows:
        pivots = pivots.sort_by("key")
        p = _unit(_vectors(pivots["embedding"]))
        alone = ~np.tril(_distance(p, p) < CORE_SLACK, -1).any(axis=1)
        p, names = p[alone], [k for k, a in zip(pivots["key"].to_pylist(), alone) if a]
    else:                                       # any point serves as the only pivot
        p, names = np.eye(1, len(part["embedding"][0])), [NO_PIVOT]
    count = np.zeros(len(p), np.int64)
    for _, u in _chunks(part["embedding"]):
        count += np.bincount(_distance(u, p).argmin(axis=1), minlength=len(p))
    return pa.table({"block": [part["block"][0].as_py()] * len(p), "cell": names, "n": count}).filter(pa.array(count > 0))


def _placer(radius: float):
    """Area, cell and zone of each vector of one salted part, and where it is sent as a
    candidate: areas with their units, 2 * cell for the vectors outside the cell's core and
    2 * cell + 1 for the core.  Vectors outside cores go to all cores they may be linked to,
    and never the other way; for others of the same zone one of two areas sends, and in one
    area (``own``) each is sent to the other."""
    def place(part: pa.Table, cells: pa.Table) -> pa.Table:
        cells = cells.sort_by("number")
        n, start, areas = cells["n"].to_numpy(), cells["start"].to_numpy(), cells["areas"][0].as_py()
        total = n.sum()
        if cells["embedding"].null_count:
            p = np.eye(1, len(part["embedding"][0]) if len(part) else 1)
        else:
            p = _unit(_vectors(cells["embedding"]))
        gaps = _distance(p, p)
        np.fill_diagonal(gaps, 0.0)
        # a cell's vectors are spread over its places, start to start + n, and places over areas
        low, high = start * areas // total, (start + n - 1) * areas // total
        slot_cell = np.repeat(np.arange(len(n)), high - low + 1)
        slot_area = np.concatenate([np.arange(i, j + 1) for i, j in zip(low, high)])
        unit = (2 * slot_cell[:, None] + [0, 1]).ravel()
        spread = part["hash"].to_numpy()
        area, cell, core, row, column = ([np.zeros(0, np.int32)] for _ in range(5))
        for at, u in _chunks(part["embedding"]):
            d = _distance(u, p)
            home = d.argmin(axis=1)
            own = d[np.arange(len(d)), home]
            in_core = own <= radius / 2 - CORE_SLACK
            here = (start[home] + spread[at:at + len(d)] % n[home]) * areas // total
            open_ = (d * d - (own * own)[:, None] <= 2.0 * gaps[home] * radius + SLACK)[:, slot_cell]
            near = (d <= 1.5 * radius + SLACK)[:, slot_cell]
            mine, there = here[:, None], slot_area[None, :]
            sends = (mine == there) | (((mine + there) % 2 == 0) == (mine > there))
            rest = open_ & sends & ~in_core[:, None]
            to_core = open_ & near & np.where(in_core[:, None], sends & (home[:, None] != slot_cell), True)
            i, j = np.nonzero(np.stack([rest, to_core], axis=2).reshape(len(d), -1))
            row.append((at + i).astype(np.int32))
            column.append(j.astype(np.int32))
            area.append(here)
            cell.append(home)
            core.append(in_core)
        area, cell, core, row, column = (np.concatenate(a) for a in (area, cell, core, row, column))
        to = slot_area[column // 2]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (to[1:] != to[:-1])][:len(row)])
        units = pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)], pa.int32()), pa.array(unit[column], pa.int32()))
        targets = pa.StructArray.from_arrays(
            [pa.array(to[first], pa.int32()), pa.array(to[first] == area[row[first]]), units], names=["area", "own", "units"])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[first], np.arange(len(area) + 1)), pa.int32()), targets)
        return pa.table({"block": part["block"], "area": pa.array(area, pa.int32()), "cell": pa.array(cell, pa.int32()),
                         "core": pa.array(core.astype(bool)), "to": lists, "key": part["key"], "copies": part["copies"],
                         "embedding": part["embedding"]})
    return place


def _merged(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, given that before the links (u, v)."""
    u, v, to = label[u], label[v], np.arange(len(label), dtype=label.dtype)
    while (apart := u != v).any():
        u, v = u[apart], v[apart]
        np.minimum.at(to, np.maximum(u, v), np.minimum(u, v))
        while ((on := to[to]) != to).any():
            to = on
        u, v = to[u], to[v]
    return to[label]


def _cosines(x: pa.ChunkedArray, i: np.ndarray, y: pa.ChunkedArray, j: np.ndarray) -> np.ndarray:
    """Of the vectors i of x with the vectors j of y, in double precision."""
    return np.einsum("ij,ij->i", _unit(_vectors(x.take(pa.array(i)))), _unit(_vectors(y.take(pa.array(j)))))


def _comparer(cosine: float):
    """Links of one group of queries to one group of candidates, and a spanning forest.

    Similarities are taken in single precision; those nearer to the limit than its error
    are taken again in double precision."""
    def compare(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table({"key": pa.array([], pa.string()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.string())})
        by_unit = np.argsort(q["unit"].to_numpy(), kind="stable")
        x, y = _single(q["embedding"])[by_unit], _single(c["embedding"])
        slack = (x.shape[1] + 16) * 2.0 ** -23
        names, where = np.unique(np.array(q["key"].to_pylist() + c["key"].to_pylist(), dtype="S"), return_inverse=True)
        where = where.astype(np.int32)
        copies = np.zeros(len(names), np.int64)
        copies[where] = np.concatenate([q["copies"].to_numpy(), c["copies"].to_numpy()])
        of_q, of_c = where[:len(q)][by_unit], where[len(q):]
        own, core = c["own"].to_numpy(), c["core"].to_numpy()
        lists = c["units"].combine_chunks()
        sent = lists.flatten().to_numpy()
        order = np.argsort(sent, kind="stable")
        sender = np.repeat(np.arange(len(c), dtype=np.int32), lists.value_lengths().to_numpy())[order]
        sent = sent[order]
        units, first = np.unique(q["unit"].to_numpy()[by_unit], return_index=True)
        links, label = np.zeros(len(names), np.int64), np.arange(len(names), dtype=np.int32)
        us, vs, waiting = [], [], 0
        for unit, low, high in zip(units, first, [*first[1:], len(q)]):
            b = sender[np.searchsorted(sent, unit):np.searchsorted(sent, unit, "right")]
            for j in range(0, len(b), TILE[1]):
                to = b[j:j + TILE[1]]
                cut = y[to].T
                for i in range(low, high, TILE[0]):
                    near = (x[i:min(i + TILE[0], high)] @ cut).ravel()
                    at = np.flatnonzero(near >= cosine - slack)
                    if not len(at):
                        continue
                    u, v = i + at // len(to), to[at % len(to)]
                    linked = near[at] >= cosine + slack
                    doubt = np.flatnonzero(~linked)
                    for k in range(0, len(doubt), 4096):
                        some = doubt[k:k + 4096]
                        linked[some] = _cosines(q["embedding"], by_unit[u[some]], c["embedding"], v[some]) >= cosine
                    u, v = of_q[u[linked]], v[linked]
                    once = ~own[v] | (core[v] != bool(unit % 2))      # else it is also met the other way
                    v = of_c[v]
                    np.add.at(links, u, np.where(u != v, copies[v], 0))
                    np.add.at(links, v[once], copies[u[once]])
                    apart = label[u] != label[v]
                    us.append(u[apart])
                    vs.append(v[apart])
                    waiting += len(us[-1])
                    if waiting > OPEN_LINKS:
                        label = _merged(label, np.concatenate(us), np.concatenate(vs))
                        us, vs, waiting = [], [], 0
        if us:
            label = _merged(label, np.concatenate(us), np.concatenate(vs))
        found, joined = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(names)))
        names = names.astype("U")
        return pa.table({"key": pa.array(np.concatenate([names[found], names[joined]]), pa.string()),
                         "links": np.concatenate([links[found], np.zeros(len(joined), np.int64)]),
                         "root": pa.array([None] * len(found) + names[label[joined]].tolist(), pa.string())})
    return compare


def _rows(limit: int) -> Column:
    """Rows of a block's length (its name begins with it) that count as ``limit``."""
    length = F.substring_index("block", "|", 1).cast("int")
    return F.greatest(F.lit(1), F.floor(limit / F.ceil(length / COMPONENTS)))


def _renewed(df: DataFrame) -> DataFrame:
    """The same rows under new column identities, for a cogroup with a relative."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    block_col: str = "label", cosine: float = 0.93) -> DataFrame:
    """Direct links and components of vectors with cosine at least ``cosine``.

    One row per input row: ``id_col``, n_links (other rows linked directly),
    component_id (smallest id reachable by links, itself included) and kept (id equals
    component_id).  Rows are compared only when their block is equal and not null and
    their vectors have the same length.  A vector that is null, empty, zero or holds a
    null or non-finite component links with nothing.  Equal rows, repeated ids included,
    are linked as rows of their own; a null id counts as a link but never names a
    component (component_id is null and kept false where no other id is reachable).  Other
    columns are ignored, whatever their names.  An empty table gives an empty result.
    """
    if not 0.0 < cosine < 1.0:
        raise ValueError("cosine must lie between 0 and 1")
    radius = float(np.sqrt(2.0 - 2.0 * cosine))
    single = isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), T.FloatType)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.col(block_col).cast("string").alias("b"))
    usable = (F.col("b").isNotNull() & F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("v", lambda x: x != 0.0), F.lit(False)))
    block = F.concat_ws("|", F.size("v").cast("string"), "b")
    rows = rows.select("id", "v", F.when(usable, block).alias("block"))
    # equal vectors of a block have equal digests and are compared once
    key = F.when(F.col("block").isNotNull(),
                 F.md5(F.concat_ws(",", F.lit(None).cast("string"), "block", F.col("v").cast("array<string>"))))
    rows = rows.withColumn("key", key)
    kind = "array<float>" if single else "array<double>"        # their own type takes half the room
    reps = stored(rows.where("key IS NOT NULL").groupBy("block", "key")
                  .agg(F.min("id").alias("least_id"), F.count("*").alias("copies"),
                       F.any_value(F.col("v").cast(kind)).alias("embedding")), "embedding_reps")

    sizes = reps.groupBy("block").agg(F.count("*").alias("rows"))
    sizes = sizes.withColumn("areas", F.ceil(F.col("rows") / _rows(QUERY_ROWS)).cast("long"))
    most = SALT_CELLS / (F.sqrt("rows") / PIVOT_SHARE + F.col("areas"))       # cells and areas of a block, about
    sizes = stored(sizes.withColumn("salts", F.ceil(F.col("rows") / F.greatest(
        F.lit(1.0), F.least(_rows(SALT_ROWS), most))).cast("int")), "embedding_sizes")      # known to be small where it is
    part = reps.join(sizes, "block")
    every_salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    u = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / float(16 ** 12)
    pivots = part.where(u * F.sqrt("rows") * PIVOT_SHARE < 1.0).select("block", "salts", "key", "embedding")
    part = part.select("block", F.pmod(F.xxhash64("key"), "salts").cast("int").alias("salt"),
                       F.xxhash64("key").alias("hash"), "key", "copies", "embedding")
    by = ["block", "salt"]
    cells = (part.select(*by, "embedding").groupBy(*by)
             .cogroup(_renewed(pivots).select("block", every_salt, "key", "embedding").groupBy(*by))
             .applyInArrow(_homes, "block string, cell string, n long"))
    cells = stored(cells.groupBy("block", "cell").agg(F.sum("n").alias("n")), "embedding_cells")
    in_order = Window.partitionBy("block").orderBy("cell")
    cells = (cells.select("block", "cell", "n", (F.row_number().over(in_order) - 1).alias("number"),
                          (F.sum("n").over(in_order) - F.col("n")).alias("start"))
             .join(pivots.select("block", F.col("key").alias("cell"), "embedding"), ["block", "cell"], "left")
             .join(sizes.select("block", "areas", "salts"), "block")
             .select("block", every_salt, "number", "n", "start", "areas", "embedding"))
    placed = stored(part.groupBy(*by).cogroup(_renewed(cells).groupBy(*by)).applyInArrow(
        _placer(radius), f"{PLACED}, key string, copies long, embedding {kind}"), "embedding_placed")

    sent = placed.select("block", F.explode("to").alias("to"), "core", "key", "copies", "embedding")
    sent = sent.select("block", "to.area", "to.own", "to.units", "core", "key", "copies", "embedding")
    groups = sent.groupBy("block", "area").agg(F.count("*").alias("n"))
    groups = stored(groups.select("block", "area", F.ceil(F.col("n") / _rows(CANDIDATE_ROWS)).cast("int").alias("groups")),
                    "embedding_groups")
    by = ["block", "area", "part"]
    q = placed.join(groups, ["block", "area"]).select(
        "block", "area", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"),
        (2 * F.col("cell") + F.col("core").cast("int")).alias("unit"), "key", "copies", "embedding")
    c = sent.join(groups, ["block", "area"]).select(
        "block", "area", F.pmod(F.xxhash64("key", F.lit(1)), "groups").cast("int").alias("part"),
        "own", "units", "core", "key", "copies", "embedding")
    found = stored(q.groupBy(*by).cogroup(_renewed(c).groupBy(*by)).applyInArrow(
        _comparer(cosine), "key string, links long, root string"), "embedding_links")

    # vectors of one core are linked without a comparison
    cores = placed.where("core").select("block", "cell", "key", "copies")
    counts = cores.groupBy("block", "cell").agg(F.sum("copies").alias("core_copies"), F.min("key").alias("core_key"))
    cores = cores.join(counts, ["block", "cell"]).select("key", "core_copies", "core_key")
    edges = (found.where("root IS NOT NULL").select(F.col("key").alias("u"), F.col("root").alias("v"))
             .unionByName(cores.select(F.col("key").alias("u"), F.col("core_key").alias("v"))))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(edges)
    per_rep = (reps.select("key", "least_id", "copies")
               .join(links, "key", "left").join(cores.select("key", "core_copies"), "key", "left")
               .join(roots.withColumnRenamed("node", "key"), "key", "left")
               .select("key", "least_id", F.coalesce("root", "key").alias("root"),
                       (F.coalesce("links", F.lit(0)) + F.coalesce("core_copies", "copies") - 1).alias("n_links")))
    least = per_rep.groupBy("root").agg(F.min("least_id").alias("component_id"))
    per_rep = per_rep.join(least, "root").select("key", "n_links", "component_id")
    out = rows.select("id", "key").join(per_rep, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def near_duplicates_sql(table: str = "embeddings", cosine: float = 0.93) -> str:
    """DuckDB SQL for :func:`near_duplicates` over ``table`` (vec_id, embedding, label) with
    unique ids, by comparing all pairs."""
    return f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
               label IS NOT NULL AND len(embedding) > 0
               AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
               AND len(list_filter(embedding, lambda c: c <> 0)) > 0 AS usable
        FROM {table}),
    u AS (SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS norm FROM v WHERE usable),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
              WHERE list_dot_product(a.x, b.x) / (a.norm * b.norm) >= {cosine}),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM v
              UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
    FROM v JOIN component c ON c.a = v.vec_id LEFT JOIN counts k ON k.a = v.vec_id"""
