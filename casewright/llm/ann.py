"""Approximate nearest neighbours by multiprobe p-stable hashing, for the largest inner product.

Vectors are split into ranges of norms within a factor of two, each range scaled to a greatest norm of one, and get
one more component that makes all of them unit vectors; then the nearest point of a range is the one of largest inner
product. Each of TABLES tables of a range hashes a point to the cell of
HASHES Gaussian projections cut into steps of WIDTH. A query visits, in every table, the PROBES cells around its own
that are likeliest to hold neighbours: a cell's score is the sum of squared distances from the query's projections
to the cell's sides. Candidates of all tables are merged and ranked by their exact inner
product. A query that finds too few is compared with all points.

Cells are dealt out by table and their first few coordinates, in blocks of bounded size for data and queries alike.
"""

from __future__ import annotations

from itertools import product
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casewright.llm.common import durable
from casewright.llm.vectors import dimension, lengths, matrix, usable

TABLES, HASHES, WIDTH, PROBES = 4, 8, 2.0, 480
#: Rows and queries that one task holds at a time.
BLOCK, QUERIES = 8192, 4096
_BIAS = 128


class Tables:
    """The random projections; equal seeds give equal tables everywhere."""

    def __init__(self, dims: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(TABLES, dims + 1, HASHES))
        self.b = rng.uniform(0, WIDTH, (TABLES, HASHES))
        self.steps = np.array(list(product((-1, 0, 1), repeat=HASHES)), np.int8)

    def project(self, x: np.ndarray, top: np.ndarray | None, query: bool) -> np.ndarray:
        x = x / (np.linalg.norm(x, axis=1) if query else top)[:, None]
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))
        return (np.einsum("nd,tdk->tnk", np.column_stack([x, more]), self.a) + self.b[:, None]) / WIDTH

    def probes(self, p: np.ndarray) -> np.ndarray:
        """Cells (query, probe, coordinate) for projections (query, coordinate), in order of estimated success."""
        own = np.floor(p)
        low = p - own
        cost = np.stack([low**2, np.zeros_like(low), (1 - low) ** 2], axis=2)
        total = np.zeros((len(p), len(self.steps)))
        for k in range(HASHES):
            total += cost[:, k, :][:, self.steps[:, k] + 1]
        n = min(PROBES, len(self.steps))
        best = np.argpartition(total, n - 1, axis=1)[:, :n]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(total, best, 1), axis=1, kind="stable"), 1)
        return own[:, None, :].astype(np.int64) + self.steps[best]


def _packed(cells: np.ndarray) -> np.ndarray:
    out = np.zeros(cells.shape[:-1], np.int64)
    for k in range(cells.shape[-1]):
        out = out << 7 | np.clip(cells[..., k] + 64, 0, 127)
    return out


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``rows`` of largest inner product found for each of ``queries``.

    A row with the query's own id is no candidate. Ties go to the smaller id; fewer candidates give fewer rows.
    Vectors that are null, empty, zero or hold null or non-finite components, and null ids, take no part on either
    side. A repeated query id with different vectors is searched with the least of them. Equal vectors are one class,
    of which the ``k`` + 1 smallest ids can come into a result. A vector of another length than a query's is no
    candidate of that query.
    """
    as_doubles = F.transform(vector_col, lambda x: x.cast("double"))
    clean = lambda df: df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), as_doubles.alias("v"))
    members = clean(rows).distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    members = durable(members.withColumn("c", F.min("id").over(Window.partitionBy("v"))).select("c", "id", "r", "v"))
    asked = durable(clean(queries).groupBy("id").agg(F.min("v").alias("v")))
    dims = dimension(members.select("v").union(asked.select("v")), "v")
    schema = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return rows.sparkSession.createDataFrame([], schema)
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("most")) * (x / F.col("most")))) * F.col("most")
    points = members.where("r = 1").withColumn("most", F.array_max(F.transform("v", F.abs))).select("id", "v", F.least(size, F.lit(np.finfo(float).max.item())).alias("norm"))
    top, n = points.agg(F.max("norm"), F.count("*")).first()
    if top is None:
        return rows.sparkSession.createDataFrame([], schema)
    points = points.withColumn("band", F.greatest(F.lit(0), F.floor(F.log2(F.lit(top)) - F.log2("norm"))).cast("int"))
    tops = {x["band"]: x["top"] for x in points.groupBy("band").agg(F.max("norm").alias("top")).collect()}
    # a query's own id can stand for as many candidates as it has vectors; none of them may take another's place
    short_list = k + (members.join(asked.select("id"), "id", "left_semi").groupBy("id").count().agg(F.max("count")).first()[0] or 1)
    tables, lead = Tables(dims), max(1, min(4, ceil(log(max(2, n / BLOCK), 3))))

    def hashed(batches):
        for batch in batches:
            v = matrix(batch.column(1), dims)
            if len(v):
                band = batch.column(2).to_numpy()
                cells = np.floor(tables.project(v, np.array([tops[x] for x in band.tolist()]), False)).astype(np.int64)
                t = np.repeat(np.arange(TABLES), len(v)) + np.tile(band, TABLES) * TABLES
                take = np.tile(np.arange(len(v)), TABLES)
                yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(_packed(cells[:, :, :lead]).ravel()), *(batch.column(c).take(pa.array(take)) for c in (0, 1)), pa.array(_packed(cells).ravel()[:, None].tolist(), pa.list_(pa.int64()))], names=["t", "g", "id", "v", "cells"])

    def probed(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                p = tables.project(matrix(batch.column(1), dims), None, True)
                out = [[], [], [], []]
                for t in range(TABLES):
                    cells = tables.probes(p[t])
                    coarse, fine = _packed(cells[:, :, :lead]), _packed(cells)
                    for q in range(len(cells)):
                        order = np.argsort(coarse[q], kind="stable")
                        c, f = coarse[q][order], fine[q][order]
                        edge = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
                        out[0] += [t] * len(edge)
                        out[1] += c[edge].tolist()
                        out[2] += [q] * len(edge)
                        out[3] += [x.tolist() for x in np.split(f, edge[1:])]
                take = pa.array(out[2], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), *(batch.column(c).take(take) for c in (0, 1)), pa.array(out[3], pa.list_(pa.int64()))], names=["t", "g", "id", "v", "cells"])

    made = "t int, g long, id long, v array<double>, cells array<long>"
    data, probes = durable(points.select("id", "v", "band").mapInArrow(hashed, made)), durable(asked.mapInArrow(probed, made))
    if set(tops) != {0}:
        probes = probes.withColumn("band", F.explode(F.array(*map(F.lit, sorted(tops))))).select((F.col("t") + F.col("band") * TABLES).alias("t"), "g", "id", "v", "cells")
    share = lambda df, size, name: df.groupBy("t", "g").agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    def met(data, probes):
        """The short lists of the queries of ``probes``, one for each block of ``data`` that they meet."""
        parts = share(data, BLOCK, "nd").join(share(probes, QUERIES, "nq"), ["t", "g"])  # a row for each cell: few, whatever the input
        data = data.join(F.broadcast(parts), ["t", "g"]).select("t", "g", F.expr("cast(pmod(xxhash64(id), nd) as int)").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("j"), F.lit(0).alias("side"), "id", "v", "cells")
        probes = probes.join(F.broadcast(parts), ["t", "g"]).select("t", "g", F.explode(F.sequence(F.lit(0), F.col("nd") - 1)).alias("i"), F.expr("cast(pmod(xxhash64(id), nq) as int)").alias("j"), F.lit(1).alias("side"), "id", "v", "cells")
        return data.union(probes).groupBy("t", "g", "i", "j").applyInArrow(ranked, "q long, c array<long>, score array<double>")

    def ranked(table):
        side, ids, vectors = table.column("side").to_numpy(), table.column("id").to_numpy(), table.column("v").combine_chunks()
        v, long = matrix(vectors, dims), lengths(vectors)
        cells = table.column("cells").combine_chunks()
        at, flat = cells.offsets.to_numpy(), cells.values.to_numpy()
        points = np.flatnonzero(side == 0)
        points = points[np.lexsort((ids[points], flat[at[points]]))]
        own, x = flat[at[points]], v[points]
        out = [[], [], []]
        for q in np.flatnonzero(side == 1):
            probe = flat[at[q] : at[q + 1]]
            low, high = np.searchsorted(own, probe), np.searchsorted(own, probe, side="right")
            some = high > low
            low, size = low[some], (high - low)[some]
            if not len(low):
                continue
            take = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
            if not (fits := long[points[take]] == long[q]).all():
                take = take[fits]
            score, who = x[take] @ v[q], ids[points[take]]
            if len(score) > short_list:
                least = np.partition(score, len(score) - short_list)[len(score) - short_list]
                keep = score >= least
                score, who = score[keep], who[keep]
            best = np.lexsort((who, -score))[:short_list]
            out[0].append(int(ids[q]))
            out[1].append(who[best].tolist())
            out[2].append(score[best].tolist())
        return pa.table([pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())), strict=True)], names=["q", "c", "score"])

    def merged(table):
        """The best of one query's short lists; a candidate that several tables found counts once."""
        who, score = (table.column(n).combine_chunks().flatten().to_numpy() for n in ("c", "score"))
        who, first = np.unique(who, return_index=True)
        score = score[first]
        best = np.lexsort((who, -score))[:short_list]
        return pa.table([pa.array(np.full(len(best), table.column("q")[0].as_py())), pa.array(who[best]), pa.array(score[best])], names=["q", "c", "score"])

    lists = lambda found: found.groupBy("q").applyInArrow(merged, "q long, c long, score double")
    named = lambda found: found.join(members.select("c", "id"), "c").where("id != q").select("q", "id", "score")
    found = durable(lists(met(data, probes)))
    enough = named(found).groupBy("q").count().where(F.col("count") >= k)
    few = durable(asked.join(enough, F.col("id") == F.col("q"), "left_anti"))
    if not few.isEmpty():
        one_cell = lambda df: df.select(F.lit(0).alias("t"), F.lit(0).cast("long").alias("g"), "id", "v", F.array(F.lit(0).cast("long")).alias("cells"))
        found = found.join(few.select(F.col("id").alias("q")), "q", "left_anti").union(lists(met(one_cell(points), one_cell(few))))
    final = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return named(found).withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select(F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
