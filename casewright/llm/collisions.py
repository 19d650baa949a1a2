"""Embedding near-duplicates by collision counting over many one-dimensional projections.

Two unit vectors whose cosine is at least the threshold lie at most d = sqrt(2 - 2 cosine) apart, so on a random
Gaussian direction they differ by no more than WINDOW * d with a known probability. The vectors of a block are sorted
by each of many projections; around a query's projection lies a window, which is a stretch of that order. A pair
collides on a direction where one lies in the other's window. Pairs that collide on at least the number of directions
that a pair at the very threshold reaches with probability 1 - MISS are verified exactly.

Windows are counted as sets of bits: for each order, a set for each prefix of it, so that a window is the difference of
two of them, and the windows of one query on all directions are added up bit by bit, 64 vectors in one word. All vectors
are sorted by one projection of unit length and cut into blocks there; as unit vectors that near can't differ by more
than d on it, what lies farther apart in that order is never compared.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from casewright.llm.common import components, durable
from casewright.llm.vectors import classes, dimension, lengths, matrix

#: Half a window, in standard deviations of what a pair at the threshold differs by.
WINDOW = 2.0
#: All directions, and those that are counted for every pair; the others are counted for pairs that these leave.
DIRECTIONS, FIRST = 64, 32
#: How likely a pair at the threshold may be passed over.
MISS = 1e-6
#: Vectors in a block; a task holds two blocks.
BLOCK = 4096
#: Queries whose windows are added up at a time.
TILE = 256


def least_count(directions: int = DIRECTIONS, window: float = WINDOW, miss: float = MISS / 2) -> int:
    """The greatest count that a pair at the threshold reaches with probability 1 - miss at least."""
    p, below = erf(window / sqrt(2)), 0.0
    for k in range(directions + 1):
        below += comb(directions, k) * p**k * (1 - p) ** (directions - k)
        if below > miss:
            return k
    return directions


def prefixes(order: np.ndarray) -> np.ndarray:
    """Row r is the set of the first r members of ``order``, a bit for each place; n + 1 rows."""
    n = len(order)
    out = np.zeros((n + 1, -(-n // 64)), np.uint64)
    out[np.arange(1, n + 1), order >> 6] = np.uint64(1) << (order & 63).astype(np.uint64)
    return np.bitwise_or.accumulate(out, axis=0, out=out)


def at_least(planes: list[np.ndarray], least: int) -> np.ndarray:
    """The set of places whose count is ``least`` or more; plane p holds the counts' bits of worth 2**p."""
    more, equal = np.zeros_like(planes[0]), np.full_like(planes[0], ~np.uint64(0))
    for p in range(len(planes) - 1, -1, -1):
        if least >> p & 1:
            equal &= planes[p]
        else:
            more |= equal & planes[p]
            equal &= ~planes[p]
    return more | equal


def colliding(x: np.ndarray, y: np.ndarray, half: float, x_sorted: np.ndarray, y_sorted: np.ndarray, far: float):
    """Pairs (i, j) of rows of the projections x and y with as many collisions as a pair at the threshold has.

    ``x_sorted`` and ``y_sorted`` are the ascending projections on the one direction of unit length: a tile of x meets
    the stretch of y that lies no farther off than ``far``.
    """
    first, least = least_count(FIRST), least_count()
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if not len(x) or not len(y):
        return left[0], right[0]
    order = [np.argsort(y[:, k]) for k in range(DIRECTIONS)]
    place = [np.argsort(o) for o in order]
    sorted_ = [y[order[k], k] for k in range(DIRECTIONS)]
    low = [np.searchsorted(sorted_[k], x[:, k] - half - 1e-9) for k in range(DIRECTIONS)]
    high = [np.searchsorted(sorted_[k], x[:, k] + half + 1e-9, side="right") for k in range(DIRECTIONS)]
    sets = [prefixes(order[k]) for k in range(FIRST)]
    for i in range(0, len(x), TILE):
        j = min(i + TILE, len(x))
        a, b = np.searchsorted(y_sorted, x_sorted[i] - far - 1e-9), np.searchsorted(y_sorted, x_sorted[j - 1] + far + 1e-9, side="right")
        if a >= b:
            continue
        words = slice(int(a) // 64, -(-int(b) // 64))
        planes = [np.zeros((j - i, words.stop - words.start), np.uint64) for _ in range(FIRST.bit_length())]
        for k in range(FIRST):
            carry = sets[k][high[k][i:j], words] & ~sets[k][low[k][i:j], words]
            for p in range((k + 1).bit_length()):
                planes[p], carry = planes[p] ^ carry, planes[p] & carry
        p, q = np.nonzero(np.unpackbits(at_least(planes, first).view(np.uint8), axis=1, bitorder="little"))
        total = sum((planes[k][p, q >> 6] >> (q & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << k for k in range(len(planes)))
        q += words.start * 64
        keep = (q >= a) & (q < b)
        p, q, total = p[keep] + i, q[keep], total[keep]
        for k in range(FIRST, DIRECTIONS):
            at = place[k][q]
            total += (at >= low[k][p]) & (at < high[k][p])
            if k % 8 == 7:  # what can't reach the count any more leaves
                keep = total + (DIRECTIONS - 1 - k) >= least
                p, q, total = p[keep], q[keep], total[keep]
        keep = total >= least
        left.append(p[keep])
        right.append(q[keep])
    return np.concatenate(left), np.concatenate(right)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges with the same components as (a, b), one fewer than there are nodes in each."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    ends = [(x, find(x)) for x in parent]
    return [x for x, r in ends if x != r], [r for x, r in ends if x != r]


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, block: int = BLOCK, seed: int = 9) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``rows``.

    Two rows link if their vectors have one length and a cosine, in double precision, of at least ``cosine``. Equal
    vectors are one class: only classes are compared, and a row's links are its class's other rows and the rows of
    linked classes. Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
    id, link with nothing; a null id's component is null. Rows with one id count as rows of their own, each with its
    own vector's links. Other columns are not read; an empty table gives an empty result.
    """
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    every = durable(classes(base, "id", "v").withColumn("c", F.monotonically_increasing_id()))
    dims = dimension(every, "v")
    rng = np.random.default_rng(seed)
    far = sqrt(max(0.0, 2 - 2 * cosine))
    first = rng.normal(size=max(1, dims))
    first /= np.linalg.norm(first)
    lit = F.array(*[F.lit(float(x)) for x in first])
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sorted_ = every.withColumn("p", F.aggregate(F.zip_with("v", lit, lambda x, w: F.coalesce(x, F.lit(0.0)) * w), F.lit(0.0), lambda s, x: s + x) / norm)
    n_blocks = max(1, -(-every.count() // block))
    cuts = sorted_.approxQuantile("p", [k / n_blocks for k in range(1, n_blocks)], 0.1 / n_blocks) if n_blocks > 1 else []
    blocked = sorted_.withColumn("g", _bucket(F.col("p"), sorted(set(cuts))))
    # a row for each block; those that it reaches are one range, since blocks follow the order
    spans = np.array(blocked.groupBy("g").agg(F.min("p").alias("low"), F.max("p").alias("high")).orderBy("g").collect() or [(0, 0.0, 0.0)], np.float64)
    lowest, highest = np.searchsorted(spans[:, 2], spans[:, 1] - far - 1e-9), np.searchsorted(spans[:, 1], spans[:, 2] + far + 1e-9, side="right") - 1
    reach = rows.sparkSession.createDataFrame([(int(g), int(spans[i, 0]), int(spans[j, 0])) for g, i, j in zip(spans[:, 0], lowest, highest, strict=True)], "g int, from int, to int")
    dealt = blocked.join(F.broadcast(reach), "g").withColumn("h", F.explode(F.sequence("from", "to"))).withColumns({"gi": F.least("g", "h"), "gj": F.greatest("g", "h")})
    directions = rng.normal(size=(max(1, dims), DIRECTIONS))
    half = WINDOW * far

    def compare(key, table):
        g, i, j = table.column("g").to_numpy(), key[0].as_py(), key[1].as_py()
        ids, n, place = (table.column(c).to_numpy() for c in ("c", "n", "p"))
        vectors = table.column("v").combine_chunks()
        v, long = matrix(vectors, dims), lengths(vectors)
        size = np.sqrt((v * v).sum(1))
        p = v @ directions / size[:, None]
        mine, other = (x[np.argsort(place[x], kind="stable")] for x in (np.flatnonzero(g == i), np.flatnonzero(g == j)))
        a, b = colliding(p[mine], p[other], half, place[mine], place[other], far)
        a, b = mine[a], other[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        ok = long[a] == long[b]
        for k in range(0, len(a), 1 << 16):
            s, t = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            ok[k : k + (1 << 16)] &= np.einsum("ij,ij->i", v[s], v[t]) / (size[s] * size[t]) >= cosine
        a, b = a[ok], b[ok]
        links = np.bincount(a, n[b], len(ids)) + np.bincount(b, n[a], len(ids))
        has = np.flatnonzero(links)
        x, y = _forest(ids[a], ids[b])
        return pa.table([pa.array([*ids[has].tolist(), *x], pa.int64()), pa.array([*[0] * len(has), *y], pa.int64()), pa.array([*links[has].astype(np.int64).tolist(), *[0] * len(x)], pa.int64())], names=["a", "b", "links"])

    # vectors of floats travel as floats, which doubles hold exactly
    kind = "array<float>" if rows.schema[vector_col].dataType.elementType == FloatType() else "array<double>"
    # a row with links counts a class's links within one pair of blocks; one without is an edge
    found = durable(dealt.select("c", "n", "p", F.col("v").cast(kind).alias("v"), "g", "gi", "gj").groupBy("gi", "gj").applyInArrow(compare, "a long, b long, links long"))
    tops = every.select("c", "id").join(components(found.where("links = 0")).withColumnRenamed("node", "c"), "c")
    least = tops.groupBy("component").agg(F.min("id").alias("least"))
    tops = tops.join(least, "component").select(F.col("c").alias("node"), "least")
    counts = found.where("links > 0").groupBy(F.col("a").alias("l_c")).agg(F.sum("links").alias("links"))
    told = every.join(tops, F.col("c") == F.col("node"), "left").join(counts, F.col("c") == F.col("l_c"), "left")
    told = told.select(F.col("v").cast(kind).alias("class_v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("least", "id").alias("component"))
    keyed = base.select("id", F.col("v").cast(kind).alias("v"))
    joined = keyed.join(told, (F.col("v") == F.col("class_v")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("component", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _bucket(p, cuts: list[float]):
    """The number of cuts at or below ``p``."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= p)) if cuts else F.lit(0)
