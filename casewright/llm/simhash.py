"""SimHash near-duplicates: fingerprints, and links by a generalised pigeonhole over unequal bit groups.

Two fingerprints of 64 bits that differ in at most ``t`` bits must, for any groups g of the bits and any
thresholds T(g) >= -1 with sum t - groups + 1, differ in at most T(g) bits in some group. Bits that go together
share a group (their agreement is then counted once), and the thresholds come from dynamic programming over
the cost of probes and of estimated candidates. A group of threshold 0 is probed with its own bits, one of
threshold 1 with each bit flipped too, one of -1 not at all.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import components, durable

BITS = 64
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Cost of a probe that is dealt out and sorted, in comparisons of two fingerprints.
PROBE_COST = 12.0
#: Fingerprints that the driver holds to estimate candidate counts: a bound, whatever the corpus.
SAMPLE = 4096


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The unsigned SimHash: bit i is 1 if it is set in over half the hashes of the word shingles."""
    w = words(text)
    n = len(w)
    if n == 0:
        return 0
    line = b" ".join(w)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    end = np.cumsum(np.fromiter(map(len, w), np.int64, n) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(line[a:b], seed) for a, b in zip(start[: n - shingle + 1].tolist(), end[shingle - 1 :].tolist(), strict=True)], "<u8", n - shingle + 1)
    return majority(h)


def majority(h: np.ndarray) -> int:
    """The number whose bits are those that over half of the 64-bit numbers ``h`` have."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):  # a very long text takes bounded memory
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long. Null and empty texts and texts without words get 0."""

    def each(batches):
        for batch in batches:
            got = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(each, "id long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_moments(distinct: DataFrame) -> np.ndarray:
    """The 64 x 64 correlations of the bits over all distinct fingerprints; each task sends one matrix."""

    def each(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = _bits(batch.column(0).to_numpy()).astype(np.float32)
            total += x.T @ x
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["n", "m"])

    parts = distinct.select("fp").mapInArrow(each, "n long, m array<double>")
    summed = parts.select("n", F.posexplode("m").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect()
    both, n = np.zeros(BITS * BITS), max([1, *(r["n"] for r in summed)])
    for r in summed:
        both[r["k"]] = r["x"] / n
    both = both.reshape(BITS, BITS)
    p = np.diag(both)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return (both - np.outer(p, p)) / np.outer(spread, spread)


def bit_groups(correlation: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal size; each takes, one by one, the free bit that agrees most with its own."""
    tie, free, groups = np.abs(correlation), list(range(BITS)), []
    for g in range(m):
        size = (BITS - sum(map(len, groups))) // (m - g)
        own = [max(free, key=lambda b: (tie[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < size:
            own.append(max(free, key=lambda b: (tie[b, own].sum(), -b)))
            free.remove(own[-1])
        groups.append(sorted(own))
    return groups


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least cost that add up to ``total``; costs[g][t + 1] is what threshold t costs in group g."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        ahead: dict[int, tuple[float, list[int]]] = {}
        for had, (cost, chosen) in best.items():
            for t, more in enumerate(row, -1):
                if had + t not in ahead or cost + more < ahead[had + t][0]:
                    ahead[had + t] = (cost + more, [*chosen, t])
        best = ahead
    return best[total]


def plan(correlation: np.ndarray, sample: np.ndarray, n: int, distance: int) -> list[tuple[int, int]]:
    """(mask, threshold) of each probed group, for ``n`` distinct fingerprints of which ``sample`` are some."""
    x = np.unique(sample.astype(np.int64)).view(np.uint64)
    best: tuple[float, list[tuple[int, int]]] | None = None
    for m in range(1, distance + 2):
        masks = [sum(1 << b for b in g) for g in bit_groups(correlation, m)]
        costs = []
        for mask in masks:
            near = np.zeros(4)
            part = x & np.uint64(mask)
            for i in range(0, len(part), 512):
                near += np.bincount(np.minimum(np.bitwise_count(part[i : i + 512, None] ^ part[None, :]), 3).ravel(), minlength=4)
            near[0] -= len(part)  # a fingerprint against itself
            share, width = np.cumsum(near)[:3] / max(1, len(part) * (len(part) - 1)), mask.bit_count()
            costs.append([0.0] + [n * PROBE_COST * (1 + sum(comb(width, k) for k in range(t + 1))) + n * n * float(share[t]) for t in range(3)])
        if m * 2 >= distance - m + 1:
            cost, chosen = allocate(costs, distance - m + 1)
            if best is None or cost < best[0]:
                best = cost, [(mask, t) for mask, t in zip(masks, chosen, strict=True) if t >= 0]
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): ids of distinct fingerprints of ``distinct`` (id, fp) that differ in at most ``distance`` bits, once or more."""
    n = distinct.count()
    sample = np.array([r["fp"] for r in distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE).select("fp").collect()], np.int64)
    groups = plan(bit_moments(distinct), sample, n, distance) if n > 1 else [(2**BITS - 1, 0)]
    flips = []
    for g, (mask, t) in enumerate(groups):
        own = [b for b in range(BITS) if mask >> b & 1]
        flips += [(g, _signed(mask), _signed(sum(1 << b for b in flip))) for k in range(t + 1) for flip in combinations(own, k)]
    probes = ", ".join(f"struct({g}, {m}L, {x}L)" for g, m, x in flips)
    index = ", ".join(f"struct({g}, {m}L, 0L)" for g, m, x in flips if x == 0)
    spread = lambda these, name: distinct.select("id", "fp", F.expr(f"inline(array({these.replace('-9223372036854775808L', '(-9223372036854775807L - 1L)')})) as (g, mask, flip)")).select(F.col("g").alias(f"{name}_g"), F.expr("(fp & mask) ^ flip").alias(f"{name}_key"), F.col("id").alias(f"{name}_id"), F.col("fp").alias(f"{name}_fp"))
    x, y = spread(probes, "x"), spread(index, "y")
    near = (F.col("x_g") == F.col("y_g")) & (F.col("x_key") == F.col("y_key")) & (F.col("x_fp") < F.col("y_fp")) & (F.bit_count(F.col("x_fp").bitwiseXOR(F.col("y_fp"))) <= distance)
    return x.join(y, near).select(F.col("x_id").alias("a"), F.col("y_id").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, shingle: int = 4) -> DataFrame:
    """(id_col, fp, component_id) for every row of ``docs``.

    Equal fingerprints become one row before any pairing, so copies never multiply; pairs are made between
    different fingerprints only. component_id is the smallest id reachable over links, the row's own included.
    Rows whose id is null take no part in links: their component_id is null. Repeated ids yield repeated rows.
    Other columns of ``docs`` are not read; an empty table gives an empty result.
    """
    prints = durable(fingerprints(docs, id_col, text_col, shingle))
    distinct = durable(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("id")))
    tops = components(links(distinct, distance))
    classes = distinct.join(tops, F.col("id") == F.col("node"), "left").select(F.col("fp").alias("class_fp"), F.coalesce("component", "id").alias("component_id"))
    return prints.join(classes, F.col("fp") == F.col("class_fp"), "left").select(F.col("id").alias(id_col), "fp", F.expr("case when id is not null then component_id end").alias("component_id"))
