"""Near copies by exact Jaccard similarity of word shingles; fingerprints and MinHash bands only say what to compare.

Texts of equal words are one class. Classes whose SimHashes of 5-word shingles link (``simhash.links``, the generalised
pigeonhole) are candidates. At a similarity of 0.8 two fingerprints differ in 9 to 10 bits of 64 on average, more than a
pigeonhole can probe at any size, so classes that share a band of ROWS minima are candidates too: a pair at 0.8 shares no
band with probability (1 - 0.8**6)**40, or 5 in a million.

Each bucket adds a star of candidates, never all its pairs. A connected set of at most GATHERED candidates goes to one
task, where a search from text to text drops each text it reaches, so a group of copies costs about one comparison a
text. A larger set is never gathered: the leaves of its stars are compared with their centers in a stream, which joins
most of a group of copies; then the texts outside its largest group are compared with all that share a band with them
and lie in another group. Either way two candidates in different groups have been compared, and each link is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import components, durable, mix
from casewright.llm.simhash import links, majority, words

ROWS, BANDS = 6, 40
_RNG = np.random.default_rng(12)
_FACTORS = _RNG.integers(0, 2**31, ROWS * BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SALTS = _RNG.integers(0, 2**63, (ROWS + 1, BANDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Candidates of a connected set that one task takes at most.
GATHERED = 10_000
#: Leaves that one task compares with a center.
LEAVES = 4096
#: Shingles that are hashed by all factors at once.
_CHUNK = 4096


def shingles(w: list[bytes], size: int = 5) -> np.ndarray:
    """The different hashes of the shingles of ``size`` words, ascending; a shorter text is one shingle."""
    if not w:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(w), len(w)
    end = np.cumsum(np.fromiter(map(len, w), np.int64, n) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    last = max(1, n - size + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b]) for a, b in zip(start[:last].tolist(), end[min(size, n) - 1 :].tolist(), strict=True)], np.uint64))


def bands(s: np.ndarray) -> np.ndarray:
    """A key for each band of minima; the band's number is part of it."""
    least = np.full(ROWS * BANDS, 2**32 - 1, np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), _CHUNK):
        np.minimum(least, (_FACTORS[:, None] * x[None, i : i + _CHUNK]).min(axis=1), out=least)
    return mix((least.reshape(ROWS, BANDS) * _SALTS[:ROWS]).sum(axis=0, dtype=np.uint64) + _SALTS[ROWS]).view(np.int64)


def alike(sets: list[np.ndarray], parts: tuple[int, int] = (4, 5)) -> list[tuple[int, int]]:
    """Pairs (i, j) of a spanning forest of the sets whose Jaccard similarity is ``parts`` (a fraction) or more."""
    size = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(size, kind="stable")
    _, flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    size, vocabulary = size[order], int(flat.max()) + 1 if len(flat) else 0
    at = np.concatenate(([0], np.cumsum(size)))
    marked, out, (num, den) = np.zeros(vocabulary, bool), [], parts
    left, left_flat, left_at = np.arange(len(size)), flat, at  # what no search has reached, by size

    while len(left):
        queue = [left[0]]
        left, left_flat, left_at = left[1:], left_flat[left_at[1] :], left_at[1:] - left_at[1]
        while queue and len(left):
            p = queue.pop()
            own = flat[at[p] : at[p + 1]]
            low, high = np.searchsorted(size[left] * den, size[p] * num), np.searchsorted(size[left] * num, size[p] * den, side="right")
            if low >= high:
                continue
            marked[own] = True
            part = left_flat[left_at[low] : left_at[high]]
            both = np.add.reduceat(marked[part], left_at[low:high] - left_at[low], dtype=np.int64)
            marked[own] = False
            hit = both * den >= num * (size[p] + size[left[low:high]] - both)
            if not hit.any():
                continue
            reached = left[low:high][hit]
            out += [(int(order[p]), int(order[q])) for q in reached]
            queue += reached.tolist()
            stay = np.ones(len(left), bool)
            stay[low:high] = ~hit
            left_flat = left_flat[np.repeat(stay, np.diff(left_at))]
            left = left[stay]
            left_at = np.concatenate(([0], np.cumsum(size[left])))
    return out


def similar(x: np.ndarray, y: np.ndarray, num: int = 4, den: int = 5) -> bool:
    """Whether the Jaccard similarity of two ascending sets is ``num`` / ``den`` or more; an empty set is like none."""
    if not len(x) or not len(y) or min(len(x), len(y)) * den < max(len(x), len(y)) * num:
        return False
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return both * den >= num * (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): the ``pairs`` (center, leaf) of nodes whose ``sets`` (node, s) are similar.

    A center's set meets its leaves in a stream, so a task holds one set at a time; a center with many leaves is dealt
    out to several tasks.
    """
    counts = durable(pairs.groupBy("center").agg(F.ceil(F.count("*") / LEAVES).cast("int").alias("k")))
    heads = counts.join(sets, F.col("center") == F.col("node")).select("center", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("salt"), F.lit(-1).cast("long").alias("leaf"), "s")
    leaves = pairs.join(counts, "center").withColumn("salt", F.pmod(F.xxhash64("leaf"), F.col("k")).cast("int")).join(sets, F.col("leaf") == F.col("node")).select("center", "salt", "leaf", "s")
    met = heads.union(leaves).repartition("center", "salt").sortWithinPartitions("center", "salt", "leaf")

    def each(batches):
        now, head = None, None
        for batch in batches:
            out = []
            for center, salt, leaf, s in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                own = np.frombuffer(s, np.uint64)
                if leaf < 0:
                    now, head = (center, salt), own
                elif now == (center, salt) and similar(head, own):
                    out.append((leaf, center))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return met.mapInArrow(each, "a long, b long")


def starred(pairs: DataFrame, dealt: DataFrame, sets: DataFrame, whole: DataFrame) -> DataFrame:
    """(a, b): links that join the nodes of ``whole`` (node, component) as far as any two of them that share a band do.

    ``pairs`` (center, leaf) are the stars and ``dealt`` (node, band) the bands of these nodes.
    """
    found = durable(verified(pairs, sets))
    groups = durable(whole.withColumnRenamed("component", "of").join(components(found), "node", "left").select("node", "of", F.coalesce("component", "node").alias("own")))
    largest = groups.groupBy("of", "own").agg(F.count("*").alias("n")).groupBy("of").agg(F.max(F.struct("n", "own"))["own"].alias("most"))
    outside = groups.join(largest, "of").where("own <> most").select(F.col("node").alias("center"), F.col("own").alias("c_own"))
    asked = outside.join(dealt.withColumnRenamed("node", "center"), "center")
    mates = dealt.join(groups.select("node", "own"), "node").withColumnRenamed("node", "leaf")
    more = asked.join(mates, "band").where("own <> c_own").select("center", "leaf").distinct()
    return found.union(durable(verified(durable(more.join(pairs, ["center", "leaf"], "left_anti")), sets)))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4) -> DataFrame:
    """(id, key, component) for every row of ``docs`` with an id: key stands for the row's words, and component for
    all texts that links of a 5-word Jaccard similarity of 0.8 or more join. A text of fewer words is one shingle; texts
    without words, null ones included, are copies of each other. Ids may repeat; an empty table gives an empty result."""
    given = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))

    def printed(batches):
        for batch in batches:
            keys, prints, found = [], [], []
            for text in batch.column(1).to_pylist():
                w = words(text)
                s = shingles(w)
                keys.append(xxhash.xxh3_128_digest(b" ".join(w)))
                prints.append(majority(s))
                found.append(bands(s) if w else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(found, pa.list_(pa.int64()))], names=["id", "key", "fp", "bands"])

    def full(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                w = [words(text) for text in batch.column(1).to_pylist()]
                keys, sets = [xxhash.xxh3_128_digest(b" ".join(x)) for x in w], [shingles(x).tobytes() for x in w]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["id", "key", "s"])

    def compared(table):
        node, first = np.unique(table.column("node").to_numpy(), return_index=True)
        own = table.column("s").take(pa.array(first)).to_pylist()
        links_ = np.array(alike([np.frombuffer(s, np.uint64) for s in own]), np.int64).reshape(-1, 2)
        return pa.table([pa.array(node[links_[:, 0]]), pa.array(node[links_[:, 1]])], names=["a", "b"])

    prints = durable(given.mapInArrow(printed, "id long, key binary, fp long, bands array<long>"))
    classes = durable(prints.groupBy("key").agg(F.min("id").alias("id"), F.first("fp").alias("fp"), F.first("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id()))
    same = durable(classes.groupBy("fp").agg(F.min("node").alias("id")))
    near = links(same, distance).union(classes.join(same.withColumnRenamed("id", "b"), "fp").where("node <> b").select("node", "b"))
    dealt = classes.select("node", F.explode("bands").alias("band"))
    shared = dealt.groupBy("band").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = near.union(dealt.withColumnRenamed("node", "a").join(shared, "band").where("a <> b").select("a", "b"))
    pairs = durable(stars.select(F.least("a", "b").alias("center"), F.greatest("a", "b").alias("leaf")).distinct())
    whole = components(pairs, "center", "leaf")
    wanted = durable(classes.join(whole, "node").select("node", "id", "key", "component"))
    large = wanted.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > GATHERED).select("component")
    large = durable(large)

    def sets(rows: DataFrame) -> DataFrame:
        texts = given.join(rows.select("id").distinct(), "id", "left_semi").mapInArrow(full, "id long, key binary, s binary")
        return texts.join(rows, ["id", "key"]).select("component", "node", "s")

    found = sets(wanted.join(large, "component", "left_anti")).groupBy("component").applyInArrow(compared, "a long, b long")
    if not large.isEmpty():
        own = durable(wanted.join(large, "component", "left_semi").select("node", "id", "key", "component"))
        mine = own.select("node")
        found = found.union(starred(pairs.join(mine, F.col("center") == F.col("node"), "left_semi"), dealt.join(mine, "node", "left_semi"), durable(sets(own).select("node", "s").dropDuplicates(["node"])), own.select("node", "component").distinct()))
    named = classes.select("key", "node").join(components(found), "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    return prints.select("id", "key").join(named, "key").select("id", "key", "component")
