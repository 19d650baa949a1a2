"""URL filters: exact membership of hosts and paths in rule lists by cascades of Bloom filters.

The key universe is every key that some URL of the corpus could match: its host or a parent domain with as many
labels as some rule has, joined to a prefix of its path as long as some rule's. Level 0 of a cascade encodes a
list's keys; level 1 the universe's keys that level 0 takes wrongly; level 2 the list's keys that level 1 takes; and
so on until a level takes nothing wrongly. A key is listed if the first level that refuses it has an odd number.
Over the universe this is exact, so that no URL is joined to the rules. A long list is dealt out by the keys' hash into
shares of bounded size; each share has cascades of its own and makes one pass over the URLs, which keep their best rule.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.common import durable, mix

#: Listed keys of one share: its cascades take about 40 MB at most, its keys 64 MB while they are built.
SHARE = 4_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Bloom:
    """A filter over pairs of 64-bit hashes; levels of a cascade differ by their ``salt``, so that keys which meet in
    one level part in another."""

    def __init__(self, n: int, rate: float, salt: int):
        self.salt = np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
        per_key = 1.44 * math.log2(1 / rate)
        self.bits = max(64, int(n * per_key))
        self.hashes = max(1, round(per_key * 0.69))
        self.words = np.zeros(self.bits // 64 + 1, np.uint64)

    def _slots(self, a: np.ndarray, b: np.ndarray):
        a, b = mix(a.view(np.uint64) ^ self.salt), mix(b.view(np.uint64) + self.salt) | np.uint64(1)
        for k in range(self.hashes):
            yield mix(a + b * np.uint64(k)) % np.uint64(self.bits)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for s in self._slots(a, b):
            np.bitwise_or.at(self.words, s >> np.uint64(6), np.uint64(1) << (s & np.uint64(63)))

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for s in self._slots(a, b):
            out &= (self.words[s >> np.uint64(6)] >> (s & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def listed(levels: list[Bloom], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each key is in the list that the cascade was built from."""
    out, open_ = np.zeros(len(a), bool), np.arange(len(a))
    for k, level in enumerate(levels):
        took = level.has(a[open_], b[open_])
        out[open_[~took]] = k % 2 == 1
        open_ = open_[took]
    out[open_] = len(levels) % 2 == 1
    return out


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and for URLs without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All keys that a rule of these label counts and path lengths could have for the URL, as an array."""
    parts, n = F.split(host, r"\.", -1), F.size(F.split(host, r"\.", -1))
    hosts = [F.when(n >= k, F.array_join(F.slice(parts, n - k + 1, k), ".")) for k in labels]
    paths = [F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths]
    return F.array_compact(F.array(*[F.concat(h, p) for h in hosts for p in paths]))


def _false_hits(keys: DataFrame, first: Bloom, a: np.ndarray, b: np.ndarray) -> DataFrame:
    """The keys (a, b) of ``keys`` that ``first`` takes although they aren't listed."""
    sent = keys.sparkSession.sparkContext.broadcast((first, np.sort(np.rec.fromarrays([a, b], names="a,b"))))

    def each(batches):
        level, mine = sent.value
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            hits = np.flatnonzero(level.has(a, b))
            if len(mine):
                pairs = np.rec.fromarrays([a[hits], b[hits]], names="a,b")
                hits = hits[mine[np.minimum(np.searchsorted(mine, pairs), len(mine) - 1)] != pairs]
            yield pa.RecordBatch.from_arrays([pa.array(a[hits]), pa.array(b[hits])], names=["a", "b"])

    return keys.mapInArrow(each, "a long, b long")


def cascade(universe: DataFrame, a: np.ndarray, b: np.ndarray, size: int) -> list[Bloom]:
    """The levels for the listed keys (a, b) over ``universe``, whose rows (a, b) are ``size`` different keys or so.

    Level 0 is as fine as needed for no more false hits than there are listed keys or so; it is made finer where they
    are four times as many after all, so what comes to the driver is bounded by the listed keys.
    """
    rate = min(0.5, max(1, len(a)) / max(1, size))
    while True:
        first = Bloom(len(a), rate, 0)
        first.add(a, b)
        wrong = durable(_false_hits(universe, first, a, b))
        if wrong.count() <= 4 * max(1000, len(a)):
            break
        rate /= 8
    levels, ins, got = [first], (a, b), wrong.toArrow()
    outs = tuple(got.column(k).to_numpy() for k in range(2))
    while len(outs[0]):
        level = Bloom(len(outs[0]), 0.25, len(levels))
        level.add(*outs)
        levels.append(level)
        took = level.has(*ins)
        ins, outs = outs, tuple(x[took] for x in ins)
    return levels


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow", share: int = SHARE) -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of ``pages``; rule is null where none fits.

    ``rules``: (action, host, path), the action being block or allow. A rule fits its host and all subdomains if the
    path starts with the rule's; the longest rule wins, of equals the one with the longer host; a rule listed with both
    actions blocks. A URL that no list has gets ``default``. Null URLs and URLs without ``://`` have empty host and
    path and are judged like others. Ids may be null or repeat and repeated rows give repeated rows; other columns are
    not read. Without rules everything gets ``default``; an empty table gives an empty result.
    """
    host, path = split_url(F.col(url_col))
    base = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    if not rules:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels, lengths = sorted({r[1].count(".") + 1 for r in rules}), sorted({len(r[2]) for r in rules})
    keyed = base.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    spark = pages.sparkSession
    pair = lambda key: (F.xxhash64(key), F.xxhash64(F.lit(7), key))
    named = lambda key: [x.alias(n) for x, n in zip(pair(key), "ab", strict=True)]
    known = spark.createDataFrame([(h + p, action) for action, h, p in rules], "rule string, action string").select("action", *named(F.col("rule"))).distinct().toArrow()
    action, a, b = (known.column(k).to_numpy(zero_copy_only=False) for k in range(3))
    universe = durable(keyed.select(F.explode("keys").alias("k")).select(*named(F.col("k"))).distinct())
    shares = -(-len(a) // share)
    widths = F.transform("keys", lambda k: F.length(k) * 4096 + F.least(F.length(F.substring_index(k, "/", 1)), F.lit(4095)))
    state = keyed.select(F.col(id_col).alias("x"), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"), F.lit(-1).cast("long").alias("best"), "keys", F.transform("keys", lambda k: pair(k)[0]).alias("a"), F.transform("keys", lambda k: pair(k)[1]).alias("b"), F.transform(widths, lambda w: w.cast("long")).alias("w"))
    kind = pages.schema[id_col].dataType.simpleString()
    schema = f"x {kind}, host string, path string, rule string, verdict string, best long, keys array<string>, a array<long>, b array<long>, w array<long>"
    for k in range(shares):
        part = universe.where(F.pmod("a", F.lit(shares)) == k) if shares > 1 else universe
        size = part.count()
        own = {x: (action == x) & (a % shares == k) for x in ("block", "allow")}
        levels = {x: cascade(part, a[m], b[m], size) if m.any() else [] for x, m in own.items()}
        state = state.mapInArrow(_better(spark.sparkContext.broadcast(levels), k, shares), schema)
        if k + 1 < shares:  # so that a task holds one share's cascades at a time
            state = durable(state)
    return state.select(F.col("x").alias(id_col), "host", "path", "rule", "verdict")


def _better(sent, k: int, shares: int):
    """A pass that gives each URL the longest rule of the share ``k``, if that is longer than the best one so far."""

    def each(batches):
        have = sent.value
        for batch in batches:
            rows = batch.num_rows
            keys, a, b, w = (batch.column(c) for c in range(6, 10))
            owner = np.repeat(np.arange(rows), np.diff(keys.offsets.to_numpy()))
            names, (a, b, w) = keys.flatten(), (x.flatten().to_numpy() for x in (a, b, w))
            mine = np.flatnonzero(a % shares == k)
            block, allow = np.zeros(len(a), bool), np.zeros(len(a), bool)
            block[mine], allow[mine] = (listed(have[x], a[mine], b[mine]) for x in ("block", "allow"))
            hit = np.flatnonzero((block | allow) & (w > batch.column(5).to_numpy()[owner]))
            order = hit[np.lexsort((w[hit], owner[hit]))]
            top = order[np.append(owner[order][1:] != owner[order][:-1], True)[: len(order)]]
            at = np.full(rows, -1)
            at[owner[top]] = top
            new = pa.array(at >= 0)
            told = np.full(rows, "", object)
            told[owner[top]] = np.where(block[top], "block", "allow")
            longest = batch.column(5).to_numpy().copy()
            longest[owner[top]] = w[top]
            rule, verdict = pc.if_else(new, names.take(pa.array(at, pa.int64(), mask=at < 0)), batch.column(3)), pc.if_else(new, pa.array(told, pa.string()), batch.column(4))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], rule, verdict, pa.array(longest), *batch.columns[6:]], names=batch.schema.names)

    return each
