"""Removal of long repeated byte strings, found by bounded interval expansion on a Burrows-Wheeler transform.

A string of ``length`` bytes contains ``length - GRAM + 1`` grams; its anchor is the one of least hash, the leftmost
of equals. Equal strings have equal anchors at equal places, so dealing texts out by anchor brings all that can be
equal together. Neighbouring strings with one anchor form a run. Occurrences of one and the same run are told by
its hash; where an anchor has different runs, one of each is written into a text whose suffixes are sorted to a
bounded depth. Starting from the intervals of short strings, breadth-first backward extension over the transform
fixes common prefix values in increasing order; those still open at ``length`` join strings that are equal. An anchor
with very many different runs, as a passage has that stands in many contexts, is not gathered: its strings are dealt out
by their hashes instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import Hashes, durable, mix, slices, utf8

GRAM = 32
#: Bytes of text whose strings are anchored at a time; a longer text is taken in pieces that overlap.
PIECE = 1 << 20
#: Bytes of runs in one transform, unless one anchor alone has more.
BLOCK = 1 << 20
#: Bits of the largest filter that is broadcast (4 MB). With more runs to fetch, texts are joined to them instead.
FILTER_BITS = 1 << 25
PACK = 1 << 10
#: Different runs of one anchor that are compared in one transform; the strings of an anchor with more are dealt out one
#: by one, so that no task holds them all. At most so many anchors are treated so, those with most runs.
HOT, MOST_HOT = 1 << 12, 1 << 17
_LOW = np.uint64((1 << 24) - 1)
_hashes = Hashes(6)


def runs(raw: np.ndarray, at: np.ndarray, length: int, hot: np.ndarray | None = None):
    """Yields, piece by piece, the runs of the texts raw[at[i] : at[i + 1]]: anchor, run hash, text, start, strings.

    With ``hot``, ascending anchors, these are instead the strings of the runs that have such an anchor, each a run of
    one string that is its own anchor.
    """
    for i, j in slices(at, PIECE):
        for s in range(int(at[i]), max(int(at[j]), int(at[i]) + 1), PIECE) if j == i + 1 else [int(at[i])]:
            e = min(int(at[j]), s + PIECE + length - 1) if j == i + 1 else int(at[j])
            if e - s >= length:
                edge = np.clip(at[i : j + 1], s, e) - s
                yield from _piece(raw[s:e], edge, i, s - at[i:j], length, hot)


def _piece(x: np.ndarray, edge: np.ndarray, first: int, shift: np.ndarray, length: int, hot: np.ndarray | None):
    n, wide = len(x), length - GRAM + 1
    sums = _hashes.sums(x)
    place = np.arange(n - GRAM + 1)
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * _hashes.down[: len(place)])
    least = (gram & ~_LOW) | place.astype(np.uint64)
    have = 1
    while have * 2 <= wide:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < wide:
        least = np.minimum(least[: len(least) - (wide - have)], least[wide - have :])
    anchor = (least & _LOW).astype(np.int64)
    strings = np.maximum(np.diff(edge) - length + 1, 0)
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, edge[:-1], (strings > 0).astype(np.int32))
    np.add.at(mark, edge[:-1] + strings, -(strings > 0).astype(np.int32))
    valid = np.cumsum(mark[: len(anchor)]) > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    start = np.flatnonzero(new)
    if not len(start):
        return
    stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    count, where = stop - start, anchor[start]
    text = np.searchsorted(edge, start, side="right") - 1
    if hot is not None:
        own = gram[where].view(np.int64)
        some = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, own), len(hot) - 1)] == own)
        if len(some):
            size = count[some]
            at = np.repeat(start[some], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            key, whose = _hashes.of(sums, at, at + length).view(np.int64), np.repeat(text[some], size)
            yield key, key, whose + first, at + shift[whose], np.ones(len(at), np.int64)
        return
    run = _hashes.of(sums, start, start + count + length - 1)
    run = mix(run + (where - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + count.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    yield gram[where].view(np.int64), run.view(np.int64), text + first, start + shift[text], count


def _anchored(docs: DataFrame, length: int, hot=None) -> DataFrame:
    """(anchor, run, doc, place, again): place packs where the run begins and how many strings it has.

    With ``hot``, a broadcast of ascending anchors, of the strings of such anchors' runs only.

    again marks a run that the same batch has earlier: it is known to repeat, needs no other occurrence beside it
    and gets an anchor of its own, so that copies and common passages don't all meet in one task.
    """

    def each(batches):
        for batch in batches:
            raw, at = utf8(batch.column(1))
            ids = batch.column(0).to_numpy()
            got = list(runs(raw, at, length, None if hot is None else hot.value))
            if not got:
                continue
            anchor, run, text, start, count = (np.concatenate(x) for x in zip(*got, strict=True))
            doc, place = ids[text], start * PACK + count
            order = np.lexsort((place, doc, run))
            same = np.append(False, (run[order][1:] == run[order][:-1]) & (anchor[order][1:] == anchor[order][:-1]))
            first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            again = np.zeros(len(order), bool)
            again[order] = same & ((doc[order] != doc[first]) | (place[order] != place[first]))
            anchor = np.where(again, mix(doc.astype(np.uint64) ^ mix(place.astype(np.uint64))).view(np.int64), anchor)
            for lo in range(0, len(anchor), 100_000):
                part = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (anchor, run, doc, place, again)], names=["anchor", "run", "doc", "place", "again"])

    return docs.where("id is not null").mapInArrow(each, "anchor long, run long, doc long, place long, again boolean")


def _told(rows: DataFrame) -> DataFrame:
    """(kind, anchor, doc, place) from all runs: kind 0 repeats an earlier run, kind 1 is the first of one of several."""

    def each(batches):
        held = (None, None, None, None, False)  # the last run's first occurrence, and whether it is already passed on
        for batch in batches:
            known = batch.column(4).to_numpy(zero_copy_only=False)
            every = [batch.column(k).to_numpy() for k in range(4)]
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(int(known.sum()), np.int32)), *(pa.array(every[k][known]) for k in (0, 2, 3))], names=["kind", "anchor", "doc", "place"])
            anchor, run, doc, place = (x[~known] for x in every)
            if not len(anchor):
                continue
            same = np.zeros(len(anchor), bool)
            same[1:] = (anchor[1:] == anchor[:-1]) & (run[1:] == run[:-1])
            if held[0] is not None:
                same[0] = anchor[0] == held[0] and run[0] == held[1]
            first = np.flatnonzero(~same)
            lead = np.cumsum(~same) - 1
            fd, fp = np.append(doc[first], held[2] or 0), np.append(place[first], held[3] or 0)  # place -1 is what was held
            again = same & ((doc != fd[lead]) | (place != fp[lead]))
            kinds, rows = [np.zeros(int(again.sum()), np.int32)], [np.flatnonzero(again)]
            early = []
            if len(first):
                a = anchor[first]
                by = np.zeros(len(a), bool)
                by[1:] |= a[1:] == a[:-1]
                by[:-1] |= a[1:] == a[:-1]
                if held[0] is not None and held[0] == a[0]:
                    by[0] = True
                    if not held[4]:
                        early = [held[:4]]
                rows.append(first[by])
                kinds.append(np.ones(int(by.sum()), np.int32))
                k = first[-1]
                held = (int(anchor[k]), int(run[k]), int(doc[k]), int(place[k]), bool(by[-1]))
            rows = np.concatenate(rows)
            out = [np.concatenate([*kinds, np.ones(len(early), np.int32)])] + [np.append(x[rows], np.array([e[k] for e in early], np.int64)) for k, x in ((0, anchor), (2, doc), (3, place))]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["kind", "anchor", "doc", "place"])

    return rows.mapInArrow(each, "kind int, anchor long, doc long, place long")


def _slots(doc: np.ndarray, place: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ mix(place.astype(np.uint64)))
    return [((h >> np.uint64(k * 16)) ^ h * np.uint64(2 * k + 1)) & np.uint64(bits - 1) for k in range(4)]


def _fetched(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, doc, place, bytes) of the ``wanted`` runs (and, after a filter, a few more, which do no harm)."""
    schema = "anchor long, doc long, place long, bytes binary"
    n = wanted.count()
    bits = 1 << max(16, int(16 * n).bit_length())
    if bits > FILTER_BITS:

        def cut(batches):
            for batch in batches:
                raw, at = utf8(batch.column(1))
                rows = [(w["anchor"], doc, w["place"], raw[s : s + w["place"] % PACK + length - 1].tobytes()) for doc, a, own in zip(batch.column(0).to_pylist(), at.tolist(), batch.column(2).to_pylist(), strict=False) for w in own for s in [a + w["place"] // PACK]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["anchor", "doc", "place", "bytes"])

        lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "place")).alias("own"))
        return docs.join(lists, F.col("id") == F.col("doc")).select("id", "t", "own").mapInArrow(cut, schema)

    def slots(batches):
        for batch in batches:
            s = np.concatenate(_slots(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits))
            yield pa.RecordBatch.from_arrays([pa.array((s >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (s & np.uint64(63))).view(np.int64))], names=["w", "b"])

    filled = wanted.select("doc", "place").mapInArrow(slots, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[filled.column("w").to_numpy()] = filled.column("b").to_numpy().view(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def each(batches):
        have = sent.value
        for batch in batches:
            raw, at = utf8(batch.column(1))
            ids = batch.column(0).to_numpy()
            for anchor, _, text, start, count in runs(raw, at, length):
                doc, place, hit = ids[text], start * PACK + count, np.ones(len(text), bool)
                for s in _slots(doc, place, bits):
                    hit &= (have[s >> np.uint64(6)] >> (s & np.uint64(63)) & np.uint64(1)).astype(bool)
                k = np.flatnonzero(hit)
                if len(k):
                    begin = at[text[k]] + start[k]
                    blobs = [raw[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + count[k] + length - 1).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[k]), pa.array(doc[k]), pa.array(place[k]), pa.array(blobs, pa.binary())], names=["anchor", "doc", "place", "bytes"])

    return docs.where("id is not null").mapInArrow(each, schema)


def suffixes(x: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``x`` (bytes) in the order of their first ``depth`` symbols or more."""
    n = len(x)
    wide = np.concatenate([x, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | wide[k : k + n]
    order = np.argsort(key)
    have = 8
    key = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.append(True, key[1:] != key[:-1]))
    while have < depth:
        key = rank << 32
        key[: max(0, n - have)] |= rank[have:]
        order = np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        rank[order] = np.cumsum(new)
        have *= 2
        if new.all():
            break
    return order


def equal_prefixes(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted suffixes of ``x``, and for each whether its first ``length`` symbols differ from the one before.

    ``x`` holds bytes of which 0 ends each string; only suffixes with no 0 in their first ``length`` symbols count.
    """
    n = len(x)
    order = suffixes(x, length)
    bwt = x[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)
    back[by_symbol] = np.arange(n)
    # the first eight levels from the sorted strings themselves
    wide = np.concatenate([x, np.zeros(8, np.uint8)])
    value = np.full(n + 1, -1, np.int16)
    value[0] = value[n] = 0
    open_ = np.ones(max(n - 1, 0), bool)
    for k in range(min(8, length)):
        differ = open_ & (wide[order[1:] + k] != wide[order[:-1] + k])
        value[1:n][differ] = k
        open_ &= ~differ
    level = 8
    ends = np.flatnonzero(value == 7)
    edges = np.flatnonzero(value >= 0)
    begins = edges[np.searchsorted(edges, ends) - 1] if len(ends) else ends
    while level < length and len(ends):
        size = ends - begins
        which = np.repeat(np.arange(len(ends)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begins, size)
        symbol = bwt[at]
        keep = symbol > 0
        if not keep.all():
            which, at, symbol = which[keep], at[keep], symbol[keep]
        key = which << 8 | symbol
        if len(key) > len(ends):  # equal symbols of an interval go to neighbouring places, in their order
            turn = np.argsort(key, kind="stable")
            key, at = key[turn], at[turn]
            new = np.append(True, key[1:] != key[:-1])
            last = np.append(new[1:], True)
            low, high = back[at[new]], back[at[last]] + 1
        else:
            low = back[at]
            high = low + 1
        fresh = value[high] < 0
        begins, ends = low[fresh], high[fresh]
        value[ends] = level
        level += 1
    return order, value[:n] >= 0


def _repeats(doc: np.ndarray, start: np.ndarray, count: np.ndarray, blobs: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs of several anchors: (doc, begin, end) of bytes in strings that another of the runs has earlier."""
    joined = np.frombuffer(b"".join(b + b"\xff" for b in blobs), np.uint8)  # no byte of UTF-8 is 255
    size = np.fromiter(map(len, blobs), np.int64, len(blobs)) + 1
    own = np.repeat(np.arange(len(blobs)), size)
    offset = np.arange(len(joined)) - np.repeat(np.cumsum(size) - size, size)
    symbols = np.zeros(256, np.uint8)
    present = np.flatnonzero(np.bincount(joined, minlength=256))
    present = present[present < 255]
    symbols[present] = np.arange(1, len(present) + 1)
    order, differs = equal_prefixes(symbols[joined], length)
    group = np.cumsum(differs)
    valid = offset[order] < count[own[order]]
    order, group = order[valid], group[valid]
    many = np.zeros(len(group), bool)
    many[1:] |= group[1:] == group[:-1]
    many[:-1] |= group[1:] == group[:-1]
    order, group = order[many], group[many]
    d, s = doc[own[order]], start[own[order]] + offset[order]
    turn = np.lexsort((s, d, group))
    group, d, s = group[turn], d[turn], s[turn]
    lead = np.append(True, group[1:] != group[:-1])[: len(group)]
    head = np.flatnonzero(lead)[np.cumsum(lead) - 1] if len(group) else group
    late = (d != d[head]) | (s != s[head])
    d, s = d[late], s[late]
    turn = np.lexsort((s, d))
    d, s = d[turn], s[turn]
    new = np.append(True, (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1))[: len(d)]
    last = np.append(new[1:], True)[: len(d)]
    return d[new], s[new], s[last] + length


def _expanded(rows: DataFrame, length: int) -> DataFrame:
    def each(batches):
        doc, place, blobs, anchors, held = [], [], [], [], 0

        def flush(n):
            p = np.array(place[:n], np.int64)
            out = _repeats(np.array(doc[:n], np.int64), p // PACK, p % PACK, blobs[:n], length)
            del doc[:n], place[:n], blobs[:n], anchors[:n]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc", "begin", "end"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                anchors += part.column(0).to_pylist()
                doc += part.column(1).to_pylist()
                place += part.column(2).to_pylist()
                own = part.column(3).to_pylist()
                blobs += own
                held += sum(map(len, own))
                if held > BLOCK:
                    n = len(anchors) - 1
                    while n and anchors[n - 1] == anchors[-1]:
                        n -= 1
                    if n:
                        yield flush(n)
                        held = sum(map(len, blobs))
        if anchors:
            yield flush(len(anchors))

    return rows.mapInArrow(each, "doc long, begin long, end long")


def _whole(x: bytes, gone: np.ndarray) -> bytes:
    """The stretches of ``x`` that aren't gone, without the parts of characters at the cuts."""
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).astype(np.int8)))
    out = []
    for a, b in edges.reshape(-1, 2).tolist():
        if a:
            while a < b and x[a] & 0xC0 == 0x80:
                a += 1
        if b < len(x):
            lead = next((k for k in range(b - 1, max(a, b - 4) - 1, -1) if x[k] & 0xC0 != 0x80), b)
            if lead < b and lead + (1 + (x[lead] >= 0xC0) + (x[lead] >= 0xE0) + (x[lead] >= 0xF0)) > b:
                b = lead
        out.append(x[a:b])
    return b"".join(out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, carry: tuple[str, ...] = (), whole_characters: bool = False) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, kept, *carry) for every row of ``docs``.

    Each byte that lies in a string of ``length`` bytes which begins earlier too (in a document of smaller id, or
    earlier in the same) goes; ``kept`` is what stays, as binary, since a cut may fall inside a character. With
    ``whole_characters`` it lacks the parts of characters that cuts have left, and nothing else. Null and empty texts keep nothing and lose nothing. Rows whose id is null stay whole and repeat nothing. Rows with one
    id and one text are one document and get the same result; rows with one id and different texts share their
    removals, each within its own length. Of the other columns only those of ``carry`` are read; they come back as
    they are.
    """
    if not GRAM < length < PACK:
        raise ValueError(f"length must lie between {GRAM} and {PACK}")
    whole = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)])
    own = whole.select("id", "t")
    dealt = lambda rows: _told(rows.repartition("anchor").sortWithinPartitions("anchor", "run", "doc", "place"))
    told = durable(dealt(_anchored(own, length)))
    repeats, wanted = told.where("kind = 0"), told.where("kind = 1")
    hot = wanted.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).orderBy(F.desc("n"), "anchor").limit(MOST_HOT).select("anchor")
    if anchors := sorted(r["anchor"] for r in hot.collect()):
        sent = docs.sparkSession.sparkContext.broadcast(np.array(anchors, np.int64))
        repeats = repeats.union(dealt(_anchored(own, length, sent)).where("kind = 0"))
        wanted = wanted.join(F.broadcast(docs.sparkSession.createDataFrame([(a,) for a in anchors], "anchor long")), "anchor", "left_anti").select(told.columns)
    fetched = _fetched(own, wanted, length).repartition("anchor").sortWithinPartitions("anchor")
    begin = F.expr(f"place div {PACK}")
    spans = repeats.select("doc", begin.alias("begin"), (begin + F.expr(f"place % {PACK}") + length - 1).alias("end")).union(_expanded(fetched, length))
    lists = spans.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def each(batches):
        for batch in batches:
            raw, at = utf8(batch.column(1))
            own = batch.column(2)
            cut, flat = own.offsets.to_numpy(), own.values
            first, last = (flat.field(k).to_numpy() for k in range(2))
            has = own.is_valid().to_numpy(zero_copy_only=False)
            out = [[], [], [], [], []]
            for k in range(batch.num_rows):
                x = raw[at[k] : at[k + 1]]
                removed = runs_ = 0
                if has[k] and cut[k + 1] > cut[k] and len(x):
                    gone = np.zeros(len(x) + 1, np.int32)
                    np.add.at(gone, np.minimum(first[cut[k] : cut[k + 1]], len(x)), 1)
                    np.add.at(gone, np.minimum(last[cut[k] : cut[k + 1]], len(x)), -1)
                    gone = np.cumsum(gone[:-1]) > 0
                    removed, runs_ = int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                    kept = x[~gone].tobytes()
                else:
                    kept = x.tobytes()
                digest = hashlib.sha256(kept).hexdigest()
                if removed and whole_characters:
                    kept = _whole(x.tobytes(), gone)
                for o, v in zip(out, (len(x), removed, runs_, digest, kept), strict=True):
                    o.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(o, t) for o, t in zip(out, kinds, strict=True)), *batch.columns[3:]], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *batch.schema.names[3:]])

    joined = whole.join(lists, F.col("id") == F.col("doc"), "left").select("id", "t", "spans", *[f"c{k}" for k in range(len(carry))])
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary" + "".join(f", c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(carry))
    got = joined.mapInArrow(each, schema)
    return got.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *[F.col(f"c{k}").alias(c) for k, c in enumerate(carry)])
