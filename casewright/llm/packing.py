"""Best-fit packing of texts into sequences of several permitted lengths.

Pieces are dealt out by hash and packed in groups of bounded size, longest first: each goes into the open bin that it
fills best. Where none has room, a bin of that length is opened which costs least for each unit it can be expected to
hold. At the end every bin shrinks to the shortest permitted length that holds its contents. Which lengths are worth
opening depends on the others, so each group is packed once for every set of lengths that may be opened, and the
packing of least total cost is kept. The result is the sequences themselves, with the boundaries of what they hold.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

from casewright.llm.common import utf8

#: Tokens and pieces of one group; a group may pass the first by one piece.
TOKENS, PIECES = 1 << 24, 50_000


def opened_sets(capacities: list[int]) -> list[list[int]]:
    """The sets of lengths from which bins may be opened; each has the greatest, since any piece must fit.

    All sets of up to five lengths; of more, each length with the greatest, and all lengths from one on.
    """
    *rest, top = sorted(capacities)
    if len(rest) <= 4:
        return [[*some, top] for k in range(len(rest) + 1) for some in combinations(rest, k)]
    return [[top], *([c, top] for c in rest), *([*rest[k:], top] for k in range(len(rest) - 1))]


def pack(lengths: np.ndarray, capacities: list[int], overhead: float = 64.0, quadratic: float = 1 / 65536) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Bin, offset and the bin's final capacity of each piece, and the cost of all bins; pieces in falling order of length.

    A bin of capacity c costs overhead + c + quadratic * c * c: the start of a sequence, its tokens, its attention.
    """
    sizes = sorted(capacities)
    cost = {c: overhead + c + quadratic * c * c for c in sizes}
    best = None
    for some in opened_sets(sizes):
        bin_, offset, used = _best_fit(lengths.tolist(), some, cost)
        final = np.array(sizes, np.int64)[np.searchsorted(sizes, used)] if len(used) else used
        total = float(sum(cost[c] * n for c, n in zip(*(x.tolist() for x in np.unique(final, return_counts=True)), strict=True)))
        if best is None or total < best[3]:
            best = bin_, offset, final[bin_] if len(used) else final, total
    return best


def _best_fit(lengths: list[int], sizes: list[int], cost: dict[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and what each bin holds, when bins of ``sizes`` may be opened."""
    n, left = len(lengths), sum(lengths)
    bin_, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    used: list[int] = []
    for k, size in enumerate(lengths):
        at = bisect_left(free, (size, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            rest = left - size
            gap = rest / (2 * max(1, n - k - 1))  # half of what a later piece takes on average stays empty
            room = min((c for c in sizes if c >= size), key=lambda c: (cost[c] / max(1.0, size + max(0.0, min(c - size - gap, rest))), c))
            b = len(used)
            used.append(0)
        bin_[k], offset[k] = b, used[b]
        used[b] += size
        insort(free, (room - size, b))
        left -= size
    return bin_, offset, np.array(used, np.int64)


def packed(docs: DataFrame, capacities: tuple[int, ...] = (2048, 8192, 32768), id_col: str = "doc_id", text_col: str = "text", overhead: float = 64.0, quadratic: float = 1 / 65536) -> DataFrame:
    """(bin_id, capacity, used, doc_ids, begins, lengths, tokens): a row for each sequence.

    ``text_col`` holds texts, whose tokens are their bytes as UTF-8 (a byte vocabulary), or lists of token ids. The k-th
    piece of a sequence is ``lengths[k]`` tokens of document ``doc_ids[k]`` from its token ``begins[k]`` on; the pieces
    follow each other in ``tokens``, which ``used`` counts and ``capacity``, one of ``capacities``, bounds. A document
    longer than the greatest capacity is cut into pieces that fill it; nothing is cut off. Null and empty texts are one
    piece without tokens. Ids may be null or repeat; bin_id is unique. Other columns are not read; an empty table gives
    no sequence. Pieces of one length go by id, begin and content, nulls first.
    """
    most, field = max(capacities), docs.schema[text_col].dataType
    listed = isinstance(field, ArrayType)
    whole = F.coalesce(F.col(text_col), F.array().cast(field)) if listed else F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).alias("id"), whole.alias("t"))
    n = F.size("t") if listed else F.octet_length("t")
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)).cast("long"), F.lit(most).cast("long"))
    cut = "slice(t, int(begin + 1), {0})" if listed else "substring(t, int(begin + 1), {0})"
    pieces = rows.select("id", "t", F.explode(begins).alias("begin")).select("id", "begin", F.expr(cut.format(most)).alias("t"))
    dealt = pieces.withColumn("h", F.xxhash64("id", "begin", "t")).repartition("h").sortWithinPartitions("h", "id", "begin")
    names = ["bin_id", "capacity", "used", "doc_ids", "begins", "lengths", "tokens"]

    def each(batches):
        held, tokens, count, part = [], 0, 0, 0

        def flush():
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, begin, own = (rows.column(k).chunk(0) for k in range(3))
            size = _sizes(own)
            order = np.argsort(-size, kind="stable")
            bins, offset, capacity = (np.empty(len(size), np.int64) for _ in range(3))
            bins[order], offset[order], capacity[order], _ = pack(size[order], list(capacities), overhead, quadratic)
            turn = np.lexsort((np.arange(len(size)), offset, bins))
            size, last = size[turn], np.append(np.flatnonzero(np.diff(bins[turn])) + 1, len(turn))
            edges, ends = np.append(0, last).astype(np.int32), np.append(0, np.cumsum(size)[last - 1]).astype(np.int32)
            take, lists = pa.array(turn), lambda x: pa.ListArray.from_arrays(pa.array(edges), x)
            number = (TaskContext.get().partitionId() << 40) + (part << 20) + np.arange(len(last))
            return pa.RecordBatch.from_arrays([pa.array(number), pa.array(capacity[turn][last - 1]), pa.array(np.diff(ends).astype(np.int64)), lists(ids.take(take)), lists(begin.take(take)), lists(pa.array(size)), _joined(own.take(take), ends)], names=names)

        for batch in batches:
            at = np.append(0, np.cumsum(_sizes(batch.column(2))))
            lo = 0
            while lo < batch.num_rows:
                hi = min(lo + PIECES - count, max(lo + 1, int(np.searchsorted(at, at[lo] + TOKENS - tokens, side="right")) - 1), batch.num_rows)
                held.append(batch.slice(lo, hi - lo))
                tokens, count, lo = tokens + int(at[hi] - at[lo]), count + hi - lo, hi
                if tokens >= TOKENS or count >= PIECES or lo < batch.num_rows:
                    yield flush()
                    held, tokens, count, part = [], 0, 0, part + 1
        if held:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    return dealt.select("id", "begin", "t").mapInArrow(each, f"bin_id long, capacity long, used long, doc_ids array<{kind}>, begins array<long>, lengths array<long>, tokens {field.simpleString() if listed else 'binary'}")


def _sizes(column: pa.Array) -> np.ndarray:
    """The tokens of each piece."""
    return np.diff(utf8(column)[1]) if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _joined(column: pa.Array, ends: np.ndarray) -> pa.Array:
    """The pieces of ``column``, one after the other, anew divided at ``ends``."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(utf8(column)[0].tobytes())])
    return pa.ListArray.from_arrays(pa.array(ends), column.flatten())
