"""Chat formatting by prefix-target expansion.

A conversation is rendered turn by turn. Every assistant turn becomes an example of its own: all turns before it are
its context, and only its own reply is trainable. The examples of a conversation are written one after the other while
its turns pass by, so that a task holds one conversation's rendering and no more than a few megabytes of examples.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: The template. ``<|`` never occurs in an escaped text, so that no text can open or close a turn.
START, END = "<|im_start|>", "<|im_end|>\n"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
#: Code points of examples that one batch has at most, unless one example alone has more.
BATCH = 1 << 21


def escape(text: Column) -> Column:
    """Doubles backslashes and parts ``<|``; undone by ``unescape``."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant") -> DataFrame:
    """(conv_id, seq, text, loss_begin, loss_end): the rendered examples of each conversation, in order.

    An example ends with an assistant's turn, the seq-th of its conversation, and begins with the conversation's first
    turn; [loss_begin, loss_end) of its text, in code points, is that reply, as escaped, and alone is trainable. Turns
    after the last reply make a row without a loss, so that no turn is lost. Turns go by ``turn``, ties by role and
    text, nulls first; null texts and roles are empty; repeated rows are turns of their own. Turns without a
    conversation belong to none, so each is a conversation by itself. Other columns are not read; an empty table gives
    no example. The examples of a conversation are as long together as the square of its turns; each is a row.
    """
    kind = turns.schema[conv].dataType.simpleString()
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    rows = rows.withColumn("alone", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    ordered = rows.select("conv_id", "alone", "turn", "role", "text", F.concat(head, escape(F.col("text")), F.lit(END)).alias("piece"), F.length(head).alias("head")).repartition("conv_id", "alone").sortWithinPartitions("conv_id", "alone", "turn", "role", "text")
    names = ["conv_id", "seq", "text", "loss_begin", "loss_end"]

    def each(batches):
        now, parts, size, seq, open_ = (None, None), [], 0, 0, False
        out, held, ids = [[], [], [], []], 0, []

        def add(first, last):
            nonlocal parts, held
            parts = ["".join(parts)]
            ids.append(now[0])
            for o, v in zip(out, (seq, parts[0], first, last), strict=True):
                o.append(v)
            held += size

        def flush():
            nonlocal out, held, ids
            batch = pa.RecordBatch.from_arrays([pa.array(ids, id_type), *(pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True))], names=names)
            out, held, ids = [[], [], [], []], 0, []
            return batch

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for conv, alone, own_role, piece, n in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (conv, alone) != now or not seq:
                    if open_:
                        add(None, None)
                    now, parts, size, seq = (conv, alone), [], 0, 0
                parts.append(piece)
                seq += 1
                open_ = own_role != target
                if not open_:
                    first, last = size + n, size + len(piece) - len(END)
                    size += len(piece)
                    add(first, last)
                else:
                    size += len(piece)
                if held > BATCH:
                    yield flush()
        if open_:
            add(None, None)
        if ids:
            yield flush()

    return ordered.select("conv_id", "alone", "role", "piece", "head").mapInArrow(each, f"conv_id {kind}, seq long, text string, loss_begin long, loss_end long")


def read_back(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read from the result of ``examples``,
    whose rows it takes as they come from there, one conversation's after the other.

    Turns are parsed from a conversation's longest text, losses from each example's own. formatted_chars counts the
    code points of all examples, contexts included; a conversation without an example counts 0.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def each(batches):
        longest, state = None, None
        done: list[list] = [[] for _ in names]

        def close():
            digest, n = hashlib.sha256(), 0
            for m in _TURN.finditer(longest):
                n += 1
                digest.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
            for o, v in zip(done, (state[0], n, digest.hexdigest(), state[2], state[3].hexdigest(), state[4]), strict=True):
                o.append(v)

        for batch in batches:
            for conv, seq, text, first, last in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if state is None or conv != state[0] or seq <= state[1]:
                    if state is not None:
                        close()
                    state = [conv, 0, 0, hashlib.sha256(), 0]
                state[1], longest = seq, text
                if first is not None:
                    own = unescape(text[first:last])
                    state[2] += len(own)
                    state[3].update(own.encode("utf-8", "surrogatepass"))
                    state[4] += len(text)
            if len(done[0]) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(done, kinds, strict=True)], names=names)
                done = [[] for _ in names]
        if state is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(done, kinds, strict=True)], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "seq", "text", "loss_begin", "loss_end").mapInArrow(each, schema)
