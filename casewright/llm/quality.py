"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent in numpy.

A document's features are its words, the pairs of neighbouring words and the character n-grams inside and at the
edges of words, each hashed to one of BUCKETS learned vectors. A pair is hashed by the difference of its words' hashes,
so that all pairs of a word with itself share one vector. The vectors are averaged and a softmax layer gives the class.
Training takes a bounded sample; scoring reads every whole text, a chunk of texts at a time, from a table that holds
each vector's pull on the logit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casewright.llm.common import Hashes, durable, slices, utf8

BUCKETS = 1 << 18
#: Lengths of character n-grams, in bytes of UTF-8.
GRAMS = (3, 4, 5)
#: Labelled documents that training takes at most: those of least hash of the id.
SAMPLE = 3000
#: Bytes of text that these documents have together at most; a document that passes the rest is left out of training.
SAMPLE_BYTES = 1 << 26
#: Steps of training at least; few labelled documents are gone through more often.
STEPS = 6000
CHUNK = 1 << 19
_hashes = Hashes(5)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(raw: np.ndarray, at: np.ndarray):
    """Yields (buckets, valid, edges) for each kind of feature of the texts raw[at[i] : at[i + 1]].

    Text i has the buckets from edges[i] to edges[i + 1], of which those count that are valid.
    """
    n = len(raw)
    if n == 0:
        return
    blank = _SPACE[raw]
    sums = _hashes.sums(np.where(blank, np.uint8(32), raw))
    fresh = np.zeros(n + 1, bool)
    fresh[at] = True
    fresh[0] = fresh[n] = True
    begins, ends = fresh[:n] & ~blank, fresh[1:] & ~blank
    begins[1:] |= blank[:-1] & ~blank[1:]
    ends[:-1] |= blank[1:] & ~blank[:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    bucket = lambda h, kind: ((h ^ np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(46)).astype(np.int64)
    word, edges = _hashes.of(sums, start, end), np.searchsorted(start, at)
    yield bucket(word, 1), np.ones(len(word), bool), edges
    if len(word) > 1:
        pair = np.ones(len(word), bool)
        pair[edges[:-1][edges[:-1] < len(word)]] = False
        before = np.append(word[:1], word[:-1])
        yield bucket(word - before, 2), pair, edges
    # an n-gram may begin or end with a blank but has none inside
    for size in GRAMS:
        if n >= size:
            m = n - size + 1
            valid = ~fresh[1 : m + 1]
            for k in range(2, size):
                valid &= ~fresh[k : m + k]
            for k in range(1, size - 1):
                valid &= ~blank[k : m + k]
            yield bucket((sums[size:] - sums[:-size]) * _hashes.down[:m] ^ np.uint64(size), 3), valid, np.minimum(at, m)


def _counted(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's different buckets and how often each comes."""
    got = [b[v] for b, v, _ in features(raw, np.array([0, len(raw)]))]
    return np.unique(np.concatenate(got) if got else np.zeros(0, np.int64), return_counts=True)


def train(texts: list[np.ndarray], labels: np.ndarray, dims: int = 8, epochs: int = 5, rate: float = 0.6, seed: int = 7) -> np.ndarray:
    """For each bucket its vector's pull towards label 1, and at the end the bias; trained by SGD on the softmax loss.

    Classes count alike. A bucket that no training text has pulls nowhere.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dims, 1 / dims, (BUCKETS, dims)).astype(np.float32)
    out, bias = np.zeros((2, dims), np.float32), np.zeros(2, np.float32)
    seen = np.zeros(BUCKETS, bool)
    share = np.bincount(labels, minlength=2) / max(1, len(labels))
    if len(labels) == 0 or share.min() == 0:
        return np.concatenate([np.zeros(BUCKETS), [np.log((share[1] + 1e-3) / (share[0] + 1e-3)) if len(labels) else 0.0]])
    epochs = max(epochs, -(-STEPS // len(labels)))
    rows = [_counted(t) for t in texts]
    for b, _ in rows:
        seen[b] = True
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            b, c = rows[k]
            step = rate * (1 - done / steps)
            done += 1
            if not len(b):
                continue
            w = (c / c.sum()).astype(np.float32)
            hidden = w @ vectors[b]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[labels[k]] -= 1
            g *= step * 0.5 / share[labels[k]]
            back = g @ out
            out -= np.outer(g, hidden)
            bias -= g * 0.1
            # a step on an average is small for each vector, so it is scaled up by the number of different features
            vectors[b] -= np.outer(np.minimum(w * np.float32(np.sqrt(len(b))), 1), back)
    pull = (vectors @ (out[1] - out[0])).astype(np.float64) * seen
    return np.concatenate([pull, [float(bias[1] - bias[0])]])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, **how) -> np.ndarray:
    """The trained table. ``labels`` may hold rows without a document, null labels and repeated ids (the least label
    counts). Training runs in one task on at most ``sample`` documents, whole, those of least hash of the id, as far as
    they have ``sample_bytes`` together; of rows that repeat an id the least text counts. Null texts are empty. Without
    documents, or with labels of one kind only, the table has a bias alone."""
    own = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    ids = own.join(docs.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.coalesce(F.octet_length(text_col), F.lit(0))).alias("size")), "id")
    first = durable(ids.orderBy(F.xxhash64("id"), "id").limit(sample))
    upto = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)  # over at most ``sample`` rows
    chosen = durable(first.withColumn("upto", F.sum("size").over(upto)).where(F.col("upto") <= sample_bytes).select("id", "label"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id")

    def each(batches):
        rows = []
        for batch in batches:
            raw, at = utf8(batch.column(1))
            rows += [(i, y, raw[a:b].copy()) for i, y, a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]
        rows = {i: (y, t) for i, y, t in sorted(rows, key=lambda r: (r[0], len(r[2]), r[2].tobytes()))}  # one text for each id
        table = train([t for _, t in rows.values()], np.array([y for y, _ in rows.values()], np.int64), **how)
        yield pa.RecordBatch.from_arrays([pa.array([table.astype("<f8").tobytes()], pa.binary())], names=["table"])

    got = texts.select("id", "t", "label").repartition(1).mapInArrow(each, "table binary").first()
    return np.frombuffer(got[0], "<f8") if got else np.zeros(BUCKETS + 1)


def scores(raw: np.ndarray, at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text; a text without features gets what the bias gives."""
    n = len(at) - 1
    total, count = np.zeros(n), np.zeros(n)
    for bucket, valid, edges in features(raw, at):
        pull = table[bucket]
        pull *= valid
        total += np.diff(np.concatenate([[0], np.cumsum(pull)])[edges])
        count += np.diff(np.concatenate([[0], np.cumsum(valid)])[edges])
    z = total / np.maximum(count, 1) + table[-1]
    return 1 / (1 + np.exp(-z))


def _scored(docs: DataFrame, table: np.ndarray, names: list[str], text_col: str) -> DataFrame:
    """Columns c0, c1, ... for ``names``, and the score."""
    sent = docs.sparkSession.sparkContext.broadcast(table)
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], F.col(f"`{text_col}`").alias("t"))
    last = len(names)

    def each(batches):
        table = sent.value
        for batch in batches:
            raw, at = utf8(batch.column(last))
            got = np.concatenate([np.zeros(0), *(scores(raw[at[i] : at[j]], at[i : j + 1] - at[i], table) for i, j in slices(at, CHUNK))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(got)], names=[*batch.schema.names[:last], "score"])

    return inner.mapInArrow(each, "".join(f"c{k} {docs.schema[c].dataType.simpleString()}, " for k, c in enumerate(names)) + "score double")


def score(docs: DataFrame, table: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id_col, score, predicted) for every row of ``docs``.

    Whole texts are scored; null and empty texts, and texts of white space, get the bias's score. Ids may be null or
    repeat. predicted is 1 from ``threshold`` on. Other columns are not read.
    """
    return _scored(docs, table, [id_col], text_col).select(F.col("c0").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, table: np.ndarray, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with all their columns whatever the names, whose text scores ``threshold`` at least."""
    names = docs.columns
    return _scored(docs, table, names, text_col).where(F.col("score") >= threshold).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
