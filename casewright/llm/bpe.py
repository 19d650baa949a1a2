"""Byte-level BPE: a memory-mapped minimal acyclic transducer for frequent words, exact merges for the others.

The corpus's frequent words are compiled into the smallest automaton that accepts just them: states with equal
futures are one state, so words share suffixes as well as prefixes. Every transition carries an output; the sum
along a word's path is its number, and the number gives its token ids. The automaton lies in a row-displacement
array that Python workers map from one file; all words of a batch walk it side by side, a byte at a time.
Words that it does not know are merged pair by pair in rank order. Which words are frequent changes the speed,
never the result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import Hashes, shipped, slices, utf8

#: The code points of Unicode's property White_Space.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
NONE = np.iinfo(np.int32).max
#: Words of more bytes than this are merged on a heap instead of side by side.
LONG = 96
#: Bytes of text taken at a time, unless one text alone has more.
CHUNK = 1 << 21
#: Unseen words that a worker remembers.
REMEMBERED = 400_000

_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """Of each code point: 0 white space, 1 letter, 2 number, 3 anything else."""
    global _classes
    if _classes is None:
        kinds = {"L": 1, "N": 2}
        _classes = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 3) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        _classes[SPACES] = 0
    return _classes


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A vocabulary's merges as arrays: sorted pairs with their ranks and results, and each id's bytes."""

    def __init__(self, first: np.ndarray, pairs: np.ndarray, ranks: np.ndarray, made: np.ndarray, pieces: list[bytes], special: dict[bytes, int]):
        self.first, self.pairs, self.ranks, self.made, self.pieces, self.special = first, pairs, ranks, made, pieces, special
        self.by_rank = np.zeros(len(ranks) + 1, np.int32)
        self.by_rank[ranks] = made

    @classmethod
    def read(cls, path: str) -> Merges:
        """From a tokenizer file of the byte-level kind."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, stand = spec["model"]["vocab"], byte_symbols()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in vocab.items():
            pieces[i] = bytes(stand[c] for c in token)
        for token, i in added.items():
            pieces[i] = token.encode()
        rows = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in rows], np.int64)
        order = np.argsort(keys, kind="stable")
        first = np.zeros(256, np.int32)
        for c, b in stand.items():
            first[b] = vocab[c]
        return cls(first, keys[order], order.astype(np.int32), np.array([vocab[a + b] for a, b in rows], np.int32)[order], pieces, {t.encode(): i for t, i in added.items()})

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)

    def _long(self, word: bytes) -> list[int]:
        """One word on a heap of (rank, place); linked places, so a run of any length takes n log n steps."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        ranks = self.rank(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        after, before, known = [*range(1, n), -1], [-1, *range(n - 1)], {}
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.by_rank[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    pair = (ids[x], ids[y])
                    if pair not in known:
                        known[pair] = int(self.rank(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if known[pair] != NONE:
                        heapq.heappush(heap, (known[pair], x, *pair))
        return [x for x in ids if x >= 0]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word: the pair of lowest rank is merged first, the leftmost of equals."""
        out: list[list[int]] = [[]] * len(words)
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = self._long(w)
        short = [k for k, w in enumerate(words) if 0 < len(w) <= LONG]
        for i in range(0, len(short), 1 << 16):
            self._side_by_side([words[k] for k in short[i : i + (1 << 16)]], short[i : i + (1 << 16)], out)
        return out

    def _side_by_side(self, words: list[bytes], places: list[int], out: list[list[int]]) -> None:
        size = np.fromiter(map(len, words), np.int64, len(words))
        sym, who = self.first[np.frombuffer(b"".join(words), np.uint8)], np.array(places)
        start = np.cumsum(size) - size
        last = np.zeros(len(sym), bool)
        last[start + size - 1] = True
        rank = np.full(len(sym), NONE, np.int32)
        rank[:-1] = np.where(last[:-1], NONE, self.rank(sym[:-1], sym[1:]))
        while len(sym):
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(sym)), start)
            live = best >> 32 != NONE
            if not live.all():
                flat = sym.tolist()
                for k in np.flatnonzero(~live).tolist():
                    out[who[k]] = flat[start[k] : start[k] + size[k]]
                keep = np.repeat(live, size)
                renumber = np.cumsum(keep) - 1
                best, sym, rank, who, size = best[live], sym[keep], rank[keep], who[live], size[live]
                best = best >> 32 << 32 | renumber[best & 0xFFFFFFFF]
                start = np.cumsum(size) - size
                if not len(sym):
                    break
            at = best & 0xFFFFFFFF
            sym[at] = self.by_rank[best >> 32]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, rank, size = sym[keep], rank[keep], size - 1
            at -= np.arange(len(at))
            start = np.cumsum(size) - size
            end = start + size - 1
            more = at < end
            rank[at[~more]] = NONE
            rank[at[more]] = self.rank(sym[at[more]], sym[at[more] + 1])
            prior = at > start
            rank[at[prior] - 1] = self.rank(sym[at[prior] - 1], sym[at[prior]])


class Lexicon:
    """The transducer: arrays that can be written as one block of bytes and mapped again."""

    NAMES = ("base", "final", "check", "target", "weight", "first_id", "ids")

    def __init__(self, arrays: dict[str, np.ndarray], longest: int):
        self.arrays, self.longest = arrays, longest
        for name in self.NAMES:
            setattr(self, name, arrays[name])

    @classmethod
    def compile(cls, words: list[bytes], ids: list[list[int]]) -> Lexicon:
        order = sorted(range(len(words)), key=words.__getitem__)
        known: dict[tuple, int] = {}
        edges: list[list[tuple[int, int]]] = []
        finals: list[bool] = []

        def settle(node: list) -> int:
            """The number of the one state that has this node's finality and transitions."""
            key = (node[0], *node[1])
            if key not in known:
                known[key] = len(edges)
                edges.append(node[1])
                finals.append(node[0])
            return known[key]

        path: list[list] = [[False, []]]
        prior = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                done = path.pop()
                path[-1][1].append((prior[len(path) - 1], settle(done)))

        for k in order:
            word = words[k]
            shared = len(os.path.commonprefix([prior, word]))
            close(shared)
            path += [[False, []] for _ in range(len(word) - shared)]
            path[-1][0] = True
            prior = word
        close(0)
        root = settle(path[0])
        accepts = [0] * len(edges)
        for s, (own, final) in enumerate(zip(edges, finals, strict=True)):  # a state comes after all that it leads to
            accepts[s] = final + sum(accepts[t] for _, t in own)
        swap = {root: 0, 0: root}
        number = lambda s: swap.get(s, s)
        room = sum(map(len, edges)) + 512
        check, target, weight = (np.full(room * 2, -1, np.int32) for _ in range(3))
        base, taken, free, wide = np.zeros(len(edges), np.int32), bytearray(room * 2 + 512), 256, 256
        for s in sorted(range(len(edges)), key=lambda s: -len(edges[s])):
            own = edges[s]
            if not own:
                continue
            low = own[0][0]
            at = begun = free if len(own) == 1 else max(free, wide)
            while taken[at] or any(taken[at + b - low] for b, _ in own[1:]):
                at += 1
                if at + 256 >= len(check):
                    check, target, weight = (np.concatenate([x, np.full(room, -1, np.int32)]) for x in (check, target, weight))
                    taken += bytes(room)
            before = int(finals[s])
            for b, t in own:
                p = at + b - low
                taken[p], check[p], target[p], weight[p] = 1, number(s), number(t), before
                before += accepts[t]
            base[number(s)] = at - low
            if len(own) > 1 and at - begun > 32:  # the dense part is left to states with one transition
                wide = begun + (at - begun) // 2
            while taken[free]:
                free += 1
        final = np.zeros(len(edges), bool)
        for s, f in enumerate(finals):
            final[number(s)] = f
        size = np.array([len(ids[k]) for k in order], np.int64)
        arrays = {"base": base, "final": final, "check": check, "target": target, "weight": weight, "first_id": np.concatenate([[0], np.cumsum(size)]).astype(np.int32), "ids": np.array([i for k in order for i in ids[k]], np.int32)}
        return cls(arrays, max(map(len, words), default=0))

    def dump(self) -> bytes:
        head = {"longest": self.longest, "arrays": [[n, str(self.arrays[n].dtype), len(self.arrays[n])] for n in self.NAMES]}
        return json.dumps(head).encode() + b"\n" + b"".join(np.ascontiguousarray(self.arrays[n]).tobytes() for n in self.NAMES)

    @classmethod
    def mapped(cls, file) -> Lexicon:
        """From an open file of a line and what ``dump`` gave; the arrays are views of the mapped file."""
        file.readline()
        head = json.loads(file.readline())
        arrays, at = {}, file.tell()
        for name, kind, n in head["arrays"]:
            arrays[name] = np.memmap(file, kind, "r", at, (n,)) if n else np.zeros(0, kind)
            at += n * np.dtype(kind).itemsize
        return cls(arrays, head["longest"])

    def find(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of each word raw[start : start + size], -1 if the lexicon hasn't it."""
        out = np.full(len(start), -1, np.int64)
        live = np.flatnonzero((size <= self.longest) & (size > 0))
        state, total, j = np.zeros(len(live), np.int32), np.zeros(len(live), np.int32), 0
        start, size = start[live], size[live]
        while len(live):
            at = self.base[state] + raw[start + j]
            ok = (at >= 0) & (at < len(self.check))
            at = np.where(ok, at, 0)
            ok &= self.check[at] == state
            live, start, size, at, total = live[ok], start[ok], size[ok], at[ok], total[ok]
            total = total + self.weight[at]
            state = self.target[at]
            j += 1
            done = size == j
            if done.any():
                hit = done.copy()
                hit[done] = self.final[state[done]]
                out[live[hit]] = total[hit]
                more = ~done
                live, start, size, state, total = live[more], start[more], size[more], state[more], total[more]
        return out


def split(raw: np.ndarray, at: np.ndarray, special: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of the texts raw[at[i] : at[i + 1]] begin and end, and the id of a special token, else -1.

    This is the usual byte-level splitting: contractions; runs of letters, of numbers or of other signs, each with
    one blank before it; white space, of which the last sign stays apart when something follows.
    """
    blob = raw.tobytes()
    n_bytes = len(blob)
    if n_bytes == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if raw.max() < 128:
        cp, byte = raw.astype(np.uint32), None
    else:
        cp = np.frombuffer(blob.decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
        byte = np.concatenate([[0], np.cumsum(width)])
    n = len(cp)
    place = (lambda b: b) if byte is None else (lambda b: np.searchsorted(byte, b))
    cut = np.zeros(n + 1, bool)
    cut[place(at)] = True
    cut[0] = cut[n] = True
    begins, ends, given = [], [], []
    for token, i in special.items():
        x = blob.find(token)
        while x >= 0:
            row = int(np.searchsorted(at, x, side="right")) - 1
            if x + len(token) <= at[row + 1]:
                begins.append(x)
                ends.append(x + len(token))
                given.append(i)
                x = blob.find(token, x + len(token))
            else:
                x = blob.find(token, x + 1)
    s, e = (place(np.array(x, np.int64)) for x in (begins, ends))
    cut[s] = cut[e] = True
    kind = classes()[cp]
    run = cut[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    starts = run.copy()
    led = np.flatnonzero(run[1:] & ~cut[1:n] & (kind[1:] != 0) & (kind[:-1] == 0)) + 1
    starts[led - 1] = True
    starts[led[cp[led - 1] == 0x20]] = False
    quote = np.flatnonzero((cp == 0x27) & starts)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == 1) & ~cut[quote + 1]]
    if len(quote):
        one, two = cp[quote + 1], np.where((quote + 2 < n) & ~cut[np.minimum(quote + 2, n)], cp[np.minimum(quote + 2, n - 1)], 0)
        length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for pair in ("re", "ve", "ll"):
            length = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 3, length)
        quote, length = quote[length > 0], length[length > 0]
        starts[quote + 1] = False
        after = quote + length
        starts[after[after < n]] = True
    for a, b in zip(s.tolist(), e.tolist(), strict=True):
        starts[a + 1 : b] = False
    first = np.flatnonzero(starts)
    ids = np.full(len(first), -1, np.int64)
    if len(s):
        ids[np.searchsorted(first, s)] = given
    begin = first if byte is None else byte[first]
    return begin, np.append(begin[1:], n_bytes), ids


_hashes = Hashes(71)
#: Words of more bytes than this are compared one by one instead of side by side.
WIDE = 64


def _unlike(raw: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of the stretches raw[one : one + size] and raw[other : other + size] differ, by their bytes."""
    out = np.zeros(len(one), bool)
    if not len(one):
        return out
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    live = np.flatnonzero(size <= WIDE)
    for k in range(0, WIDE, 8):
        live = live[size[live] > k]
        if not len(live):
            break
        out[live] |= ((eight[one[live] + k] ^ eight[other[live] + k]) & masks[np.minimum(size[live] - k, 8)]) != 0
    long = np.flatnonzero(size > WIDE)
    if len(long):
        blob = memoryview(raw)
        out[long] = [blob[a : a + n] != blob[b : b + n] for a, b, n in zip(one[long].tolist(), other[long].tolist(), size[long].tolist(), strict=True)]
    return out


def distinct_words(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the words raw[begin : end]: a place of each different word, every word's number among them, and counts.

    Words are sorted by a hash; each is then compared, byte by byte, with the first of its hash and length. Words that
    differ from it are told apart by their bytes alone, so that no choice of text can make two words one.
    """
    size = end - begin
    hashed = _hashes.of(_hashes.sums(raw), begin, end)
    order = np.argsort(hashed, kind="stable")
    a = hashed[order]
    new = np.append(True, a[1:] != a[:-1])[: len(order)]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    places = order[new]
    first = places[number]
    other = size != size[first]
    same = np.flatnonzero(~other)
    other[same] = _unlike(raw, begin[same], begin[first[same]], size[same])
    if other.any():
        blob, known, more = raw.tobytes(), {}, []
        for k in np.flatnonzero(other).tolist():
            word = blob[begin[k] : end[k]]
            if word not in known:
                known[word] = len(places) + len(more)
                more.append(k)
            number[k] = known[word]
        places = np.append(places, np.array(more, places.dtype))
    return places, number, np.bincount(number, minlength=len(places))


class Encoder:
    """What a worker keeps: merges, the mapped lexicon, and by word number the ids as text and the decoded bytes."""

    def __init__(self, merges: Merges, lexicon: Lexicon):
        self.merges, self.lexicon = merges, lexicon
        self.decimal = [str(i).encode() for i in range(len(merges.pieces))]
        ends, ids = lexicon.first_id.tolist(), lexicon.ids.tolist()
        self.text, self.bytes, self.count = [], [], []
        self._add([ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
        self.special = {i: len(self.text) + k for k, i in enumerate(merges.special.values())}
        self._add([[i] for i in merges.special.values()])
        self.fixed = len(self.text)
        self.seen: dict[bytes, int] = {}

    def _add(self, words: list[list[int]]) -> None:
        decimal, pieces = self.decimal, self.merges.pieces
        self.text += [b",".join([decimal[i] for i in ids]) for ids in words]
        self.bytes += [b"".join([pieces[i] for i in ids]) for ids in words]
        self.count += map(len, words)

    def numbers(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different words' numbers, for all texts in a row which of them comes, and where each text's words begin and end."""
        begin, end, given = split(raw, at, self.merges.special)
        own, which, _ = distinct_words(raw, begin, end)
        number = self.lexicon.find(raw, begin[own], end[own] - begin[own])
        for i, k in self.special.items():
            number[given[own] == i] = k
        missing = np.flatnonzero(number < 0)
        if len(missing):
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
                del self.text[self.fixed :], self.bytes[self.fixed :], self.count[self.fixed :]
            blob, seen, new, top, got = raw.tobytes(), self.seen, [], len(self.text), []
            for a, b in zip(begin[own[missing]].tolist(), end[own[missing]].tolist(), strict=True):
                word = blob[a:b]
                i = seen.get(word)
                if i is None:
                    i = seen[word] = top + len(new)
                    new.append(word)
                got.append(i)
            self._add(self.merges.encode(new))
            number[missing] = got
        return number, which, np.searchsorted(begin, at)

    def encoded(self, raw: np.ndarray, at: np.ndarray):
        """Of each text: how many ids, the ids in decimal with commas, and the bytes that they decode to."""
        number, which, ends = self.numbers(raw, at)
        number = number.tolist()
        text, piece = ([x[k] for k in number] for x in (self.text, self.bytes))
        count = np.concatenate([[0], np.cumsum(np.array([self.count[k] for k in number], np.int64)[which])])[ends]
        which, ends = which.tolist(), ends.tolist()
        for n, x, y in zip(np.diff(count).tolist(), ends[:-1], ends[1:], strict=True):
            own = which[x:y]
            yield n, b",".join(map(text.__getitem__, own)), b"".join(map(piece.__getitem__, own))


def _worker(name: str, merges: tuple) -> Encoder:
    """This worker's encoder; the lexicon is mapped from the executor's one copy, which its workers share."""
    got = _encoders.get(name)
    if got is None:
        with open(SparkFiles.get(name), "rb") as f:
            mapped = Lexicon.mapped(f)
        _encoders.clear()
        got = _encoders[name] = Encoder(Merges(*merges), mapped)
    return got


_encoders: dict[str, Encoder] = {}


def frequent_words(docs: DataFrame, text_col: str, special: dict[bytes, int], size: int) -> list[bytes]:
    """The ``size`` words that occur most often in all texts; every occurrence counts, however thinly it is spread.

    Words that occur once, and words of more than LONG bytes, are left out: they are merged one by one when they come.
    """

    def each(batches):
        for batch in batches:
            raw, at = utf8(batch.column(0))
            for i, j in slices(at, CHUNK):
                part = raw[at[i] : at[j]]
                begin, end, given = split(part, at[i : j + 1] - at[i], special)
                own, _, n = distinct_words(part, begin, end)
                keep = (given[own] < 0) & (end[own] - begin[own] <= LONG)
                # words follow each other without a gap, so the text itself holds them all as one Arrow array
                words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(part)).astype(np.int64).tobytes()), pa.py_buffer(part.tobytes())])
                yield pa.RecordBatch.from_arrays([words.take(pa.array(own[keep])).cast(pa.binary()), pa.array(n[keep], pa.int64())], names=["w", "c"])

    rows = docs.select(F.col(text_col).alias("t")).mapInArrow(each, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c")).where("c > 1")
    return rows.orderBy(F.desc("c"), "w").limit(size).select("w").toArrow().column(0).to_pylist()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_size: int = 200_000, ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row of ``docs``; whole texts, null as empty.

    ``path``: a byte-level BPE tokenizer file, read on the driver. An empty text has no tokens and the hash of the
    empty string. Special tokens' strings in a text become those tokens. Ids may be null or repeat: each row
    gives a row. With ``ids`` the token ids themselves come too. What is broadcast is bounded by ``lexicon_size``
    words and the vocabulary, whatever the corpus.
    """
    m = Merges.read(path)
    words = frequent_words(docs, text_col, m.special, lexicon_size)
    spark = docs.sparkSession
    name = shipped(spark, path.encode() + b"\n" + Lexicon.compile(words, m.encode(words)).dump())
    sent = spark.sparkContext.broadcast((m.first, m.pairs, m.ranks, m.made, m.pieces, m.special))
    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * ids

    def each(batches):
        coder = _worker(name, sent.value)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            raw, at = utf8(batch.column(1))
            n, a, b, full = [], [], [], []
            for i, j in slices(at, CHUNK):
                for size, line, back in coder.encoded(raw[at[i] : at[j]], at[i : j + 1] - at[i]):
                    n.append(size)
                    a.append(sha(line))
                    b.append(sha(back.decode("utf-8", "replace").encode()))
                    if ids:
                        full.append([int(k) for k in line.split(b",")] if line else [])
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip([batch.column(0), n, a, b, full], fields, strict=False)], names=[f for f, _ in fields])

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(each, schema).withColumnRenamed("id", id_col)
