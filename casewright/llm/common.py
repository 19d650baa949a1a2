"""What the operators of this subpackage share: Arrow buffers, hashes, files for all executors; cuts of lineage and components come from the core."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from casewright.operators.durability import durable, shared_folder, star_components


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(spark: SparkSession, blob: bytes) -> str:
    """The name under which ``SparkFiles.get`` finds ``blob`` as a file, one for each executor, which its workers can map.

    The file is written to the folder that all executors share, named by its content; an executor that comes later, or
    in place of a lost one, fetches it by itself.
    """
    name = f"casewright-{hashlib.sha256(blob).hexdigest()[:32]}"
    jvm, at = spark.sparkContext._jvm, f"{shared_folder(spark)}/{name}"
    path = jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        staged = jvm.org.apache.hadoop.fs.Path(f"{at}.staged")
        out = fs.create(staged, True)
        for lo in range(0, len(blob), 1 << 22):
            out.write(bytearray(blob[lo : lo + (1 << 22)]))
        out.close()
        fs.rename(staged, path)
    spark.sparkContext.addFile(at)
    return name


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of an Arrow array, end to end, and the n + 1 places where they begin and end.

    Null strings count as empty. The arrays are views of Arrow's own buffers, so nothing is copied.
    """
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cuts rows [i, j) whose texts together have ``most`` bytes or so; a longer text stands alone."""
    cuts, i, n = [], 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        cuts.append((i, min(j, n)))
        i = cuts[-1][1]
    return cuts


components = star_components


class Hashes:
    """Hashes of any stretch of a byte array in constant time, from running sums of powers of an odd base modulo 2**64.

    Every byte first becomes a random number, so equal hashes of different stretches are no likelier than chance.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(2**32, 2**62)) * 8 + 5
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            step = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b % 2**64, np.uint64)]), dtype=np.uint64)
            self.up, self.down = step(self.base), step(pow(self.base, -1, 2**64))

    def sums(self, raw: np.ndarray) -> np.ndarray:
        """len(raw) + 1 running sums."""
        self._grow(len(raw) + 1)
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.table[raw] * self.up[: len(raw)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The mixed hashes of the stretches [start, end)."""
        return mix((sums[end] - sums[start]) * self.down[start])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, in a one-to-one way."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
