"""Helpers shared by the operators of this subpackage.

The Python side works on Arrow batches: a text column is one byte buffer
with offsets, so numpy handles whole batches without a Python string per
row.  ``row_chunks`` cuts a batch into runs of whole rows of bounded size,
which bounds the memory of every vectorised step (a single longer text is a
run of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: [\x20\x09-\x0D], the white space that separates words everywhere here.
WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, and any executor can read it again."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def row_chunks(offsets: np.ndarray, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of rows whose bytes stay below ``max_bytes`` together."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def odd_numbers(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers derived from a seed."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_BYTES[list(WHITE)] = 0  # white space adds nothing to a word's hash
_BASE = 0xA3EC647659359ACD
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        x = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        x[0] = 1
        have = np.cumprod(x, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word in order, number of words of each row) for
    the rows ``data[offsets[i]:offsets[i + 1]]``.  A word is a longest run of
    bytes outside :data:`WHITE`."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    body = data[lo:hi]
    at = offsets - lo
    if not len(body):
        return np.empty(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    white = _IS_WHITE[body]
    first = np.empty(len(body), bool)
    first[0] = True
    first[1:] = white[:-1]
    begin = at[:-1][at[:-1] < at[1:]]
    first[begin] = True
    first &= ~white
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    value = _BYTES[body] * _powers(_BASE, len(body))
    sums = np.add.reduceat(value, starts) * _powers(_INVERSE, len(body))[starts]
    return mixed(sums), np.diff(np.searchsorted(starts, at))
