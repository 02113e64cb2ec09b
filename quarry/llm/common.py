"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..tables import kept_table as cut  # noqa: F401
from ..tables import sweep  # noqa: F401

SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of text that one vectorised pass works on; a longer single text makes its own pass.
PASS_BYTES = 4 << 20
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(df: DataFrame) -> int:
    """How many partitions a shuffle of df's rows should have: its scan's, or the session's if more."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def passes(batches: Iterator[pa.RecordBatch], column: str, limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of `column`. Gives memory back at the end: Python workers outlive their task."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.diff(flat(batch.column(column))[1])
        part = np.cumsum(size) // limit
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
        del batch
    release()


def release() -> None:
    """Return what the allocators hold beyond need to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end (null: empty), and the n + 1 offsets of the texts there."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit generator: every input bit changes about half of the output bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Longer words are hashed one by one.
LONG_WORD = 512


def eights(data: np.ndarray) -> np.ndarray:
    """From each place, the next 8 bytes as a number, the first lowest; bytes after the end are 0."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data),), "<u8", padded.data, 0, (1,))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, and the n + 1 offsets of the texts in them.

    Eight bytes at a time are mixed into a word's hash; no sum over bytes takes part, so words can't be made to cancel out.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    gap = _SPACE[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    after[inner - 1] = True
    start, end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after)
    low = _LOWER[data]
    eight = eights(low)
    size = end - start + 1
    h = mix(size.astype(np.uint64) + _STEP)
    at, left, who = start, size, None
    long = np.flatnonzero(size > LONG_WORD)
    for i in long.tolist():
        h[i] = int.from_bytes(hashlib.blake2b(low[start[i] : end[i] + 1].tobytes(), digest_size=8).digest(), "little")
    if len(long):
        who = np.flatnonzero(size <= LONG_WORD)
        at, left = start[who], size[who]
    while len(at):
        block = eight[at]
        short = left < 8
        block[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        if who is None:
            h = mix((h ^ block) + _STEP)
        else:
            h[who] = mix((h[who] ^ block) + _STEP)
        more = np.flatnonzero(left > 8)
        who = more if who is None else who[more]
        at, left = at[more] + 8, left[more] - 8
    return h, np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, at: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of q words within each text, or of the whole text if it has fewer; offsets of the texts in them."""
    n = np.diff(at)
    count = np.where(n >= q, n - q + 1, np.minimum(n, 1))
    out_at = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(at[:-1] - out_at[:-1], count) + np.arange(out_at[-1])
    width = np.repeat(np.minimum(n, q), count)
    h = width.astype(np.uint64)
    for k in range(q):
        has = width > k
        h[has] = mix(h[has] * _STEP + hashes[first[has] + k])
    return h, out_at
