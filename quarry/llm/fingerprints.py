"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint holds the k smallest distinct 64-bit hashes of a text's shingles (five words, A-Z lower-cased, split at
ASCII white space; a text of fewer words is one shingle). The k smallest hashes of a union are the k smallest of the
parts' fingerprints, so fingerprints of parts merge without the texts.

Cases: a null text counts as empty; a text without words has the empty fingerprint; two empty fingerprints have
likeness 1, an empty and another one 0. Equal texts have equal fingerprints. Repeated rows give repeated rows. A null
doc_id sorts first; of rows with one doc_id the lesser text comes first. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, flat, partitions, passes, shingles, words

K = 128
WORDS = 5
_LEAST = -(1 << 63)


def sketch(texts: pa.Array, k: int = K, q: int = WORDS) -> list[np.ndarray]:
    """The fingerprint of each text: its k smallest distinct shingle hashes, ascending."""
    h, at = shingles(*words(*flat(texts)), q)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        part = h[a:b]
        while True:
            # the k smallest distinct ones lie among the m smallest as long as those hold k distinct ones
            m = 4 * k
            if len(part) > 2 * m:
                least = np.unique(np.partition(part, m)[:m])
                if len(least) >= k:
                    out.append(least[:k])
                    break
            out.append(np.unique(part)[:k])
            break
    return out


def merge(parts: list[np.ndarray], k: int = K) -> np.ndarray:
    """The fingerprint of the union of the parts' texts (of the shingles within the parts)."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated size of the intersection over that of the union; exact if both sketches hold all shingles."""
    if not len(a) and not len(b):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    if len(a) < k and len(b) < k:
        return len(both) / (len(a) + len(b) - len(both))
    union = np.union1d(a, b)[:k]
    return int(np.searchsorted(both, union[-1], "right")) / len(union)


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / (float(a[-1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    if not len(a):
        return 1.0
    union = distinct_shingles(merge([a, b], k), k)
    if len(a) < k and len(b) < k:
        return len(np.intersect1d(a, b, assume_unique=True)) / len(a)
    return float(min(1.0, resemblance(a, b, k) * union / max(distinct_shingles(a, k), 1.0)))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def decode(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u8")


def fingerprint(df: DataFrame, text: str = "text", k: int = K, q: int = WORDS) -> DataFrame:
    """df with the columns fingerprint (string) and shingle_estimate (double); no shuffle."""
    df = df.drop("fingerprint", "shingle_estimate")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, fingerprint string, shingle_estimate double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in passes(batches, text):
            s = sketch(b.column(text), k, q)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(map(encode, s), pa.string()), pa.array([distinct_shingles(x, k) for x in s])], [*b.schema.names, "fingerprint", "shingle_estimate"])

    return df.mapInArrow(run, schema)


def merge_by(df: DataFrame, key: str, fingerprint_column: str = "fingerprint", k: int = K) -> DataFrame:
    """One merged fingerprint per key. Each task first merges what it has of a key, so a hot key sends one row a task."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, fingerprint string"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for name, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held[name] = merge([held[name], decode(s)], k) if name in held else decode(s)
            if len(held) > 20_000:
                yield out(held)
                held = {}
        if held:
            yield out(held)

    def out(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(map(encode, held.values()), pa.string())], [key, "fingerprint"])

    kind = pa.int64() if df.schema[key].dataType.simpleString() in ("bigint", "int") else pa.string()
    first = df.select(F.col(key), F.col(fingerprint_column).alias("fingerprint")).mapInArrow(partial, schema)
    return first.repartition(key).mapInArrow(partial, schema)


def _ordered(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (place, key, halo, text): partition `place` holds a range of keys, and after it the next range's first rows (halo)."""
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = partitions(docs)
    splits = np.array(sorted(set(keyed.approxQuantile(["key"], [i / n for i in range(n)], max(0.1 / n, 1e-5))[0])), np.float64)
    least = keyed.agg(F.min("key")).first()[0]
    if least is None:
        return spark.createDataFrame([], "place int, key long, doc_id long, halo boolean, text string"), 1
    # quantiles are values of the table, but as doubles; past 2 ** 53 some round, so take the rows' own order of the rounded keys
    splits = np.unique(np.concatenate([[float(least)], splits]))
    n = len(splits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("key").to_numpy(zero_copy_only=False)
            at = np.searchsorted(splits, key.astype(np.float64), "right") - 1
            edge = np.flatnonzero(splits[at] == key.astype(np.float64))
            halo = pa.array(np.repeat([False, True], [len(key), len(edge)]))
            rows = np.concatenate([np.arange(len(key)), edge])
            goes = np.concatenate([at, (at[edge] - 1) % n])
            taken = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(goes.astype(np.int32)), taken.column("key"), taken.column("doc_id"), halo, taken.column("text")], ["place", "key", "doc_id", "halo", "text"])

    return keyed.mapInArrow(place, "place int, key long, doc_id long, halo boolean, text string"), n


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shingle_estimate double"


def fingerprint_edits(docs: DataFrame, k: int = K, q: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, beside the next document's.

    One shuffle: documents are dealt to ranges of doc_id between quantiles; the first rows of each range also go to the
    range before (the first of all to the last), so each document meets its successor without a second shuffle.
    """
    placed, n = _ordered(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row so far, whose successor is not known yet
        for b in passes(batches, "text"):
            texts = ["" if t is None else t for t in b.column("text").to_pylist()]
            rows = list(zip(b.column("doc_id").to_pylist(), b.column("halo").to_pylist(), texts, sketch(pa.array(texts, pa.string()), k, q)))
            yield from out([held, *rows] if held else rows)
            held = rows[-1]
        # the last row of a range is a halo row: its own range has it

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs = [(x, y) for x, y in zip(rows, rows[1:]) if not x[1]]
        if not pairs:
            return
        edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for (_, _, t, _), (_, _, u, _) in pairs]
        marks = []
        a = size = 0
        for i, t in enumerate(edited):  # edited texts may be long where texts of the pass were short
            size += len(t)
            if size > 8 << 20 or i == len(edited) - 1:
                marks += sketch(pa.array(edited[a : i + 1], pa.string()), k, q)
                a, size = i + 1, 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x, _ in pairs], pa.int64()),
                pa.array([len(x[2]) for x, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([encode(x[3]) for x, _ in pairs], pa.string()),
                pa.array(map(encode, marks), pa.string()),
                pa.array([resemblance(x[3], m, k) for (x, _), m in zip(pairs, marks)], pa.float64()),
                pa.array([resemblance(x[3], y[3], k) for x, y in pairs], pa.float64()),
                pa.array([distinct_shingles(x[3], k) for x, _ in pairs], pa.float64()),
            ],
            [x.split()[0] for x in RESULT.split(", ")],
        )

    dealt = placed.repartitionById(n, F.col("place")).sortWithinPartitions(F.col("halo"), F.col("key"), F.col("text").asc_nulls_first())
    return dealt.mapInArrow(run, RESULT)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir).select("doc_id", "text"))
