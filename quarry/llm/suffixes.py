"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a document with a smaller doc_id.

The suffix array holds the suffixes at token starts. A token is 16 bytes long, and starts where its hash is the least
of those in some 50-byte window; so the text alone, not its place, decides where tokens start, equal windows have equal tokens at
equal offsets, every window has one, and about one place in 18 is one.

Splitters sampled from some documents range-partition the suffixes by their leading token, in byte order, and by their context
where one token is so frequent that splitters fall within it. Each bucket sorts its suffixes by multikey quicksort: by the
first 8 bytes, then, only those that are still equal, by the next 8, then by their context, then by document. The context is the bytes
from 34 before the token (where a window that holds it can begin) to 50 after its start (where one can end), within the
document; it takes part by 96 bits of hash beside the token's own 128 bits.

All windows of a context that an earlier document has too are repeated, so its bytes go. What is left are the first
documents of each context; where contexts agree on one side of the same token (17 more bytes before or after), their
windows are compared one by one, byte by byte: the first document of each window stays, later ones lose it. A token that several
buckets share is compared across their boundaries: the first documents of its contexts meet again by token and side.

Only the text's join with what was found moves whole texts.

Cases: a null text counts as empty; texts under 50 bytes lose nothing; a null doc_id is smaller than any; rows with one
doc_id never repeat each other; equal rows give equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _STEP, cut, documents, eights, flat, mix, partitions, passes, release

MATCH = 50
ANCHOR = 16
BEFORE = MATCH - ANCHOR  # places of a window's start before a token in it
SIDE = ANCHOR + BEFORE // 2  # of any window, this many bytes from its token on or up to its token's end lie in it
SAMPLE_DOCUMENTS = 1000
SAMPLE_CHARS = 4000
#: Buckets for each partition of the input.
BUCKETS_EACH = 2
#: Bytes of text at a time; arrays of 8-byte numbers are made of each.
PASS = 2 << 20


def token_hashes(eight: np.ndarray) -> np.ndarray:
    """32 bits of hash of the 16 bytes from each place; they choose and deal tokens, and make nothing equal."""
    n = max(len(eight) - ANCHOR + 1, 0)
    eight = np.ascontiguousarray(eight)
    h = eight[:n] * _STEP
    h ^= h >> np.uint64(29)
    h += eight[ANCHOR - 8 : ANCHOR - 8 + n]
    h *= _STEP
    h >>= np.uint64(32)
    return h.astype(np.uint32)


#: Odd multipliers of the hashes of a context, and of a side.
_BY = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def span_hashes(eight: np.ndarray, a: np.ndarray, b: np.ndarray, most: int, by: tuple = _BY) -> list[np.ndarray]:
    """Hashes of the bytes a to b (8 to most), one for each multiplier: 8 bytes at a time, the last 8 as often as spans of `most` have more."""
    size = (b - a).astype(np.uint64)
    out = [mix(size + m) for m in by]
    last = b - 8
    for k in range(0, most, 8):
        block = eight[np.minimum(a + k, last)]
        for h, m in zip(out, by):
            h ^= block
            h *= m
            h ^= h >> np.uint64(29)
    return [mix(h) for h in out]


def _sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over all w neighbours, by the first of them."""
    k = 1
    while 2 * k <= w:
        x = f(x[: len(x) - k], x[k:])
        k *= 2
    return f(x[: len(x) - (w - k)], x[w - k :]) if w > k else x


def anchors(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places whose token has the least hash in some 50-byte window within one text (all that are equal to the least)."""
    h = hashes
    w = BEFORE + 1
    n = int(offsets[-1])
    if n < MATCH:
        return np.zeros(0, np.int64)
    # of the windows that hold a token, the greatest least hash; one that runs over a text's end counts for nothing
    least = _sliding(h, w, np.minimum)
    padded = np.zeros(len(h) + w - 1, np.uint32)
    padded[w - 1 : w - 1 + len(least)] = least
    whole = np.zeros(len(padded), bool)
    whole[w - 1 : w - 1 + len(least)] = True
    for a, b in zip(np.maximum(offsets[1:] - MATCH + 1, offsets[:-1]).tolist(), offsets[1:].tolist()):
        padded[w - 1 + a : w - 1 + b] = 0
        whole[w - 1 + a : w - 1 + b] = False
    found = np.flatnonzero(_sliding(padded, w, np.maximum)[: len(h)] == h)
    zero = h[found] == 0  # a hash of 0 is the least of any window; see that there is one
    if zero.any():
        count = np.concatenate([[0], np.cumsum(whole)])
        found = found[~zero | (count[found + w] > count[found])]
    return found


def leading(eight: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The token's 16 bytes from each place, as two numbers whose order is that of the bytes; one row each."""
    return np.stack([eight[at].byteswap(), eight[at + 8].byteswap()])


def multikey_sort(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort: the order by the keys in turn, each of which sorts only what those before leave equal; and where, in that order, all keys change."""
    n = len(keys[0])
    order = np.argsort(keys[0], kind="stable")
    first = keys[0][order]
    new = np.ones(n, bool)
    new[1:] = first[1:] != first[:-1]
    for key in keys[1:]:
        # places in the order that are equal to a neighbour so far
        open_ = ~new
        open_[:-1] |= ~new[1:]
        at = np.flatnonzero(open_)
        if not len(at):
            break
        group = np.cumsum(new[at])
        mine = key[order[at]]
        inner = np.lexsort((mine, group))
        order[at] = order[at][inner]
        mine = mine[inner]
        new[at[1:]] |= mine[1:] != mine[:-1]
    return order, new


COLUMNS = ("<u8", "<u8", "<u8", "<u4", "<u2", "<u2", "<u2", "<u4")


def _suffixes(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The suffixes of texts (65,535 at most): token, as two numbers; context, as two hashes; right and left side; text; place."""
    eight = np.ascontiguousarray(eights(data))
    a = anchors(offsets, token_hashes(eight))
    text = np.searchsorted(offsets, a, "right") - 1
    begin, end = offsets[text], offsets[text + 1]
    left, right = np.maximum(a - BEFORE, begin), np.minimum(a + MATCH, end)
    cut_at = mix((a - left).astype(np.uint64))
    contexts = [h ^ cut_at for h in span_hashes(eight, left, right, BEFORE + MATCH)]
    sides = []
    for x, y in ((a, a + SIDE), (a + ANCHOR - SIDE, a + ANCHOR)):
        has = np.flatnonzero((x >= begin) & (y <= end))
        side = np.zeros(len(a), np.uint16)
        side[has] = (span_hashes(eight, x[has], y[has], SIDE, _BY[:1])[0] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        sides.append(side)
    return [*leading(eight, a), contexts[0], (contexts[1] >> np.uint64(32)).astype("<u4"), *sides, text.astype("<u2"), (a - begin).astype("<u4")]


def planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones, and so on: high zeros lie together for the compressor."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def from_planes(raw: bytes, kind: str, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def _splitters(docs: DataFrame, n: int) -> np.ndarray:
    """Up to n - 1 rows (token, as two numbers, and context) that cut the suffixes of a sample into equal parts.

    The context is 0 but where a token has more than a part, so that other tokens have a bucket each to themselves.
    """
    rate = F.xxhash64("_did", "_hash").bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    count = docs.count()
    rows = docs.where(rate < min(1.0, SAMPLE_DOCUMENTS / max(count, 1))).select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(2 * SAMPLE_DOCUMENTS).collect()
    found = [np.stack(_suffixes(*flat(pa.array([r["text"] for r in rows[i : i + 200]], pa.string())))[:3]) for i in range(0, len(rows), 200)]
    keys = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.uint64)
    m = keys.shape[1]
    if not m:
        return keys
    order, _ = multikey_sort(list(keys))
    keys = keys[:, order]
    cuts = keys[:, np.arange(1, n) * m // n]
    same = (cuts[0, 1:] == cuts[0, :-1]) & (cuts[1, 1:] == cuts[1, :-1])
    hot = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if cuts.shape[1] else np.zeros(0, bool)
    cuts[2, ~hot] = 0
    return np.unique(cuts, axis=1)


def _bucket(splitters: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """How many splitters each key (three numbers) is not less than."""
    out = np.searchsorted(splitters[0], keys[0], "left")
    for i in np.unique(splitters[0]):
        at = np.flatnonzero(keys[0] == i)
        if len(at):
            mine = np.flatnonzero(splitters[0] == i)
            for j in mine.tolist():
                s = splitters[:, j]
                out[at] += (keys[1][at] > s[1]) | ((keys[1][at] == s[1]) & (keys[2][at] >= s[2]))
    return out


def _entries(docs: DataFrame) -> DataFrame:
    """By document, codes 2 * place + kind of tokens: kind 0, the whole context is repeated; kind 1, its windows are to be compared."""
    splitters = _splitters(docs, BUCKETS_EACH * partitions(docs))
    within = splitters[:, splitters[2] > 0] if splitters.shape[1] else splitters
    shared = set(zip(within[0].tolist(), within[1].tolist()))  # tokens that several buckets may hold

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in passes(batches, "text", PASS):
            for c in (b.slice(i, 60_000) for i in range(0, b.num_rows, 60_000)):
                data, offsets = flat(c.column("text"))
                if len(data) < MATCH:
                    continue
                rows = _suffixes(data, offsets)
                if not len(rows[0]):
                    continue
                order, _ = multikey_sort(rows[:3])
                rows = [x[order] for x in rows]
                bucket = _bucket(splitters, rows)
                ids = np.stack([c.column("_did").to_numpy(zero_copy_only=False), c.column("_hash").to_numpy(zero_copy_only=False)])
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                blobs = []
                for x, y in zip(starts.tolist(), [*starts.tolist()[1:], len(bucket)]):
                    part = [r[x:y] for r in rows]
                    used, local = np.unique(part[6], return_inverse=True)
                    part[0] = np.diff(part[0], prepend=np.uint64(0))  # they ascend
                    part[6] = local.astype("<u2")
                    blobs.append((y - x).to_bytes(4, "little") + pack(b"".join(planes(z) for z in [*part, ids[0][used], ids[1][used]])))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "suffixes"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        held: list[list[np.ndarray]] = []
        for b in batches:
            for blob in b.column("suffixes"):
                blob = blob.as_py()
                m = int.from_bytes(blob[:4], "little")
                raw = unpack.decompress(blob[4:])
                at, columns = 0, []
                for kind in COLUMNS:
                    columns.append(from_planes(raw, kind, m, at))
                    at += m * np.dtype(kind).itemsize
                ids = np.stack([from_planes(raw, "<i8", (len(raw) - at) // 16, x) for x in (at, (len(raw) + at) // 2)])
                text = columns[6]
                held.append([np.cumsum(columns[0], dtype=np.uint64), *columns[1:6], ids[0][text], ids[1][text], columns[7]])
        if not held:
            return
        columns = []
        for i in range(9):  # a column at a time, so that only one is there twice
            columns.append(np.concatenate([h[i] for h in held]))
            for h in held:
                h[i] = None
        held.clear()
        order, new = multikey_sort(columns[:4])
        del columns[3]
        for i, c in enumerate(columns):
            columns[i] = c[order]
        t0, t1, _, right, left, did, doc_hash, place = columns
        del order, columns
        which = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        least = np.minimum.reduceat(did, first)
        whole = did > least[which]
        token = np.ones(len(first), bool)
        token[1:] = (t0[first][1:] != t0[first][:-1]) | (t1[first][1:] != t1[first][:-1])
        token = np.cumsum(token)
        compare = np.zeros(len(first), bool)
        for side in (right, left):
            s = side[first]
            has = np.flatnonzero(s)
            key = token[has].astype(np.uint64) << np.uint64(16) | s[has]
            o = np.lexsort((least[has], key))
            k, d = key[o], least[has][o]
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
            ends = np.concatenate([starts[1:], [len(k)]]) if len(k) else starts
            mixed = d[starts] < d[ends - 1] if len(k) else np.zeros(0, bool)
            compare[has[o]] |= np.repeat(mixed, ends - starts)
        across = np.zeros(len(first), bool)
        for x, y in shared:
            across |= (t0[first] == np.uint64(x)) & (t1[first] == np.uint64(y))
        keep = whole | (compare | across)[which]
        for a in range(0, len(keep), 1 << 20):
            k = np.flatnonzero(keep[a : a + (1 << 20)]) + a
            code = place[k].astype(np.int64) * 2 + ~whole[k]
            sure, across_k = pa.array(whole[k] | compare[which[k]]), pa.array(~whole[k] & across[which[k]])
            sides = [pa.array(mix(t0[k] ^ mix(t1[k] + x[k].astype(np.uint64) * _STEP)).view(np.int64), mask=x[k] == 0) for x in (right, left)]
            yield pa.RecordBatch.from_arrays([pa.array(did[k]), pa.array(doc_hash[k]), pa.array(code), sure, across_k, *sides], ["_did", "_hash", "code", "sure", "across", "right", "left"])
        release()

    dealt = docs.mapInArrow(deal, "bucket int, suffixes binary").repartitionById(splitters.shape[1] + 1, F.col("bucket"))
    found = dealt.mapInArrow(sort, "_did long, _hash long, code long, sure boolean, across boolean, right long, left long")
    if shared:
        # the first documents of a token's contexts, from all buckets, by token and side
        found = cut(found, "codes")
        doubt = found.where("across")
        mixed = None
        for s in ("right", "left"):
            group = doubt.where(F.col(s).isNotNull()).groupBy(s).agg(F.min("_did").alias("least"), F.max("_did").alias("most")).where("least < most").select(s)
            some = doubt.where("NOT sure").join(cut(group, "sides"), s, "left_semi").select("_did", "_hash", "code")
            mixed = some if mixed is None else mixed.union(some)
        found = found.where("sure").select("_did", "_hash", "code").union(mixed.distinct())
    return found.groupBy("_did", "_hash").agg(F.collect_list("code").alias("codes"))


def _later_windows(df: DataFrame, n: int) -> DataFrame:
    """By document, (place, bits) of anchors: bit s stands for the window that starts at place - BEFORE + s, if a document with a smaller doc_id has it too."""
    span = BEFORE + MATCH

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in passes(batches, "text", PASS):
            data, offsets = flat(b.column("text"))
            places = [np.array(c, np.int64) for c in b.column("codes").to_pylist()]
            places = [c[c & 1 == 1] >> 1 for c in places]
            text = np.repeat(np.arange(len(places)), [len(c) for c in places])
            at = np.concatenate(places)
            a = at + offsets[text]
            h = token_hashes(eights(data))[a]
            left, right = np.minimum(at, BEFORE), np.minimum(offsets[text + 1] - a, MATCH)
            bucket = h % np.uint32(n)
            order = np.lexsort((h, bucket))
            bucket, text, at, a, left, right = (x[order] for x in (bucket.astype(np.int64), text, at, a, left, right))
            ids = np.stack([b.column("_did").to_numpy(zero_copy_only=False), b.column("_hash").to_numpy(zero_copy_only=False)])
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            blobs = []
            for x, y in zip(cuts.tolist(), [*cuts.tolist()[1:], len(at)]):
                used, local = np.unique(text[x:y], return_inverse=True)
                around = data[np.clip(a[x:y, None] + np.arange(-BEFORE, MATCH), 0, len(data) - 1)]
                columns = [left[x:y].astype("u1"), right[x:y].astype("u1"), local.astype("<u4"), at[x:y].astype("<u4"), ids[0][used], ids[1][used]]
                blobs.append((y - x).to_bytes(4, "little") + pack(around.tobytes() + b"".join(map(planes, columns))))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts].astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "contexts"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        held = []
        for b in batches:
            for blob in b.column("contexts"):
                blob = blob.as_py()
                m = int.from_bytes(blob[:4], "little")
                raw = unpack.decompress(blob[4:])
                around, p = np.frombuffer(raw, np.uint8, m * span).reshape(m, span), m * span
                left, right, text, at = (from_planes(raw, kind, m, p + m * skip) for kind, skip in (("u1", 0), ("u1", 1), ("<u4", 2), ("<u4", 6)))
                p += 10 * m
                ids = np.stack([from_planes(raw, "<i8", (len(raw) - p) // 16, x) for x in (p, (len(raw) + p) // 2)])
                held.append((around, left, right, ids[0][text], ids[1][text], at))
        if not held:
            return
        around, left, right, did, doc_hash, at = (np.concatenate(c) for c in zip(*held))
        held.clear()
        bits = np.zeros(len(at), np.int64)
        rows = np.arange(len(at))
        for s in range(BEFORE + 1):
            has = rows[(s >= BEFORE - left.astype(np.int64)) & (s + MATCH <= BEFORE + right.astype(np.int64))]
            if not len(has):
                continue
            # a window's bytes as seven numbers, the last of which overlaps
            window = np.ascontiguousarray(around[has, s : s + MATCH])
            keys = [np.ascontiguousarray(window[:, x : x + 8]).view(">u8").ravel().astype(np.uint64) for x in (*range(0, MATCH - 8, 8), MATCH - 8)]
            order, new = multikey_sort(keys)
            d = did[has][order]
            least = np.minimum.reduceat(d, np.flatnonzero(new))
            bits[has[order[d > least[np.cumsum(new) - 1]]]] |= 1 << s
        for a in range(0, len(at), 1 << 20):
            k = np.flatnonzero(bits[a : a + (1 << 20)]) + a
            yield pa.RecordBatch.from_arrays([pa.array(did[k]), pa.array(doc_hash[k]), pa.array(at[k].astype(np.int64)), pa.array(bits[k])], ["_did", "_hash", "place", "bits"])
        release()

    some = df.where(F.exists("codes", lambda c: c % 2 == 1)).select("_did", "_hash", "text", "codes")
    dealt = some.mapInArrow(deal, "bucket int, contexts binary").repartitionById(n, F.col("bucket"))
    found = dealt.mapInArrow(sort, "_did long, _hash long, place long, bits long")
    return found.groupBy("_did", "_hash").agg(F.collect_list("place").alias("places"), F.collect_list("bits").alias("bits"))


def removed_mask(n: int, contexts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of n bytes go: those of whole contexts of anchors, and of windows."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.maximum(contexts - BEFORE, 0), 1)
    np.add.at(change, np.minimum(contexts + MATCH, n), -1)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + MATCH, -1)
    return np.cumsum(change)[:n] > 0


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """One row per row of df: bytes, removed bytes, removed runs, digest of what is kept (with keep_bytes, that too)."""
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_did"), F.xxhash64("text").alias("_hash"), "text")
    entries = cut(_entries(docs.select("_did", "_hash", "text")), "suffixes")
    joined = docs.join(entries, ["_did", "_hash"], "left")
    later = _later_windows(docs.join(entries, ["_did", "_hash"]), partitions(docs))
    schema = RESULT + ", kept binary" * keep_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in passes(batches, "text", PASS):
            data, offsets = flat(b.column("text"))
            removed, spans, kept = [], [], []
            for i, (c, places, bits) in enumerate(zip(*(b.column(x).to_pylist() for x in ("codes", "places", "bits")))):
                part = data[offsets[i] : offsets[i + 1]]
                if c:
                    c = np.array(c, np.int64)
                    at, bits = np.array(places or [], np.int64), np.array(bits or [], np.int64)
                    starts = [at[bits >> s & 1 == 1] - BEFORE + s for s in range(BEFORE + 1)] if len(at) else [at]
                    gone = removed_mask(len(part), c[c & 1 == 0] >> 1, np.concatenate(starts))
                    removed.append(int(gone.sum()))
                    spans.append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
                    kept.append(part[~gone].tobytes())
                else:
                    removed.append(0)
                    spans.append(0)
                    kept.append(part.tobytes())
            columns = [b.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())] if keep_bytes else columns, [x.split()[0] for x in schema.split(", ")])

    return joined.join(later, ["_did", "_hash"], "left").select("doc_id", "text", "codes", "places", "bits").mapInArrow(run, schema)


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
