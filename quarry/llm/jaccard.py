"""N-gram Jaccard join with vertical partitioning.

A document's set holds its distinct shingles of Q words; documents link when intersection over union reaches
SHARE_OF / SHARE_IN. Equal sets are one node. The global order of n-grams puts the frequent ones (by a count over all
documents, at most FREQUENT of them) last and orders by hash otherwise; any order gives the same links, a good one few
candidates. The order is cut into fragments. Linked sets share an n-gram of their prefixes, the first
n - ceil(share * n) + 1 n-grams, so each fragment gets the prefixes' n-grams that fall in it and counts, per pair, those
that both have; the counts are summed per pair. A pair is dropped where its places of an n-gram, its sizes, its bitmaps or its
summed count show that the intersection cannot reach the share: linked sets share their first t n-grams within the
first n - least + t places of either. What is left is counted over the whole sets, again fragment by
fragment and summed per pair, and compared exactly in whole numbers.

Pairs are made in two steps, so that a large group of near copies does not give all its pairs. First every n-gram's
documents are paired with one of them, the one with the fewest rare n-grams (the copy with the fewest edits), and the
pairs that link form groups. Then only pairs from different groups are made, all of them. Components need no more.

Cases: a null or wordless text has the empty set, links with nothing and is its own component; a text of fewer than Q
words is one shingle; a null doc_id is smaller than any and shows as a null component_id; rows with one doc_id are
separate documents (one_of_each takes rows with one doc_id and text for one); repeated rows give repeated rows; an empty table gives no rows.
Equal sets are equal in 128 bits of hash, n-grams in 62 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, documents, flat, mix, partitions, passes, release, shingles, words
from .graph import components
from .suffixes import from_planes, planes

Q = 4
SHARE_OF, SHARE_IN = 85, 100
#: An n-gram is frequent from OFTEN documents on; in more than OFTEN_OF documents from as many times more, OFTEN_MOST at most.
OFTEN, OFTEN_OF, OFTEN_MOST = 3, 4000, 48
FREQUENT = 1 << 20
COUNT_BITS = 40  # n-grams that agree in them count together, so they have one place in the order
COUNTED = 4 << 20  # n-grams that a task holds before it sums them up
COUNT_PARTS = 8  # of a partition's n-grams, summed up one after another
BITMAP = 8  # numbers of 64 bits: half for the rare n-grams, half for all
STARS = 2  # partners that a document is compared with in the first step
SHARED = 2  # n-grams that a pair must share early in the order, where its sizes allow to ask for so many
FRAGMENTS = 4  # of the whole sets
PASS = 2 << 20
BITS = [f"bits{i}" for i in range(BITMAP)]
_LEAST = -(1 << 63)
_RARE = 1 << 62


def sets(texts: pa.Array, q: int) -> list[np.ndarray]:
    """Each text's distinct shingles as 62-bit hashes, ascending."""
    h, at = shingles(*words(*flat(texts)), q)
    h >>= np.uint64(2)
    return [np.unique(h[a:b]).astype(np.int64) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: the first 64 name it unless another set has them too."""
    h = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _named(every: DataFrame) -> DataFrame:
    """every, whose sets that agree in d alone get names of their own. Expected are none up to some billion sets."""
    twins = cut(every.where("n > 0").groupBy("d").agg(F.min("e").alias("x"), F.max("e").alias("y")).where("x <> y").select("d", F.lit(True).alias("twin")), "twins")
    if twins.isEmpty():
        return every
    return every.join(twins, "d", "left").withColumn("d", F.when(F.col("twin"), F.xxhash64("d", "e")).otherwise(F.col("d"))).drop("twin")


def _often(docs: int) -> int:
    """How many of so many documents make an n-gram frequent."""
    return min(OFTEN_MOST, max(OFTEN, -(-OFTEN * docs // OFTEN_OF)))


def _counts(docs: DataFrame, q: int, least: int, most: int = COUNTED) -> DataFrame:
    """(gram, n): the first COUNT_BITS of each shingle that `least` documents or more have, and how many do, by all documents."""
    n = partitions(docs)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress

        def out(held: list[np.ndarray]) -> pa.RecordBatch:
            gram, count = np.unique(np.concatenate(held), return_counts=True)
            cell = gram * (n * COUNT_PARTS) >> COUNT_BITS
            cuts = np.flatnonzero(np.diff(cell, prepend=-1))
            blobs = []
            for x, y in zip(cuts.tolist(), [*cuts.tolist()[1:], len(gram)]):
                columns = [np.diff(gram[x:y], prepend=0), count[x:y].astype("<u4")]
                blobs.append((y - x).to_bytes(4, "little") + pack(b"".join(map(planes, columns))))
            cell = cell[cuts].astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(cell // COUNT_PARTS), pa.array(cell % COUNT_PARTS), pa.array(blobs, pa.binary())], ["bucket", "part", "grams"])

        held, size = [], 0
        for b in passes(batches, "text", PASS):
            held.append(np.concatenate(sets(b.column("text"), q)) >> (62 - COUNT_BITS))
            size += len(held[-1])
            if size >= most:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        by_part: dict[tuple[int, int], list[bytes]] = {}
        for b in batches:
            for bucket, part, blob in zip(*(b.column(i).to_pylist() for i in range(3))):
                by_part.setdefault((bucket, part), []).append(blob)
        for key in sorted(by_part):
            grams, counts = [], []
            for blob in by_part.pop(key):
                m = int.from_bytes(blob[:4], "little")
                raw = unpack.decompress(blob[4:])
                grams.append(np.cumsum(from_planes(raw, "<i8", m, 0)))
                counts.append(from_planes(raw, "<u4", m, 8 * m).astype(np.int64))
            gram, count = np.concatenate(grams), np.concatenate(counts)
            order = np.argsort(gram)
            gram, count = gram[order], count[order]
            first = np.flatnonzero(np.diff(gram, prepend=-1))
            gram, count = gram[first], np.add.reduceat(count, first)
            often = count >= least
            yield pa.RecordBatch.from_arrays([pa.array(gram[often]), pa.array(count[often])], ["gram", "n"])
        release()

    return docs.select("text").mapInArrow(summed, "bucket int, part int, grams binary").repartitionById(n, F.col("bucket")).mapInArrow(total, "gram long, n long")


def _frequent(docs: DataFrame, q: int) -> np.ndarray:
    """The first COUNT_BITS of the frequent shingles, at most FREQUENT of them; they only steer the order."""
    top = _counts(docs, q, _often(docs.count())).orderBy(F.desc("n"), "gram").limit(FREQUENT).select("gram")
    return np.sort(top.toArrow().column("gram").to_numpy())


def _flips(each: list[np.ndarray]) -> np.ndarray:
    """For each set, a bitmap (one row) in which each n-gram flips a bit: bits that differ between two sets are n-grams that differ, at least."""
    wide = 32 * BITMAP
    which = np.repeat(np.arange(len(each)), [len(s) for s in each])
    grams = np.concatenate(each) if each else np.zeros(0, np.int64)
    bit = (mix(grams.view(np.uint64)) % np.uint64(wide)).astype(np.int64)
    odd = (np.bincount(which * wide + bit, minlength=len(each) * wide) & 1).astype(np.uint8).reshape(len(each), wide)
    return np.packbits(odd, axis=1, bitorder="little").view("<i8").reshape(len(each), BITMAP // 2)


def _prefixes(docs: DataFrame, q: int, of: int, in_: int) -> DataFrame:
    """(quarry__did, quarry__hash, n, d, e, rare, prefix, bitmap): size and digest of each set, its prefix in the global order, how many of
    that are rare, and bitmaps in which each of its n-grams flips a bit: of the rare ones, if the prefix holds all of them, and of all."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, q))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for b in passes(batches, "text", PASS):
            each = sets(b.column("text"), q)
            out, rare = [], []
            bitmaps = np.zeros((len(each), BITMAP), np.int64)
            bitmaps[:, BITMAP // 2 :] = _flips(each)
            early: list[np.ndarray] = []
            for s in each:
                if len(known):
                    top = s >> (62 - COUNT_BITS)
                    often = known[np.minimum(np.searchsorted(known, top), len(known) - 1)] == top
                else:
                    often = np.zeros(len(s), bool)
                p = len(s) - -(-of * len(s) // in_) + 1 if len(s) else 0
                first = s[~often][:p]
                rare.append(len(first))
                early.append(first if len(first) < p else first[:0])
                if len(first) < p:
                    first = np.concatenate([first, s[often][: p - len(first)] | _RARE])
                out.append(first)
            bitmaps[:, : BITMAP // 2] = _flips(early)
            sizes = np.array([len(x) for x in out], np.int64)
            prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate(out).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("quarry__did"), b.column("quarry__hash"), pa.array([len(s) for s in each], pa.int32()), *(pa.array(x, pa.int64()) for x in zip(*map(digest, each))), pa.array(rare, pa.int32()), prefix, *(pa.array(c) for c in np.ascontiguousarray(bitmaps.T))], ["quarry__did", "quarry__hash", "n", "d", "e", "rare", "prefix", *BITS])

    return docs.select("quarry__did", "quarry__hash", "text").mapInArrow(run, "quarry__did long, quarry__hash long, n int, d long, e long, rare int, prefix array<long>, " + ", ".join(f"{b} long" for b in BITS))


class Reach:
    """Bounds for an intersection that reaches the share, in whole numbers."""

    def __init__(self, of: int, in_: int):
        self.of, self.in_ = of, in_

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least intersection of linked sets of those sizes."""
        return -(-self.of * (a + b) // (self.of + self.in_))

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many n-grams linked sets share, at least, among the first a - least + shared of the one and b - least + shared of the other, at most SHARED."""
        least = self.least(a, b)
        return np.minimum(SHARED, np.minimum(least - self.rest(a), least - self.rest(b)))

    def rest(self, a: np.ndarray) -> np.ndarray:
        """n-grams after the prefix."""
        return -(-self.of * a // self.in_) - 1


def _fragments(rows: DataFrame, n: int) -> DataFrame:
    """(bucket, grams): the prefixes' n-grams by fragment of the global order, with place, set, size, rare and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("prefix")
            at = lists.offsets.to_numpy().astype(np.int64)
            gram = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
            at = at - at[0]
            node = np.repeat(np.arange(b.num_rows), np.diff(at))
            place = np.arange(len(gram)) - at[:-1][node]
            d = b.column("d").to_numpy(zero_copy_only=False)
            _, only = np.unique(d, return_index=True)  # equal sets of a batch count once
            keep = np.isin(node, only)
            gram, node, place = gram[keep], node[keep], place[keep]
            bucket = ((gram & (_RARE - 1)) >> 30) * n >> 32
            order = np.lexsort((gram, bucket))
            gram, node, place, bucket = gram[order], node[order], place[order], bucket[order]
            table = [d, *(b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "rare", "label", *BITS))]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            blobs = []
            for x, y in zip(cuts.tolist(), [*cuts.tolist()[1:], len(gram)]):
                used, local = np.unique(node[x:y], return_inverse=True)
                columns = [gram[x:y], local.astype("<u4"), place[x:y].astype("<u4"), *(c[used] for c in table)]
                blobs.append((y - x).to_bytes(4, "little") + pack(b"".join(map(planes, columns))))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts].astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "grams"])

    return rows.select("d", "n", "rare", "label", "prefix", *BITS).mapInArrow(run, "bucket int, grams binary").repartitionById(n, F.col("bucket"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray] | None:
    """gram, place, d, n, rare, label and bitmap of a fragment, by gram, then rare and d; a set once per gram."""
    unpack, held, tables, count = zstandard.ZstdDecompressor(), [], [], 0
    wide = 4 + BITMAP
    for b in batches:
        for blob in b.column("grams"):
            blob = blob.as_py()
            m = int.from_bytes(blob[:4], "little")
            raw = unpack.decompress(blob[4:])
            k = (len(raw) - 16 * m) // (8 * wide)
            held.append([from_planes(raw, "<i8", m, 0), from_planes(raw, "<u4", m, 8 * m) + np.uint32(count), from_planes(raw, "<u4", m, 12 * m)])
            tables.append([from_planes(raw, "<i8", k, 16 * m + 8 * k * i) for i in range(wide)])
            count += k
    if not held:
        return None
    gram, node, place = (np.concatenate(c) for c in zip(*held))
    held.clear()
    # n-grams of one set only make no pair
    order = np.argsort(gram, kind="stable")
    same = gram[order]
    same = same[1:] == same[:-1]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    gram, node, place = gram[order], node[order], place[order].astype(np.int64)
    columns = [gram, place]
    for i in range(wide):
        columns.append(np.concatenate([t[i] for t in tables])[node])
        for t in tables:
            t[i] = None
    order = np.lexsort((columns[2], columns[4], columns[0]))
    columns = [c[order] for c in columns]
    if len(order):
        new = np.concatenate([[True], (columns[0][1:] != columns[0][:-1]) | (columns[2][1:] != columns[2][:-1])])
        columns = [c[new] for c in columns]
    return columns


PAIRS = "a long, b long, na long, nb long, c long"


def _counted(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, c: np.ndarray | None = None) -> list[np.ndarray]:
    """Pairs once each, with their counts summed."""
    order = np.lexsort((b, a))
    a, b, na, nb = a[order], b[order], na[order], nb[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    first = np.flatnonzero(new)
    weight = np.ones(len(a), np.int64) if c is None else c[order]
    return [a[first], b[first], na[first], nb[first], np.add.reduceat(weight, first)]


def _possible(reach: Reach, na, nb, pa_, pb):
    """Whether sets that share the n-gram at places pa_ and pb can reach the share."""
    return np.minimum(pa_, pb) + 1 + np.minimum(na - pa_, nb - pb) - 1 >= reach.least(na, nb)


def _differ(bits: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many bits differ between the bitmaps of rows i and j."""
    return sum(np.bitwise_count((b[i] ^ b[j]).view(np.uint64)).astype(np.int64) for b in bits)


def _early(reach: Reach, na, nb, pa_, pb):
    """Whether both places are among those where linked sets of these sizes share as many n-grams as are asked for."""
    early = reach.shared(na, nb) - reach.least(na, nb)
    return (pa_ < na + early) & (pb < nb + early)


def _stars(rows: DataFrame, n: int, reach: Reach) -> DataFrame:
    """Pairs of each n-gram's first set and its others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _unpacked(batches)
        if got is None or not len(got[0]):
            return
        gram, place, d, size = got[:4]
        bits = got[6 + BITMAP // 2 :]
        head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))[np.cumsum(np.concatenate([[True], gram[1:] != gram[:-1]])) - 1]
        k = np.flatnonzero((head != np.arange(len(gram))) & _possible(reach, size[head], size, place[head], place))
        k = k[_early(reach, size[head[k]], size[k], place[head[k]], place[k])]
        k = k[_differ(bits, head[k], k) <= size[head[k]] + size[k] - 2 * reach.least(size[head[k]], size[k])]
        if len(k):
            out = _counted(d[head[k]], d[k], size[head[k]], size[k])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["a", "b", "na", "nb", "c"])
            del out
        del got, gram, place, d, size, head, k
        release()

    return _fragments(rows, n).mapInArrow(run, PAIRS)


def _between(rows: DataFrame, n: int, reach: Reach) -> DataFrame:
    """Pairs of sets with different labels that share an n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _unpacked(batches)
        if got is None or not len(got[0]):
            return
        gram, place, d, size, rare, label, *bits = got
        # n-grams whose sets have one label only make no pair
        group = np.cumsum(np.concatenate([[True], gram[1:] != gram[:-1]])) - 1
        starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        mixed = np.minimum.reduceat(label, starts) != np.maximum.reduceat(label, starts)
        keep = mixed[group]
        gram, place, d, size, rare, label, *bits = (x[keep] for x in (gram, place, d, size, rare, label, *bits))
        order = np.lexsort((size, gram))
        gram, place, d, size, rare, label, *bits = (x[order] for x in (gram, place, d, size, rare, label, *bits))
        often = gram >= _RARE
        rest = reach.rest(size)
        held: list = []
        count = 0

        def out() -> pa.RecordBatch:
            a, b, na, nb = (np.concatenate(x) for x in zip(*held))
            swap = a > b
            a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _counted(a, b, na, nb)], ["a", "b", "na", "nb", "c"])

        live = np.arange(len(gram))
        step = 1
        while len(live):
            # sizes ascend within an n-gram: past one that is too large, all are
            live = live[live + step < len(gram)]
            live = live[(gram[live + step] == gram[live]) & (size[live] * reach.in_ >= size[live + step] * reach.of)]
            other = live + step
            ok = (label[live] != label[other]) & _possible(reach, size[live], size[other], place[live], place[other])
            i, j = live[ok], other[ok]
            ok = _early(reach, size[i], size[j], place[i], place[j])
            i, j = i[ok], j[ok]
            least = reach.least(size[i], size[j])
            # differing bits are n-grams that differ
            ok = _differ(bits[BITMAP // 2 :], i, j) <= size[i] + size[j] - 2 * least
            i, j, least = i[ok], j[ok], least[ok]
            # sets with a frequent n-gram in the prefix have all their rare ones there
            differ = _differ(bits[: BITMAP // 2], i, j)
            # what the prefixes can share at most: rare ones that don't differ, and as many frequent ones as the shorter part has
            shared = (rare[i] + rare[j] - differ) // 2 + np.minimum(size[i] - rest[i] - rare[i], size[j] - rest[j] - rare[j])
            # rare ones, frequent ones before this n-gram, this one, and what comes after it
            around = (rare[i] + rare[j] - differ) // 2 + np.minimum(place[i] - rare[i], place[j] - rare[j]) + np.minimum(size[i] - place[i], size[j] - place[j])
            ok = ~often[i] | (around >= least) & (shared + np.maximum(rest[i], rest[j]) >= least)
            i, j = i[ok], j[ok]
            if len(i):
                held.append((d[i], d[j], size[i], size[j]))
                count += len(i)
            if count > 2_000_000:
                yield out()
                held.clear()
                count = 0
            step += 1
        if held:
            yield out()
        del gram, place, d, size, rare, label, bits
        release()

    return _fragments(rows, n).mapInArrow(run, PAIRS)


def _summed(pairs: DataFrame, of: int, in_: int) -> DataFrame:
    """Candidates: pairs whose counts, summed over the fragments, reach what linked sets share early in the order."""
    total = pairs.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("c").alias("c"))
    least = F.floor(((F.col("na") + F.col("nb")) * of + of + in_ - 1) / (of + in_))
    room = [least - F.floor((F.col(x) * of + in_ - 1) / in_) + 1 for x in ("na", "nb")]
    return total.where(F.col("c") >= F.least(F.lit(SHARED), *room))


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, q: int, of: int, in_: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets: intersections are counted by fragment and summed per pair."""
    wanted = pairs.select(F.col("a").alias("d")).union(pairs.select("b")).distinct().join(nodes, "d").select("quarry__did", "quarry__hash", "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in passes(batches, "text", PASS):
            d, part, grams = [], [], []
            for want, s in zip(b.column("d").to_pylist(), sets(b.column("text"), q)):
                at = np.searchsorted(s, [i << 60 for i in range(FRAGMENTS)] + [1 << 62])
                for i in range(FRAGMENTS):
                    if at[i + 1] > at[i]:
                        d.append(want)
                        part.append(i)
                        grams.append(s[at[i] : at[i + 1]])
            if d:
                ends = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(part, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(grams)))], ["d", "part", "grams"])

    whole = cut(docs.join(wanted, ["quarry__did", "quarry__hash"]).select("d", "text").mapInArrow(run, "d long, part int, grams array<long>"), "sets")
    one = pairs.join(whole.select(F.col("d").alias("a"), "part", F.col("grams").alias("x")), "a")
    two = one.join(whole.select(F.col("d").alias("b"), "part", F.col("grams").alias("y")), ["b", "part"])
    part = two.groupBy("a", "b", "part").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.max(F.size(F.array_intersect("x", "y"))).alias("k"))
    total = part.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("k").alias("k"))
    return total.where(F.col("k") * (of + in_) >= (F.col("na") + F.col("nb")) * of).select("a", "b")


def _keys(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.withColumns({"quarry__did": F.coalesce(F.col(key).cast("long"), F.lit(_LEAST)), "quarry__hash": F.xxhash64(F.lit(9), text)})


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", q: int = Q, of: int = SHARE_OF, in_: int = SHARE_IN) -> DataFrame:
    """(quarry__did, quarry__hash, n, root, component) per row of df: root is the same for connected sets, component their least key."""
    reach = Reach(of, in_)
    docs = _keys(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text").select("quarry__did", "quarry__hash", F.coalesce("text", F.lit("")).alias("text"))
    n = partitions(df)
    every = _named(cut(_prefixes(docs, q, of, in_), "prefixes"))
    nodes = every.where("n > 0").groupBy("d").agg(F.min(F.struct("quarry__did", "quarry__hash")).alias("x"))
    nodes = cut(nodes.select("d", "x.*"), "nodes")
    some = every.where("n > 0")
    texts = docs.select("quarry__did", "quarry__hash", "text")
    stars = _summed(_stars(some.withColumn("label", F.col("d")), n, reach), of, in_)
    best = Window.partitionBy("b").orderBy(F.desc("c"), "a")
    stars = cut(stars.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= STARS).drop("rank"), "stars")
    links = cut(_linked(stars, texts, nodes, q, of, in_), "links")
    labels = components(links)
    labelled = some.join(labels.withColumnRenamed("node", "d"), "d", "left").withColumn("label", F.coalesce("label", "d"))
    others = cut(_summed(_between(labelled, n, reach), of, in_), "others")
    more = _linked(others, texts, nodes, q, of, in_)
    labels = components(links.union(more))
    grouped = nodes.join(labels.withColumnRenamed("node", "d"), "d").select("d", "label", "quarry__did")
    least = grouped.groupBy("label").agg(F.min("quarry__did").alias("component"))
    group_of = nodes.join(grouped.select("d", "label").join(least, "label"), "d", "left")
    group_of = cut(group_of.select("d", F.coalesce("label", "d").alias("root"), F.coalesce("component", "quarry__did").alias("component")), "groups")
    rows = every.select("quarry__did", "quarry__hash", "n", "d").join(group_of, "d", "left")
    empty = F.col("n") == 0
    return rows.select("quarry__did", "quarry__hash", "n", F.when(~empty, F.col("root")).alias("root"), F.when(empty, F.col("quarry__did")).otherwise(F.col("component")).alias("component"))


def join_components(df: DataFrame, key: str = "doc_id", text: str = "text", q: int = Q, of: int = SHARE_OF, in_: int = SHARE_IN) -> DataFrame:
    """One row per row of df: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    null = F.lit(None).cast("long")
    return groups(df, key, text, q, of, in_).select(
        F.when(F.col("quarry__did") != _LEAST, F.col("quarry__did")).otherwise(null).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("component") != _LEAST, F.col("component")).otherwise(null).alias("component_id"),
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", q: int = Q, of: int = SHARE_OF, in_: int = SHARE_IN) -> DataFrame:
    """df with one row of each group of linked documents, the one of least key (then least hash of its text); rows without words all stay."""
    found = groups(df, key, text, q, of, in_)
    first = found.where("n > 0 AND quarry__did = component").groupBy("quarry__did", "root").agg(F.min("quarry__hash").alias("quarry__hash")).select("quarry__did", "quarry__hash")
    kept = first.union(found.where("n = 0").select("quarry__did", "quarry__hash")).distinct()
    keyed = _keys(df.select(F.struct(*df.columns).alias("quarry__row"), F.col(key).alias("key"), F.col(text).alias("text")), "key", "text")
    rows = keyed.drop("key", "text").join(kept, ["quarry__did", "quarry__hash"])
    return rows.dropDuplicates(["quarry__did", "quarry__hash"]).select("quarry__row.*")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(documents(spark, sf_dir))
