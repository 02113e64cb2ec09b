"""Language identification by prediction by partial matching.

Each language has a variable-order byte context tree: counts of the bytes seen after every context of up to ORDER bytes.
A byte costs -log2(c / (N + D)) bits if the context of N bytes, D of them distinct, has seen it c times; otherwise the
escape, -log2(D / (N + D)), and what it costs after the next shorter context (contexts never seen cost nothing; the
last resort is 8 bits). Statistics stay frozen while texts are scored, so a text's code length is the sum over its bytes
of a function of the byte and the ORDER bytes before it; the language of least length wins. A-Z count as a-z, and a
text is taken to follow ORDER line feeds.

The trees are learned from a bounded sample: of the labelled documents whose crc32(doc_id as text) mod 3 is not 1, at
most SAMPLE_ROWS a language, chosen by a hash of doc_id, and the first SAMPLE_CHARS characters of each.

Cases: a null text, an empty one, one without a letter, and every text if nothing could be learned, get `und` with score
0. The score is the winner's share of probability, 2 ** -bits over the sum for all languages; ties go to the language
that sorts first. A null doc_id is not held out. Repeated rows give repeated rows, an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _LOWER, documents, flat, passes

ORDER = 3
SAMPLE_ROWS = 300
SAMPLE_CHARS = 20_000
NONE = "und"


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each byte, itself and the `order` bytes before it within its text, as a number (first byte highest)."""
    low = _LOWER[data]
    out = low.astype(np.uint32)
    starts = np.repeat(offsets[:-1], np.diff(offsets))
    at = np.arange(len(low)) - starts
    for k in range(1, order + 1):
        before = np.full(len(low), 10, np.uint8)
        has = at >= k
        before[has] = low[np.flatnonzero(has) - k]
        out |= before.astype(np.uint32) << np.uint32(8 * k)
    return out


class Trees:
    """The context trees of all languages, as sorted arrays by order."""

    def __init__(self, texts: dict[str, list[str]], order: int = ORDER):
        self.names, self.order = sorted(texts), order
        grams = []
        for name in self.names:
            data, offsets = flat(pa.array(texts[name], pa.string()))
            grams.append(_grams(data, offsets, order))
        self.levels = []
        for k in range(order + 1):
            mask = np.uint32((1 << 8 * (k + 1)) - 1)
            seen = [np.unique(g & mask, return_counts=True) for g in grams]
            keys = np.unique(np.concatenate([s[0] for s in seen])) if seen else np.zeros(0, np.uint32)
            count = np.zeros((len(keys), len(grams)))
            for i, (g, n) in enumerate(seen):
                count[np.searchsorted(keys, g), i] = n
            context = keys >> np.uint32(8) if k == 0 else keys & ~np.uint32(255)
            if k == 0:
                context = np.zeros(len(keys), np.uint32)
            contexts, where = np.unique(context, return_inverse=True)
            total, kinds = np.zeros((len(contexts), len(grams))), np.zeros((len(contexts), len(grams)))
            np.add.at(total, where, count)
            np.add.at(kinds, where, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = np.where(count > 0, -np.log2(count / (total + kinds)[where]), np.nan)
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            self.levels.append((keys, cost, contexts, escape))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """What the last byte of each gram costs, by language."""
        out = np.full((len(grams), len(self.names)), 8.0)
        for k, (keys, cost, contexts, escape) in enumerate(self.levels):
            if not len(keys):
                continue
            g = grams & np.uint32((1 << 8 * (k + 1)) - 1)
            c = g & ~np.uint32(255) if k else np.zeros(len(g), np.uint32)
            i = np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
            out += np.where((contexts[i] == c)[:, None], escape[i], 0.0)
            j = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
            here = np.where((keys[j] == g)[:, None], cost[j], np.nan)
            out = np.where(np.isnan(here), out, here)
        return out

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Code length in bits of each text in each language."""
        data, offsets = flat(texts)
        out = np.zeros((len(offsets) - 1, len(self.names)))
        if not len(data) or not self.names:
            return out
        kinds, which = np.unique(_grams(data, offsets, self.order), return_inverse=True)
        bits = self.bits(kinds)
        full = np.flatnonzero(np.diff(offsets))
        for i in range(len(self.names)):
            out[full, i] = np.add.reduceat(bits[which, i], offsets[:-1][full])
        return out


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, order: int = ORDER) -> Trees:
    """Trees from a sample of the labelled documents that are not held out; see the module's text for its bound."""
    from_ids = docs.where(F.col("lang").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in from_ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Trees({}, order)
    rank = (F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)).bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40)))
    # about 2 * rows of each language, the same share of each first; the order settles which ones are taken
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2.0 * rows / n))])
    chosen = from_ids.select("lang", F.substring("text", 1, chars).alias("text"), (rank / share[F.col("lang")]).alias("rank"), "doc_id").where("rank < 1 AND text IS NOT NULL")
    texts: dict[str, list[str]] = {}
    for r in chosen.orderBy("rank", "doc_id", "text").limit(4 * rows * len(counts)).collect():
        if len(texts.setdefault(r["lang"], [])) < rows:
            texts[r["lang"]].append(r["text"])
    return Trees(texts, order)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def identify(df: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """df with lang_pred, score and bits_per_byte (in place of columns of those names); no shuffle. Only the text is looked at."""
    df = df.drop("lang_pred", "score", "bits_per_byte")
    shared = df.sparkSession.sparkContext.broadcast(trees)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for b in passes(batches, text, 1 << 20):
            texts = b.column(text)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            size = np.diff(flat(texts)[1])
            bits = trees.lengths(texts)
            if trees.names:
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                names = np.array(trees.names, object)[best]
            else:
                letters, score, names, least = letters & False, np.zeros(len(size)), np.full(len(size), NONE, object), np.zeros(len(size))
            columns = [pa.array(np.where(letters, names, NONE), pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(np.where(size > 0, least / np.maximum(size, 1), 0.0))]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], [*b.schema.names, "lang_pred", "score", "bits_per_byte"])

    return df.mapInArrow(run, f"{fields}, lang_pred string, score double, bits_per_byte double")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), learn(docs)).drop("text")
