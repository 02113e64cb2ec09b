"""The corpus pipeline: from documents to packed training sequences in five stages.

1. language: texts without a letter go, and those that cost more than their bytes in every language (if any could be learned).
2. line_dedup: later copies of maximal repeated line runs are deleted; a text of which nothing is left goes.
3. jaccard: of each group of near duplicates (five-word shingles, 0.8) the document with the smallest doc_id stays.
4. secrets: owner-specific live-looking credentials are replaced by a mark.
5. packing: what is left is tokenised and packed into windows.

All stages but the last return the columns of documents; n_chars follows the text. A null text counts as empty, so the
first stage drops it. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import jaccard, language, lines, packing, secrets
from quarry.llm.common import cut, documents

#: A text is in none of the languages if the best one's code is longer than the bytes themselves.
MOST_BITS = 8.0
NEAR_WORDS, NEAR_OF, NEAR_IN = 5, 80, 100


def _packed(docs: DataFrame):
    """The columns but the text as one, so that no name of theirs can clash with an operator's."""
    return F.struct(*[c for c in docs.columns if c != "text"]).alias("quarry__row")


def _unpacked(rows: DataFrame, columns: list[str], counted: bool = True) -> DataFrame:
    """The columns again, with the text as it is now, and n_chars that follow it."""
    own = {"text": F.col("text")} | ({"n_chars": F.char_length("text").cast("long")} if counted else {})
    return rows.select(*[own.get(c, F.col("quarry__row")[c]).alias(c) for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = language.learn(docs)
    if not trees.names:  # nothing is labelled, so no text is in the wrong language
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs.select("text", _packed(docs)), trees)
    return _unpacked(found.where((F.col("lang_pred") != language.NONE) & (F.col("bits_per_byte") <= MOST_BITS)), docs.columns, counted=False)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = lines.dedup_lines(docs.select("doc_id", "text", _packed(docs)))
    return _unpacked(rows.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")), docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, q=NEAR_WORDS, of=NEAR_OF, in_=NEAR_IN)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = secrets.redact(docs.select("doc_id", "text", "source", _packed(docs)))
    return _unpacked(rows, docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language", language_stage),
    ("line_dedup", line_stage),
    ("jaccard", jaccard_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]
#: Neither code lengths nor tokens nor packing can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
