"""Tag vocabularies: a CSV with names and categories, checked by digest; specs resolved against it."""

from __future__ import annotations

import csv
import hashlib
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import norm_tag


class VocabularyError(RuntimeError):
    """A digest or a spec that doesn't match the vocabulary."""


def read(spark: SparkSession, path: str, sha256: str = "") -> DataFrame:
    """(tag_idx, name, category) in file order, names normalised. One file of some thousand rows, read whole on the driver."""
    content = bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])
    found = hashlib.sha256(content).hexdigest()
    if sha256 and sha256.lower() != found:
        raise VocabularyError(f"{path}: digest {found}, expected {sha256.lower()}")
    rows = [(i, r["name"], int(r.get("category") or 0)) for i, r in enumerate(csv.DictReader(io.StringIO(content.decode("utf-8"), newline="")))]
    return spark.createDataFrame(rows, "tag_idx int, name string, category int").withColumn("name", norm_tag(F.col("name")))


def resolve(specs: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((spec, tag_idx) of every spec, (problem) rows). Only general tags, of category 0, take part.

    A spec has its tags and prefixes less those it excludes; each of them must be found, and each spec keep one.
    """
    words = vocabulary.where("category = 0").select("tag_idx", F.col("name").alias("word"))

    def wanted(column: str) -> DataFrame:
        return specs.select(F.col("name").alias("spec"), F.explode(column).alias("given")).withColumn("tag", norm_tag(F.col("given")))

    def found(column: str) -> DataFrame:
        w = wanted(column)
        on = words["word"].startswith(w["tag"]) if column.endswith("prefixes") else words["word"] == w["tag"]
        return words.join(F.broadcast(w), on).select("spec", "given", "tag_idx")

    problems = []
    parts = {}
    for column in ("tags", "prefixes", "exclude_tags", "exclude_prefixes"):
        parts[column] = found(column)
        end = "*" if column.endswith("prefixes") else ""
        missing = wanted(column).select("spec", "given").join(parts[column], ["spec", "given"], "left_anti")
        problems.append(missing.select(F.concat("spec", F.lit(f".{column}:"), "given", F.lit(end)).alias("problem")))
    has = parts["tags"].union(parts["prefixes"]).select("spec", "tag_idx").distinct()
    without = parts["exclude_tags"].union(parts["exclude_prefixes"]).select("spec", "tag_idx")
    kept = has.join(without, ["spec", "tag_idx"], "left_anti")
    none = specs.select(F.col("name").alias("spec")).join(kept, "spec", "left_anti").select(F.concat("spec", F.lit(":matched_nothing")).alias("problem"))
    for p in problems:
        none = none.union(p)
    return kept, none


def resolved(specs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    kept, problems = resolve(specs, vocabulary)
    wrong = [r["problem"] for r in problems.orderBy("problem").limit(31).collect()]
    if wrong:
        raise VocabularyError("specs don't match the vocabulary: " + ", ".join(wrong[:30]) + (" ..." if len(wrong) > 30 else ""))
    return kept


def spec_scores(probabilities: DataFrame, spec_tags: DataFrame) -> DataFrame:
    """(record_id, spec, raw): the largest probability of a spec's tags, from (record_id, tag_idx, prob). spec_tags is short by contract."""
    return probabilities.join(F.broadcast(spec_tags), "tag_idx").groupBy("record_id", "spec").agg(F.max("prob").alias("raw"))
