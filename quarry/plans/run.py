"""A whole curation run: a folder of images in, a train split, a validation split and a debug table out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import crop_box_of
from ..sources import images, outputs, vocabulary
from ..tables import kept_table
from . import curate


class RunError(RuntimeError):
    """A run that can't reach its targets."""


@dataclass
class Inputs:
    """What models give: each takes the records and returns rows by record_id (detections: by path).

    vectors: (record_id, vector) of unit length. probabilities: (record_id, tag_idx, prob). brisque: (record_id, brisque).
    detections: (path, det_idx, x, y, w, h, confidence).
    """

    vectors: Callable[[DataFrame], DataFrame]
    probabilities: Callable[[DataFrame], DataFrame]
    tags: DataFrame
    brisque: Callable[[DataFrame], DataFrame] | None = None
    detections: Callable[[DataFrame], DataFrame] | None = None


def face_crops(spark: SparkSession, root: str, records: DataFrame, found: DataFrame, cfg: dict) -> DataFrame:
    """Crop records around the largest detection of every eligible record."""
    face = cfg["virtual"]["face_crop"]
    parents = records.where("reject_reason = ''")
    best = images.largest_detections(found, face["confidence"], face["min_face_size"]).join(parents.select("path", "width", "height"), "path")
    box = crop_box_of(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("width"), F.col("height"), face["context_scale"], face["min_size"])
    wanted = best.select("path", F.lit("face_crop").alias("kind"), F.lit(0).alias("view_index"), box.alias("crop_box"), "confidence", F.rint("w").alias("w"), F.rint("h").alias("h")).where("crop_box IS NOT NULL")
    return images.crop_records(spark, root, parents, wanted, cfg).join(parents.select("path", "burst_id"), "path")


def run(spark: SparkSession, source: str, output: str, cfg: dict, models: Inputs) -> dict[str, DataFrame]:
    """Runs all stages and writes train, validate and debug.csv below output. Returns the tables of the stages."""
    specs = config.specs(spark, cfg)
    spec_tags = vocabulary.resolved(specs, models.tags)
    every = kept_table(curate.with_bursts(images.records(spark, source, output, cfg), cfg), "records")
    if cfg["virtual"]["face_crop"]["enabled"] and models.detections:
        crops = face_crops(spark, source, every, models.detections(every), cfg)
        every = kept_table(every.unionByName(crops), "records")
    basic = kept_table(curate.with_prequality(every.where("reject_reason = ''"), cfg), "basic")
    by_hash = kept_table(curate.hash_dedup(basic, cfg), "by-hash")
    left = basic.join(by_hash.where("keep").select("record_id"), "record_id", "left_semi")
    vectors = kept_table(models.vectors(left).select("record_id", F.col("vector").cast("array<double>").alias("vector")), "vectors")
    by_vector = kept_table(curate.vector_dedup(left, vectors, cfg), "by-vector")
    compact = left.join(by_vector.where("keep").select("record_id"), "record_id", "left_semi")
    scores = kept_table(vocabulary.spec_scores(models.probabilities(compact), spec_tags), "scores")
    gated = kept_table(curate.gated(compact, scores, specs, cfg), "gated")
    eligible = gated.where("reject_reason = ''")
    if models.brisque:
        eligible = eligible.join(models.brisque(eligible).select("record_id", "brisque"), "record_id", "left")
    eligible = curate.with_quality(eligible, cfg)
    eligible = kept_table(eligible if "brisque" in eligible.columns else eligible.withColumn("brisque", F.lit(None).cast("double")), "eligible")
    n, wanted = eligible.count(), cfg["dataset"]["train"]
    if n < wanted:
        raise RunError(f"only {n} eligible images remain; {wanted} are needed")
    penalties = kept_table(curate.semantic_penalties(gated, scores, specs, cfg), "penalties")
    pool = eligible.join(penalties, "record_id").join(vectors, "record_id")
    train, train_targets = curate.select(pool, scores, specs, wanted, cfg)
    train = kept_table(train, "train")
    free = kept_table(curate.validation_pool(pool, train, vectors, cfg), "free")
    validate, validate_targets = curate.select(free, scores, specs, cfg["dataset"]["validate"], cfg)
    validate = kept_table(validate, "validate")

    for name, picks in (("train", train), ("validate", validate)):
        named = outputs.manifest(curate.file_name(picks.join(every, "record_id")))
        outputs.materialise(spark, source, named, f"{output.rstrip('/')}/{name}", cfg["runtime"]["output_mode"])
    reasons = [
        by_hash.where("NOT keep").select("record_id", F.lit("phash_duplicate").alias("_why")),
        by_vector.where("NOT keep").select("record_id", F.lit("dino_duplicate").alias("_why")),
        gated.where("reject_reason <> ''").select("record_id", F.col("reject_reason").alias("_why")),
    ]
    later = reasons[0].union(reasons[1]).union(reasons[2])
    full = every.join(later, "record_id", "left").withColumn("reject_reason", F.coalesce("_why", "reject_reason")).drop("_why")
    full = full.join(basic.select("record_id", "prequality"), "record_id", "left").fillna({"prequality": 0.0})
    own = gated.select("record_id", "focus_risk", (F.col("reject_reason") == "").alias("eligible")).join(eligible.select("record_id", "brisque", "quality"), "record_id", "left").fillna({"quality": 0.0})
    order = [(r[0], r[1]) for r in config.spec_rows(cfg)]
    debug = curate.debug_table(full, own, scores, order, penalties, vectors, train, validate)
    outputs.write_table(debug, f"{output.rstrip('/')}/debug.csv")
    return {
        "records": full, "train": train, "validate": validate, "debug": debug, "gated": gated, "worst_risk": curate.worst_risk(gated, train, validate),
        "train_coverage": curate.coverage_report(train, scores, train_targets, cfg), "validate_coverage": curate.coverage_report(validate, scores, validate_targets, cfg),
    }


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(reject_reason, n) of all records, '' for those that passed."""
    return tables["records"].groupBy("reject_reason").agg(F.count("*").alias("n")).orderBy("reject_reason")
