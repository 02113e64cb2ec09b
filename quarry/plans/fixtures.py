"""Projections of the driver's tables that stand in for audited records, their scores, specs and configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clip01, median_hash

#: Fixture specs: name, block, vector place, group, weight, target fraction, source scale, most, hard threshold.
SPECS = [
    ("c1", "category", 4, "g_view", 1.15, 0.06, 0.0, 1.0, None),
    ("c2", "category", 5, "g_view", 1.3, 0.08, 0.0, 1.0, None),
    ("c3", "category", 6, "g_frame", 1.25, 0.30, 0.0, 1.0, None),
    ("c4", "category", 7, "g_pose", 0.7, 0.10, 0.0, 1.0, None),
    ("c5", "category", 8, "g_pose", 0.85, 0.10, 0.0, 1.0, None),
    ("c6", "category", 9, "g_accessory", 0.75, 0.05, 0.85, 0.85, None),
    ("c7", "category", 10, "g_cloth", 0.75, 0.20, 0.65, 0.55, None),
    ("c8", "category", 11, "g_geometry", 0.8, 0.05, 0.35, 0.18, None),
    ("semantic_blur", "penalty", 20, "penalty", 0.0, 0.0, 0.0, 1.0, None),
    ("censoring", "penalty", 21, "penalty", 0.30, 0.0, 0.0, 1.0, 0.65),
    ("cropped_extremities", "penalty", 22, "penalty", 0.07, 0.0, 0.0, 1.0, None),
    ("body_artifact", "penalty", 23, "penalty", 0.12, 0.0, 0.0, 1.0, None),
]
SPEC_SCHEMA = "name string, block string, k int, grp string, weight double, target_fraction double, source_scale double, max_target_fraction double, hard_threshold double"
#: The part of a configuration that the stages look at.
CFG = {
    "audit": {"min_side": 512, "max_aspect": 3.0, "brisque": {"enabled": True, "weight": 0.15},
              "focus": {"fail_risk": 0.7, "soft_risk_start": 0.52, "semantic_hard": 0.45, "semantic_corroborated": 0.3, "semantic_corroboration_risk": 0.55}},
    "dedup": {"phash_distance": 18, "pixel_difference": 0.15, "dino_similarity": 0.35, "dino_phash_distance": 26},
    "burst": {"enabled": True, "gap_seconds": 3 * 3600, "max_span_seconds": 6 * 3600, "repeat_penalty": 0.08},
    "semantic": {"evidence_floor": 0.2, "availability_capture": 0.75, "presence_threshold": 0.3},
    "selection": {"quality_weight": 0.3, "coverage_weight": 0.5, "novelty_weight": 0.2, "coverage_top_groups": 3, "novelty_similarity_start": 0.2, "redundancy_similarity_start": 0.3,
                  "redundancy_penalty": 0.12, "soft_focus_penalty": 0.12, "semantic_penalty_cap": 0.30},
    "validation": {"near_duplicate_similarity": 0.25, "near_duplicate_phash_distance": 28, "same_burst_similarity": 0.05},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(c):
    return F.unix_micros(c.cast("timestamp"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the columns of sources.images.records, and `v`, the vector."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    x = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # keys alone are far larger in memory than their share of a compressed file, so documents and events are never broadcast
    j = e.join(d.hint("merge"), e.vec_id == d.doc_id).join(x.hint("merge"), e.vec_id == x.event_id)
    crop = F.col("vec_id") % 4 == 1

    def name(c):
        return F.concat(F.lit("r"), F.lpad(c.cast("string"), 6, "0"))

    number = F.col("vec_id").cast("int")
    box = F.struct(number.alias("x1"), F.lit(0).alias("y1"), (number + 512).alias("x2"), F.lit(512).alias("y2"))
    side, ratio = 256 + F.col("n_chars") % 1792, 1 + (F.col("n_chars") * 7 % 37) / F.lit(12.0)
    return j.select(
        "vec_id", "label", F.concat(F.lit("/d"), (F.col("user_id") % 8).cast("string"), F.lit("/"), name(F.col("vec_id")), F.lit(".jpg")).alias("path"),
        name(F.col("vec_id")).alias("record_id"), name(F.when(crop, F.col("vec_id") - 1).otherwise(F.col("vec_id"))).alias("source_id"),
        F.when(crop, "face_crop").otherwise("original").alias("kind"), F.when(crop, box).alias("crop_box"), F.lit(0).alias("view_index"),
        F.when(crop, 0.75).alias("detector_confidence"), F.when(crop, 64).otherwise(0).alias("detected_width"), F.when(crop, 70).otherwise(0).alias("detected_height"),
        (side * ratio).cast("int").alias("width"), side.cast("int").alias("height"), side.alias("min_side"), ratio.alias("aspect_ratio"),
        F.when(F.col("vec_id") % 17 != 0, F.col("value")).alias("laplacian"), (F.col("vec_id") * 37 % 101 / F.lit(100.0)).alias("exposure"),
        *[F.least(F.lit(1.0), F.abs(F.col("v")[i]) * 4).alias(n) for i, n in enumerate(("blur_global", "blur_center", "blur_local"))],
        F.when(F.col("vec_id") % 13 != 0, F.abs(F.col("v")[3]) * 100).alias("brisque"), F.col("event_type").alias("capture_source"),
        micros(F.col("ts")).alias("capture_us"), median_hash(F.col("v")).alias("phash"), F.md5((F.col("vec_id") % 50).cast("string").cast("binary")).cast("binary").alias("thumb"),
        F.when(side < CFG["audit"]["min_side"], "small").when(ratio > CFG["audit"]["max_aspect"], "aspect").otherwise("").alias("reject_reason"), F.lit(1).alias("orientation"), "v",
    )


def specs(spark: SparkSession) -> DataFrame:
    """The specs with the columns of config.specs, and k, the place in the vector that gives the score."""
    blocks = [[s for s in SPECS if s[1] == b] for b in ("category", "penalty")]
    return spark.createDataFrame([(*s, i) for b in blocks for i, s in enumerate(b)], SPEC_SCHEMA + ", ord int")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, spec, raw) for every record and spec; the specs are a fixed table, so they are broadcast."""
    rows = records(spark, sf_dir).select("record_id", "v").crossJoin(F.broadcast(specs(spark).select(F.col("name").alias("spec"), "k")))
    return rows.select("record_id", "spec", clip01(0.25 + 1.5 * F.element_at("v", F.col("k"))).alias("raw"))


def _num(x) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"{x}::DOUBLE" if isinstance(x, float) else str(x)


SQL_RECORDS = """
q AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, n_chars, ts, user_id, event_type, value FROM embeddings JOIN documents ON doc_id = vec_id JOIN events ON event_id = vec_id),
records AS (SELECT vec_id, label, 'r' || lpad(vec_id::VARCHAR, 6, '0') AS record_id, vec_id % 4 = 1 AS is_crop, 'r' || lpad((CASE WHEN vec_id % 4 = 1 THEN vec_id - 1 ELSE vec_id END)::VARCHAR, 6, '0') AS source_id,
  256 + n_chars % 1792 AS min_side, 1 + ((n_chars * 7) % 37)::DOUBLE / 12.0::DOUBLE AS aspect_ratio, CASE WHEN vec_id % 17 <> 0 THEN value END AS laplacian, ((vec_id * 37) % 101)::DOUBLE / 100.0::DOUBLE AS exposure,
  least(1.0::DOUBLE, abs(v[1]) * 4) AS blur_global, least(1.0::DOUBLE, abs(v[2]) * 4) AS blur_center, least(1.0::DOUBLE, abs(v[3]) * 4) AS blur_local,
  CASE WHEN vec_id % 13 <> 0 THEN abs(v[4]) * 100 END AS brisque, '/d' || (user_id % 8) AS dir, event_type AS capture_source, epoch_us(ts) AS capture_us, md5((vec_id % 50)::VARCHAR) AS thumb,
  list_sum(list_transform(range(2, 65), lambda i: CASE WHEN v[i] > list_sort(v[2:64])[32] THEN 1::BIGINT << (64 - i)::BIGINT ELSE 0 END))::BIGINT AS phash, v FROM q)"""
SQL_SCORES = f"""{SQL_RECORDS},
specs(spec, block, k, grp, weight, target, scale, most, hard) AS (VALUES {", ".join("(" + ", ".join(map(_num, s)) + ")" for s in SPECS)}),
scores AS (SELECT record_id, is_crop, spec, block, grp, weight, target, scale, most, hard, greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.25::DOUBLE + 1.5::DOUBLE * v[k])) AS raw FROM records CROSS JOIN specs)"""
_GAP, _SPAN = (CFG["burst"][k] * 10**6 for k in ("gap_seconds", "max_span_seconds"))
#: Bursts of the records, numbered in order of folder, source and start; '' outside of bursts.
SQL_BURST_IDS = f"""
bi AS (SELECT record_id, dir, capture_source, capture_us AS t, row_number() OVER (PARTITION BY dir, capture_source ORDER BY capture_us, record_id) AS i FROM records),
bw AS (SELECT dir, capture_source, record_id, i, t, t AS start FROM bi WHERE i = 1 UNION ALL
  SELECT bi.dir, bi.capture_source, bi.record_id, bi.i, bi.t, CASE WHEN bi.t - bw.t <= {_GAP} AND bi.t - bw.start <= {_SPAN} THEN bw.start ELSE bi.t END FROM bw JOIN bi ON bi.dir = bw.dir AND bi.capture_source = bw.capture_source AND bi.i = bw.i + 1),
bz AS (SELECT *, count(*) OVER (PARTITION BY dir, capture_source, start) AS n FROM bw),
bn AS (SELECT record_id, 'B' || lpad((dense_rank() OVER (ORDER BY dir, capture_source, start))::VARCHAR, 5, '0') AS burst_id FROM bz WHERE n >= 2),
burst_ids AS (SELECT record_id, coalesce(burst_id, '') AS burst_id FROM records LEFT JOIN bn USING (record_id))"""
