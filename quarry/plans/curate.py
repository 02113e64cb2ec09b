"""The stages of a curation run, each from DataFrames and the configuration to a DataFrame.

Records have the columns of sources.images.records; other tables hang on record_id.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import kernels
from ..functions.columns import clip01, evidence, hamming, median3, output_stem, resolution_score
from ..operators.bursts import assign_bursts, burst_names
from ..operators.independent import greedy_keep
from ..operators.pairs import cosine_pairs, hamming_pairs, near_chosen, nearest
from ..operators.ranks import robust_rank
from ..operators.selection import coverage_scores, rule_of, select_greedy
from ..tables import kept_table

CROP_EXEMPT, BLUR_SPEC = "cropped_extremities", "semantic_blur"


def with_bursts(records: DataFrame, cfg: dict) -> DataFrame:
    """records with burst_id, '' outside of bursts."""
    b = cfg["burst"]
    if not b["enabled"]:
        return records.withColumn("burst_id", F.lit(""))
    keys = ["dir", "capture_source"]
    items = records.select("record_id", "capture_us", "capture_source", F.regexp_replace("path", "/[^/]*$", "").alias("dir"))
    found = assign_bursts(items, keys, "capture_us", "record_id", round(b["gap_seconds"] * 10**6), round(b["max_span_seconds"] * 10**6))
    names = burst_names(found, keys).select("record_id", "burst_id")
    return records.join(names, "record_id", "left").withColumn("burst_id", F.coalesce("burst_id", F.lit("")))


def with_prequality(records: DataFrame, cfg: dict) -> DataFrame:
    ranked = robust_rank(records, "laplacian", "_sharp")
    total = 0.65 * F.col("_sharp") + 0.25 * F.col("exposure") + 0.10 * resolution_score(F.col("min_side"), cfg["audit"]["min_side"])
    return ranked.withColumn("prequality", total).drop("_sharp")


def _order(records: DataFrame) -> DataFrame:
    return records.select(F.col("record_id").alias("id"), F.struct((-F.col("prequality")).alias("p"), "record_id").alias("rank"))


def hash_dedup(records: DataFrame, cfg: dict) -> DataFrame:
    """(record_id, keep): a record goes if one that stays is better, near by hash and near by pixels.

    Records alike in hash and thumb conflict with the same others, so only the best of them enters the join of pairs.
    """
    d = cfg["dedup"]
    w = Window.partitionBy("phash", "_digest").orderBy(F.desc("prequality"), "record_id")
    rows = records.select("record_id", "prequality", "phash", F.xxhash64("thumb").alias("_digest"))
    rows = kept_table(rows.withColumn("first", F.row_number().over(w) == 1).drop("_digest"), "classes")
    best = rows.where("first")
    pairs = hamming_pairs(best, "record_id", "phash", d["phash_distance"]).select("a", "b")
    views = records.select("record_id", "thumb")

    @F.pandas_udf("double")
    def difference(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([kernels.pixel_difference(a, b) for a, b in zip(x, y)], dtype=float)

    both = pairs.join(views.select(F.col("record_id").alias("a"), F.col("thumb").alias("x")), "a").join(views.select(F.col("record_id").alias("b"), F.col("thumb").alias("y")), "b")
    edges = both.where(difference("x", "y") <= d["pixel_difference"]).select("a", "b")
    kept = greedy_keep(_order(best), edges)
    return rows.join(kept.where("keep").select(F.col("id").alias("record_id"), "keep"), "record_id", "left").select("record_id", F.coalesce("keep", F.lit(False)).alias("keep"))


def vector_dedup(records: DataFrame, vectors: DataFrame, cfg: dict) -> DataFrame:
    """(record_id, keep): a record goes if one that stays is better, near by vector and near by hash."""
    d = cfg["dedup"]
    rows = records.select("record_id", "prequality", "phash").join(vectors, "record_id")
    code = rows.select("record_id", "phash")
    pairs = cosine_pairs(rows, "record_id", "vector", d["dino_similarity"])
    pairs = pairs.join(code.select(F.col("record_id").alias("a"), F.col("phash").alias("x")), "a").join(code.select(F.col("record_id").alias("b"), F.col("phash").alias("y")), "b")
    edges = pairs.where(hamming(F.col("x"), F.col("y")) <= d["dino_phash_distance"]).select("a", "b")
    return greedy_keep(_order(rows), edges).select(F.col("id").alias("record_id"), "keep")


def gated(records: DataFrame, scores: DataFrame, specs: DataFrame, cfg: dict) -> DataFrame:
    """records with focus_risk and reject_reason: focus before semantic_hard, else ''."""
    f = cfg["audit"]["focus"]
    df = records
    for c in ("blur_global", "blur_center", "blur_local", "laplacian"):
        df = robust_rank(df, c, "_r_" + c, of=records)
    blur = median3(*[F.col("_r_" + c) for c in ("blur_global", "blur_center", "blur_local")])
    risk = clip01(0.5 * blur + 0.4 * (1 - F.col("_r_laplacian")) + 0.1 * (1 - F.col("exposure")))
    df = df.withColumn("focus_risk", risk).drop("_r_blur_global", "_r_blur_center", "_r_blur_local", "_r_laplacian")
    of = scores.join(F.broadcast(specs.where("block = 'penalty'").select(F.col("name").alias("spec"), "hard_threshold")), "spec")
    marks = of.groupBy("record_id").agg(F.max(F.when(F.col("spec") == BLUR_SPEC, F.col("raw"))).alias("_blur"), F.bool_or(F.coalesce(F.col("raw") >= F.col("hard_threshold"), F.lit(False))).alias("_hard"))
    r, b = F.col("focus_risk"), F.coalesce("_blur", F.lit(0.0))
    soft = (r >= f["fail_risk"]) | (b >= f["semantic_hard"]) | ((b >= f["semantic_corroborated"]) & (r >= f["semantic_corroboration_risk"]))
    why = F.when(soft, "focus").when(F.col("_hard"), "semantic_hard").otherwise("")
    return df.join(marks, "record_id", "left").withColumn("reject_reason", why).drop("_blur", "_hard")


def with_quality(eligible: DataFrame, cfg: dict) -> DataFrame:
    """Eligible records with quality; the column brisque, if there and of two known values or more, takes part by its rank."""
    b = cfg["audit"]["brisque"]
    parts = [(0.55, 1 - F.col("focus_risk")), (0.20, F.col("exposure")), (0.10, resolution_score(F.col("min_side"), cfg["audit"]["min_side"]))]
    df = eligible
    if b["enabled"] and "brisque" in df.columns and len(df.where(F.abs("brisque") < float("inf")).limit(2).collect()) == 2:
        df = robust_rank(df, "brisque", "_brisque", higher=False, of=eligible)
        parts.append((b["weight"], F.col("_brisque")))
    total = sum(w * c for w, c in parts) / sum(w for w, _ in parts)
    return df.withColumn("quality", total).drop("_brisque")


def _evidence(cfg: dict):
    return evidence(F.col("raw"), cfg["semantic"]["evidence_floor"], cfg["semantic"]["presence_threshold"])


def semantic_penalties(records: DataFrame, scores: DataFrame, specs: DataFrame, cfg: dict) -> DataFrame:
    """(record_id, penalty) of all records; a crop is not blamed for what cropping does."""
    of = scores.join(F.broadcast(specs.where("block = 'penalty'").select(F.col("name").alias("spec"), "weight")), "spec")
    of = of.join(records.select("record_id", F.col("crop_box").isNotNull().alias("_crop")), "record_id")
    each = F.when(F.col("_crop") & (F.col("spec") == CROP_EXEMPT), 0.0).otherwise(_evidence(cfg) * F.col("weight"))
    sums = of.groupBy("record_id").agg(F.sum(each).alias("_s"))
    cap = cfg["selection"]["semantic_penalty_cap"]
    return records.select("record_id").join(sums, "record_id", "left").select("record_id", F.least(F.lit(float(cap)), F.greatest(F.lit(0.0), F.coalesce("_s", F.lit(0.0)))).alias("penalty"))


def coverage_targets(pool: DataFrame, scores: DataFrame, specs: DataFrame, cfg: dict) -> DataFrame:
    """(spec, ord, grp, weight, prevalence, target) of every category over the pool."""
    present = cfg["semantic"]["presence_threshold"]
    total = pool.agg(F.count("*").alias("n"))
    found = scores.join(pool.select("record_id"), "record_id", "left_semi").groupBy("spec").agg(F.count_if(F.col("raw") >= present).alias("_present"))
    c = specs.where("block = 'category'").withColumnRenamed("name", "spec").join(found, "spec", "left").crossJoin(total)
    have = F.coalesce("_present", F.lit(0))
    prevalence = F.when(F.col("n") > 0, have / F.col("n")).otherwise(0.0)
    goal = F.least(F.greatest("target_fraction", F.col("source_scale") * prevalence), "max_target_fraction") * F.col("n")
    return c.select("spec", "ord", "grp", "weight", prevalence.alias("prevalence"), F.least(goal, have * cfg["semantic"]["availability_capture"]).alias("target"))


def selection_weights(cfg: dict) -> dict:
    s, focus = cfg["selection"], cfg["audit"]["focus"]
    return {
        "quality": s["quality_weight"], "coverage": s["coverage_weight"], "novelty": s["novelty_weight"], "top_groups": s["coverage_top_groups"],
        "novelty_start": s["novelty_similarity_start"], "redundancy_start": s["redundancy_similarity_start"], "redundancy": s["redundancy_penalty"], "repeat": cfg["burst"]["repeat_penalty"],
        "soft_focus": s["soft_focus_penalty"], "soft_start": focus["soft_risk_start"], "fail_risk": focus["fail_risk"],
    }


def with_evidence(pool: DataFrame, scores: DataFrame, specs: DataFrame, cfg: dict) -> DataFrame:
    """pool with evidence, an array of one number per category in their order."""
    categories = specs.where("block = 'category'")
    order = F.broadcast(categories.select(F.col("name").alias("spec"), "ord"))
    by = scores.join(order, "spec").groupBy("record_id").agg(F.map_from_entries(F.collect_list(F.struct("ord", _evidence(cfg).alias("e")))).alias("_m"))
    full = F.array(*[F.coalesce(F.col("_m")[r["ord"]], F.lit(0.0)) for r in categories.select("ord").orderBy("ord").collect()])
    return pool.join(by, "record_id", "left").withColumn("evidence", full).drop("_m")


def select(pool: DataFrame, scores: DataFrame, specs: DataFrame, picks: int, cfg: dict) -> tuple[DataFrame, DataFrame]:
    """((record_id, pick), targets). pool: record_id, quality, penalty, vector, burst_id, focus_risk, perhaps similar and uses."""
    targets = coverage_targets(pool, scores, specs, cfg)
    rows = targets.orderBy("ord").collect()  # one per category
    pool = with_evidence(pool, scores, specs, cfg).withColumnRenamed("burst_id", "burst")
    return select_greedy(pool, [r["grp"] for r in rows], [r["weight"] for r in rows], [r["target"] for r in rows], picks, selection_weights(cfg)), targets


def coverage_of(pool: DataFrame, scores: DataFrame, specs: DataFrame, cfg: dict) -> DataFrame:
    """(record_id, coverage): what coverage adds to each row's score before any pick."""
    rows = coverage_targets(pool, scores, specs, cfg).orderBy("ord").collect()
    rule = rule_of([r["grp"] for r in rows], [r["weight"] for r in rows], [r["target"] for r in rows], selection_weights(cfg))
    return coverage_scores(with_evidence(pool, scores, specs, cfg), rule)


def stage_counts(gated: DataFrame) -> DataFrame:
    """One row: gated records, those lost to each reason, and those that are eligible."""
    r = F.col("reject_reason")
    return gated.agg(F.count("*").alias("records"), F.count_if(r == "focus").alias("focus"), F.count_if(r == "semantic_hard").alias("semantic_hard"), F.count_if(r == "").alias("eligible"))


def worst_risk(gated: DataFrame, train: DataFrame, validate: DataFrame) -> DataFrame:
    """(split, picks, worst): the largest focus risk of each split's picks."""
    chosen = train.select("record_id", F.lit("train").alias("split")).union(validate.select("record_id", F.lit("validate").alias("split")))
    return gated.join(chosen, "record_id").groupBy("split").agg(F.count("*").alias("picks"), F.max("focus_risk").alias("worst"))


def validation_pool(eligible: DataFrame, train: DataFrame, vectors: DataFrame, cfg: dict) -> DataFrame:
    """Eligible rows (record_id, source_id, phash, burst_id, ...) free of the train picks, with similar and uses."""
    v = cfg["validation"]
    facts = eligible.select("record_id", "source_id", "phash", "burst_id")
    chosen = train.select("record_id").join(facts, "record_id")
    free = eligible.join(chosen.select("source_id").distinct(), "source_id", "left_anti").join(chosen.select("record_id"), "record_id", "left_anti")
    mine, theirs = free.select("record_id").join(vectors, "record_id"), chosen.select("record_id").join(vectors, "record_id")
    least = min(v["near_duplicate_similarity"], v["same_burst_similarity"])
    near = near_chosen(mine, theirs, "record_id", "vector", least)
    near = near.join(free.select("record_id", F.col("phash").alias("x"), F.col("burst_id").alias("bx")), "record_id").join(chosen.select(F.col("record_id").alias("chosen"), F.col("phash").alias("y"), F.col("burst_id").alias("by")), "chosen")
    same = (F.col("similarity") >= v["near_duplicate_similarity"]) & (hamming(F.col("x"), F.col("y")) <= v["near_duplicate_phash_distance"])
    burst = (F.col("similarity") >= v["same_burst_similarity"]) & (F.col("bx") != "") & (F.col("bx") == F.col("by"))
    pool = free.join(near.where(same | burst).select("record_id").distinct(), "record_id", "left_anti")
    similar = nearest(mine, theirs, "record_id", "vector").select("record_id", F.col("similarity").alias("similar"))
    uses = chosen.where("burst_id <> ''").groupBy("burst_id").agg(F.count("*").alias("uses"))
    return pool.join(similar, "record_id", "left").join(uses, "burst_id", "left").fillna({"similar": -1.0, "uses": 0})


def coverage_report(picks: DataFrame, scores: DataFrame, targets: DataFrame, cfg: dict) -> DataFrame:
    """(spec, achieved, target) of the categories where either reaches a half."""
    got = scores.join(picks.select("record_id"), "record_id", "left_semi").groupBy("spec").agg(F.sum(_evidence(cfg)).alias("achieved"))
    rows = targets.join(got, "spec", "left").select("ord", "spec", F.coalesce("achieved", F.lit(0.0)).alias("achieved"), "target")
    return rows.where("target >= 0.5 OR achieved >= 0.5").orderBy("ord").drop("ord")


def file_name(records: DataFrame) -> DataFrame:
    name = F.regexp_extract("path", "([^/]*)$", 1)
    return records.withColumn("file", output_stem(name, F.when(F.col("crop_box").isNull(), "original").otherwise(F.col("kind")), F.col("view_index")))


def debug_table(every: DataFrame, compact: DataFrame, scores: DataFrame, specs: list[tuple[str, str]], penalties: DataFrame, vectors: DataFrame, train: DataFrame, validate: DataFrame) -> DataFrame:
    """One row per record, all columns as text, blank where unknown. every: records with the first reject_reason; compact: with
    focus_risk, brisque, quality, eligible; specs: (name, block) in order."""
    chosen = train.select("record_id", F.lit("train").alias("_in")).union(validate.select("record_id", F.lit("validate").alias("_in")))
    names = file_name(every).select("record_id", "file")
    mine = compact.select("record_id").join(vectors, "record_id")
    near = nearest(mine, mine.join(chosen, "record_id", "left_semi"), "record_id", "vector").where("similarity > -0.5")
    near = near.join(names.select(F.col("record_id").alias("nearest"), F.col("file").alias("nearest_selected_file")), "nearest").select("record_id", F.col("similarity").alias("nearest_selected_similarity"), "nearest_selected_file")
    wide = scores.groupBy("record_id").pivot("spec", [n for n, _ in specs]).agg(F.first("raw"))
    wide = wide.select("record_id", *[F.col(f"`{n}`").alias(f"{'cat' if b == 'category' else 'pen'}:{n}") for n, b in specs])
    own = compact.select("record_id", "eligible", "focus_risk", "brisque", "quality").join(penalties.select("record_id", F.col("penalty").alias("semantic_penalty")), "record_id").join(near, "record_id", "left").join(wide, "record_id", "left")
    status = F.coalesce("_in", F.when(F.col("eligible"), "eligible_not_selected").otherwise("rejected"))
    rows = file_name(every).join(own, "record_id", "left").join(chosen, "record_id", "left").withColumn("status", status)
    box = F.col("crop_box")
    shown = {
        "crop_box": F.concat_ws(",", box["x1"], box["y1"], box["x2"], box["y2"]), "phash": F.lower(F.lpad(F.hex("phash"), 16, "0")),
        "detected_width": F.nullif("detected_width", F.lit(0)), "detected_height": F.nullif("detected_height", F.lit(0)),
    }
    order = (
        "file path record_id source_id kind crop_box status reject_reason detector_confidence detected_width detected_height width height min_side aspect_ratio capture_source burst_id "
        "phash laplacian exposure blur_global blur_center blur_local prequality focus_risk brisque quality semantic_penalty nearest_selected_similarity nearest_selected_file"
    ).split() + [c for c in wide.columns if c != "record_id"]
    return rows.select(*[F.coalesce(shown.get(c, F.col(f"`{c}`")).cast("string"), F.lit("")).alias(c) for c in order])
