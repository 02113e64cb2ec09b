"""Scalar column functions of the curation engine; all run in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def resolution_score(min_side: Column, least: float) -> Column:
    """clip(log2(max(1, side / least)) / 2)."""
    return clip01(F.log2(F.greatest(F.lit(1.0), min_side / F.lit(float(least)))) / 2)


def evidence(raw: Column, floor: float, presence: float) -> Column:
    return clip01((raw - floor) / (presence - floor))


def median3(a: Column, b: Column, c: Column) -> Column:
    return F.array_sort(F.array(a, b, c))[1]


def norm_tag(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"\s+", "_")


def median_hash(v: Column) -> Column:
    """64-bit hash of 64 coefficients: the first gives no bit, the others one each if above their median."""
    rest = F.slice(v, 2, 63)
    median = F.array_sort(rest)[31]
    return F.aggregate(rest, F.lit(0).cast("long"), lambda h, x: h * 2 + F.when(x > median, 1).otherwise(0))


def crop_box_of(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, scale: float, least: int) -> Column:
    """Square box around a detection, moved down by 0.15 h and into the image; null if it doesn't fit."""
    side = F.greatest(F.lit(float(least)), F.rint(F.greatest(w, h) * scale))
    left = F.rint(x + w / 2 - side / 2)
    top = F.rint(y + h / 2 + h * 0.15 - side / 2)
    x1 = F.least(F.greatest(F.lit(0.0), left), width - side)
    y1 = F.least(F.greatest(F.lit(0.0), top), height - side)
    box = F.struct(*[c.cast("int").alias(n) for c, n in ((x1, "x1"), (y1, "y1"), (x1 + side, "x2"), (y1 + side, "y2"))])
    return F.when(side <= F.least(width, height), box)


def crop_box(x: Column, y: Column, w: Column, h: Column, width: int, height: int, scale: float, least: int) -> Column:
    return crop_box_of(x, y, w, h, F.lit(width), F.lit(height), scale, least)


def output_stem(name: Column, kind: Column, index: Column) -> Column:
    """File name of a materialised item: originals keep theirs, crops get their kind and number."""
    clean = F.regexp_replace(kind, "[^a-zA-Z0-9_-]+", "_")
    clean = F.regexp_replace(clean, "^_+|_+$", "")
    clean = F.when(clean == "", "crop").otherwise(clean)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.when(kind == "original", name).otherwise(F.concat(stem, F.lit("__"), clean, index.cast("string"), F.lit(".png")))
