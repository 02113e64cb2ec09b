"""Image folders: the scan, decoding, the technical audit and virtual crops."""

from __future__ import annotations

import io
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from . import capture

#: File name endings of images.
SUFFIXES = ("jpg", "jpeg", "png", "webp", "bmp", "tif", "tiff", "avif")
#: Those that the JVM has no reader for; a decoder in Python reads them, see `pixels`.
OTHER_SUFFIXES = ("webp", "avif")
#: Readers name local files with one slash or three.
TRIPLE = "^([a-z0-9]+):///"

VIEW = "hash_view binary, thumb binary"
SIGNALS = "laplacian double, exposure double, blur_global double, blur_center double, blur_local double"
TAGS = "orientation int, original string, original_fraction string, digitized string, digitized_fraction string, modified string"


def _wanted(df: DataFrame, path: str, output: str | None, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    df = df.where(F.lower(F.regexp_extract(path, r"[^/]\.([^./]*)$", 1)).isin(*suffixes))
    if output:
        end = re.sub("^file:/+", "/", output).rstrip("/")
        bare = F.regexp_replace(path, "^file:/+", "/")
        df = df.where((bare != end) & ~bare.startswith(end + "/"))
    return df


def image_files(spark: SparkSession, root: str, output: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content) of the images below root, without those below output; only asked columns are read."""
    return _wanted(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root), "path", output)


def file_digests(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("digest"))


def headers(files: DataFrame) -> DataFrame:
    """(path, modificationTime, tags) out of each entire file: a TIFF's folder and a PNG's chunk may follow the pixels."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            tags = [capture.metadata(bytes(c)) for c in pdf["content"]]
            out = pdf[["path", "modificationTime"]].copy()
            turn = [t.get(capture.ORIENTATION) for t in tags]
            out["orientation"] = pd.array([t if isinstance(t, int) and 1 <= t <= 8 else 1 for t in turn], dtype="Int32")
            for name, tag in (("original", capture.ORIGINAL), ("original_fraction", capture.ORIGINAL_FRACTION), ("digitized", capture.DIGITIZED), ("digitized_fraction", capture.DIGITIZED_FRACTION), ("modified", capture.MODIFIED)):
                out[name] = [None if t.get(tag) is None else str(t[tag]) for t in tags]
            yield out

    return files.select("path", "modificationTime", "content").mapInPandas(run, f"path string, modificationTime timestamp, {TAGS}")


def library_decoder() -> Callable[[bytes], np.ndarray] | None:
    """A decoder to RGB by an imaging library, if the workers have one."""
    try:
        from PIL import Image
    except ImportError:
        return None

    def decode(content: bytes) -> np.ndarray:
        with Image.open(io.BytesIO(content)) as im:
            over = im.convert("RGBA")
            white = Image.new("RGBA", over.size, (255, 255, 255, 255))
            white.alpha_composite(over)
            return np.asarray(white.convert("RGB"))

    return decode


def pixels(spark: SparkSession, root: str, output: str | None = None, decoder: Callable[[], Callable[[bytes], np.ndarray] | None] = library_decoder) -> DataFrame:
    """(path, height, width, channels, data) of the same files; an unreadable one has height -1.

    The JVM decodes; files of OTHER_SUFFIXES go to the function that `decoder` makes in the task (bytes to RGB as stored),
    and are unreadable where it makes none.
    """
    read = spark.read.format("image").option("recursiveFileLookup", True).load(root)
    i = F.col("image")
    rows = read.select(i["origin"].alias("path"), i["height"].alias("height"), i["width"].alias("width"), i["nChannels"].alias("channels"), i["data"].alias("data"))
    mine = tuple(x for x in SUFFIXES if x not in OTHER_SUFFIXES)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = decoder()
        for pdf in frames:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rgb = decode(bytes(content)) if decode else None
                except Exception:  # one broken file is a reject, as any unreadable one
                    rgb = None
                out.append((path, -1, -1, -1, b"") if rgb is None else (path, *rgb.shape[:2], 3, np.ascontiguousarray(rgb[:, :, ::-1]).tobytes()))
            yield pd.DataFrame(out, columns=["path", "height", "width", "channels", "data"])

    other = _wanted(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root), "path", output, OTHER_SUFFIXES)
    other = other.select("path", "content").mapInPandas(run, "path string, height int, width int, channels int, data binary")
    return _wanted(rows, "path", output, mine).unionByName(other)


def audited(rows: DataFrame, least: int, aspect: float) -> DataFrame:
    """rows (any columns, height, width, channels, data, and perhaps box and turn) with sizes, reject_reason, signals and small views.

    A row that the gates reject, or whose kernel fails, gets a reason and null signals; no row fails the job. A box is one of
    the upright image, and turn the stored image's orientation: the part is cut out and turned before it is measured.
    Without a box signals are taken of the image as stored: turning it by quarters or mirroring it leaves them, but for rounding.
    """
    keep = [c for c in rows.columns if c not in ("height", "width", "channels", "data", "box", "turn")]
    kinds = dict(rows.dtypes)
    out = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["width int, height int, reject_reason string", SIGNALS, VIEW])
    with_box = "box" in rows.columns

    def one(r) -> tuple:
        none = (None,) * 7
        try:
            if r["height"] < 1:
                return (0, 0, "decode:Unreadable", *none)
            rgb = kernels.to_rgb(r["data"], r["height"], r["width"], r["channels"])
            if with_box and r["box"] is not None:
                rgb = kernels.crop(rgb, tuple(r["box"][c] for c in ("x1", "y1", "x2", "y2")), r.get("turn"))
            h, w = rgb.shape[:2]
            if min(h, w) < least:
                return (w, h, "small", *none)
            if max(h, w) / max(1, min(h, w)) > aspect:
                return (w, h, "aspect", *none)
            blur = [None if np.isnan(x) else x for x in kernels.blur_signals(rgb)]
            return (w, h, "", *kernels.simple_signals(rgb), *blur, kernels.hash_view(kernels.grey(rgb)).tobytes(), kernels.thumb(rgb).tobytes())
        except Exception as e:  # one broken file is a reject, as any unreadable one
            return (0, 0, f"decode:{type(e).__name__}", *none)

    names = ["width", "height", "reject_reason", "laplacian", "exposure", "blur_global", "blur_center", "blur_local", "hash_view", "thumb"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            got = pd.DataFrame([one(r) for r in pdf.to_dict("records")], columns=names, index=pdf.index)
            yield pd.concat([pdf[keep], got], axis=1)

    return rows.mapInPandas(run, out)


def upright(rows: DataFrame) -> DataFrame:
    """Views, sizes and hash of audited rows turned by `orientation`; hash_view gives way to phash."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            codes, thumbs = [], []
            for view, small, turn in zip(pdf["hash_view"], pdf["thumb"], pdf["orientation"]):
                if view is None:
                    codes.append(None)
                    thumbs.append(None)
                    continue
                side = kernels.HASH_SIDE
                codes.append(kernels.perceptual_hash(kernels.orient(np.frombuffer(view, np.uint8).reshape(side, side), turn)))
                side = kernels.THUMB_SIDE
                thumbs.append(np.ascontiguousarray(kernels.orient(np.frombuffer(small, np.uint8).reshape(side, side, 3), turn)).tobytes())
            out = pdf.drop(columns=["hash_view", "thumb"])
            out["phash"], out["thumb"] = pd.array(codes, dtype="Int64"), thumbs
            yield out

    rest = [f"`{c}` {t}" for c, t in rows.dtypes if c not in ("hash_view", "thumb")]
    turned = rows.withColumns({"width": F.when(F.col("orientation") >= 5, F.col("height")).otherwise(F.col("width")), "height": F.when(F.col("orientation") >= 5, F.col("width")).otherwise(F.col("height"))})
    return turned.mapInPandas(run, ", ".join([*rest, "phash long, thumb binary"]))


def records(spark: SparkSession, root: str, output: str | None, cfg: dict) -> DataFrame:
    """One audited record per image file.

    Pixels stay where they are decoded: what is joined with the metadata is some 50 KB of views and numbers per file.
    """
    burst, audit = cfg["burst"], cfg["audit"]
    head = headers(image_files(spark, root, output))
    tags = F.struct("original", "original_fraction", "digitized", "digitized_fraction", "modified")
    time = capture.capture_time(tags, capture.file_stem(F.col("path")), F.col("modificationTime"), burst["use_exif"], burst["use_filename"], burst["use_mtime"])
    if not burst["enabled"]:
        time = F.struct(F.lit(None).cast("long").alias("capture_us"), F.lit("").alias("capture_source"))
    head = head.select("path", "orientation", time.alias("t")).select("path", "orientation", "t.capture_us", "t.capture_source")
    same = F.regexp_replace("path", TRIPLE, "$1:/")
    seen = audited(pixels(spark, root, output), audit["min_side"], audit["max_aspect"]).withColumn("path", same)
    rows = upright(seen.join(head.withColumn("path", same), "path"))
    return rows.select(
        "path", F.col("path").alias("record_id"), F.col("path").alias("source_id"), F.lit("original").alias("kind"), F.lit(None).cast("struct<x1:int,y1:int,x2:int,y2:int>").alias("crop_box"),
        F.lit(0).alias("view_index"), F.lit(None).cast("double").alias("detector_confidence"), F.lit(0).alias("detected_width"), F.lit(0).alias("detected_height"),
        "width", "height", F.least("width", "height").alias("min_side"), (F.greatest("width", "height") / F.greatest(F.lit(1), F.least("width", "height"))).alias("aspect_ratio"),
        "capture_us", "capture_source", "reject_reason", "phash", "laplacian", "exposure", "blur_global", "blur_center", "blur_local", "thumb", "orientation",
    )


def crop_records(spark: SparkSession, root: str, parents: DataFrame, crops: DataFrame, cfg: dict) -> DataFrame:
    """Audited child records of crops (path, kind, view_index, crop_box, confidence, w, h); those that the audit rejects are left out.

    Boxes are in the upright image's coordinates, and views and signals are taken of the upright part. The crops are joined
    to the pixels by path, and a broadcast of them is left to the planner, which knows their size.
    """
    audit = cfg["audit"]
    same = F.regexp_replace("path", TRIPLE, "$1:/")
    wanted = crops.select("path", "kind", "view_index", F.col("crop_box").alias("box"), "confidence", "w", "h")
    wanted = wanted.join(parents.select("path", F.col("orientation").alias("turn")), "path")
    joined = pixels(spark, root).withColumn("path", same).join(wanted, "path").withColumn("crop_box", F.col("box"))
    good = audited(joined, audit["min_side"], audit["max_aspect"]).where("reject_reason = ''")
    of = parents.select("path", "source_id", "capture_us", "capture_source", F.col("orientation").alias("turn"))
    # the parts are upright; `orientation` is then again that of their file
    rows = upright(good.withColumn("orientation", F.lit(1)).join(of, "path"))
    return crop_columns(rows.withColumn("orientation", F.col("turn")))


def crop_columns(rows: DataFrame) -> DataFrame:
    """Records of audited crops: what they have of their own, and their parents' source and capture time."""
    b = F.col("crop_box")
    ident = F.concat(F.col("source_id"), F.lit("::"), F.col("kind"), F.lit(":"), F.col("view_index").cast("string"), F.lit(":"), F.concat_ws(",", b["x1"], b["y1"], b["x2"], b["y2"]))
    return rows.select(
        "path", ident.alias("record_id"), "source_id", "kind", "crop_box", "view_index", F.col("confidence").alias("detector_confidence"),
        F.col("w").cast("int").alias("detected_width"), F.col("h").cast("int").alias("detected_height"), "width", "height", F.least("width", "height").alias("min_side"),
        (F.greatest("width", "height") / F.greatest(F.lit(1), F.least("width", "height"))).alias("aspect_ratio"), "capture_us", "capture_source", "reject_reason",
        "phash", "laplacian", "exposure", "blur_global", "blur_center", "blur_local", "thumb", "orientation",
    )


def largest_detections(found: DataFrame, least_confidence: float, least_side: float) -> DataFrame:
    """Of detections (path, det_idx, x, y, w, h, confidence) the largest per image, the first of equal ones; images whose largest is too small get none."""
    good = found.where(F.col("confidence") >= least_confidence)
    best = good.groupBy("path").agg(F.max_by(F.struct("x", "y", "w", "h", "confidence"), F.struct(F.col("w") * F.col("h"), -F.col("det_idx"))).alias("d"))
    return best.select("path", "d.*").where(F.greatest("w", "h") >= least_side)
