"""Outputs of a run: the chosen files in a folder each, and the debug table."""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import kernels
from . import images


#: Files that a task copies.
FILES_EACH = 64


def png(rgb: np.ndarray) -> bytes:
    """An RGB image as an 8-bit PNG."""
    h, w = rgb.shape[:2]
    lines = np.zeros((h, 1 + 3 * w), np.uint8)
    lines[:, 1:] = rgb.reshape(h, 3 * w)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def manifest(chosen: DataFrame) -> DataFrame:
    """chosen (record_id, pick, file, ...) with final_name: a later pick of the same name, case aside, gets a digest of its id."""
    n = F.row_number().over(Window.partitionBy(F.lower("file")).orderBy("pick"))
    tail = F.substring(F.sha1("record_id"), 1, 8)
    stem, end = F.regexp_replace("file", r"(?<=.)\.[^.]*$", ""), F.regexp_extract("file", r"(?<=.)(\.[^.]*)$", 1)
    return chosen.withColumn("final_name", F.when(n > 1, F.concat(stem, F.lit("__"), tail, end)).otherwise(F.col("file")))


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri if re.match("^[a-z0-9]+:/", uri) else "file://" + os.path.abspath(uri)))


def _put(uri: str, data: bytes) -> None:
    system, path = _filesystem(uri)
    with system.open_output_stream(path) as f:
        f.write(data)


def materialise(spark: SparkSession, root: str, chosen: DataFrame, folder: str, mode: str) -> int:
    """Write what manifest() names to a new folder, which then takes the place of folder; the number of files. mode: copy, hardlink or symlink.

    Originals are copied or linked as they are, crops are written as PNG. A task that runs twice writes the same files.
    What was in folder stays until all is written. One task for FILES_EACH originals.
    """
    from pyarrow import fs

    folder = folder.rstrip("/")
    system, path = _filesystem(folder)
    final, folder = path, f"{folder}.{uuid.uuid4().hex}"
    system, path = _filesystem(folder)
    system.create_dir(path)

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for source, name in zip(pdf["path"], pdf["final_name"]):
                here, start = _filesystem(source)
                there, end = _filesystem(f"{folder}/{name}")
                if mode == "copy":
                    with here.open_input_stream(start) as a, there.open_output_stream(end) as b:
                        while block := a.read(1 << 20):
                            b.write(block)
                    continue
                if os.path.lexists(end):
                    os.remove(end)
                (os.link if mode == "hardlink" else os.symlink)(start, end)
            yield pd.DataFrame({"n": [len(pdf)]})

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.to_dict("records"):
                b = r["crop_box"]
                rgb = kernels.to_rgb(r["data"], r["height"], r["width"], r["channels"])
                rgb = kernels.crop(rgb, (b["x1"], b["y1"], b["x2"], b["y2"]), r["orientation"])
                _put(f"{folder}/{r['final_name']}", png(rgb))
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = chosen.select("path", "crop_box", "final_name", F.col("orientation") if "orientation" in chosen.columns else F.lit(1).alias("orientation"))
    whole = rows.where("crop_box IS NULL")
    done = whole.repartition(1 + whole.count() // FILES_EACH).mapInPandas(link, "n long")
    crops = rows.where("crop_box IS NOT NULL")
    if not crops.isEmpty():
        seen = images.pixels(spark, root).withColumn("path", F.regexp_replace("path", images.TRIPLE, "$1:/"))
        done = done.union(seen.join(crops, "path").mapInPandas(cut, "n long"))
    n = done.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if system.get_file_info(final).type != fs.FileType.NotFound:
        system.delete_dir(final)
    system.move(path, final)
    return n


def write_table(rows: DataFrame, path: str) -> None:
    """A CSV folder in path order; many parts for many rows, each with a header."""
    rows.orderBy(F.split("path", "/"), F.col("kind") != "original", "record_id").write.mode("overwrite").option("header", True).csv(path)
