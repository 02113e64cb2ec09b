"""Hooks for models: inputs prepared from pixels, batched prediction, and what follows it. No model is shipped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels


def usable(name: str) -> bool:
    """Whether this worker's tensor library, if it has one, can use the device."""
    try:
        import torch
    except ImportError:
        return False
    return bool(torch.cuda.is_available() if name == "cuda" else getattr(torch.backends, "mps", None) and torch.backends.mps.is_available())


def device(wanted: str, probe: Callable[[str], bool] = usable) -> str:
    """The device of runtime.device; `auto` is the first of cuda and mps that can be used here, or cpu. For make_predict to call, in the worker."""
    return wanted if wanted != "auto" else next((d for d in ("cuda", "mps") if probe(d)), "cpu")


def model_inputs(rows: DataFrame, side: int, neutral: bool, bgr: bool = False) -> DataFrame:
    """(record_id, pixels) of rows (record_id, height, width, channels, data, and perhaps orientation, box): squared, resized to
    side x side, channels last, 0 to 1. Squares are filled with the mean colour (neutral) or white. Unreadable rows are left out."""

    def one(r) -> np.ndarray:
        rgb = kernels.orient(kernels.to_rgb(r["data"], r["height"], r["width"], r["channels"]), r.get("orientation"))
        if r.get("box") is not None:
            b = r["box"]
            rgb = rgb[b["y1"] : b["y2"], b["x1"] : b["x2"]]
        a = kernels.resize(kernels.square(rgb, neutral), side, side)
        return ((a[:, :, ::-1] if bgr else a) / np.float32(255)).astype(np.float32).ravel()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            good = pdf[pdf["height"] > 0]
            if len(good):
                yield pd.DataFrame({"record_id": good["record_id"], "pixels": [one(r) for r in good.to_dict("records")]})

    return rows.mapInPandas(run, f"record_id {dict(rows.dtypes)['record_id']}, pixels array<float>")


def embeddings(inputs: DataFrame, make_predict: Callable, side: int, batch: int) -> DataFrame:
    """(record_id, vector) of unit length. make_predict() loads the model in a worker and returns a function of (n, side, side, 3)."""
    run = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch, input_tensor_shapes=[[side, side, 3]])
    v = F.transform(run("pixels"), lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return inputs.select("record_id", v.alias("v")).select("record_id", F.transform("v", lambda x: x / F.greatest(length, F.lit(1e-12))).alias("vector"))


def tag_probabilities(inputs: DataFrame, make_predict: Callable, side: int, batch: int, tags: int) -> DataFrame:
    """(record_id, tag_idx, prob) of logits; a width other than that of the vocabulary ends the run."""
    run = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch, input_tensor_shapes=[[side, side, 3]])
    logits = inputs.select("record_id", run("pixels").alias("l"))
    right = F.when(F.size("l") == tags, F.col("l")).otherwise(F.raise_error(F.concat(F.lit("output width "), F.size("l").cast("string"), F.lit(f" is not the vocabulary's {tags}"))).cast("array<float>"))
    rows = logits.select("record_id", F.posexplode(right).alias("tag_idx", "logit"))
    return rows.select("record_id", "tag_idx", (1 / (1 + F.exp(-F.col("logit").cast("double")))).alias("prob"))
