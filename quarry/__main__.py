"""Command line: python -m quarry SOURCE OUTPUT --config FILE --vectors ... --probabilities ... --vocabulary ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import config
from .plans.run import Inputs, run, summary
from .sources import vocabulary


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarry", description="Curate a folder of images into a train and a validation split.")
    p.add_argument("source")
    p.add_argument("output")
    p.add_argument("--config", required=True)
    p.add_argument("--vectors", required=True, help="Parquet (record_id, vector) of unit length")
    p.add_argument("--probabilities", required=True, help="Parquet (record_id, tag_idx, prob)")
    p.add_argument("--vocabulary", required=True, help="CSV with name and category")
    p.add_argument("--brisque", help="Parquet (record_id, brisque)")
    p.add_argument("--detections", help="Parquet (path, det_idx, x, y, w, h, confidence)")
    a = p.parse_args(argv)
    spark = None
    try:
        cfg = config.load(a.config)
        spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()

        def rows_of(path: str):
            return lambda records, path=path: spark.read.parquet(path)

        tags = vocabulary.read(spark, a.vocabulary, cfg["models"]["tagger"]["selected_tags_sha256"])
        models = Inputs(rows_of(a.vectors), rows_of(a.probabilities), tags, a.brisque and rows_of(a.brisque), a.detections and rows_of(a.detections))
        tables = run(spark, a.source, a.output, cfg, models)
        for r in summary(tables).collect():
            print(f"{r['reject_reason'] or 'passed'}: {r['n']}", file=sys.stderr)
        for r in tables["worst_risk"].orderBy("split").collect():
            print(f"focus risk of {r['split']}: {r['worst']:.3f} at most")
        for name in ("train", "validate"):
            print(f"{name}: {tables[name].count()}")
            for r in tables[f"{name}_coverage"].collect():
                print(f"  {r['spec']:24s} {r['achieved']:6.1f} / {r['target']:5.1f}")
        return 0
    except RuntimeError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
