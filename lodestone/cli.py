"""``python -m lodestone.cli {extract,transform,validate,curate,info}``: exit code 0, 1 or 130."""

from __future__ import annotations

import argparse
import json
import sys

from .plans import pipeline, rules
from .sources import files
from .sources.tables import SourceError


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lodestone")
    parser.add_argument("stage", choices=("extract", "transform", "validate", "curate", "info"))
    parser.add_argument("--snapshot")
    parser.add_argument("--json", action="store_true")
    parser.add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    try:
        settings = pipeline.Settings.from_env()
        if args.stage == "extract":
            out = pipeline.extract(settings, args.force)
        elif args.stage == "info":
            out = {s: files.read_json(p) for s in ("extract", "staging", "validate", "curate") if (p := settings.manifest(s, args.snapshot or "latest")).exists()}
        else:
            from pyspark import SparkConf
            from pyspark.sql import SparkSession

            builder = SparkSession.builder.appName("lodestone").config("spark.sql.session.timeZone", "UTC")
            if not SparkConf().contains("spark.checkpoint.dir"):  # beside the tables, where every executor reads
                builder = builder.config("spark.checkpoint.dir", f"{settings.store}/scratch")
            spark = builder.getOrCreate()
            out = {"transform": pipeline.transform, "validate": pipeline.validate, "curate": pipeline.run_curate}[args.stage](spark, settings, args.snapshot)
    except KeyboardInterrupt:
        return 130
    except (SourceError, files.Locked, rules.ValidationError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    print(json.dumps(out, ensure_ascii=False, default=str) if args.json else "\n".join(f"{k}: {v}" for k, v in out.items()))
    return int(args.stage == "validate" and not out["passou"])


if __name__ == "__main__":
    sys.exit(main())
