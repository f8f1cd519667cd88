"""Command line: build the warehouse, or run the incremental file ingest.

    python -m tanimart build --root <warehouse> --tables <source tables> \\
        --version 37 [--input <csv folder>] [--force]
    python -m tanimart ingest-stream --input <csv folder> --output <table> \\
        --checkpoint <folder>
    python -m tanimart expire --root <warehouse> [--keep 2]

Runs on whatever session ``spark-submit`` / the cluster configures (master,
memory, ``spark.checkpoint.dir``); nothing here forces a local master.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _plain(v):
    """Build results (dataclasses, lists of them, counts) as JSON-ready values."""
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return vars(v) if hasattr(v, "__dict__") else v


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tanimart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="mirror -> validate -> fingerprint -> similarity -> dimension")
    b.add_argument("--root", required=True, help="warehouse root folder (shared storage)")
    b.add_argument("--tables", required=True, help="folder with the source tables (<name>.parquet)")
    b.add_argument("--version", required=True, help="source data version; a build is skipped when done")
    b.add_argument("--input", help="folder of raw CSV batches to ingest and match")
    b.add_argument("--force", action="store_true", help="rebuild even when the version is built")
    s = sub.add_parser("ingest-stream", help="available-now incremental CSV ingest")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", required=True)
    e = sub.add_parser("expire", help="remove replaced versions of the warehouse's tables")
    e.add_argument("--root", required=True, help="warehouse root folder (shared storage)")
    e.add_argument("--keep", type=int, default=2, help="versions to keep of each table, the published one included")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tanimart-{args.cmd}").getOrCreate()
    if args.cmd == "build":
        from tanimart.plans import build
        wh = build.Warehouse(spark, args.root)
        out = build.run_all(wh, args.tables, args.version, input_root=args.input, force=args.force)
        print(json.dumps({k: _plain(v) for k, v in out.items()}, default=str))
    elif args.cmd == "expire":
        from tanimart.plans import build
        print(json.dumps(build.expire(build.Warehouse(spark, args.root), args.keep)))
    else:
        from tanimart.streaming import file_ingest
        file_ingest.run_once(spark, args.input, args.output, args.checkpoint)


if __name__ == "__main__":
    main()
