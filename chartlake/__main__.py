"""Command line: ``python -m chartlake models --src DIR`` (or ``--landing DIR
--details PATH``) runs every model in dependency order and prints each mart
in its display order;
``python -m chartlake query NAME --src DIR`` runs one registered query."""
from __future__ import annotations

import argparse

from .session import get_session


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="chartlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("models", help="run all models (land, stage, dims, enrich, fact, marts)")
    m.add_argument("--src", help="folder with the source parquet tables (scale binding)")
    m.add_argument("--landing", help="your landing folder (tracks/, artists/ NDJSON)")
    m.add_argument("--details", help="artist details table (parquet) for --landing")
    m.add_argument("--out", help="output folder for --landing (default: shared folder)")
    m.add_argument("--rows", type=int, default=10, help="rows to print per mart")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--src", required=True)
    q.add_argument("--rows", type=int, default=20)
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    if a.cmd == "models" and not (a.src or a.landing):
        p.error("give --src or --landing")
    if a.cmd == "models" and a.landing and not a.details:
        p.error("--landing needs --details")

    spark = get_session(master=a.master)
    if a.cmd == "models":
        from .operators import present
        from .plans import run_models, run_models_on, stage_landing
        if a.landing:
            from .session import shared_dir
            target = a.out or f"{shared_dir(spark)}/chartlake/models"
            stg_t, stg_a = stage_landing(spark, a.landing, target)
            out = run_models_on(spark, stg_t, stg_a, spark.read.parquet(a.details), target)
        else:
            out = run_models(spark, a.src)
        for name, df in out.items():
            if name.startswith("mart_"):
                print(f"== {name}")
                present(name, df).show(a.rows, truncate=False)
    else:
        from .plans.registry import QUERIES
        QUERIES[a.name](spark, a.src).show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
