"""Command line for the jobs (``spark-submit`` or ``python -m``).

    python -m pricelens.plans.cli prepare  --raw 'raw/*/*/*.json' --recipe recipe.csv --out processed
    python -m pricelens.plans.cli trend    --out processed --results results
    python -m pricelens.plans.cli profit   --out processed --results results
    python -m pricelens.plans.cli correlation --out processed --results results
    python -m pricelens.plans.cli anomaly  --out processed --results results
    python -m pricelens.plans.cli refresh  --recipe recipe.csv --out processed --dates 2026-05-20
    python -m pricelens.plans.cli all      --raw … --recipe … --out processed --results results

Each step reads what the previous one wrote, so steps can run as separate
applications.  Results are Parquet tables under ``--results`` (one folder per
result), plus the text reports.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from pricelens.plans import jobs
from pricelens.session import build_session


def _save(df, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def run(spark: SparkSession, step: str, raw: str | None, recipe: str | None, out: str,
        results: str | None, collapse: str | None = None,
        require_complete: bool = False, dates: list[str] | None = None) -> dict:
    done: dict = {}
    log, profit = f"{out}/auction_log", f"{out}/craft_profit"
    if step in ("prepare", "all"):
        if not raw or not recipe:
            raise SystemExit("prepare needs --raw and --recipe")
        done["prepare"] = jobs.prepare(spark, raw, recipe, out, collapse, require_complete)
    if step == "refresh":
        if not recipe or not dates:
            raise SystemExit("refresh needs --recipe and --dates")
        jobs.prepare_dates(spark, log, recipe, profit, dates, collapse, require_complete)
        done["refresh"] = dates
        return done
    res = results or f"{out}/results"
    if step in ("trend", "all"):
        _save(jobs.daily_trend(spark, log), f"{res}/q1_daily_trend")
        done["trend"] = f"{res}/q1_daily_trend"
    if step in ("profit", "all"):
        _save(jobs.craft_profit_by_weekday(spark, profit), f"{res}/q2_craft_profit")
        done["profit"] = f"{res}/q2_craft_profit"
    if step in ("correlation", "all"):
        parts = jobs.correlation(spark, log)
        for name, df in parts.items():
            _save(df, f"{res}/q3_{name}")
        done["correlation"] = jobs.correlation_report(spark, parts, f"{res}/q3_report")
    if step in ("anomaly", "all"):
        parts = jobs.anomaly(spark, log, out=f"{out}/anomaly")
        for name in ("counts", "top", "by_weekday"):
            _save(parts[name], f"{res}/q4_{name}")
        done["anomaly"] = jobs.anomaly_report(spark, parts, f"{res}/q4_report")
    return done


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pricelens")
    ap.add_argument("step", choices=["prepare", "refresh", "trend", "profit", "correlation",
                                     "anomaly", "all"])
    ap.add_argument("--dates", nargs="*", help="refresh: collection dates (YYYY-MM-DD)")
    ap.add_argument("--raw")
    ap.add_argument("--recipe")
    ap.add_argument("--out", required=True)
    ap.add_argument("--results")
    ap.add_argument("--collapse", choices=["min"])
    ap.add_argument("--require-complete", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session(app=f"pricelens-{a.step}")
    try:
        print(run(spark, a.step, a.raw, a.recipe, a.out, a.results, a.collapse,
                  a.require_complete, a.dates))
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
