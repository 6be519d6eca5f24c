"""Command line: ``python -m seasonlab ranking|forecast ...`` (or via spark-submit).

Data comes from stored datasets (``--weekly``/``--players`` paths, any
format Spark reads) or from the driver's tables (``--testbed SF_DIR``).
Scoring mode and provider come from ``--scoring``/``--provider`` or the
environment (``FANTASY_SCORING``/``SCORING_PROVIDER``, optional .env file).
"""

from __future__ import annotations

import argparse

from seasonlab.config import load_config
from seasonlab.operators.scoring import scoring_from_mode
from seasonlab.plans import pipelines as pl
from seasonlab.session import build_session, materialize, use_local_scratch
from seasonlab.sources.base import DatasetSource, TestbedSource
from seasonlab.sources.readers import write_csv


def _source(spark, args):
    if args.testbed:
        return TestbedSource(spark, args.testbed)
    if not args.weekly:
        raise SystemExit("give --weekly PATH (and --players PATH for forecast) or --testbed SF_DIR")
    return DatasetSource(spark, args.weekly, args.players, fmt=args.format, schema=args.schema,
                         players_options={"schema": args.players_schema})


def _scoring(args):
    cfg = load_config(dotenv_path=args.env_file)
    return scoring_from_mode(args.scoring or cfg.fantasy_scoring, args.provider or cfg.scoring_provider)


def _preview(title: str, df, path: str | None, rows: int = 50) -> None:
    """The first rows, with the number of all rows and where they are."""
    total = df.count()
    where = f", all in {path}" if path else ""
    print(f"\n== {title}: first {min(rows, total)} of {total} rows{where}")
    df.show(rows, truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="seasonlab")
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--weekly", help="weekly stats dataset (ideally partitioned by season)")
    common.add_argument("--players", help="roster dataset (id, birth_date)")
    common.add_argument("--format", default="parquet")
    common.add_argument("--schema", help="DDL schema of the weekly dataset (CSV: else numbers are found by column name)")
    common.add_argument("--players-schema", help="DDL schema of the roster dataset")
    common.add_argument("--testbed", help="folder with the order tables instead of stored datasets")
    common.add_argument("--scoring", help="PPR, HALF_PPR or STANDARD")
    common.add_argument("--provider", help="ESPN or YAHOO")
    common.add_argument("--env-file", default=".env")
    common.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    sub = parser.add_subparsers(dest="command", required=True)
    rank = sub.add_parser("ranking", parents=[common], help="top-N per position of one season")
    rank.add_argument("--season", type=int, required=True)
    rank.add_argument("--top-n", type=int, default=24)
    rank.add_argument("--out", help="write the ranking as CSV (one file if it ends with .csv, else a folder)")
    fc = sub.add_parser("forecast", parents=[common], help="train, evaluate and forecast the next season")
    fc.add_argument("--start-season", type=int, required=True)
    fc.add_argument("--end-season", type=int, required=True)
    fc.add_argument("--train-end-season", type=int, required=True)
    fc.add_argument("--forecast-season", type=int, help="default: --end-season")
    fc.add_argument("--alpha", type=float, default=1.0)
    fc.add_argument("--out-preds", help="write the forecast as CSV (one file if it ends with .csv, else a folder)")
    args = parser.parse_args(argv)

    spark = build_session(args.master, app_name=f"seasonlab-{args.command}")
    use_local_scratch(spark)
    source = _source(spark, args)
    scoring = _scoring(args)
    if args.command == "ranking":
        ranking = materialize(pl.build_baseline_top_n(source, season=args.season, top_n=args.top_n, scoring=scoring))
        if args.out:
            write_csv(ranking, args.out)
        _preview("ranking", ranking, args.out)
        return
    features = pl.load_and_build_features(source, seasons=range(args.start_season, args.end_season + 1),
                                          scoring=scoring)
    res = pl.run_forecast(features, train_end_season=args.train_end_season,
                          forecast_season=args.forecast_season or args.end_season, alpha=args.alpha,
                          out_path=args.out_preds)
    model = res.overall_model
    print(f"train seasons {list(model.train_seasons)}  test seasons {list(model.test_seasons)}")
    print("age known for {with_age} of {total} feature rows, unknown for {null_age}".format(**res.age_coverage))
    print("{dropped} of {total} pairs of seasons dropped for a null input".format(**res.dropped_rows))
    for title, df in (("ridge vs naive (holdout)", res.ridge_vs_naive), ("winner per metric", res.winner),
                      ("per-position ridge", res.position_metrics), ("top-N per position", res.slice_top_per_position),
                      ("top-N overall", res.slice_top_overall), ("Spearman by position", res.spearman)):
        _preview(title, df, None)
    _preview("forecast", res.forecast, args.out_preds, 10)


if __name__ == "__main__":
    main()
