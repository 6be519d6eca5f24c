"""Composed pipelines: ranking (L1), feature table (L2), train/evaluate/forecast (L3)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from seasonlab.functions.columns import drop_nulls
from seasonlab.operators.aggregate import season_totals
from seasonlab.operators.dataset import build_next_season_dataset
from seasonlab.operators.evaluation import spearman_rank_by_position, top_n_overall_metrics, top_n_per_position_metrics
from seasonlab.operators.features import attach_roster_age, build_season_features
from seasonlab.operators.metrics import metrics_with_overall
from seasonlab.operators.ranking import PLAYER_POSITIONS, filter_positions, top_n_by_position
from seasonlab.operators.ridge import (
    RidgeModel,
    fit_overall_and_by_group,
    model_winner,
    predict_for_season,
    side_by_side_metrics,
)
from seasonlab.operators.scoring import Scoring, add_weekly_points, scoring_from_mode
from seasonlab.session import materialize
from seasonlab.sources.readers import write_csv

# The model inputs of the forecast.
FEATURES_6 = ("feat_ppg", "feat_carries_pg", "feat_targets_pg", "feat_pass_att_pg", "feat_age", "feat_age_sq")
TARGET = "target_next_season_points"


def scored_season_totals(weekly: DataFrame, scoring: Scoring | None = None, *,
                         out_points_col: str = "season_fantasy_points") -> DataFrame:
    """Positions QB/RB/WR/TE/K -> weekly points -> season totals (one stage + one shuffle)."""
    scored = add_weekly_points(filter_positions(weekly, PLAYER_POSITIONS), scoring or scoring_from_mode(),
                               out_col="fantasy_points_calc")
    return season_totals(scored, points_col="fantasy_points_calc", out_points_col=out_points_col)


def baseline_top_n(weekly: DataFrame, *, top_n: int = 24, scoring: Scoring | None = None) -> DataFrame:
    """L1: season totals of the given weekly rows, top-N per position by dense rank."""
    totals = scored_season_totals(weekly, scoring, out_points_col="fantasy_points")
    return top_n_by_position(totals, n=top_n, points_col="fantasy_points", position_col="position")


def build_baseline_top_n(source, *, season: int, top_n: int = 24, scoring: Scoring | None = None,
                         out_path: str | None = None) -> DataFrame:
    """L1 from a source object: one season of weekly rows -> top-N per position.

    ``out_path`` also writes the ranking as CSV with a header, in ranking order
    (ties can make it longer than positions x N rows): one file if it ends
    with ``.csv``, else a folder of part files.
    """
    ranking = baseline_top_n(source.load_weekly_player_stats(season), top_n=top_n, scoring=scoring)
    if out_path:
        write_csv(ranking, out_path)
    return ranking


def load_and_build_features(source, *, seasons, scoring: Scoring | None = None) -> DataFrame:
    """L2 from a source object: the seasons (None: all) in one scan, roster age, features."""
    from seasonlab.sources.base import load_seasons

    return feature_table(load_seasons(source, seasons), source.load_players(), scoring=scoring)


def feature_table(weekly: DataFrame, players: DataFrame, *, scoring: Scoring | None = None) -> DataFrame:
    """L2: season totals of all seasons, age from the roster, eleven features."""
    totals = scored_season_totals(weekly, scoring)
    return build_season_features(attach_roster_age(totals, players), points_col="season_fantasy_points")


def age_coverage_columns() -> list[Column]:
    no_age = F.col("age").isNull()
    return [F.count(F.lit(1)).alias("total"), F.count_if(no_age).alias("null_age"), F.count_if(~no_age).alias("with_age")]


def age_coverage(features: DataFrame) -> DataFrame:
    """Rows with and without an age (the runner's coverage line) in one aggregate."""
    return features.agg(*age_coverage_columns())


def materialize_counted(df: DataFrame, counts: Sequence[Column], how: str, kept=lambda df: df) -> tuple[DataFrame, dict]:
    """``kept(df)`` materialized, and counts over the rows of ``df``.

    A checkpoint counts the rows as it writes them (observed metrics); the
    other ways write nothing yet, so their counts are an aggregate of its own.
    """
    if how != "checkpoint":
        return materialize(kept(df), how), df.agg(*counts).first().asDict()
    seen = Observation()
    out = materialize(kept(df.observe(seen, *counts)), how)
    return out, seen.get


def supervised_sets(features: DataFrame, feature_cols: Sequence[str] = FEATURES_6) -> tuple[DataFrame, DataFrame]:
    """(all next-season pairs, pairs with no null model input)."""
    supervised = build_next_season_dataset(features, target_col="feat_points", out_target_col=TARGET)
    return supervised, drop_nulls(supervised, feature_cols)


def dropped_rows_columns(feature_cols: Sequence[str] = FEATURES_6) -> list[Column]:
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in feature_cols])
    return [F.count(F.lit(1)).alias("total"), F.count_if(any_null).alias("dropped")]


def dropped_rows_report(supervised: DataFrame, feature_cols: Sequence[str] = FEATURES_6) -> DataFrame:
    return supervised.agg(*dropped_rows_columns(feature_cols))


@dataclass
class ForecastResult:
    overall_model: RidgeModel
    ridge_vs_naive_predictions: DataFrame
    ridge_vs_naive: DataFrame
    winner: DataFrame
    position_model: RidgeModel
    position_predictions: DataFrame
    position_metrics: DataFrame
    slice_top_per_position: DataFrame
    slice_top_overall: DataFrame
    spearman: DataFrame
    forecast: DataFrame
    age_coverage: dict  # total, null_age, with_age of the feature rows
    dropped_rows: dict  # total pairs of seasons, and those dropped for a null input


def forecast_output(model: RidgeModel, features_clean: DataFrame, season: int, *, check_empty: bool = True) -> DataFrame:
    out_col = f"predicted_{season + 1}_points"
    preds = predict_for_season(model, features_clean, season=season, out_col=out_col, check_empty=check_empty)
    # player_id / season break ties: equal predictions spread over range
    # partitions instead of landing in one, and the order is deterministic
    return (preds.select("season", "player_id", "player_display_name", "position", "feat_age", "feat_points", out_col)
            .orderBy(F.col(out_col).desc(), F.col("player_id").asc(), F.col("season").asc()))


def holdout_table(clean: DataFrame, model: RidgeModel, pos_model: RidgeModel, *, train_end_season: int) -> DataFrame:
    """Test rows with the overall model's, the naive and the position's own prediction (null without a model)."""
    naive = F.coalesce(F.col("feat_points").cast("double"), F.lit(0.0))
    test = clean.where(F.col("season") > F.lit(train_end_season))
    wide = model.predict(test, "y_pred_ridge").withColumn("y_pred_naive", naive)
    return pos_model.predict(wide, "y_pred", keep_all=True).select(
        "season", "position", "player_id", F.col(TARGET).cast("double").alias("y_true"), "y_pred_ridge", "y_pred_naive", "y_pred")


def run_forecast(features: DataFrame, *, train_end_season: int, forecast_season: int, alpha: float = 1.0,
                 feature_cols: Sequence[str] = FEATURES_6, top_n_position: int = 24, top_n_overall: int = 100,
                 materialization: str = "checkpoint", out_path: str | None = None) -> ForecastResult:
    """L3: supervised set -> overall ridge vs naive -> per-position ridge ->
    slices and Spearman -> next-season forecast with the overall model.

    Both models come from one pass (``fit_overall_and_by_group``). The rows
    without an age, and the pairs that a null input drops, are counted as the
    tables are written.
    The supervised set (one row per player and pair of seasons) and the one
    table of holdout predictions (both models and the naive forecast) feed
    every fit, metric and slice, so each is materialized once (default: a
    reliable checkpoint in the shared checkpoint folder, see
    ``session.materialize``); so is the feature table, of which the forecast
    reads one season. ``out_path`` writes the forecast as CSV with a header,
    in prediction order (one file if it ends with ``.csv``, else part files).
    """
    features, coverage = materialize_counted(features, age_coverage_columns(), materialization)
    supervised = build_next_season_dataset(features, target_col="feat_points", out_target_col=TARGET)
    clean, dropped = materialize_counted(supervised, dropped_rows_columns(feature_cols), materialization, lambda df: drop_nulls(df, feature_cols))
    # both models from one pass (one triangle per position and one for the rest)
    model, pos_model = fit_overall_and_by_group(clean, feature_cols=list(feature_cols), target_col=TARGET,
                                                train_end_season=train_end_season, alpha=alpha)
    preds = materialize(holdout_table(clean, model, pos_model, train_end_season=train_end_season), materialization)
    both = preds.drop("y_pred")
    pos_preds = preds.where(F.col("y_pred").isNotNull()).drop("y_pred_ridge", "y_pred_naive")
    vs = side_by_side_metrics(both)
    forecast = forecast_output(model, drop_nulls(features, feature_cols), forecast_season)
    if out_path:
        write_csv(forecast, out_path)
    return ForecastResult(
        overall_model=model,
        ridge_vs_naive_predictions=both,
        ridge_vs_naive=vs,
        winner=model_winner(vs),
        position_model=pos_model,
        position_predictions=pos_preds,
        position_metrics=metrics_with_overall(pos_preds),
        slice_top_per_position=top_n_per_position_metrics(pos_preds, n=top_n_position),
        slice_top_overall=top_n_overall_metrics(pos_preds, n=top_n_overall),
        spearman=spearman_rank_by_position(pos_preds),
        forecast=forecast,
        age_coverage=coverage,
        dropped_rows=dropped,
    )
