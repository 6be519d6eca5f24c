"""Ridge regression in the cluster (see ``tsqr``), one model or one per group.

A fit reads its rows once. The overall model's triangle is one row; the listed
positions' models are a row each, and reach the driver as weights. Models by a free
column (player, name, ...) stay a table, which predictions join. The intercept
isn't penalised: b = mean(y) - mean(x) . w. Predictions are column expressions.

Rows of either side with a null, NaN or infinite feature or target are refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonlab.functions.columns import require_columns
from seasonlab.operators.metrics import metric_columns
from seasonlab.operators.ranking import PLAYER_POSITIONS
from seasonlab.operators.tsqr import ridge_table, solve_triangle
from seasonlab.session import materialize


@dataclass(frozen=True)
class RidgeModel:
    """Fitted coefficients of one model, or one model per value of ``group_col``."""

    feature_cols: tuple[str, ...]
    coefficients: dict = field(default_factory=dict)  # group value (None overall) -> (weights, intercept)
    group_col: str | None = None
    train_seasons: tuple[int, ...] = ()
    test_seasons: tuple[int, ...] = ()
    alpha: float = 1.0

    def weights(self, group=None) -> list[float]:
        return list(self.coefficients[group][0])

    def intercept(self, group=None) -> float:
        return float(self.coefficients[group][1])

    def _linear(self, weights: Sequence[float], intercept: float) -> Column:
        expr = F.lit(float(intercept))
        for w, c in zip(weights, self.feature_cols):
            expr = expr + F.lit(float(w)) * F.col(c).cast("double")
        return expr

    def prediction(self) -> Column:
        """Prediction column of the one overall model."""
        if self.group_col is not None:
            raise ValueError("one model per group: use predict()")
        return self._linear(*self.coefficients[None])

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        """group, feature, coefficient rows plus one '(intercept)' row per group."""
        rows = []
        for g, (w, b) in self.coefficients.items():
            rows += [(g, f, float(x)) for f, x in zip(self.feature_cols, w)]
            rows.append((g, "(intercept)", float(b)))
        schema = T.StructType([T.StructField("group", T.StringType()), T.StructField("feature", T.StringType()),
                               T.StructField("coefficient", T.DoubleType())])
        return spark.createDataFrame([(None if g is None else str(g), f, x) for g, f, x in rows], schema)

    def predict(self, df: DataFrame, out_col: str = "y_pred", *, keep_all: bool = False) -> DataFrame:
        """Append the prediction; rows of a group without a model get no row (with ``keep_all`` a null prediction).

        Grouped models join the coefficient table, a row for each listed group;
        its measured size decides how.
        """
        if self.group_col is None:
            return df.withColumn(out_col, self.prediction())
        names = [f"_w{i}" for i in range(len(self.feature_cols))] + ["_b"]
        schema = T.StructType([df.schema[self.group_col]] + [T.StructField(n, T.DoubleType()) for n in names])
        coefs = df.sparkSession.createDataFrame([(g, *w, b) for g, (w, b) in self.coefficients.items()], schema)
        pred = F.col("_b")
        for i, c in enumerate(self.feature_cols):
            pred = pred + F.col(f"_w{i}") * F.col(c).cast("double")
        joined = df.join(coefs, [self.group_col], "left" if keep_all else "inner").withColumn(out_col, pred)
        return joined.select(*df.columns, out_col)


@dataclass(frozen=True)
class GroupedRidge:
    """One model for every value of ``group_col``, as a table: the group, n_train, n_test, weights (array) and intercept."""

    feature_cols: tuple[str, ...]
    group_col: str
    table: DataFrame
    alpha: float = 1.0

    def coefficient_rows(self) -> DataFrame:
        """(group column, feature, coefficient), with an '(intercept)' row a group."""
        names = F.array(*[F.lit(f) for f in (*self.feature_cols, "(intercept)")])
        pairs = F.arrays_zip(names.alias("feature"), F.concat("weights", F.array("intercept")).alias("coefficient"))
        return self.table.select(self.group_col, F.inline(pairs)).toDF(self.group_col, "feature", "coefficient")

    def predict(self, df: DataFrame, out_col: str = "y_pred") -> DataFrame:
        """Append the prediction of the row's group; rows of a group without a model get no row."""
        models = self.table.select(F.col(self.group_col).alias("_g"), "weights", "intercept")
        terms = [F.col("weights")[i] * F.col(c).cast("double") for i, c in enumerate(self.feature_cols)]
        pred = reduce(lambda a, b: a + b, terms, F.col("intercept"))
        return df.join(models, F.col(self.group_col) == F.col("_g")).withColumn(out_col, pred).select(*df.columns, out_col)


def _refuse_bad(n: int) -> None:
    if n:
        raise ValueError(f"{n} rows have a null, NaN or infinite feature or target; drop them first")


def _models_from_rows(rows: list, feature_cols: Sequence[str], alpha: float, group_col: str | None, key_col: str | None = None) -> RidgeModel:
    """A model of the rows of a ridge table that the driver holds: one, or one a listed group."""
    _refuse_bad(sum(r["n_bad"] for r in rows))
    solved = [r for r in rows if r["weights"] is not None]
    coefs = {r[key_col] if key_col else None: (list(r["weights"]), float(r["intercept"])) for r in solved}
    seasons = sorted({s for r in solved if "seasons" in r for s in r["seasons"]})
    return RidgeModel(tuple(feature_cols), coefs, group_col, tuple(seasons), (), alpha)


def _split_seasons(model: RidgeModel, train_end_season: int) -> RidgeModel:
    """The model with its seasons told apart by the split."""
    train, test = (tuple(s for s in model.train_seasons if (s <= train_end_season) == side) for side in (True, False))
    return RidgeModel(model.feature_cols, model.coefficients, model.group_col, train, test, model.alpha)


def fit_overall_and_by_group(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, train_end_season: int,
                             alpha: float = 1.0, season_col: str = "season", group_col: str = "position",
                             groups: Sequence[str] = PLAYER_POSITIONS) -> tuple[RidgeModel, RidgeModel]:
    """The overall model and one model per listed group from ONE pass over the rows.

    Rows of groups outside ``groups`` share a null key, so there is one triangle
    for each listed group and one for the rest; the overall model's triangle is
    these, stacked and reduced. Same results as ``train_ridge`` plus
    ``train_ridge_by_position`` (tested).
    """
    require_columns(df, list(feature_cols) + [target_col, season_col, group_col])
    keyed = df.withColumn("_group_key", F.when(F.col(group_col).isin(list(groups)), F.col(group_col)))
    rows = ridge_table(keyed, feature_cols=feature_cols, target_col=target_col, season_col=season_col, train_end_season=train_end_season,
                       alpha=alpha, group_cols=["_group_key"]).collect()  # at most a row a listed group and one more
    by_group = _models_from_rows([r for r in rows if r["_group_key"] is not None], feature_cols, alpha, group_col, "_group_key")
    _refuse_bad(sum(r["n_bad"] for r in rows))
    width = len(feature_cols) + 2
    whole = np.concatenate([np.zeros((0, width)), *(np.frombuffer(r["triangle"], "<f8").reshape(-1, width) for r in rows)])
    if not len(whole) or not sum(r["n_test"] for r in rows):
        raise ValueError(f"the time split at season {train_end_season} leaves an empty train or test set")
    w, b = solve_triangle(whole, alpha)
    seasons = tuple(sorted({s for r in rows for s in r["seasons"]}))
    overall = RidgeModel(tuple(feature_cols), {None: (w.tolist(), b)}, None, seasons, (), alpha)
    if not by_group.coefficients:
        raise ValueError("No position has rows on both sides of the time split")
    return _split_seasons(overall, train_end_season), _split_seasons(by_group, train_end_season)


def train_ridge(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, season_col: str = "season",
                train_end_season: int, alpha: float = 1.0) -> RidgeModel:
    """One ridge model on season <= T; fails if either side of the split is empty."""
    require_columns(df, list(feature_cols) + [target_col, season_col])
    row = ridge_table(df, feature_cols=feature_cols, target_col=target_col, season_col=season_col, train_end_season=train_end_season, alpha=alpha)
    model = _models_from_rows(row.collect(), feature_cols, alpha, None)
    if not model.coefficients:
        raise ValueError(f"the time split at season {train_end_season} leaves an empty train or test set")
    return _split_seasons(model, train_end_season)


def train_ridge_by_group(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, group_col: str, train_end_season: int,
                         season_col: str = "season", alpha: float = 1.0) -> GroupedRidge:
    """One model for every value of a column that may have any number of them.

    All models are solved in the cluster and written once; the driver learns only
    how many rows are unusable and whether there is a model. Groups with an empty
    train or test side get no model; a null group is one of its own in the table,
    and matches no row in ``predict``.
    """
    require_columns(df, list(feature_cols) + [target_col, season_col, group_col])
    table = materialize(ridge_table(df, feature_cols=feature_cols, target_col=target_col, season_col=season_col, train_end_season=train_end_season,
                                    alpha=alpha, group_cols=[group_col], with_seasons=False).drop("triangle"))
    seen = table.agg(F.coalesce(F.sum("n_bad"), F.lit(0)).alias("bad"), F.count("weights").alias("models")).first()
    _refuse_bad(seen["bad"])
    if not seen["models"]:
        raise ValueError(f"No value of {group_col} has rows on both sides of the time split")
    return GroupedRidge(tuple(feature_cols), group_col, table.where(F.col("weights").isNotNull()).drop("n_bad"), alpha)


def holdout_predictions(df: DataFrame, model: RidgeModel, *, target_col: str, season_col: str = "season",
                        position_col: str = "position", train_end_season: int, out_col: str = "y_pred",
                        extra: dict[str, Column] | None = None) -> DataFrame:
    """Test rows as (season, position[, player_id], y_true, prediction[, extra])."""
    test = df.where(F.col(season_col) > F.lit(train_end_season))
    keep = [season_col, position_col] + (["player_id"] if "player_id" in df.columns else [])
    cols = [F.col(c) for c in keep] + [F.col(target_col).cast("double").alias("y_true")]
    extras = [v.alias(k) for k, v in (extra or {}).items()]
    return model.predict(test, out_col).select(*cols, out_col, *extras)


def holdout_metrics(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, season_col: str = "season",
                    train_end_season: int, alpha: float = 1.0) -> tuple[RidgeModel, DataFrame]:
    """Fit once, then n / mae / rmse / r2 of the model on the test seasons."""
    model = train_ridge(df, feature_cols=feature_cols, target_col=target_col, season_col=season_col,
                        train_end_season=train_end_season, alpha=alpha)
    test = df.where(F.col(season_col) > F.lit(train_end_season)).select(
        F.col(target_col).cast("double").alias("y_true"), model.prediction().alias("y_pred"))
    return model, test.agg(*metric_columns("y_true", "y_pred"))


def compare_ridge_to_naive(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, train_end_season: int,
                           naive_source_col: str = "feat_points", season_col: str = "season",
                           position_col: str = "position", alpha: float = 1.0) -> tuple[RidgeModel, DataFrame, DataFrame]:
    """Ridge and the naive forecast (this season's points) on the same holdout.

    Returns (model, predictions with y_pred_ridge and y_pred_naive side by
    side, metrics with one row per model). The model is fit once and both
    metric sets come from a single aggregate.
    """
    require_columns(df, list(feature_cols) + [target_col, season_col, position_col, naive_source_col])
    model = train_ridge(df, feature_cols=feature_cols, target_col=target_col, season_col=season_col,
                        train_end_season=train_end_season, alpha=alpha)
    naive = F.coalesce(F.col(naive_source_col).cast("double"), F.lit(0.0))
    preds = holdout_predictions(df, model, target_col=target_col, season_col=season_col, position_col=position_col,
                                train_end_season=train_end_season, out_col="y_pred_ridge",
                                extra={"y_pred_naive": naive})
    return model, preds, side_by_side_metrics(preds)


def side_by_side_metrics(preds: DataFrame, models: Sequence[str] = ("ridge", "naive")) -> DataFrame:
    """(model, n, mae, rmse, r2) for each ``y_pred_<model>`` column, one aggregate pass; ``n`` counts the model's pairs without a null."""
    cols = []
    for m in models:
        n, mae, rmse, r2 = metric_columns("y_true", f"y_pred_{m}")
        cols += [n.alias(f"n_{m}"), mae.alias(f"mae_{m}"), rmse.alias(f"rmse_{m}"), r2.alias(f"r2_{m}")]
    wide = preds.agg(*cols)
    parts = ", ".join(f"'{m}', n_{m}, mae_{m}, rmse_{m}, r2_{m}" for m in models)
    return wide.selectExpr(f"stack({len(models)}, {parts}) as (model, n, mae, rmse, r2)")


def model_winner(metrics: DataFrame, *, challenger: str = "ridge", baseline: str = "naive") -> DataFrame:
    """Per metric: (metric, ridge, naive, winner). Lower MAE/RMSE wins, higher R^2; ties -> baseline."""
    w = metrics.groupBy().pivot("model", [challenger, baseline]).agg(
        F.first("mae").alias("mae"), F.first("rmse").alias("rmse"), F.first("r2").alias("r2"))
    rows = []
    for metric in ("mae", "rmse", "r2"):
        rows.append(f"'{metric}', `{challenger}_{metric}`, `{baseline}_{metric}`")
    long = w.selectExpr(f"stack(3, {', '.join(rows)}) as (metric, {challenger}, {baseline})")
    higher, lower = F.col(challenger) > F.col(baseline), F.col(challenger) < F.col(baseline)
    better = F.when(F.col("metric") == "r2", higher).otherwise(lower)
    return long.withColumn("winner", F.when(better, F.lit(challenger)).otherwise(F.lit(baseline)))


def train_ridge_by_position(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, train_end_season: int,
                            season_col: str = "season", position_col: str = "position",
                            positions: Sequence[str] = PLAYER_POSITIONS, alpha: float = 1.0) -> tuple[RidgeModel, DataFrame]:
    """One model per listed position, all solved in the cluster.

    Positions with no rows, or an empty train or test side, get no model.
    Returns (models, stacked holdout predictions). Raises if no position
    qualifies.
    """
    require_columns(df, list(feature_cols) + [target_col, season_col, position_col])
    scoped = df.where(F.col(position_col).isin(list(positions)))
    rows = ridge_table(scoped, feature_cols=feature_cols, target_col=target_col, season_col=season_col, train_end_season=train_end_season,
                       alpha=alpha, group_cols=[position_col]).drop("triangle").collect()  # at most a row a listed position
    model = _split_seasons(_models_from_rows(rows, feature_cols, alpha, position_col, position_col), train_end_season)
    if not model.coefficients:
        raise ValueError("No position has rows on both sides of the time split")
    preds = holdout_predictions(scoped, model, target_col=target_col, season_col=season_col,
                                position_col=position_col, train_end_season=train_end_season)
    return model, preds


def predict_for_season(model: RidgeModel, df: DataFrame, *, season: int, season_col: str = "season",
                       out_col: str = "predicted_next_season_points", check_empty: bool = True) -> DataFrame:
    """Rows of one season with the model's prediction appended; errors if none."""
    require_columns(df, list(model.feature_cols) + [season_col])
    subset = df.where(F.col(season_col) == F.lit(season))
    if check_empty and subset.isEmpty():
        raise ValueError(f"No rows found for season {season}")
    return model.predict(subset, out_col)
