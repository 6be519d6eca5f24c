import math
import random

import numpy as np
import pytest

from seasonlab.operators.metrics import metrics_with_overall, regression_metrics
from seasonlab.operators.ridge import (
    compare_ridge_to_naive,
    fit_overall_and_by_group,
    holdout_metrics,
    model_winner,
    predict_for_season,
    train_ridge,
    train_ridge_by_position,
)

FEATS = ["feat_ppg", "feat_carries_pg"]
T = "target_next_season_points"


def frame(spark):
    rnd = random.Random(17)
    data = []
    for position, n in (("RB", 4), ("WR", 3)):
        for k in range(n):
            for season in (1996, 1997, 1998):
                ppg, carries = rnd.uniform(2, 20), rnd.uniform(0, 15)
                points = 16 * ppg
                data.append((season, f"{position}-{k}", position, points, ppg, carries, 9 * ppg + 2 * carries + rnd.gauss(0, 4)))
    return spark.createDataFrame(data, f"season long, player_id string, position string, feat_points double, "
                                       f"feat_ppg double, feat_carries_pg double, {T} double")


def closed_form(pdf, last, alpha=1.0):
    """Textbook ridge with a centred, unpenalized intercept: weights and intercept."""
    tr = pdf[pdf.season <= last]
    x, y = tr[FEATS].to_numpy(), tr[T].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(len(FEATS)), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


def errors(y, p):
    e = y - p
    return np.abs(e).mean(), math.sqrt((e * e).mean()), 1 - (e * e).sum() / ((y - y.mean()) ** 2).sum()


def metrics_row(df, pred="y_pred"):
    r = regression_metrics(df, pred_col=pred).collect()[0]
    return r["n"], r["mae"], r["rmse"], r["r2"]


def test_overall_fit_matches_closed_form(spark):
    m = train_ridge(frame(spark), feature_cols=FEATS, target_col=T, train_end_season=1997)
    w, b = closed_form(frame(spark).toPandas(), 1997)
    assert m.weights() == pytest.approx(list(w), rel=1e-10) and m.intercept() == pytest.approx(b, rel=1e-9)
    assert (m.train_seasons, m.test_seasons) == ((1996, 1997), (1998,))


def test_overall_holdout_and_naive(spark):
    model, preds, vs = compare_ridge_to_naive(frame(spark), feature_cols=FEATS, target_col=T, train_end_season=1997)
    pdf = frame(spark).toPandas()
    w, b = closed_form(pdf, 1997)
    test = pdf[pdf.season == 1998]
    p, y = test[FEATS].to_numpy() @ w + b, test[T].to_numpy()
    assert sorted(r["y_pred_ridge"] for r in preds.collect()) == pytest.approx(sorted(p), rel=1e-9)
    by = {r["model"]: r for r in vs.collect()}
    for name, pred in (("ridge", p), ("naive", test["feat_points"].to_numpy())):
        assert (by[name]["mae"], by[name]["rmse"], by[name]["r2"]) == pytest.approx(errors(y, pred), rel=1e-9)
    assert {"season", "position", "player_id", "y_true", "y_pred_ridge", "y_pred_naive"} == set(preds.columns)
    winners = {r["metric"]: r["winner"] for r in model_winner(vs).collect()}
    assert winners == {"mae": "ridge", "rmse": "ridge", "r2": "ridge"}


def test_winner_ties_go_to_naive(spark):
    vs = spark.createDataFrame([("ridge", 3, 1.0, 2.0, 0.5), ("naive", 3, 1.0, 3.0, 0.5)],
                               "model string, n long, mae double, rmse double, r2 double")
    assert {r["metric"]: r["winner"] for r in model_winner(vs).collect()} == {"mae": "naive", "rmse": "ridge", "r2": "naive"}


def test_per_position(spark):
    df = frame(spark).where("NOT (position = 'WR' AND season = 1998 AND player_id <> 'WR-0')")
    model, preds = train_ridge_by_position(df, feature_cols=FEATS, target_col=T, train_end_season=1997)
    pdf = df.toPandas()
    every = []
    for position in ("RB", "WR"):
        own = pdf[pdf.position == position]
        w, b = closed_form(own, 1997)
        assert model.weights(position) == pytest.approx(list(w), rel=1e-9)
        assert model.intercept(position) == pytest.approx(b, rel=1e-9)
        test = own[own.season == 1998]
        every.append((test[T].to_numpy(), test[FEATS].to_numpy() @ w + b))
    got = {r["position"]: r for r in metrics_with_overall(preds).collect()}
    assert (got["RB"]["mae"], got["RB"]["rmse"], got["RB"]["r2"]) == pytest.approx(errors(*every[0]), rel=1e-8)
    assert got["WR"]["n"] == 1 and math.isnan(got["WR"]["r2"])
    y, p = (np.concatenate(x) for x in zip(*every))
    assert (got["ALL"]["mae"], got["ALL"]["rmse"], got["ALL"]["r2"]) == pytest.approx(errors(y, p), rel=1e-8)


def test_positions_without_split_are_skipped_and_none_raises(spark):
    df = frame(spark)
    model, _ = train_ridge_by_position(df.where("NOT (position = 'WR' AND season = 1998)"), feature_cols=FEATS,
                                       target_col=T, train_end_season=1997)
    assert set(model.coefficients) == {"RB"}
    with pytest.raises(ValueError, match="No position"):
        train_ridge_by_position(df, feature_cols=FEATS, target_col=T, train_end_season=1998)


def test_errors(spark):
    df = frame(spark)
    with pytest.raises(ValueError, match="empty"):
        train_ridge(df, feature_cols=FEATS, target_col=T, train_end_season=1998)
    with pytest.raises(ValueError, match="feat_x"):
        train_ridge(df, feature_cols=["feat_x"], target_col=T, train_end_season=1997)
    with pytest.raises(ValueError, match="null"):
        train_ridge(df.withColumn("feat_ppg", df.feat_ppg * None), feature_cols=FEATS, target_col=T, train_end_season=1997)
    from pyspark.sql import functions as F
    for column in ("feat_ppg", T):  # a test row too
        broken = df.withColumn(column, F.when(~((F.col("season") == 1998) & (F.col("player_id") == "RB-0")), F.col(column)))
        for call in (train_ridge, train_ridge_by_position, compare_ridge_to_naive, holdout_metrics, fit_overall_and_by_group):
            with pytest.raises(ValueError, match="null"):
                call(broken, feature_cols=FEATS, target_col=T, train_end_season=1997)
    model = train_ridge(df, feature_cols=FEATS, target_col=T, train_end_season=1997)
    with pytest.raises(ValueError, match="No rows found"):
        predict_for_season(model, df, season=2030)


def test_predict_for_season(spark):
    df = frame(spark)
    model = train_ridge(df, feature_cols=FEATS, target_col=T, train_end_season=1997)
    out = predict_for_season(model, df, season=1998, out_col="p")
    w, b = closed_form(df.toPandas(), 1997)
    test = df.where("season = 1998").toPandas()
    assert sorted(r["p"] for r in out.collect()) == pytest.approx(sorted(test[FEATS].to_numpy() @ w + b), rel=1e-9)
    assert out.count() == 7 and "feat_points" in out.columns


def test_metrics_edge_cases(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "y_true double, y_pred double")
    n, mae, rmse, r2 = metrics_row(one)
    assert (n, mae, rmse) == (1, 1.0, 1.0) and math.isnan(r2)
    flat = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "y_true double, y_pred double")
    assert metrics_row(flat)[3] == 1.0
    flat_off = spark.createDataFrame([(5.0, 4.0), (5.0, 5.0)], "y_true double, y_pred double")
    assert metrics_row(flat_off)[3] == 0.0


def test_many_groups_use_coefficient_join(spark):
    rnd = random.Random(1)
    groups = [f"g{i:02d}" for i in range(70)]
    data = []
    for g in groups:
        for s in (2020, 2021, 2022):
            for k in range(4):
                x1, x2 = rnd.uniform(0, 10), rnd.uniform(0, 5)
                data.append((s, f"{g}-{k}", g, x1, x2, 3 * x1 - x2 + rnd.gauss(0, 1)))
    df = spark.createDataFrame(data, f"season long, player_id string, position string, feat_ppg double, feat_carries_pg double, {T} double")
    model, preds = train_ridge_by_position(df, feature_cols=FEATS, target_col=T, train_end_season=2021, positions=groups)
    assert len(model.coefficients) == len(groups)
    pdf = df.toPandas()
    got = {(r["position"], r["player_id"]): r["y_pred"] for r in preds.collect()}
    assert len(got) == 4 * len(groups)
    for g in groups[:5] + groups[-3:]:
        tr = pdf[(pdf.position == g) & (pdf.season <= 2021)]
        x, y = tr[FEATS].to_numpy(), tr[T].to_numpy()
        w = np.linalg.solve((x - x.mean(0)).T @ (x - x.mean(0)) + np.eye(2), (x - x.mean(0)).T @ (y - y.mean()))
        b = y.mean() - x.mean(0) @ w
        for _, row in pdf[(pdf.position == g) & (pdf.season == 2022)].iterrows():
            assert got[(g, row["player_id"])] == pytest.approx(b + w @ row[FEATS].to_numpy(dtype=float), rel=1e-9)


def test_metrics_skip_undefined_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, None), (3.0, 3.0)], "y_true double, y_pred double")
    n, mae, rmse, r2 = metrics_row(df)
    assert (n, mae) == (2, 0.5)


def test_one_pass_fit_equals_separate_fits(spark):
    df = frame(spark).union(spark.createDataFrame(  # a group outside the list: overall model only
        [(1996, "x1", "LS", 1.0, 1.0, 2.0, 3.0), (1998, "x1", "LS", 1.0, 2.0, 2.0, 5.0)], frame(spark).schema))
    overall, by_pos = fit_overall_and_by_group(df, feature_cols=FEATS, target_col=T, train_end_season=1997)
    single = train_ridge(df, feature_cols=FEATS, target_col=T, train_end_season=1997)
    grouped, _ = train_ridge_by_position(df, feature_cols=FEATS, target_col=T, train_end_season=1997)
    assert overall.weights() == pytest.approx(single.weights(), rel=1e-12)
    assert overall.intercept() == pytest.approx(single.intercept(), rel=1e-12)
    assert overall.train_seasons == (1996, 1997) and set(by_pos.coefficients) == {"RB", "WR"}
    for pos in ("RB", "WR"):
        assert by_pos.weights(pos) == pytest.approx(grouped.weights(pos), rel=1e-12)
        assert by_pos.intercept(pos) == pytest.approx(grouped.intercept(pos), rel=1e-12)
