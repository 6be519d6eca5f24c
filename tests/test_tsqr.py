"""Ridge by triangles: many features, near collinearity, many groups, unusable rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonlab.operators import ridge as rg
from seasonlab.operators import tsqr


def ridge(x, y, alpha):
    """Weights and intercept from the singular values of the centred features."""
    u, s, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
    w = v.T @ (s / (s * s + alpha) * (u.T @ (y - y.mean())))
    return w, y.mean() - x.mean(0) @ w


def frame(spark, x, y, season, group=None):
    names = [f"f{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(t), int(s), None if g is None else g) for r, t, s, g in zip(x, y, season, group if group is not None else [None] * len(y))]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y double, season long, g string"), names


def test_200_features(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(1500, 200)) * rnd.uniform(0.01, 100, 200) + rnd.normal(size=200) * 50
    y, season = x @ rnd.normal(size=200) + rnd.normal(size=1500), np.where(np.arange(1500) % 5, 1998, 1999)
    df, names = frame(spark, x, y, season)
    model = rg.train_ridge(df.repartition(7), feature_cols=names, target_col="y", train_end_season=1998, alpha=2.0)
    w, b = ridge(x[season == 1998], y[season == 1998], 2.0)
    assert model.weights() == pytest.approx(list(w), rel=1e-8) and model.intercept() == pytest.approx(b, rel=1e-8)


def test_nearly_collinear_features_keep_their_digits(spark):
    """Age and its square far from zero: the normal equations lose what the triangle keeps."""
    rnd = np.random.default_rng(2)
    age = 1000 + rnd.uniform(0, 1, 400)
    x, season = np.c_[age, age**2], np.where(np.arange(400) % 4, 1, 2)
    y = 3 * age + rnd.normal(size=400) * 0.01
    df, names = frame(spark, x, y, season)
    model = rg.train_ridge(df.repartition(5), feature_cols=names, target_col="y", train_end_season=1, alpha=1e-3)
    w, b = ridge(x[season == 1], y[season == 1], 1e-3)
    assert model.weights() == pytest.approx(list(w), rel=1e-4)
    assert model.intercept() == pytest.approx(b, rel=1e-4, abs=1e-2)


def test_triangles_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(tsqr, "FAN_IN", 2)
    rnd = np.random.default_rng(3)
    x, season = rnd.normal(size=(300, 3)), np.where(np.arange(300) % 3, 1, 2)
    y = x @ [1.0, -2.0, 0.5] + 4
    df, names = frame(spark, x, y, season)
    table = tsqr.ridge_table(df.repartition(9), feature_cols=names, target_col="y", season_col="season", train_end_season=1, alpha=1.0).collect()
    assert len(table) == 1 and (table[0]["n_train"], table[0]["n_test"], table[0]["n_bad"], table[0]["seasons"]) == (200, 100, 0, [1, 2])
    w, b = ridge(x[season == 1], y[season == 1], 1.0)
    assert list(table[0]["weights"]) == pytest.approx(list(w), rel=1e-10) and table[0]["intercept"] == pytest.approx(b, rel=1e-10)
    assert len(table[0]["triangle"]) == 8 * 5 * 5


def test_many_groups_are_solved_in_the_cluster(spark, monkeypatch):
    monkeypatch.setattr(tsqr, "HELD_NUMBERS", 4000)  # a task hands its groups on many times
    rnd = np.random.default_rng(4)
    n = 6000
    group = np.array([f"g{i:04d}" for i in rnd.integers(0, 1500, n)])
    x, season = rnd.normal(size=(n, 2)), rnd.integers(1, 4, n)
    y = x[:, 0] * 2 + rnd.normal(size=n)
    df, names = frame(spark, x, y, season, group)
    model = rg.train_ridge_by_group(df.repartition(6), feature_cols=names, target_col="y", group_col="g", train_end_season=2)
    got = {r["g"]: r for r in model.table.collect()}
    train = season <= 2
    want = {g for g in set(group) if train[group == g].any() and (~train[group == g]).any()}
    assert set(got) == want
    for g in sorted(want)[::97]:
        own = (group == g) & train
        w, b = ridge(x[own], y[own], 1.0)
        assert list(got[g]["weights"]) == pytest.approx(list(w), rel=1e-8, abs=1e-10) and got[g]["intercept"] == pytest.approx(b, rel=1e-8, abs=1e-10)
        assert got[g]["n_train"] == own.sum()
    preds = model.predict(df.where("season > 2")).collect()
    assert len(preds) == sum((season > 2) & np.isin(group, list(want)))
    for r in preds[::200]:
        assert r["y_pred"] == pytest.approx(got[r["g"]]["intercept"] + got[r["g"]]["weights"][0] * r["f0"] + got[r["g"]]["weights"][1] * r["f1"])
    assert model.coefficient_rows().count() == 3 * len(want)
    plan = model.predict(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower() and "LocalRelation" not in plan.split("Join", 1)[1].split("\n", 1)[0]


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
@pytest.mark.parametrize("season", [1997, 1998])
@pytest.mark.parametrize("column", ["f0", "y"])
def test_unusable_rows_are_refused_on_both_sides(spark, bad, season, column):
    rnd = np.random.default_rng(5)
    x, seasons = rnd.normal(size=(40, 2)), np.where(np.arange(40) % 2, 1997, 1998)
    df, names = frame(spark, x, x[:, 0], seasons, ["a"] * 40)
    df = df.withColumn("position", F.lit("RB")).withColumn("feat_points", F.lit(1.0))
    broken = df.withColumn(column, F.when(~((F.col("season") == season) & (F.col("f1") == float(x[seasons == season][0, 1]))), F.col(column)).otherwise(F.lit(bad).cast("double")))
    args = {"feature_cols": names, "target_col": "y", "train_end_season": 1997}
    for call in (rg.train_ridge, rg.train_ridge_by_position, rg.fit_overall_and_by_group, lambda d, **k: rg.train_ridge_by_group(d, group_col="g", **k)):
        with pytest.raises(ValueError, match="1 rows have a null, NaN or infinite"):
            call(broken, **args)


def test_groups_may_be_null_numbers_or_empty(spark):
    rows = [(g, s, float(i), float(2 * i)) for i, (g, s) in enumerate([(1, 1), (1, 1), (1, 2), (None, 1), (None, 2), (2, 1), (3, 2), (4, None)])]
    df = spark.createDataFrame(rows, "g long, season long, f0 double, y double")
    model = rg.train_ridge_by_group(df, feature_cols=["f0"], target_col="y", group_col="g", train_end_season=1)
    assert sorted((r["g"] or 0 for r in model.table.collect())) == [0, 1]
    assert {r["g"] for r in model.predict(df).collect()} == {1}
    with pytest.raises(ValueError, match="No value of g"):
        rg.train_ridge_by_group(df.limit(0), feature_cols=["f0"], target_col="y", group_col="g", train_end_season=1)
    with pytest.raises(ValueError, match="empty train or test"):
        rg.train_ridge(df.limit(0), feature_cols=["f0"], target_col="y", train_end_season=1)


def test_no_product_aggregates_in_the_plan(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1)], "f0 double, y double, season long")
    plan = tsqr.ridge_table(df, feature_cols=["f0"], target_col="y", season_col="season", train_end_season=1, alpha=1.0)._jdf.queryExecution().toString()
    assert "covar" not in plan and "MapInArrow" in plan


def test_each_model_counts_its_own_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.0, None), (2.0, 2.5, 2.0), (None, 1.0, 1.0)], "y_true double, y_pred_ridge double, y_pred_naive double")
    assert {r["model"]: (r["n"], r["mae"]) for r in rg.side_by_side_metrics(df).collect()} == {"ridge": (2, 0.25), "naive": (1, 0.0)}
