import pytest

from seasonlab.operators.evaluation import spearman_rank_by_position, top_n_overall_metrics, top_n_per_position_metrics


def preds(spark):
    return spark.createDataFrame([("RB", 120.0, 118.0, "a"), ("RB", 100.0, 95.0, "b"), ("RB", 80.0, 85.0, "c"),
                                  ("WR", 110.0, 105.0, "d"), ("WR", 90.0, 92.0, "e"), ("WR", 70.0, 68.0, "f")],
                                 "position string, y_true double, y_pred double, player_id string")


def test_top_n_per_position(spark):
    out = top_n_per_position_metrics(preds(spark), n=2).collect()
    assert [r["position"] for r in out] == ["RB", "WR"] and [r["n"] for r in out] == [2, 2]
    for r in out:
        assert (r["mae"], r["rmse"], r["r2"]) == pytest.approx((3.5, 3.80788655, 0.855), abs=1e-8)
    assert [r["n"] for r in top_n_per_position_metrics(preds(spark), n=99).collect()] == [3, 3]
    assert set(top_n_per_position_metrics(preds(spark)).columns) == {"position", "n", "mae", "rmse", "r2"}


def test_top_n_overall(spark):
    r = top_n_overall_metrics(preds(spark), n=3).collect()[0]
    assert (r["n"], r["mae"], r["rmse"], r["r2"]) == pytest.approx((3, 4.0, 4.24264069, 0.73), abs=1e-8)
    assert top_n_overall_metrics(preds(spark), n=6).collect()[0]["mae"] == pytest.approx(3.5)
    assert top_n_overall_metrics(preds(spark).limit(0), n=6).count() == 0


def test_spearman(spark):
    out = {r["position"]: (r["n"], r["spearman"]) for r in spearman_rank_by_position(preds(spark)).collect()}
    assert out["RB"] == (3, pytest.approx(1.0)) and out["WR"] == (3, pytest.approx(1.0))


def test_missing_columns(spark):
    df = preds(spark).drop("y_pred")
    for fn in (top_n_per_position_metrics, top_n_overall_metrics, spearman_rank_by_position):
        with pytest.raises(ValueError, match="Missing required columns"):
            fn(df)


def test_spearman_nan_for_constant_or_single(spark):
    import math
    df = spark.createDataFrame([("RB", 1.0, 5.0), ("RB", 2.0, 5.0), ("RB", 3.0, 5.0), ("QB", 1.0, 2.0)],
                               "position string, y_true double, y_pred double")
    out = {r["position"]: (r["n"], r["spearman"]) for r in spearman_rank_by_position(df).collect()}
    assert out["RB"][0] == 3 and math.isnan(out["RB"][1])  # zero variance of the predicted ranks
    assert out["QB"][0] == 1 and math.isnan(out["QB"][1])  # fewer than 2 rows


def test_pearson_guards(spark):
    import math

    from seasonlab.operators.metrics import pearson_by_group
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0), ("c", 3.0, 3.0)],
                               "g string, x double, y double")
    got = {r["g"]: r["pearson"] for r in pearson_by_group(df, "x", "y", group_cols=["g"]).collect()}
    assert got["a"] == pytest.approx(1.0) and math.isnan(got["b"]) and math.isnan(got["c"])


def test_nulls_leave_the_pair_out_of_every_part(spark):
    import math

    from seasonlab.operators.metrics import metrics_with_overall, pearson_by_group, regression_metrics
    pairs = spark.createDataFrame([("g", 1.0, 1.0), ("g", 2.0, 2.0), ("g", 3.0, 3.0), ("g", 100.0, None)], "g string, x double, y double")
    row = pearson_by_group(pairs, "x", "y").collect()[0]
    assert (row["n"], row["pearson"]) == (3, pytest.approx(1.0))
    data = [("RB", 1.0, 1.5), ("RB", 2.0, 2.0), ("WR", 4.0, 3.0), ("WR", 9.0, None), ("WR", None, 5.0), ("TE", None, None)]
    df = spark.createDataFrame(data, "position string, y_true double, y_pred double")
    want = regression_metrics(df).collect()[0]
    got = {r["position"]: r for r in metrics_with_overall(df).collect()}
    assert [got["ALL"][c] for c in ("n", "mae", "rmse", "r2")] == pytest.approx([want[c] for c in ("n", "mae", "rmse", "r2")])
    assert got["TE"]["n"] == 0 and got["TE"]["mae"] is None and math.isnan(got["TE"]["r2"])
    plan = metrics_with_overall(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
