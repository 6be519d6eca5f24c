import pytest

from seasonlab.config import load_config
from seasonlab.plans import pipelines as pl
from seasonlab.sources import DatasetSource, TestbedSource, WeeklySource, csv_round_trip, load_seasons

from conftest import rows


def test_config_defaults():
    cfg = load_config(env={})
    assert (cfg.fantasy_scoring, cfg.scoring_provider) == ("PPR", "ESPN")
    assert cfg.scoring().rec == 1.0


@pytest.mark.parametrize("mode,provider,rec", [("half_ppr", "yahoo", 0.5), (" Standard ", " Yahoo ", 0.0)])
def test_config_accepts_normalized_values(mode, provider, rec):
    cfg = load_config(env={"FANTASY_SCORING": mode, "SCORING_PROVIDER": provider})
    assert cfg.scoring().rec == rec and cfg.scoring_provider == "YAHOO"


@pytest.mark.parametrize("env", [{"FANTASY_SCORING": "weird"}, {"SCORING_PROVIDER": "cbs"}])
def test_config_rejects_unknown(env):
    with pytest.raises(ValueError):
        load_config(env=env)


def test_config_env_file_fills_unset(tmp_path):
    f = tmp_path / ".env"
    f.write_text("# scoring\nFANTASY_SCORING=half_ppr\nexport SCORING_PROVIDER='yahoo'\n")
    assert load_config(dotenv_path=str(f), env={}).fantasy_scoring == "HALF_PPR"
    assert load_config(dotenv_path=str(f), env={"FANTASY_SCORING": "STANDARD"}).fantasy_scoring == "STANDARD"


def test_dataset_source_partition_pruning(spark, tmp_path, sf_small):
    weekly = TestbedSource(spark, sf_small).load_weekly_seasons([1999, 2000])
    path = str(tmp_path / "weekly")
    weekly.write.partitionBy("season").parquet(path)
    src = DatasetSource(spark, path)
    assert isinstance(src, WeeklySource)
    one = src.load_weekly_player_stats(2000)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "2000" in plan
    assert one.count() == weekly.where("season = 2000").count()
    assert load_seasons(src, [1999, 2000]).count() == weekly.count()


def test_per_season_frames_are_stacked_by_name(spark):
    class Frames:
        def load_weekly_player_stats(self, season):
            df = spark.createDataFrame([(season, 1.0)], "season long, x double")
            return df.withColumn("y", df.x) if season > 2000 else df
    out = load_seasons(Frames(), [2000, 2001])
    assert rows(out, "season", "y") == [(2000, None), (2001, 1.0)]


def test_source_pipelines(spark, sf_small):
    src = TestbedSource(spark, sf_small)
    top = pl.build_baseline_top_n(src, season=2000, top_n=5)
    assert top.count() >= 5 and {r["season"] for r in top.collect()} == {2000}
    feats = pl.load_and_build_features(src, seasons=range(1995, 2002))
    assert {"feat_age", "feat_ppg"} <= set(feats.columns)


def test_csv_round_trip_keeps_rows(spark):
    df = spark.createDataFrame([(1, None, "a,b"), (2, 1.5, None)], "k long, v double, s string")
    assert rows(csv_round_trip(df), "k", "v", "s") == rows(df, "k", "v", "s")


def test_baseline_csv_output(spark, sf_small, tmp_path):
    from seasonlab.sources import read_csv
    out = str(tmp_path / "ranking")
    ranking = pl.build_baseline_top_n(TestbedSource(spark, sf_small), season=2000, top_n=3, out_path=out)
    back = read_csv(spark, out, ranking.schema)
    assert rows(back, "player_id", "fantasy_points") == rows(ranking, "player_id", "fantasy_points")


def test_cli_ranking_and_forecast(spark, sf_small, tmp_path, capsys):
    from seasonlab.__main__ import main
    main(["ranking", "--testbed", sf_small, "--season", "2000", "--top-n", "1", "--scoring", "standard",
          "--env-file", str(tmp_path / "none.env")])
    out = capsys.readouterr().out
    assert "fantasy_points" in out and "QB" in out
    main(["forecast", "--testbed", sf_small, "--start-season", "1995", "--end-season", "2001",
          "--train-end-season", "1998", "--out-preds", str(tmp_path / "preds"), "--env-file", str(tmp_path / "none.env")])
    out = capsys.readouterr().out
    assert "train seasons [1995, 1996, 1997, 1998]" in out and "Spearman by position" in out
    assert any(p.name.endswith(".csv") for p in (tmp_path / "preds").iterdir())


@pytest.mark.parametrize("typed", [False, True])
def test_ranking_and_forecast_from_csv_folders(spark, sf_small, tmp_path, typed):
    from seasonlab.sources import write_csv
    testbed = TestbedSource(spark, sf_small)
    weekly, players = testbed.load_weekly_seasons(None), testbed.load_players()
    write_csv(weekly, str(tmp_path / "weekly"))
    write_csv(players, str(tmp_path / "players"))
    options = {"schema": weekly.schema, "players_options": {"schema": players.schema}} if typed else {}
    source = DatasetSource(spark, str(tmp_path / "weekly"), str(tmp_path / "players"), fmt="csv", **options)
    got = pl.build_baseline_top_n(source, season=2000, top_n=3)
    want = pl.build_baseline_top_n(testbed, season=2000, top_n=3)
    assert [(r["player_display_name"], r["games_in_data"]) for r in got.collect()] == [(r["player_display_name"], r["games_in_data"]) for r in want.collect()]
    res = pl.run_forecast(pl.load_and_build_features(source, seasons=range(1995, 2002)), train_end_season=1998, forecast_season=2001)
    ref = pl.run_forecast(pl.load_and_build_features(testbed, seasons=None), train_end_season=1998, forecast_season=2001)
    assert res.overall_model.weights() == pytest.approx(ref.overall_model.weights(), rel=1e-6)
    assert res.forecast.count() == ref.forecast.count() > 0


def test_checkpoint_folder_is_required():
    from seasonlab.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local[4]"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_season_type_filter(spark, tmp_path):
    df = spark.createDataFrame([(2025, 1, "REG"), (2025, 19, "POST"), (2024, 1, "REG")], "season long, week long, season_type string")
    path = str(tmp_path / "w")
    df.write.partitionBy("season").parquet(path)
    assert DatasetSource(spark, path).load_weekly_player_stats(2025).count() == 2  # playoffs kept by default
    assert rows(DatasetSource(spark, path, season_type="REG").load_weekly_player_stats(2025), "week") == [(1,)]
