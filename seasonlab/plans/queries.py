"""Registered queries: one per operator of the inventory, over the driver's tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads the whole given
tables (weekly stats and roster are derived from them, see
``sources.testbed``). Doubles are rounded to 4 decimals at the output only,
because float sums differ in the last bits between engines; the library
functions themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonlab.functions.columns import drop_nulls, num_or_null, num_or_zero
from seasonlab.functions.dates import age_on_reference_date, parse_date_lenient, season_reference_date
from seasonlab.operators import aggregate as agg
from seasonlab.operators import evaluation as ev
from seasonlab.operators import features as feat
from seasonlab.operators import metrics as met
from seasonlab.operators import ranking as rk
from seasonlab.operators import ridge as rg
from seasonlab.operators import rules as ru
from seasonlab.operators import scoring as sc
from seasonlab.operators.dataset import build_next_season_dataset, split_seasons, time_split
from seasonlab.plans import pipelines as pl
from seasonlab.session import materialize
from seasonlab.sources.base import TestbedSource
from seasonlab.sources.feed import FeedSource, write_feed
from seasonlab.sources.readers import csv_round_trip, scratch_path, union_by_name
from seasonlab.sources.store import derived_refresh, scratch_store
from seasonlab.sources.testbed import roster_from_tables, seasons_in_tables, table, weekly_from_tables

# Fixed parameters of the registered queries (the testbed covers 1995-2001;
# 2001 ends on August 1, so its pairs only serve as targets). The seasons
# themselves are those that the data has.
RANK_SEASON = 2000
TOP_N = 24
TRAIN_END = 1998
FORECAST_SEASON = 2001
ALPHA = 1.0
FEATURES_2 = ("feat_ppg", "feat_carries_pg")
FEATURES_6 = pl.FEATURES_6
TARGET = pl.TARGET
DECIMALS = 4
STORE_BUCKETS = 16

Query = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    rounded = {f.name: F.round(F.col(f.name), decimals) for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(rounded) if rounded else df


def exact(df: DataFrame, *cols: str, decimals: int = 6) -> DataFrame:
    """Doubles as the nearest value of ``decimals`` decimal places.

    The queries that rank or cut by a sum give the operators such input, as
    the oracle does: the last bits of a sum depend on the order of adding, and
    would make ties of one engine no ties of the other.
    """
    return df.withColumns({c: F.col(c).cast(f"decimal(28,{decimals})").cast("double") for c in cols})


def age_seasons(spark, sf):
    """The seasons of the data, with one before and one after."""
    found = seasons_in_tables(spark, sf)
    return range(found.start - 1, found.stop + 1) if found else found


# -- shared building blocks -------------------------------------------------

def weekly(spark, sf, seasons=None):
    return weekly_from_tables(spark, sf, seasons)


def roster(spark, sf):
    return roster_from_tables(spark, sf)


def totals(spark, sf, seasons=None):
    return pl.scored_season_totals(weekly(spark, sf, seasons))


def features(spark, sf, materialized=False):
    """Feature table; ``materialized`` checkpoints it for queries that read it in several passes."""
    f = pl.feature_table(weekly(spark, sf), roster(spark, sf))
    return materialize(f) if materialized else f


def supervised(spark, sf):
    """Both sides of the pairing read one written feature table, so the raw tables are scanned once."""
    return pl.supervised_sets(features(spark, sf, True), FEATURES_6)


def clean(spark, sf):
    return supervised(spark, sf)[1]


def naive_holdout(spark, sf):
    test = clean(spark, sf).where(F.col("season") > TRAIN_END)
    return test.select("season", "position", "player_id", F.col(TARGET).cast("double").alias("y_true"),
                       F.coalesce(F.col("feat_points").cast("double"), F.lit(0.0)).alias("y_pred"))


def naive_all_pairs(spark, sf):
    return clean(spark, sf).select("season", "position", "player_id", F.col(TARGET).alias("y_true"),
                                   F.coalesce(F.col("feat_points").cast("double"), F.lit(0.0)).alias("y_pred"))


def position_predictions(spark, sf, feature_cols=FEATURES_6):
    _, preds = rg.train_ridge_by_position(clean(spark, sf), feature_cols=list(feature_cols), target_col=TARGET,
                                          train_end_season=TRAIN_END, alpha=ALPHA)
    return preds


def overall_model(spark, sf, feature_cols=FEATURES_6):
    return rg.train_ridge(clean(spark, sf), feature_cols=list(feature_cols), target_col=TARGET,
                          train_end_season=TRAIN_END, alpha=ALPHA)


def coefficient_rows(model: rg.RidgeModel, spark: SparkSession, group_name: str | None) -> DataFrame:
    table = model.coefficient_table(spark)
    if group_name is None:
        return table.drop("group")
    return table.withColumnRenamed("group", group_name)


# -- queries ----------------------------------------------------------------

def q_scan_weekly_season(spark, sf):
    return weekly(spark, sf, [RANK_SEASON])


def q_scan_weekly_seasons(spark, sf):
    return weekly(spark, sf)


def q_scan_roster(spark, sf):
    return roster(spark, sf)


def q_scan_csv_roundtrip(spark, sf):
    return csv_round_trip(weekly(spark, sf), "weekly-csv")


def q_sink_csv_ranking(spark, sf):
    return csv_round_trip(q_baseline_top_n(spark, sf), "ranking", one_file=True)


def q_filter_positions5(spark, sf):
    return rk.filter_positions(weekly(spark, sf), rk.PLAYER_POSITIONS)


def q_filter_positions6(spark, sf):
    return rk.filter_positions(weekly(spark, sf), rk.RANKING_POSITIONS)


def q_num_or_zero(spark, sf):
    w = weekly(spark, sf)
    return w.select("game_id", num_or_zero(w, "passing_yards").alias("passing_yards"),
                    num_or_zero(w, "rushing_fumbles_lost").alias("rushing_fumbles_lost"),
                    num_or_zero(w, "sack_fumbles_lost").alias("sack_fumbles_lost"))


def q_num_or_null(spark, sf):
    w = weekly(spark, sf)
    return w.select("game_id", num_or_null(w, "rushing_fumbles_lost").alias("rushing_fumbles_lost"),
                    num_or_null(w, "age").alias("age"))


def q_project_forecast_columns(spark, sf):
    f = features(spark, sf)
    return (f.select("season", "player_id", "player_display_name", "position", "feat_age", "feat_points")
            .withColumnRenamed("feat_points", "points").drop("player_display_name"))


def q_drop_null_features(spark, sf):
    return clean(spark, sf)


def q_age_coverage(spark, sf):
    return pl.age_coverage(features(spark, sf))


def q_dropped_rows_report(spark, sf):
    return pl.dropped_rows_report(supervised(spark, sf)[0], FEATURES_6)


def q_time_split_train(spark, sf):
    return time_split(clean(spark, sf), train_end_season=TRAIN_END)[0]


def q_time_split_test(spark, sf):
    return time_split(clean(spark, sf), train_end_season=TRAIN_END)[1]


def q_explore_top_receiving(spark, sf):
    """Ten rows of one season; rows without yards come last, ties by game."""
    w = weekly(spark, sf, [RANK_SEASON])
    return (rk.filter_positions(w, ("RB", "WR"))
            .orderBy(F.col("receiving_yards").desc_nulls_last(), F.col("game_id").asc())
            .limit(10)
            .select("player_display_name", "position", "week", "receiving_yards", "receiving_tds",
                    "rushing_tds", "rushing_fumbles_lost", "receiving_fumbles_lost",
                    num_or_null(w, "sack_fumbles_lost").alias("sack_fumbles_lost"), "fg_made", "pat_made"))


def q_score_generic(spark, sf):
    return sc.add_fantasy_points(weekly(spark, sf), sc.scoring_from_mode("PPR"),
                                 int_col="passing_interceptions", fumble_lost_col="rushing_fumbles_lost")


def q_score_weekly(spark, sf):
    return sc.add_weekly_points(weekly(spark, sf), sc.scoring_from_mode("PPR"))


def q_score_all_modes(spark, sf):
    return sc.add_weekly_points_all_modes(weekly(spark, sf))


def league_columns(df: DataFrame) -> DataFrame:
    """Per-row league settings written the way users type them."""
    modes = F.array(F.lit(" ppr"), F.lit("Half_PPR "), F.lit("standard"))
    providers = F.array(F.lit(" espn"), F.lit("Yahoo "))
    return df.withColumns({
        "league_mode": F.element_at(modes, (F.col("player_id") % 3 + 1).cast("int")),
        "league_provider": F.element_at(providers, (F.col("player_id") % 2 + 1).cast("int")),
    })


def q_score_by_mode_column(spark, sf):
    return sc.add_weekly_points_by_mode_column(league_columns(weekly(spark, sf)),
                                               mode_col="league_mode", provider_col="league_provider")


def q_score_custom_weights(spark, sf):
    return sc.add_weekly_points(weekly(spark, sf), sc.scoring_from_mode("PPR").with_weights(pass_td=6.0))


def league_rules(spark, sf) -> DataFrame:
    """Rules as data: a league for most nations, with weights of its own and one for a stat that no weekly row has."""
    weights = {**{k: sc.Scoring().as_dict()[k] for k in ru.WEEKLY_STATS}, "long_td": 3.0}
    stats = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    nations = table(spark, sf, "nation").where(F.col("n_nationkey") % 6 != 5)
    rules = nations.select(F.concat(F.lit("League "), F.col("n_nationkey")).alias("league"), (1 + F.col("n_nationkey") / 10).alias("factor"),
                           F.explode(stats).alias("stat", "weight"))
    return rules.select("league", "stat", (F.col("weight") * F.col("factor")).alias("weight"))


def league_scores(spark, sf) -> ru.LeagueScores:
    rows = weekly(spark, sf).withColumn("league", F.concat(F.lit(" league "), F.col("player_id") % 25))
    return ru.score_by_rules(rows, league_rules(spark, sf))


def q_score_rules_table(spark, sf):
    return league_scores(spark, sf).scored


def q_score_unknown_leagues(spark, sf):
    return league_scores(spark, sf).unknown_leagues


def q_score_unknown_stats(spark, sf):
    return league_scores(spark, sf).unknown_stats


def stored_weekly(spark, sf):
    store = scratch_store(spark, "weekly-store", buckets=STORE_BUCKETS)
    store.create(weekly(spark, sf))
    return store


def q_store_season_totals(spark, sf):
    """Season totals from the season-partitioned, player-bucketed store."""
    return pl.scored_season_totals(stored_weekly(spark, sf).read())


def q_store_next_season(spark, sf):
    """Pairs of seasons from the store: both sides keep the buckets' partitioning."""
    return build_next_season_dataset(feat.build_season_features(pl.scored_season_totals(stored_weekly(spark, sf).read())), out_target_col=TARGET)


def corrected_delivery(spark, sf):
    """Two seasons delivered once more: one as it was, the other with a reception more a game."""
    w = weekly(spark, sf, [RANK_SEASON - 1, RANK_SEASON])
    return w.withColumn("receptions", F.when(F.col("season") == RANK_SEASON, F.col("receptions") + 1).otherwise(F.col("receptions")))


def q_store_refresh_totals(spark, sf):
    """Load, replace the season of a delivery that changed, bring its totals up to date: as a full recompute has them."""
    store, totals_store = stored_weekly(spark, sf), scratch_store(spark, "totals-store", buckets=STORE_BUCKETS)
    derived_refresh(store, totals_store, pl.scored_season_totals, [])
    changed = store.refresh(corrected_delivery(spark, sf))
    derived_refresh(store, totals_store, pl.scored_season_totals, changed)
    return totals_store.read()


def q_feed_ranking(spark, sf):
    """The ranking from record streams that a Python data source reads, of which only the season's are opened."""
    rows, folder = weekly(spark, sf), scratch_path(spark, "feed")
    write_feed(rows, folder)
    season = FeedSource(spark, folder, rows.schema).load_weekly_player_stats(RANK_SEASON)
    return rk.top_n_by_position(exact(pl.scored_season_totals(season, out_points_col="fantasy_points"), "fantasy_points"), n=TOP_N)


def q_season_age(spark, sf):
    return feat.derive_season_age(roster(spark, sf), seasons=age_seasons(spark, sf))


def q_join_age(spark, sf):
    lookup = feat.derive_season_age(roster(spark, sf), seasons=age_seasons(spark, sf))
    return feat.join_age_to_features(totals(spark, sf), lookup)


def q_next_season_dataset(spark, sf):
    return supervised(spark, sf)[0]


def q_next_season_nullable_target(spark, sf):
    """Next season's age as the target: null where it isn't known, and such pairs stay."""
    pairs = build_next_season_dataset(features(spark, sf, True), target_col="feat_age", out_target_col="next_age")
    return pairs.select("season", "player_id", "position", "feat_points", "next_age")


def q_season_totals(spark, sf):
    return totals(spark, sf)


def q_sum_or_zero(spark, sf):
    w = weekly(spark, sf)
    return w.groupBy("season", "player_id").agg(agg.sum_or_zero(w, "passing_yards", "passing_yards_sum"),
                                                agg.sum_or_zero(w, "sack_fumbles_lost", "sack_fumbles_sum"))


def q_sum_all_null_is_zero(spark, sf):
    w = weekly(spark, sf)
    return w.groupBy("season", "player_id").agg(agg.sum_nulls_as_zero("rushing_fumbles_lost", "fumbles_sum"),
                                                agg.sum_nulls_as_zero("passing_yards", "passing_yards_sum"))


def q_season_totals_with_age(spark, sf):
    w = feat.attach_roster_age(weekly(spark, sf), roster(spark, sf))
    scored = sc.add_weekly_points(rk.filter_positions(w), sc.scoring_from_mode("PPR"))
    return agg.season_totals(scored)


def nullable_pairs(spark, sf):
    """Actuals and predictions that are each null on some rows."""
    return naive_all_pairs(spark, sf).withColumns({
        "y_true": F.when(F.col("player_id") % 5 != 0, F.col("y_true")), "y_pred": F.when(F.col("player_id") % 7 != 0, F.col("y_pred"))})


def q_metrics_with_nulls(spark, sf):
    return met.metrics_with_overall(nullable_pairs(spark, sf))


def q_pearson_with_nulls(spark, sf):
    return met.pearson_by_group(nullable_pairs(spark, sf), "y_true", "y_pred", group_cols=["position"])


def q_regression_metrics(spark, sf):
    return met.regression_metrics(naive_all_pairs(spark, sf))


def q_metrics_by_position(spark, sf):
    return met.regression_metrics(naive_all_pairs(spark, sf), group_cols=["position"])


def q_metrics_rollup(spark, sf):
    return met.metrics_with_overall(naive_holdout(spark, sf))


def q_split_seasons(spark, sf):
    return split_seasons(clean(spark, sf), train_end_season=TRAIN_END)


def q_pearson_by_group(spark, sf):
    return met.pearson_by_group(clean(spark, sf), "feat_ppg", TARGET, group_cols=["position"])


def q_dense_rank_by_position(spark, sf):
    t = exact(totals(spark, sf), "season_fantasy_points")
    return rk.with_dense_rank(rk.filter_positions(t, rk.RANKING_POSITIONS), points_col="season_fantasy_points")


def q_top_n_by_position(spark, sf):
    t = exact(totals(spark, sf), "season_fantasy_points")
    return rk.top_n_by_position(t, points_col="season_fantasy_points", n=10)


def q_average_rank(spark, sf):
    t = exact(totals(spark, sf).select("season", "player_id", "position", "season_fantasy_points"), "season_fantasy_points")
    return rk.average_rank(t, value_col="season_fantasy_points", group_cols=["position"], out_col="avg_rank")


def q_top_n_overall_rows(spark, sf):
    t = exact(totals(spark, sf), "season_fantasy_points")
    return t.orderBy(F.col("season_fantasy_points").desc(), "player_id", "season").limit(100)


def q_union_seasons_diagonal(spark, sf):
    t = totals(spark, sf)
    older = t.where(F.col("season") <= 1997).drop("pass_attempts_sum")
    newer = t.where(F.col("season") >= 1998)
    return union_by_name([older, newer])


def q_union_predictions(spark, sf):
    # one frame per position, as when each comes from its own source; they all
    # read one checkpointed predictions table
    preds = materialize(naive_holdout(spark, sf))
    frames = []
    for pos in rk.PLAYER_POSITIONS:
        frame = preds.where(F.col("position") == pos)
        if pos == "K":  # a frame from another source with narrower types
            frame = frame.withColumns({"season": F.col("season").cast("int"), "y_pred": F.col("y_pred").cast("float")})
        frames.append(frame)
    return union_by_name(frames)


def q_age_on_reference_date(spark, sf):
    r = roster(spark, sf)
    parsed = parse_date_lenient("birth_date")
    # dates are returned as ISO text so any result comparison sees the same value
    return r.select("gsis_id", "birth_date", parsed.cast("string").alias("birth_date_parsed"),
                    season_reference_date(F.lit(RANK_SEASON)).cast("string").alias("reference_date"),
                    F.datediff(season_reference_date(F.lit(RANK_SEASON)), parsed).cast("long").alias("days"),
                    age_on_reference_date(F.lit(RANK_SEASON), parsed).alias("age"))


def q_per_game_rates(spark, sf):
    f = feat.build_season_features(totals(spark, sf))
    return f.select("season", "player_id", "position", "feat_ppg", "feat_carries_pg", "feat_targets_pg", "feat_pass_att_pg")


def q_age_squared(spark, sf):
    return features(spark, sf).select("season", "player_id", "feat_age", "feat_age_sq")


def q_season_features(spark, sf):
    return feat.build_season_features(totals(spark, sf))


def q_feature_table(spark, sf):
    return pl.load_and_build_features(TestbedSource(spark, sf), seasons=None)


def q_ridge_fit_2feat(spark, sf):
    return coefficient_rows(overall_model(spark, sf, FEATURES_2), spark, None)


def q_ridge_fit_6feat(spark, sf):
    return coefficient_rows(overall_model(spark, sf, FEATURES_6), spark, None)


def q_ridge_holdout_metrics(spark, sf):
    _, m = rg.holdout_metrics(clean(spark, sf), feature_cols=list(FEATURES_6), target_col=TARGET,
                              train_end_season=TRAIN_END, alpha=ALPHA)
    return m


def q_predict_season(spark, sf):
    f = features(spark, sf, True)
    model = rg.train_ridge(pl.supervised_sets(f, FEATURES_6)[1], feature_cols=list(FEATURES_6), target_col=TARGET,
                           train_end_season=TRAIN_END, alpha=ALPHA)
    f = drop_nulls(f, FEATURES_6)
    return rg.predict_for_season(model, f, season=FORECAST_SEASON)


def q_naive_metrics(spark, sf):
    return met.regression_metrics(naive_holdout(spark, sf))


def _vs_naive(spark, sf):
    return rg.compare_ridge_to_naive(clean(spark, sf), feature_cols=list(FEATURES_6), target_col=TARGET,
                                     train_end_season=TRAIN_END, alpha=ALPHA)


def q_ridge_vs_naive_predictions(spark, sf):
    return _vs_naive(spark, sf)[1]


def q_ridge_vs_naive(spark, sf):
    return _vs_naive(spark, sf)[2]


def q_model_winner(spark, sf):
    return rg.model_winner(_vs_naive(spark, sf)[2])


def q_ridge_by_position_coefs_2feat(spark, sf):
    model, _ = rg.train_ridge_by_position(clean(spark, sf), feature_cols=list(FEATURES_2), target_col=TARGET,
                                          train_end_season=TRAIN_END, alpha=ALPHA)
    return coefficient_rows(model, spark, "position")


def q_ridge_by_player_coefs(spark, sf):
    """A model for every player with seasons on both sides of the split, solved in the cluster."""
    models = rg.train_ridge_by_group(clean(spark, sf), feature_cols=list(FEATURES_2), target_col=TARGET, group_col="player_id",
                                     train_end_season=TRAIN_END, alpha=ALPHA)
    return models.coefficient_rows()


def q_ridge_by_player_metrics(spark, sf):
    pairs = clean(spark, sf)
    models = rg.train_ridge_by_group(pairs, feature_cols=list(FEATURES_2), target_col=TARGET, group_col="player_id",
                                     train_end_season=TRAIN_END, alpha=ALPHA)
    test = models.predict(pairs.where(F.col("season") > TRAIN_END))
    return met.regression_metrics(test, actual_col=TARGET, group_cols=["position"])


def q_ridge_by_position_metrics(spark, sf):
    return met.metrics_with_overall(position_predictions(spark, sf))


def q_slice_top_n_per_position(spark, sf):
    return ev.top_n_per_position_metrics(exact(position_predictions(spark, sf), "y_true", "y_pred"), n=TOP_N)


def q_slice_top_n_overall(spark, sf):
    return ev.top_n_overall_metrics(exact(position_predictions(spark, sf), "y_true", "y_pred"), n=100)


def q_spearman_by_position(spark, sf):
    return ev.spearman_rank_by_position(exact(position_predictions(spark, sf), "y_true", "y_pred"))


def q_baseline_top_n(spark, sf):
    weekly_rows = TestbedSource(spark, sf).load_weekly_player_stats(RANK_SEASON)
    t = exact(pl.scored_season_totals(weekly_rows, out_points_col="fantasy_points"), "fantasy_points")
    return rk.top_n_by_position(t, n=TOP_N)


def q_forecast_next_season(spark, sf):
    f = features(spark, sf, True)
    model = rg.train_ridge(pl.supervised_sets(f, FEATURES_6)[1], feature_cols=list(FEATURES_6), target_col=TARGET,
                           train_end_season=TRAIN_END, alpha=ALPHA)
    return pl.forecast_output(model, drop_nulls(f, FEATURES_6), FORECAST_SEASON)


def q_forecast_top10(spark, sf):
    col = f"predicted_{FORECAST_SEASON + 1}_points"
    out = exact(q_forecast_next_season(spark, sf), col)
    return out.orderBy(F.col(col).desc(), "player_id").limit(10)


def q_forecast_pipeline(spark, sf):
    """Every metric table of one run of the whole pipeline, stacked: section, name, n, mae, rmse, r2, spearman."""
    r = pl.run_forecast(exact(features(spark, sf), "feat_points"), train_end_season=TRAIN_END, forecast_season=FORECAST_SEASON, alpha=ALPHA)
    tables = (("ridge_vs_naive", r.ridge_vs_naive.withColumnRenamed("model", "name")),
              ("position", r.position_metrics.withColumnRenamed("position", "name")),
              ("top_per_position", r.slice_top_per_position.withColumnRenamed("position", "name")),
              ("top_overall", r.slice_top_overall.withColumn("name", F.lit("ALL"))),
              ("spearman", r.spearman.withColumnRenamed("position", "name")),
              ("forecast", r.forecast.agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit("rows"))))
    stacked = union_by_name(df.withColumn("section", F.lit(section)) for section, df in tables)
    return stacked.select("section", "name", "n", "mae", "rmse", "r2", "spearman")


def q_run_reports(spark, sf):
    """What one run of the whole pipeline counts as it writes its tables: report, total, n."""
    r = pl.run_forecast(features(spark, sf), train_end_season=TRAIN_END, forecast_season=FORECAST_SEASON, alpha=ALPHA)
    rows = [("null_age", r.age_coverage["total"], r.age_coverage["null_age"]), ("with_age", r.age_coverage["total"], r.age_coverage["with_age"]),
            ("dropped", r.dropped_rows["total"], r.dropped_rows["dropped"])]
    return spark.createDataFrame(rows, "report string, total bigint, n bigint")


RAW_QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def _rounded(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {name: _rounded(fn) for name, fn in RAW_QUERIES.items()}
