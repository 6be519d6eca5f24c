"""Scoring by a table of rules."""

from pyspark.sql import functions as F

from seasonlab.operators.rules import WEEKLY_STATS, league_weights, rules_of, score_by_rules
from seasonlab.operators.scoring import Scoring, add_weekly_points, scoring_from_mode
from seasonlab.plans import queries as q

from conftest import rows


def weekly(spark):
    data = [(1, "a", 100.0, 2, 1), (2, " A ", 50.0, None, 0), (3, "b", 10.0, 1, 1), (4, "nobody", 1.0, 1, 1), (5, None, 1.0, 1, 1)]
    return spark.createDataFrame(data, "id long, league string, rushing_yards double, receptions long, sack_fumbles_lost long")


def test_rules_table_equals_literal_rules(spark):
    leagues = {"A": scoring_from_mode("HALF_PPR"), "b": Scoring(rush_yd=1.0, fumble_lost=-7.5)}
    out = score_by_rules(weekly(spark), rules_of(spark, leagues))
    want = {}
    for league, scoring in leagues.items():
        own = weekly(spark).where(F.upper(F.trim("league")) == league.upper())
        want |= {r["id"]: r["fantasy_points_calc"] for r in add_weekly_points(own, scoring).collect()}
    assert {r["id"]: r["fantasy_points_calc"] for r in out.scored.collect()} == want and set(want) == {1, 2, 3}
    assert out.scored.columns == [*weekly(spark).columns, "fantasy_points_calc"]
    assert {(r["league"], r["n"]) for r in out.unknown_leagues.collect()} == {("NOBODY", 1), (None, 1)}
    assert out.unknown_stats.count() == 0


def test_rules_add_up_and_odd_ones_are_reported(spark):
    rules = spark.createDataFrame([("a", "rush_yd", 0.1), ("a ", "RUSH_YD", 0.2), ("a", "rec", None), ("a", "moon", 5.0), ("a", None, 1.0), (None, "rec", 1.0)], "league string, stat string, weight double")
    out = score_by_rules(weekly(spark), rules)
    assert [round(r[1], 6) for r in rows(out.scored, "id", "fantasy_points_calc")] == [30.0, 15.0]
    assert sorted(((r["league"], r["stat"], r["n"]) for r in out.unknown_stats.collect()), key=str) == [("A", "moon", 1), ("A", None, 1), (None, "rec", 1)]
    assert len(league_weights(rules).columns) == 1 + len(WEEKLY_STATS)
    none = score_by_rules(weekly(spark), rules.limit(0))
    assert none.scored.count() == 0 and none.unknown_leagues.agg(F.sum("n")).first()[0] == 5
    assert score_by_rules(weekly(spark).limit(0), rules).scored.count() == 0


def test_rules_join_follows_the_measured_size(spark, sf_small):
    plan = q.RAW_QUERIES["score_rules_table"](spark, sf_small)._jdf.queryExecution()
    assert "hint" not in plan.optimizedPlan().toString().lower() and "Cartesian" not in plan.executedPlan().toString()
