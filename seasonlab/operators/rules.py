"""Scoring by a table of rules: (league, stat, weight) rows instead of literals."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.functions.columns import num_or_zero, require_columns
from seasonlab.operators.scoring import WEEKLY_FUMBLE_COLUMNS, WEEKLY_KICKING_TERMS, WEEKLY_OFFENSE_TERMS, Scoring

#: Names that a rule's ``stat`` may have; each weighs one term of a weekly row.
WEEKLY_STATS = tuple(k for _, k in WEEKLY_OFFENSE_TERMS) + ("fumble_lost",) + tuple(k for _, k in WEEKLY_KICKING_TERMS)


def _name(col: Column) -> Column:
    return F.upper(F.trim(col.cast("string")))


def rules_of(spark: SparkSession, leagues: dict[str, Scoring]) -> DataFrame:
    """Rule rows of scorings that a program holds, by league."""
    rows = [(league, stat, float(scoring.as_dict()[stat])) for league, scoring in leagues.items() for stat in WEEKLY_STATS]
    return spark.createDataFrame(rows, "league string, stat string, weight double")


@dataclass(frozen=True)
class LeagueScores:
    """``scored``: the rows whose league has rules, with their points. ``unknown_leagues``: (league, n) of the
    other rows, a null league included. ``unknown_stats``: (league, stat, n) of rules that weigh nothing a weekly row has."""

    scored: DataFrame
    unknown_leagues: DataFrame
    unknown_stats: DataFrame


def league_weights(rules: DataFrame, *, league_col: str = "league", stat_col: str = "stat", weight_col: str = "weight") -> DataFrame:
    """One row a league: ``_league`` and a weight ``_w_<stat>`` for each stat (0 without a rule; several rules of a stat add up; a null weight is none)."""
    require_columns(rules, [league_col, stat_col, weight_col])
    stat, weight = F.lower(F.trim(F.col(stat_col))), F.col(weight_col).cast("double")
    sums = [F.coalesce(F.sum(F.when(stat == k, weight)), F.lit(0.0)).alias(f"_w_{k}") for k in WEEKLY_STATS]
    named = rules.withColumn("_league", _name(F.col(league_col))).where(F.col("_league").isNotNull())
    return named.groupBy("_league").agg(*sums)


def weekly_terms(df: DataFrame) -> dict[str, Column]:
    """What each stat weighs: the columns of a weekly row, nulls and absent ones as 0.0."""
    terms = {k: num_or_zero(df, c) for c, k in (*WEEKLY_OFFENSE_TERMS, *WEEKLY_KICKING_TERMS)}
    terms["fumble_lost"] = reduce(lambda a, b: a + b, [num_or_zero(df, c) for c in WEEKLY_FUMBLE_COLUMNS])
    return terms


def score_by_rules(weekly: DataFrame, rules: DataFrame, *, league_col: str = "league", rule_league_col: str = "league",
                   stat_col: str = "stat", weight_col: str = "weight", out_col: str = "fantasy_points_calc") -> LeagueScores:
    """Points of every weekly row by its own league's rules, which are data.

    The rules become one row of weights a league, joined on the league's name
    (trimmed, in upper case) and multiplied with the row's stats in one
    expression. How the join runs follows the measured size of the weights; a league
    that holds a large share of the rows is split by the join. Rows of a league
    without rules, or without a league, don't fail the job: they are counted
    in ``unknown_leagues``.
    """
    require_columns(weekly, [league_col])
    weights = league_weights(rules, league_col=rule_league_col, stat_col=stat_col, weight_col=weight_col)
    terms = weekly_terms(weekly)
    points = reduce(lambda a, b: a + b, [terms[k] * F.col(f"_w_{k}") for k in WEEKLY_STATS])
    same = _name(F.col(league_col)) == F.col("_league")
    scored = weekly.join(weights, same).withColumn(out_col, points).select(*weekly.columns, out_col)
    unknown = (weekly.select(_name(F.col(league_col)).alias(league_col)).groupBy(league_col).agg(F.count(F.lit(1)).alias("n"))
               .join(weights.select("_league"), F.col(league_col) == F.col("_league"), "left_anti"))
    stat = F.lower(F.trim(F.col(stat_col)))
    odd = rules.where(stat.isNull() | ~stat.isin(*WEEKLY_STATS) | F.col(rule_league_col).isNull())
    odd = odd.groupBy(_name(F.col(rule_league_col)).alias("league"), stat.alias("stat")).agg(F.count(F.lit(1)).alias("n"))
    return LeagueScores(scored, unknown, odd)
