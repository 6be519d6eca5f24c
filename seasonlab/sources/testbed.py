"""Weekly stats and roster derived from the driver's order tables.

The given tables carry no player statistics, so both Spark and the SQL
oracle derive them by the same definition: one order is one game of the
ordering customer (the player); line items are the plays.

  season / week        year / ISO week of o_orderdate
  player               customer: id c_custkey, name c_name
  position             nation 24 -> LS (filtered out later), nation 23 -> DST;
                       else by market segment: AUTOMOBILE QB, BUILDING RB,
                       FURNITURE WR, HOUSEHOLD TE, other K
  passing_*            return flag A lines (yards = quantity, TD = discount >= 0.05)
  rushing_*            flag N lines;  receiving_* flag R lines
  passing_interceptions  lines with tax >= 0.07
  receptions           lines with status O
  rushing_fumbles_lost 1 when the order has a line number 7, else null
  fg_made / pat_made   lines numbered 1 / 2
  receiving_fumbles_lost  lines numbered 6 with flag R (null if none)
  attempts / carries / targets   lines with flag A / N / R
  def_sacks, def_interceptions, def_fumble_recoveries, def_tds
                       DST rows only, else null: lines numbered 3, 4, 5 and
                       lines with discount >= 0.09

Spark plan: ``lineitem`` (the largest table) is aggregated per order first,
so it is shuffled once as partial aggregates and arrives hash-partitioned on
the order key, which the join with ``orders`` reuses; the customer join then
moves one row per order. A season filter becomes a range predicate on
``o_orderdate`` that reaches the parquet scan, and a semi join with the chosen
orders' keys keeps the other seasons' line items out of the aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derivation (shared with the SQL text below).
POSITION_BY_SEGMENT = (("AUTOMOBILE", "QB"), ("BUILDING", "RB"), ("FURNITURE", "WR"), ("HOUSEHOLD", "TE"))
OTHER_POSITION = "K"
FILTERED_NATION, FILTERED_POSITION = 24, "LS"
DEFENSE_NATION, DEFENSE_POSITION = 23, "DST"
TD_DISCOUNT, INT_TAX, FUMBLE_LINE, FG_LINE, PAT_LINE = 0.05, 0.07, 7, 1, 2
REC_FUMBLE_LINE, SACK_LINE, DEF_INT_LINE, RECOVERY_LINE, DEF_TD_DISCOUNT = 6, 3, 4, 5, 0.09


# Physical layout of the tables the testbed reads. Passing it to the reader
# skips schema inference (a footer-reading job per table and query).
TABLE_SCHEMAS = {
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str, *, infer_schema: bool = False) -> DataFrame:
    reader = spark.read
    if not infer_schema and name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _season_ranges(seasons: Iterable[int]) -> list[tuple[int, int]]:
    """Contiguous [first, last] runs of a season list."""
    runs: list[tuple[int, int]] = []
    for s in sorted(set(int(x) for x in seasons)):
        if runs and s == runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], s)
        else:
            runs.append((s, s))
    return runs


def season_predicate(date_col: Column, seasons: Iterable[int], dtype: str = "timestamp_ntz") -> Column:
    """year(date) in seasons, written as date ranges so parquet can skip row groups."""
    cond = None
    for a, b in _season_ranges(seasons):
        lo = F.lit(f"{a}-01-01 00:00:00").cast(dtype)
        hi = F.lit(f"{b + 1}-01-01 00:00:00").cast(dtype)
        term = (date_col >= lo) & (date_col < hi)
        cond = term if cond is None else cond | term
    return cond if cond is not None else F.lit(False)


def weekly_from_tables(spark: SparkSession, sf_dir: str, seasons: Iterable[int] | None = None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rf, qty, disc = F.col("l_returnflag"), F.col("l_quantity"), F.col("l_discount")
    ln = F.col("l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if seasons is not None:
        dtype = orders.schema["o_orderdate"].dataType.simpleString()
        orders = orders.where(season_predicate(F.col("o_orderdate"), seasons, dtype))
        li = li.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(F.when(rf == "A", qty)).alias("passing_yards"),
        F.count_if((rf == "A") & (disc >= TD_DISCOUNT)).alias("passing_tds"),
        F.count_if(F.col("l_tax") >= INT_TAX).alias("passing_interceptions"),
        F.sum(F.when(rf == "N", qty)).alias("rushing_yards"),
        F.count_if((rf == "N") & (disc >= TD_DISCOUNT)).alias("rushing_tds"),
        F.sum(F.when(rf == "R", qty)).alias("receiving_yards"),
        F.count_if((rf == "R") & (disc >= TD_DISCOUNT)).alias("receiving_tds"),
        F.count_if(F.col("l_linestatus") == "O").alias("receptions"),
        (F.max(F.when(ln == FUMBLE_LINE, ln)) - F.lit(FUMBLE_LINE - 1)).cast("long").alias("rushing_fumbles_lost"),
        F.max(F.when((ln == REC_FUMBLE_LINE) & (rf == "R"), F.lit(1))).cast("long").alias("receiving_fumbles_lost"),
        F.count_if(ln == FG_LINE).alias("fg_made"),
        F.count_if(ln == PAT_LINE).alias("pat_made"),
        F.count_if(rf == "A").alias("attempts"),
        F.count_if(rf == "N").alias("carries"),
        F.count_if(rf == "R").alias("targets"),
        F.count_if(ln == SACK_LINE).alias("def_sacks"),
        F.count_if(ln == DEF_INT_LINE).alias("def_interceptions"),
        F.count_if(ln == RECOVERY_LINE).alias("def_fumble_recoveries"),
        F.count_if(disc >= DEF_TD_DISCOUNT).alias("def_tds"),
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = F.col("c_nationkey")
    position = F.when(nation == FILTERED_NATION, F.lit(FILTERED_POSITION)).when(nation == DEFENSE_NATION, F.lit(DEFENSE_POSITION))
    for seg, pos in POSITION_BY_SEGMENT:
        position = position.when(F.col("c_mktsegment") == seg, F.lit(pos))
    position = position.otherwise(F.lit(OTHER_POSITION))
    defense = nation == DEFENSE_NATION
    stats = [F.when(defense, F.col(c)).alias(c) if c.startswith("def_") else F.col(c)
             for c in per_order.columns if c != "l_orderkey"]
    return (orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
            .select(F.col("o_orderkey").alias("game_id"),
                    F.year("o_orderdate").cast("long").alias("season"),
                    F.weekofyear("o_orderdate").cast("long").alias("week"),
                    F.col("o_custkey").alias("player_id"),
                    F.col("c_name").alias("player_display_name"),
                    position.alias("position"),
                    *stats))


def seasons_in_tables(spark: SparkSession, sf_dir: str) -> range:
    """All seasons from the first to the last order's year (one small aggregate; empty without orders)."""
    years = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    return range(years["a"].year, years["b"].year + 1) if years["a"] else range(0)


def roster_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gsis_id, display_name, birth_date (text; some null, some unparseable)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    generated = F.date_add(F.lit("1970-01-01").cast("date"), ((k * 37) % 9000).cast("int")).cast("string")
    birth = (F.when(k % 17 == 0, F.lit(None).cast("string"))
             .when(k % 23 == 0, F.lit("unknown"))
             .when(k % 11 == 0, F.lit("1980-09-01"))
             .otherwise(generated))
    return c.select(k.alias("gsis_id"), F.col("c_name").alias("display_name"), birth.alias("birth_date"))


def _seasons_sql(seasons: Iterable[int] | None) -> str:
    if seasons is None:
        return ""
    terms = [f"(o_orderdate >= TIMESTAMP '{a}-01-01 00:00:00' AND o_orderdate < TIMESTAMP '{b + 1}-01-01 00:00:00')"
             for a, b in _season_ranges(seasons)]
    return "WHERE " + " OR ".join(terms)


def weekly_sql(seasons: Iterable[int] | None = None) -> str:
    """The same derivation as SQL text (DuckDB and Spark SQL)."""
    return f"""
SELECT o_orderkey AS game_id, CAST(year(o_orderdate) AS BIGINT) AS season,
  CAST(weekofyear(o_orderdate) AS BIGINT) AS week, o_custkey AS player_id, c_name AS player_display_name,
  CASE WHEN c_nationkey = 24 THEN 'LS' WHEN c_nationkey = 23 THEN 'DST' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'QB'
       WHEN c_mktsegment = 'BUILDING' THEN 'RB' WHEN c_mktsegment = 'FURNITURE' THEN 'WR'
       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'TE' ELSE 'K' END AS position,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS passing_yards,
  count(*) FILTER (WHERE l_returnflag = 'A' AND l_discount >= 0.05) AS passing_tds,
  count(*) FILTER (WHERE l_tax >= 0.07) AS passing_interceptions,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS rushing_yards,
  count(*) FILTER (WHERE l_returnflag = 'N' AND l_discount >= 0.05) AS rushing_tds,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS receiving_yards,
  count(*) FILTER (WHERE l_returnflag = 'R' AND l_discount >= 0.05) AS receiving_tds,
  count(*) FILTER (WHERE l_linestatus = 'O') AS receptions,
  CAST(max(l_linenumber) FILTER (WHERE l_linenumber = 7) - 6 AS BIGINT) AS rushing_fumbles_lost,
  CAST(max(CASE WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN 1 END) AS BIGINT) AS receiving_fumbles_lost,
  count(*) FILTER (WHERE l_linenumber = 1) AS fg_made,
  count(*) FILTER (WHERE l_linenumber = 2) AS pat_made,
  count(*) FILTER (WHERE l_returnflag = 'A') AS attempts,
  count(*) FILTER (WHERE l_returnflag = 'N') AS carries,
  count(*) FILTER (WHERE l_returnflag = 'R') AS targets,
  CASE WHEN c_nationkey = 23 THEN count(*) FILTER (WHERE l_linenumber = 3) END AS def_sacks,
  CASE WHEN c_nationkey = 23 THEN count(*) FILTER (WHERE l_linenumber = 4) END AS def_interceptions,
  CASE WHEN c_nationkey = 23 THEN count(*) FILTER (WHERE l_linenumber = 5) END AS def_fumble_recoveries,
  CASE WHEN c_nationkey = 23 THEN count(*) FILTER (WHERE l_discount >= 0.09) END AS def_tds
FROM (SELECT * FROM orders {_seasons_sql(seasons)}) o
JOIN customer ON c_custkey = o_custkey
JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_orderdate, o_custkey, c_name, c_nationkey, c_mktsegment"""


ROSTER_SQL = """
SELECT c_custkey AS gsis_id, c_name AS display_name,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'unknown'
       WHEN c_custkey % 11 = 0 THEN '1980-09-01'
       ELSE CAST(DATE '1970-01-01' + CAST((c_custkey * 37) % 9000 AS INTEGER) AS VARCHAR) END AS birth_date
FROM customer"""
