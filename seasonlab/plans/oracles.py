"""Oracle SQL (DuckDB) for every registered query.

The texts rebuild each result from the raw tables independently of the
Spark code: the testbed derivation, scoring (with its own copy of the
weights), totals, features, the supervised join and the metrics are plain
SQL; ridge coefficients come from
an elimination over the normal equations written as one CTE per step.
Doubles are rounded to 4 decimals, as on the Spark side.
"""

from __future__ import annotations

from seasonlab.plans import queries as q
from seasonlab.sources.testbed import ROSTER_SQL, weekly_sql

D = q.DECIMALS


def lit(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def num(col: str, present: bool = True) -> str:
    return f"coalesce(CAST({col} AS DOUBLE), 0.0)" if present else "CAST(0.0 AS DOUBLE)"


WEEKLY_PRESENT = {"passing_yards", "passing_tds", "passing_interceptions", "rushing_yards", "rushing_tds",
                  "receptions", "receiving_yards", "receiving_tds", "rushing_fumbles_lost", "receiving_fumbles_lost",
                  "fg_made", "pat_made"}


def weekly_points_sql(w: dict[str, float], present=WEEKLY_PRESENT) -> str:
    def n(c):
        return num(c, c in present)
    offense = [("passing_yards", "pass_yd"), ("passing_tds", "pass_td"), ("passing_interceptions", "pass_int"),
               ("rushing_yards", "rush_yd"), ("rushing_tds", "rush_td"), ("receptions", "rec"),
               ("receiving_yards", "rec_yd"), ("receiving_tds", "rec_td")]
    terms = [f"{n(c)} * {lit(w[k])}" for c, k in offense]
    fumbles = f"({n('sack_fumbles_lost')} + {n('rushing_fumbles_lost')} + {n('receiving_fumbles_lost')})"
    terms.append(f"{fumbles} * {lit(w['fumble_lost'])}")
    terms += [f"{n('pat_made')} * {lit(w['xpm'])}", f"{n('fg_made')} * {lit(w['fgm'])}"]
    return " + ".join(terms)


# Fixed values, written here once more: a wrong weight in the library must not reach the oracle.
PPR = {"pass_yd": 0.04, "pass_td": 4.0, "pass_int": -2.0, "rush_yd": 0.1, "rush_td": 6.0, "rec": 1.0, "rec_yd": 0.1,
       "rec_td": 6.0, "fumble_lost": -2.0, "def_sack": 1.0, "def_int": 2.0, "def_fumble_recovery": 2.0, "def_td": 6.0,
       "xpm": 1.0, "fgm": 3.0}
RECEPTION = {"PPR": 1.0, "HALF_PPR": 0.5, "STANDARD": 0.0}
PROVIDER_NAMES = ("ESPN", "YAHOO")
PPR_NO_REC = {**PPR, "rec": 0.0}
POS5 = "('QB', 'RB', 'WR', 'TE', 'K')"
POS6 = "('QB', 'RB', 'WR', 'TE', 'K', 'DST')"
F6 = list(q.FEATURES_6)
F2 = list(q.FEATURES_2)
T = q.TARGET
TE = q.TRAIN_END


def age_sql(season: str, birth: str) -> str:
    return (f"CAST(floor(datediff('day', CAST(try_strptime({birth}, '%Y-%m-%d') AS DATE), "
            f"make_date(CAST({season} AS BIGINT), 9, 1)) / 365.25e0) AS DOUBLE)")


def totals_sql(src: str, points: str = "season_fantasy_points") -> str:
    return f"""SELECT season, player_id, player_display_name, position,
  coalesce(sum(fantasy_points_calc), 0.0) AS {points}, count(player_id) AS games_in_data,
  CAST(coalesce(sum(carries), 0) AS BIGINT) AS carries_sum, CAST(coalesce(sum(targets), 0) AS BIGINT) AS targets_sum,
  CAST(coalesce(sum(attempts), 0) AS BIGINT) AS pass_attempts_sum
FROM (SELECT *, {weekly_points_sql(PPR)} AS fantasy_points_calc FROM {src} WHERE position IN {POS5})
GROUP BY season, player_id, player_display_name, position"""


def features_select(src: str, age: str | None) -> str:
    g = "coalesce(CAST(games_in_data AS DOUBLE), 0.0)"
    pts = "coalesce(CAST(season_fantasy_points AS DOUBLE), 0.0)"
    div = f"(CASE WHEN {g} > 0 THEN {g} ELSE 1.0 END)"
    a = "CAST(age AS DOUBLE)" if age else "CAST(NULL AS DOUBLE)"
    c, t, pa = (num("carries_sum"), num("targets_sum"), num("pass_attempts_sum"))
    return f"""SELECT *, {pts} AS feat_points, {g} AS feat_games, {c} AS feat_carries, {t} AS feat_targets,
  {pa} AS feat_pass_att, {pts} / {div} AS feat_ppg, {c} / {div} AS feat_carries_pg, {t} / {div} AS feat_targets_pg,
  {pa} / {div} AS feat_pass_att_pg, {a} AS feat_age, {a} * {a} AS feat_age_sq FROM {src}"""


def not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


BASE = f"""WITH weekly AS ({weekly_sql()}),
weekly_rank AS ({weekly_sql([q.RANK_SEASON])}),
roster AS ({ROSTER_SQL}),
totals AS ({totals_sql('weekly')}),
totals_rank AS ({totals_sql('weekly_rank', 'fantasy_points')}),
totals_age AS (SELECT t.*, CASE WHEN r.birth_date IS NOT NULL THEN {age_sql('t.season', 'r.birth_date')} END AS age
  FROM totals t LEFT JOIN (SELECT gsis_id, birth_date FROM roster WHERE birth_date IS NOT NULL) r ON t.player_id = r.gsis_id),
features AS ({features_select('totals_age', 'age')}),
supervised AS (SELECT f.*, n.feat_points AS {T} FROM features f JOIN
  (SELECT season AS _s, player_id AS _p, position AS _q, feat_points FROM features) n
  ON f.player_id = n._p AND f.position = n._q AND f.season + 1 = n._s),
clean AS (SELECT * FROM supervised WHERE {not_null(F6)}),
naive_all AS (SELECT season, position, player_id, CAST({T} AS DOUBLE) AS y_true,
  coalesce(CAST(feat_points AS DOUBLE), 0.0) AS y_pred FROM clean),
naive_test AS (SELECT * FROM naive_all WHERE season > {TE})"""


def metrics_sql(y: str = "y_true", p: str = "y_pred", n_alias: str | None = "n", sfx: str = "") -> str:
    e = f"({y} - {p})"
    r2 = (f"CASE WHEN count(*) < 2 THEN CAST('nan' AS DOUBLE) "
          f"WHEN var_pop({y}) * count(*) = 0 THEN (CASE WHEN sum({e} * {e}) = 0 THEN 1.0e0 ELSE 0.0e0 END) "
          f"ELSE 1.0e0 - sum({e} * {e}) / (var_pop({y}) * count(*)) END")
    cols = [f"avg(abs({e})) AS mae{sfx}", f"sqrt(avg({e} * {e})) AS rmse{sfx}", f"{r2} AS r2{sfx}"]
    if n_alias:
        cols.insert(0, f"count(*) AS {n_alias}")
    return ", ".join(cols)


def rounded(sql: str, doubles: list[str]) -> str:
    """Round the named double columns of ``sql`` (other columns unchanged)."""
    if not doubles:
        return sql
    ex = ", ".join(doubles)
    # a rounded zero is written as 0.0 (DuckDB can return -0.0, Spark's round cannot)
    rs = ", ".join(f"CASE WHEN round({c}, {D}) = 0 THEN CAST(0.0 AS DOUBLE) ELSE round({c}, {D}) END AS {c}"
                   for c in doubles)
    return f"SELECT * EXCLUDE ({ex}), {rs} FROM ({sql}) _r"


def with_base(body: str, doubles: list[str]) -> str:
    return f"{BASE}\nSELECT * FROM ({rounded(body, doubles)}) _o"


WEEKLY_DOUBLES = ["passing_yards", "rushing_yards", "receiving_yards"]
TOTAL_DOUBLES = ["season_fantasy_points"]
FEATURE_DOUBLES = ["feat_points", "feat_games", "feat_carries", "feat_targets", "feat_pass_att", "feat_ppg",
                   "feat_carries_pg", "feat_targets_pg", "feat_pass_att_pg", "feat_age", "feat_age_sq"]
METRIC_DOUBLES = ["mae", "rmse", "r2"]


# -- ridge ------------------------------------------------------------------

def ridge_ctes(data: str, feats: list[str], group: str | None, prefix: str) -> tuple[str, str]:
    """CTEs that fit ridge on ``data`` (train season <= TE) by group.

    Returns (cte text starting with ', ', name of the final CTE with columns
    [group], w0..w{p-1}, b).
    """
    p = len(feats)
    tr = f"season <= {TE}"
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    ntr = f"count(*) FILTER (WHERE {tr})"
    aggs = [f"{ntr} AS n_train", f"count(*) FILTER (WHERE season > {TE}) AS n_test"]
    aggs += [f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE {tr}) AS m{i}" for i, c in enumerate(feats)]
    aggs.append(f"avg(CAST({T} AS DOUBLE)) FILTER (WHERE {tr}) AS my")
    for i in range(p):
        for j in range(p):
            a, b = feats[min(i, j)], feats[max(i, j)]
            diag = f" + {lit(q.ALPHA)}" if i == j else ""
            aggs.append(f"covar_pop({a}, {b}) FILTER (WHERE {tr}) * {ntr}{diag} AS a{i}_{j}")
        aggs.append(f"covar_pop({feats[i]}, {T}) FILTER (WHERE {tr}) * {ntr} AS c{i}")
    ctes = [f"{prefix}0 AS MATERIALIZED (SELECT * FROM (SELECT {gsel}{', '.join(aggs)} FROM {data} {gby}) "
            f"WHERE n_train > 0 AND n_test > 0)"]
    keep = f"{gsel}" + ", ".join([f"m{i}" for i in range(p)] + ["my"])
    # forward elimination (the matrix is symmetric positive definite: no pivoting)
    for k in range(p - 1):
        cols = []
        for i in range(p):
            for j in range(p):
                if i > k and j >= k:
                    cols.append(f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j} AS a{i}_{j}")
                else:
                    cols.append(f"a{i}_{j}")
            cols.append(f"c{i} - a{i}_{k} / a{k}_{k} * c{k} AS c{i}" if i > k else f"c{i}")
        ctes.append(f"{prefix}{k + 1} AS MATERIALIZED (SELECT {keep}, {', '.join(cols)} FROM {prefix}{k})")
    last = f"{prefix}{p - 1}"
    mat = ", ".join(f"a{i}_{j}" for i in range(p) for j in range(p))
    # back substitution, one weight per step
    prev = last
    solved: list[int] = []
    for i in reversed(range(p)):
        rest = " - ".join([f"c{i}"] + [f"a{i}_{j} * w{j}" for j in solved])
        ws = "".join(f", w{j}" for j in solved)
        name = f"{prefix}w{i}"
        ctes.append(f"{name} AS MATERIALIZED (SELECT {keep}, {mat}, "
                    f"{', '.join(f'c{r}' for r in range(p))}{ws}, ({rest}) / a{i}_{i} AS w{i} FROM {prev})")
        prev = name
        solved.append(i)
    intercept = " - ".join(["my"] + [f"m{i} * w{i}" for i in range(p)])
    ctes.append(f"{prefix}coef AS MATERIALIZED (SELECT {gsel}{', '.join(f'w{i}' for i in range(p))}, "
                f"({intercept}) AS b FROM {prev})")
    return ", " + ",\n".join(ctes), f"{prefix}coef"


def prediction_sql(feats: list[str], coef_alias: str = "k") -> str:
    expr = f"{coef_alias}.b"
    for i, c in enumerate(feats):
        expr = f"({expr} + {coef_alias}.w{i} * CAST({c} AS DOUBLE))"
    return expr


def with_ridge(feats: list[str], group: str | None, body: str, doubles: list[str], prefix: str = "r") -> str:
    ctes, coef = ridge_ctes("clean", feats, group, prefix)
    return f"{BASE}{ctes}\nSELECT * FROM ({rounded(body.replace('{coef}', coef), doubles)}) _o"


def coef_rows_sql(feats: list[str], group: str | None) -> str:
    parts = []
    gsel = f"{group}, " if group else ""
    for i, f in enumerate(feats):
        parts.append(f"SELECT {gsel}'{f}' AS feature, w{i} AS coefficient FROM {{coef}}")
    parts.append(f"SELECT {gsel}'(intercept)' AS feature, b AS coefficient FROM {{coef}}")
    return " UNION ALL ".join(parts)


POS_PRED = (f"SELECT c.season, c.position, c.player_id, CAST(c.{T} AS DOUBLE) AS y_true, "
            f"{prediction_sql(F6)} AS y_pred FROM clean c JOIN {{coef}} k ON c.position = k.position "
            f"WHERE c.season > {TE} AND c.position IN {POS5}")
OVERALL_TEST = (f"SELECT c.season, c.position, c.player_id, CAST(c.{T} AS DOUBLE) AS y_true, "
                f"{prediction_sql(F6)} AS y_pred_ridge, coalesce(CAST(c.feat_points AS DOUBLE), 0.0) AS y_pred_naive "
                f"FROM clean c CROSS JOIN {{coef}} k WHERE c.season > {TE}")


def rollup_metrics_sql(src: str) -> str:
    return (f"SELECT CASE WHEN grouping(position) = 1 THEN 'ALL' ELSE position END AS position, {metrics_sql()} "
            f"FROM ({src}) GROUP BY ROLLUP (position)")


def exact(col: str, decimals: int = 6) -> str:
    """The same exact input that the query gives the operator (see ``queries.exact``)."""
    return f"CAST(CAST({col} AS DECIMAL(28, {decimals})) AS DOUBLE)"


def avg_rank_sql(v: str) -> str:
    k = exact(v)
    return (f"(rank() OVER (PARTITION BY position ORDER BY {k}) + "
            f"(count(*) OVER (PARTITION BY position, {k}) - 1) / 2.0e0)")


def pearson_sql(a: str, b: str) -> str:
    den = f"sqrt(var_pop({a}) * var_pop({b}))"
    return (f"CASE WHEN count(*) < 2 OR {den} = 0 OR {den} IS NULL THEN CAST('nan' AS DOUBLE) "
            f"ELSE covar_pop({a}, {b}) / {den} END")


def ranking_sql(src: str, points: str, n: int, positions: str = POS6) -> str:
    return (f"SELECT * EXCLUDE (_rank) FROM (SELECT *, dense_rank() OVER (PARTITION BY position ORDER BY "
            f"{exact(points)} DESC) AS _rank FROM {src} WHERE position IN {positions} AND {points} IS NOT NULL) "
            f"WHERE _rank <= {n}")


def modes_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{p}' AS provider, '{m}' AS mode, {lit(w)} AS _rec_w"
                              for p in PROVIDER_NAMES for m, w in RECEPTION.items())
    return rows


MODE_CASE = " ".join(f"WHEN '{m}' THEN {lit(w)}" for m, w in RECEPTION.items())
PROVIDER_CASE = " ".join(f"WHEN '{p}' THEN {lit(0.0)}" for p in PROVIDER_NAMES)
LEAGUE_SQL = ("SELECT *, ([' ppr', 'Half_PPR ', 'standard'])[CAST(player_id % 3 + 1 AS INTEGER)] AS league_mode, "
              "([' espn', 'Yahoo '])[CAST(player_id % 2 + 1 AS INTEGER)] AS league_provider FROM weekly")
GENERIC_TERMS_SQL = [("passing_yards", "pass_yd"), ("passing_tds", "pass_td"), ("passing_interceptions", "pass_int"),
                     ("rushing_yards", "rush_yd"), ("rushing_tds", "rush_td"), ("receptions", "rec"),
                     ("receiving_yards", "rec_yd"), ("receiving_tds", "rec_td"), ("rushing_fumbles_lost", "fumble_lost"),
                     ("def_sacks", "def_sack"), ("def_interceptions", "def_int"),
                     ("def_fumble_recoveries", "def_fumble_recovery"), ("def_tds", "def_td")]
GENERIC_POINTS = " + ".join(f"coalesce({c}, 0) * {lit(PPR[k])}" for c, k in GENERIC_TERMS_SQL)
FORECAST_COL = f"predicted_{q.FORECAST_SEASON + 1}_points"
FORECAST_BODY = (f"SELECT f.season, f.player_id, f.player_display_name, f.position, f.feat_age, f.feat_points, "
                 f"{prediction_sql(F6)} AS {FORECAST_COL} FROM features f CROSS JOIN {{coef}} k "
                 f"WHERE {not_null(['f.' + c for c in F6])} AND f.season = {q.FORECAST_SEASON}")


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    wd = WEEKLY_DOUBLES
    o["scan_weekly_season"] = with_base("SELECT * FROM weekly_rank", wd)
    o["scan_weekly_seasons"] = with_base("SELECT * FROM weekly", wd)
    o["scan_roster"] = with_base("SELECT * FROM roster", [])
    o["scan_csv_roundtrip"] = with_base("SELECT * FROM weekly", wd)
    o["sink_csv_ranking"] = with_base(ranking_sql("totals_rank", "fantasy_points", q.TOP_N), ["fantasy_points"])
    o["filter_positions5"] = with_base(f"SELECT * FROM weekly WHERE position IN {POS5}", wd)
    o["filter_positions6"] = with_base(f"SELECT * FROM weekly WHERE position IN {POS6}", wd)
    o["num_or_zero"] = with_base(
        f"SELECT game_id, {num('passing_yards')} AS passing_yards, {num('rushing_fumbles_lost')} AS rushing_fumbles_lost, "
        f"CAST(0.0 AS DOUBLE) AS sack_fumbles_lost FROM weekly", ["passing_yards", "rushing_fumbles_lost", "sack_fumbles_lost"])
    o["num_or_null"] = with_base(
        "SELECT game_id, CAST(rushing_fumbles_lost AS DOUBLE) AS rushing_fumbles_lost, CAST(NULL AS DOUBLE) AS age FROM weekly",
        ["rushing_fumbles_lost", "age"])
    o["project_forecast_columns"] = with_base(
        "SELECT season, player_id, position, feat_age, feat_points AS points FROM features", ["feat_age", "points"])
    sup_doubles = TOTAL_DOUBLES + FEATURE_DOUBLES + ["age", T]
    o["drop_null_features"] = with_base("SELECT * FROM clean", sup_doubles)
    o["age_coverage"] = with_base(
        "SELECT count(*) AS total, count(*) FILTER (WHERE age IS NULL) AS null_age, "
        "count(*) FILTER (WHERE age IS NOT NULL) AS with_age FROM features", [])
    any_null = " OR ".join(f"{c} IS NULL" for c in F6)
    o["dropped_rows_report"] = with_base(
        f"SELECT count(*) AS total, count(*) FILTER (WHERE {any_null}) AS dropped FROM supervised", [])
    o["time_split_train"] = with_base(f"SELECT * FROM clean WHERE season <= {TE}", sup_doubles)
    o["time_split_test"] = with_base(f"SELECT * FROM clean WHERE season > {TE}", sup_doubles)
    o["explore_top_receiving"] = with_base(
        "SELECT player_display_name, position, week, receiving_yards, receiving_tds, rushing_tds, rushing_fumbles_lost, "
        "receiving_fumbles_lost, CAST(NULL AS DOUBLE) AS sack_fumbles_lost, fg_made, pat_made FROM weekly_rank WHERE position IN ('RB', 'WR') "
        "ORDER BY receiving_yards DESC NULLS LAST, game_id ASC LIMIT 10", ["receiving_yards"])
    o["score_generic"] = with_base(
        "SELECT *, " + GENERIC_POINTS + " AS fantasy_points FROM weekly", wd + ["fantasy_points"])
    o["score_weekly"] = with_base(f"SELECT *, {weekly_points_sql(PPR)} AS fantasy_points_calc FROM weekly",
                                  wd + ["fantasy_points_calc"])
    o["score_all_modes"] = with_base(
        f"SELECT * EXCLUDE (_b, _r, _rec_w), _b + _r * _rec_w AS fantasy_points_calc FROM "
        f"(SELECT *, {weekly_points_sql(PPR_NO_REC)} AS _b, {num('receptions')} AS _r FROM weekly) w "
        f"CROSS JOIN ({modes_sql()}) m", wd + ["fantasy_points_calc"])
    o["score_by_mode_column"] = with_base(
        f"SELECT *, {weekly_points_sql(PPR_NO_REC)} + {num('receptions')} * "
        f"((CASE upper(trim(league_mode)) {MODE_CASE} END) + (CASE upper(trim(league_provider)) {PROVIDER_CASE} END)) "
        f"AS fantasy_points_calc FROM ({LEAGUE_SQL})", wd + ["fantasy_points_calc"])
    o["score_custom_weights"] = with_base(
        f"SELECT *, {weekly_points_sql({**PPR, 'pass_td': 6.0})} AS fantasy_points_calc FROM weekly",
        wd + ["fantasy_points_calc"])
    leagues = "SELECT n_nationkey, 1 + n_nationkey / 10.0e0 AS factor FROM nation WHERE n_nationkey % 6 <> 5"
    o["score_rules_table"] = with_base(
        f"SELECT * EXCLUDE (n_nationkey, factor), ' league ' || (player_id % 25) AS league, factor * ({weekly_points_sql(PPR)}) AS fantasy_points_calc "
        f"FROM weekly JOIN ({leagues}) ON player_id % 25 = n_nationkey", wd + ["fantasy_points_calc"])
    o["score_unknown_leagues"] = with_base(
        f"SELECT 'LEAGUE ' || (player_id % 25) AS league, count(*) AS n FROM weekly WHERE player_id % 25 NOT IN (SELECT n_nationkey FROM ({leagues})) "
        "GROUP BY player_id % 25", [])
    o["score_unknown_stats"] = with_base(f"SELECT 'LEAGUE ' || n_nationkey AS league, 'long_td' AS stat, CAST(1 AS BIGINT) AS n FROM ({leagues})", [])
    o["store_season_totals"] = with_base("SELECT * FROM totals", TOTAL_DOUBLES)
    plain = f"SELECT * FROM ({features_select('totals', None)})"
    o["store_next_season"] = with_base(
        f"SELECT f.*, n.feat_points AS {T} FROM ({plain}) f JOIN ({plain}) n ON f.player_id = n.player_id AND f.position = n.position "
        "AND f.season + 1 = n.season", TOTAL_DOUBLES + FEATURE_DOUBLES + [T])
    corrected = f"(SELECT * REPLACE (CASE WHEN season = {q.RANK_SEASON} THEN receptions + 1 ELSE receptions END AS receptions) FROM weekly)"
    o["store_refresh_totals"] = with_base(totals_sql(corrected), TOTAL_DOUBLES)
    o["feed_ranking"] = with_base(ranking_sql("totals_rank", "fantasy_points", q.TOP_N), ["fantasy_points"])
    season_age = (f"SELECT player_id, season, {age_sql('season', '_birth')} AS age FROM "
                  f"(SELECT gsis_id AS player_id, birth_date AS _birth, unnest(generate_series("
                  f"(SELECT min(year(o_orderdate)) FROM orders) - 1, (SELECT max(year(o_orderdate)) FROM orders) + 1)) AS season "
                  f"FROM roster WHERE birth_date IS NOT NULL)")
    o["season_age"] = with_base(season_age, ["age"])
    o["join_age"] = with_base(f"SELECT t.*, a.age FROM totals t LEFT JOIN ({season_age}) a "
                              f"ON t.player_id = a.player_id AND t.season = a.season", TOTAL_DOUBLES + ["age"])
    o["next_season_dataset"] = with_base("SELECT * FROM supervised", sup_doubles)
    o["next_season_nullable_target"] = with_base(
        "SELECT f.season, f.player_id, f.position, f.feat_points, n.feat_age AS next_age FROM features f JOIN features n "
        "ON f.player_id = n.player_id AND f.position = n.position AND f.season + 1 = n.season", ["feat_points", "next_age"])
    o["season_totals"] = with_base("SELECT * FROM totals", TOTAL_DOUBLES)
    o["sum_or_zero"] = with_base(
        f"SELECT season, player_id, sum({num('passing_yards')}) AS passing_yards_sum, "
        f"CAST(0.0 AS DOUBLE) AS sack_fumbles_sum FROM weekly GROUP BY season, player_id",
        ["passing_yards_sum", "sack_fumbles_sum"])
    o["sum_all_null_is_zero"] = with_base(
        "SELECT season, player_id, CAST(coalesce(sum(rushing_fumbles_lost), 0) AS BIGINT) AS fumbles_sum, "
        "coalesce(sum(passing_yards), 0) AS passing_yards_sum FROM weekly GROUP BY season, player_id",
        ["passing_yards_sum"])
    o["season_totals_with_age"] = with_base(
        f"SELECT season, player_id, player_display_name, position, coalesce(sum(fantasy_points_calc), 0.0) AS "
        f"season_fantasy_points, count(player_id) AS games_in_data, CAST(coalesce(sum(carries), 0) AS BIGINT) AS carries_sum, "
        f"CAST(coalesce(sum(targets), 0) AS BIGINT) AS targets_sum, CAST(coalesce(sum(attempts), 0) AS BIGINT) AS "
        f"pass_attempts_sum, max(age) AS age FROM (SELECT w.*, {weekly_points_sql(PPR)} AS fantasy_points_calc, "
        f"CASE WHEN r.birth_date IS NOT NULL THEN {age_sql('w.season', 'r.birth_date')} END AS age FROM weekly w "
        f"LEFT JOIN (SELECT gsis_id, birth_date FROM roster WHERE birth_date IS NOT NULL) r ON w.player_id = r.gsis_id "
        f"WHERE w.position IN {POS5}) GROUP BY season, player_id, player_display_name, position",
        TOTAL_DOUBLES + ["age"])
    nullable = ("SELECT season, position, player_id, CASE WHEN player_id % 5 <> 0 THEN y_true END AS y_true, "
                "CASE WHEN player_id % 7 <> 0 THEN y_pred END AS y_pred FROM naive_all")
    o["metrics_with_nulls"] = with_base(
        rollup_metrics_sql(f"SELECT * FROM ({nullable}) WHERE y_true IS NOT NULL AND y_pred IS NOT NULL"), METRIC_DOUBLES)
    o["pearson_with_nulls"] = with_base(
        f"SELECT position, count(*) AS n, {pearson_sql('y_true', 'y_pred')} AS pearson FROM ({nullable}) "
        f"WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY position", ["pearson"])
    o["regression_metrics"] = with_base(f"SELECT {metrics_sql()} FROM naive_all", METRIC_DOUBLES)
    o["metrics_by_position"] = with_base(f"SELECT position, {metrics_sql()} FROM naive_all GROUP BY position",
                                         METRIC_DOUBLES)
    o["metrics_rollup"] = with_base(rollup_metrics_sql("SELECT * FROM naive_test"), METRIC_DOUBLES)
    o["split_seasons"] = with_base(
        f"SELECT DISTINCT CASE WHEN season <= {TE} THEN 'train' ELSE 'test' END AS split, season FROM clean "
        f"WHERE season IS NOT NULL", [])
    o["pearson_by_group"] = with_base(
        f"SELECT position, count(*) AS n, {pearson_sql('feat_ppg', T)} AS pearson FROM clean GROUP BY position",
        ["pearson"])
    o["dense_rank_by_position"] = with_base(
        f"SELECT *, dense_rank() OVER (PARTITION BY position ORDER BY {exact('season_fantasy_points')} DESC) AS rank "
        f"FROM totals WHERE position IN {POS6} AND season_fantasy_points IS NOT NULL",
        TOTAL_DOUBLES)
    o["top_n_by_position"] = with_base(ranking_sql("totals", "season_fantasy_points", 10), TOTAL_DOUBLES)
    o["average_rank"] = with_base(
        f"SELECT season, player_id, position, season_fantasy_points, {avg_rank_sql('season_fantasy_points')} AS avg_rank "
        f"FROM totals", TOTAL_DOUBLES + ["avg_rank"])
    o["top_n_overall_rows"] = with_base(
        f"SELECT * FROM totals ORDER BY {exact('season_fantasy_points')} DESC, player_id, season LIMIT 100", TOTAL_DOUBLES)
    o["union_seasons_diagonal"] = with_base(
        "SELECT * EXCLUDE (pass_attempts_sum) FROM totals WHERE season <= 1997 UNION ALL BY NAME "
        "SELECT * FROM totals WHERE season >= 1998", TOTAL_DOUBLES)
    o["union_predictions"] = with_base(
        "SELECT season, position, player_id, y_true, CASE WHEN position = 'K' THEN CAST(CAST(y_pred AS FLOAT) AS DOUBLE) "
        "ELSE y_pred END AS y_pred FROM naive_test", ["y_true", "y_pred"])
    ref = f"make_date({q.RANK_SEASON}, 9, 1)"
    o["age_on_reference_date"] = with_base(
        f"SELECT gsis_id, birth_date, CAST(CAST(try_strptime(birth_date, '%Y-%m-%d') AS DATE) AS VARCHAR) AS birth_date_parsed, "
        f"CAST({ref} AS VARCHAR) AS reference_date, datediff('day', CAST(try_strptime(birth_date, '%Y-%m-%d') AS DATE), {ref}) AS days, "
        f"{age_sql(str(q.RANK_SEASON), 'birth_date')} AS age FROM roster", ["age"])
    o["per_game_rates"] = with_base(
        "SELECT season, player_id, position, feat_ppg, feat_carries_pg, feat_targets_pg, feat_pass_att_pg FROM "
        f"({features_select('totals', None)})", ["feat_ppg", "feat_carries_pg", "feat_targets_pg", "feat_pass_att_pg"])
    o["age_squared"] = with_base("SELECT season, player_id, feat_age, feat_age_sq FROM features", ["feat_age", "feat_age_sq"])
    o["season_features"] = with_base(features_select("totals", None), TOTAL_DOUBLES + FEATURE_DOUBLES)
    o["feature_table"] = with_base("SELECT * FROM features", TOTAL_DOUBLES + FEATURE_DOUBLES + ["age"])
    o["ridge_fit_2feat"] = with_ridge(F2, None, coef_rows_sql(F2, None), ["coefficient"])
    o["ridge_fit_6feat"] = with_ridge(F6, None, coef_rows_sql(F6, None), ["coefficient"])
    o["ridge_holdout_metrics"] = with_ridge(
        F6, None, f"SELECT {metrics_sql('y_true', 'y_pred_ridge')} FROM ({OVERALL_TEST})", METRIC_DOUBLES)
    o["predict_season"] = with_ridge(
        F6, None, f"SELECT f.*, {prediction_sql(F6)} AS predicted_next_season_points FROM features f CROSS JOIN "
        f"{{coef}} k WHERE {not_null(['f.' + c for c in F6])} AND f.season = {q.FORECAST_SEASON}",
        TOTAL_DOUBLES + FEATURE_DOUBLES + ["age", "predicted_next_season_points"])
    o["naive_metrics"] = with_base(f"SELECT {metrics_sql()} FROM naive_test", METRIC_DOUBLES)
    o["ridge_vs_naive_predictions"] = with_ridge(F6, None, OVERALL_TEST, ["y_true", "y_pred_ridge", "y_pred_naive"])
    vs = (f"SELECT 'ridge' AS model, {metrics_sql('y_true', 'y_pred_ridge')} FROM ({OVERALL_TEST}) UNION ALL "
          f"SELECT 'naive' AS model, {metrics_sql('y_true', 'y_pred_naive')} FROM ({OVERALL_TEST})")
    o["ridge_vs_naive"] = with_ridge(F6, None, vs, METRIC_DOUBLES)
    winner = (f"SELECT metric, ridge, naive, CASE WHEN (metric = 'r2' AND ridge > naive) OR (metric <> 'r2' AND ridge < naive) "
              f"THEN 'ridge' ELSE 'naive' END AS winner FROM (SELECT 'mae' AS metric, r.mae AS ridge, n.mae AS naive FROM "
              f"_vs r, _vs n WHERE r.model = 'ridge' AND n.model = 'naive' UNION ALL SELECT 'rmse', r.rmse, n.rmse FROM "
              f"_vs r, _vs n WHERE r.model = 'ridge' AND n.model = 'naive' UNION ALL SELECT 'r2', r.r2, n.r2 FROM "
              f"_vs r, _vs n WHERE r.model = 'ridge' AND n.model = 'naive')")
    o["model_winner"] = with_ridge(F6, None, f"WITH _vs AS ({vs}) {winner}", ["ridge", "naive"])
    o["ridge_by_position_coefs_2feat"] = with_ridge(
        F2, "position", coef_rows_sql(F2, "position").replace("FROM {coef}", f"FROM {{coef}} WHERE position IN {POS5}"),
        ["coefficient"])
    o["ridge_by_player_coefs"] = with_ridge(F2, "player_id", coef_rows_sql(F2, "player_id"), ["coefficient"])
    o["ridge_by_player_metrics"] = with_ridge(
        F2, "player_id", f"SELECT position, {metrics_sql()} FROM (SELECT c.position, CAST(c.{T} AS DOUBLE) AS y_true, {prediction_sql(F2)} AS y_pred "
        f"FROM clean c JOIN {{coef}} k ON c.player_id = k.player_id WHERE c.season > {TE}) GROUP BY position", METRIC_DOUBLES)
    o["run_reports"] = with_base(
        "SELECT 'null_age' AS report, count(*) AS total, count(*) FILTER (WHERE age IS NULL) AS n FROM features UNION ALL "
        "SELECT 'with_age', count(*), count(*) FILTER (WHERE age IS NOT NULL) FROM features UNION ALL "
        f"SELECT 'dropped', count(*), count(*) FILTER (WHERE {any_null}) FROM supervised", [])
    o["ridge_by_position_metrics"] = with_ridge(F6, "position", rollup_metrics_sql(POS_PRED), METRIC_DOUBLES)
    o["slice_top_n_per_position"] = with_ridge(
        F6, "position", f"SELECT position, {metrics_sql()} FROM (SELECT *, row_number() OVER (PARTITION BY position "
        f"ORDER BY {exact('y_true')} DESC, player_id, season) AS _rn FROM ({POS_PRED})) WHERE _rn <= {q.TOP_N} "
        f"GROUP BY position", METRIC_DOUBLES)
    o["slice_top_n_overall"] = with_ridge(
        F6, "position", f"SELECT {metrics_sql()} FROM (SELECT * FROM ({POS_PRED}) ORDER BY {exact('y_true')} DESC, "
        f"player_id, season LIMIT 100) HAVING count(*) > 0", METRIC_DOUBLES)
    o["spearman_by_position"] = with_ridge(
        F6, "position", f"SELECT position, count(*) AS n, {pearson_sql('_ra', '_rp')} AS spearman FROM "
        f"(SELECT position, {avg_rank_sql('y_true')} AS _ra, {avg_rank_sql('y_pred')} AS _rp FROM ({POS_PRED})) "
        f"GROUP BY position", ["spearman"])
    o["baseline_top_n"] = with_base(ranking_sql("totals_rank", "fantasy_points", q.TOP_N), ["fantasy_points"])
    o["forecast_next_season"] = with_ridge(F6, None, FORECAST_BODY, ["feat_age", "feat_points", FORECAST_COL])
    o["forecast_top10"] = with_ridge(
        F6, None, f"SELECT * FROM ({FORECAST_BODY}) ORDER BY {exact(FORECAST_COL)} DESC, player_id LIMIT 10",
        ["feat_age", "feat_points", FORECAST_COL])
    o["forecast_pipeline"] = pipeline_sql()
    return o


def pipeline_sql() -> str:
    """All metric tables of one run: the overall and the per-position models side by side."""
    overall, coef = ridge_ctes("clean", F6, None, "r")
    by_position, pos_coef = ridge_ctes("clean", F6, "position", "p")
    test = OVERALL_TEST.replace("{coef}", coef)
    preds = POS_PRED.replace("{coef}", pos_coef)
    names = "n, mae, rmse, r2, CAST(NULL AS DOUBLE) AS spearman"
    body = " UNION ALL ".join([
        f"SELECT 'ridge_vs_naive' AS section, 'ridge' AS name, {names} FROM (SELECT {metrics_sql('y_true', 'y_pred_ridge')} FROM _test)",
        f"SELECT 'ridge_vs_naive', 'naive', {names} FROM (SELECT {metrics_sql('y_true', 'y_pred_naive')} FROM _test)",
        f"SELECT 'position', position, {names} FROM ({rollup_metrics_sql('SELECT * FROM _preds')})",
        f"SELECT 'top_per_position', position, {names} FROM (SELECT position, {metrics_sql()} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY position ORDER BY y_true DESC, player_id, season) AS _rn FROM _preds) WHERE _rn <= {q.TOP_N} GROUP BY position)",
        f"SELECT 'top_overall', 'ALL', {names} FROM (SELECT {metrics_sql()} FROM (SELECT * FROM _preds ORDER BY y_true DESC, "
        f"player_id, season LIMIT 100) HAVING count(*) > 0)",
        f"SELECT 'spearman', position, n, NULL, NULL, NULL, spearman FROM (SELECT position, count(*) AS n, {pearson_sql('_ra', '_rp')} "
        f"AS spearman FROM (SELECT position, {avg_rank_sql('y_true')} AS _ra, {avg_rank_sql('y_pred')} AS _rp FROM _preds) GROUP BY position)",
        f"SELECT 'forecast', 'rows', count(*), NULL, NULL, NULL, NULL FROM ({FORECAST_BODY.replace('{coef}', coef)})",
    ])
    base = BASE.replace("features AS (SELECT *,", "features_raw AS (SELECT *,", 1).replace(
        "supervised AS (", f"features AS (SELECT * EXCLUDE (feat_points), {exact('feat_points')} AS feat_points FROM features_raw),\nsupervised AS (", 1)
    return (f"{base}{overall}{by_position}, _test AS MATERIALIZED ({test}), _preds AS MATERIALIZED ({preds})\n"
            f"SELECT * FROM ({rounded(body, ['mae', 'rmse', 'r2', 'spearman'])}) _o")


ORACLES: dict[str, str] = build()
