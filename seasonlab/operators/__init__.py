"""DataFrame -> DataFrame operators (scoring, aggregation, ranking, features, models)."""

from seasonlab.operators.aggregate import season_totals, sum_nulls_as_zero, sum_or_zero, validate_weekly_schema
from seasonlab.operators.dataset import build_next_season_dataset, split_seasons, time_split
from seasonlab.operators.evaluation import spearman_rank_by_position, top_n_overall_metrics, top_n_per_position_metrics
from seasonlab.operators.features import (
    attach_roster_age,
    build_season_features,
    derive_season_age,
    join_age_to_features,
)
from seasonlab.operators.metrics import metrics_with_overall, pearson_by_group, regression_metrics
from seasonlab.operators.ranking import (
    PLAYER_POSITIONS,
    RANKING_POSITIONS,
    average_rank,
    ranked,
    rank_table,
    filter_positions,
    first_n_per_group,
    top_n_by_position,
    with_dense_rank,
)
from seasonlab.operators.ridge import (
    GroupedRidge,
    RidgeModel,
    compare_ridge_to_naive,
    fit_overall_and_by_group,
    holdout_metrics,
    model_winner,
    predict_for_season,
    train_ridge,
    train_ridge_by_group,
    train_ridge_by_position,
)
from seasonlab.operators.rules import LeagueScores, rules_of, score_by_rules
from seasonlab.operators.scoring import (
    Scoring,
    add_fantasy_points,
    add_weekly_points,
    add_weekly_points_all_modes,
    add_weekly_points_by_mode_column,
    get_scoring_rules,
    normalize_scoring_mode,
    normalize_scoring_provider,
    scoring_from_mode,
)

__all__ = [name for name in dir() if not name.startswith("_")]
