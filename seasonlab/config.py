"""Scoring configuration from the environment (optionally a ``.env`` file).

``FANTASY_SCORING`` (PPR, HALF_PPR, STANDARD; default PPR) and
``SCORING_PROVIDER`` (ESPN, YAHOO; default ESPN), trimmed and upper-cased;
anything else is rejected.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from seasonlab.operators.scoring import (
    DEFAULT_MODE,
    DEFAULT_PROVIDER,
    Scoring,
    normalize_scoring_mode,
    normalize_scoring_provider,
    scoring_from_mode,
)

MODE_VAR = "FANTASY_SCORING"
PROVIDER_VAR = "SCORING_PROVIDER"


@dataclass(frozen=True)
class ScoringConfig:
    fantasy_scoring: str = DEFAULT_MODE
    scoring_provider: str = DEFAULT_PROVIDER

    def scoring(self) -> Scoring:
        return scoring_from_mode(self.fantasy_scoring, self.scoring_provider)


def read_env_file(path: str) -> dict[str, str]:
    """KEY=VALUE lines of a ``.env`` file (comments, blanks and ``export`` allowed)."""
    values: dict[str, str] = {}
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if not line or line.startswith("#") or "=" not in line:
                continue
            key, _, value = line.removeprefix("export ").partition("=")
            values[key.strip()] = value.strip().strip("'\"")
    return values


def load_config(*, dotenv_path: str | None = None, env: Mapping[str, str] | None = None) -> ScoringConfig:
    """Mode and provider from ``env`` (default ``os.environ``); a ``.env`` file
    only fills variables the environment does not set."""
    values = dict(read_env_file(dotenv_path)) if dotenv_path and os.path.exists(dotenv_path) else {}
    values.update(os.environ if env is None else env)
    return ScoringConfig(normalize_scoring_mode(values.get(MODE_VAR, DEFAULT_MODE)),
                         normalize_scoring_provider(values.get(PROVIDER_VAR, DEFAULT_PROVIDER)))
