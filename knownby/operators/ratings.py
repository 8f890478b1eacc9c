"""Sequential Elo ratings, frozen before every update.

A rating depends on the match before it, so one competition is one ordered stream. The
stream is read in Arrow batches and only the ratings of its teams are kept: memory grows
with teams, never with matches, and competitions run in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


def elo_ratings(
    matches: DataFrame, start: float, k: float, home_advantage: float, scale: float
) -> DataFrame:
    """matches(competition, match_id, event_time, home_team, away_team, home_goals,
    away_goals) -> pre-match ratings, expected and observed score. All four parameters are
    the caller's; the expected score is not a win probability."""

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        competition, ratings = None, {}
        for batch in batches:
            out = {"home_rating": [], "away_rating": [], "expected": [], "observed": []}
            for row in batch.itertuples(index=False):
                if row.competition != competition:
                    competition, ratings = row.competition, {}
                home, away = ratings.get(row.home_team, start), ratings.get(row.away_team, start)
                expected = 1.0 / (1.0 + 10.0 ** (-(home + home_advantage - away) / scale))
                observed = 0.5 + 0.5 * ((row.home_goals > row.away_goals) - (row.home_goals < row.away_goals))
                out["home_rating"].append(home)
                out["away_rating"].append(away)
                out["expected"].append(expected)
                out["observed"].append(observed)
                ratings[row.home_team] = home + k * (observed - expected)
                ratings[row.away_team] = away - k * (observed - expected)
            yield batch[["competition", "match_id"]].assign(**out)

    ordered = (
        matches.select(
            "competition", "match_id", "event_time", "home_team", "away_team", "home_goals", "away_goals"
        )
        .repartition("competition")
        .sortWithinPartitions("competition", "event_time", "match_id")
    )
    schema = (
        f"competition {matches.schema['competition'].dataType.simpleString()}, "
        f"match_id {matches.schema['match_id'].dataType.simpleString()}, "
        "home_rating double, away_rating double, expected double, observed double"
    )
    return ordered.mapInPandas(rate, schema)
