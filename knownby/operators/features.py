"""Point-in-time team features and season-blocked folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownby.operators.scans import carried_before, depth_blocks, rolling_before, trailing_time


def team_matches(matches: DataFrame) -> DataFrame:
    """Two rows per match, one per side, from the side's own view."""
    h, a = F.col("home_goals"), F.col("away_goals")

    def side(team: str, other: str, scored, conceded, venue: str):
        points = F.when(scored > conceded, 3).when(scored == conceded, 1).otherwise(0)
        return F.struct(
            F.col(team).alias("team"), F.col(other).alias("opponent"), F.lit(venue).alias("venue"),
            scored.alias("goals_for"), conceded.alias("goals_against"), points.alias("points"),
        )

    sides = F.array(side("home_team", "away_team", h, a, "HOME"), side("away_team", "home_team", a, h, "AWAY"))
    return matches.select("season", "match_id", "event_time", F.inline(sides))


def form_features(teams: DataFrame, window: int, congestion_days: int, block_rows: int = 65_536) -> DataFrame:
    """Form over the last ``window`` matches, rest days and congestion: earlier matches only.

    Earlier is strictly before the instant: of matches that begin together none knows another.
    The order of a team's matches is (event_time, match_id); a team's history is cut into
    blocks of about ``block_rows`` matches for the running count.
    """
    blocked = depth_blocks(teams, ["team"], "event_time", block_rows, "_block")
    formed = rolling_before(
        blocked, ["team"], "_block", ["event_time", "match_id"], window,
        {
            "form_matches": F.count(F.lit(1)),
            "form_points": F.sum("points"),
            "form_goals_for": F.sum("goals_for"),
            "form_goals_against": F.sum("goals_against"),
            "form_home_points": F.sum(F.when(F.col("venue") == "HOME", F.col("points"))),
            "form_away_points": F.sum(F.when(F.col("venue") == "AWAY", F.col("points"))),
            "previous_match_at": F.max("event_time"),
        },
    ).drop("_block")
    formed = _as_first_of_instant(formed, ["team"], [c for c in formed.columns if c not in teams.columns])
    rested = formed.withColumn(
        "rest_days",
        (F.unix_micros("event_time") - F.unix_micros("previous_match_at")) / F.lit(86_400_000_000.0),
    ).drop("previous_match_at")
    return trailing_time(
        rested, ["team"], "event_time", congestion_days, {"recent_matches": F.count(F.lit(1))}
    )


def _as_first_of_instant(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """What the first match of an instant has before it holds for all matches of that instant."""
    together = Window.partitionBy(*group, "event_time").orderBy("match_id")
    return df.withColumns({c: F.first(c).over(together) for c in columns})


def table_before(teams: DataFrame, block_rows: int = 65_536) -> DataFrame:
    """Season points, goal difference and games played strictly before every match of a team."""
    blocked = depth_blocks(teams, ["season", "team"], "event_time", block_rows, "_block").withColumn(
        "_goal_difference", F.col("goals_for") - F.col("goals_against")
    ).withColumn("_one", F.lit(1))
    added = carried_before(
        blocked, ["season", "team"], "_block", ["event_time", "match_id"],
        {
            "season_points": ("points", "sum"),
            "season_goal_difference": ("_goal_difference", "sum"),
            "season_games": ("_one", "sum"),
        },
    ).drop("_block", "_goal_difference", "_one")
    added = _as_first_of_instant(added, ["season", "team"], [c for c in added.columns if c not in teams.columns])
    return added.na.fill(0, ["season_points", "season_goal_difference", "season_games"])


def walk_forward_folds(
    matches: DataFrame, season: str, train: int | None, validation: int, calibration: int, evaluation: int
) -> DataFrame:
    """(fold_id, role, season, rows): the split manifest of season-blocked folds.

    ``train`` None expands over all earlier seasons; a number rolls over the latest ones.
    Seasons are few and are counted before anything else happens; nothing is shuffled.
    """
    counted = matches.groupBy(season).agg(F.count(F.lit(1)).alias("rows"))
    ordinals = counted.select(
        F.row_number().over(_all_seasons(season)).alias("n"),
        F.count(F.lit(1)).over(_all_seasons(season, whole=True)).alias("seasons"),
        season, "rows",
    )
    later = validation + calibration + evaluation
    first = 1 if train is None else train
    # Fold f trains up to season f; it exists while all later blocks fit.
    folds = ordinals.select(
        "*",
        F.explode(
            F.when(
                F.col("seasons") - later >= first,
                F.sequence(F.lit(first), (F.col("seasons") - later).cast("int")),
            )
        ).alias("fold_id"),
    )
    gap = F.col("n") - F.col("fold_id")
    in_train = gap <= 0 if train is None else (gap <= 0) & (gap > -train)
    role = (
        F.when(in_train, "TRAIN")
        .when((gap > 0) & (gap <= validation), "VALIDATION")
        .when((gap > validation) & (gap <= validation + calibration), "CALIBRATION")
        .when((gap > validation + calibration) & (gap <= later), "EVALUATION")
    )
    return folds.withColumn("role", role).filter("role is not null").select("fold_id", "role", season, "rows")


def _all_seasons(season: str, whole: bool = False):
    ordered = Window.partitionBy(F.lit(1)).orderBy(season)
    return ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing) if whole else ordered
