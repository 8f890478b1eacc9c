"""Result lines -> match rows: line patterns, carried state and their violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownby.functions.timeops import localize_lenient, localize_strict
from knownby.operators.scans import number_block

# The published line format.
_DAY = r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)"
HEADER = rf"(?U)^# Date\s+{_DAY}\s+[A-Z][a-z]{{2}}\s+\d{{1,2}}\s+(\d{{4}})\s+-\s+{_DAY}\s+[A-Z][a-z]{{2}}\s+\d{{1,2}}\s+\d{{4}}"
DATE = rf"(?U)^\s*{_DAY}\s+([A-Z][a-z]{{2}})\s+(\d{{1,2}})(?:\s+(\d{{4}}))?\s*$"
MATCHDAY = r"(?U)^▪\s+Matchday\s+(\d+)\s*$"
_TIME, _SCORE, _HALF = r"(?:(\d{1,2}:\d{2})\s+)?", r"(\d+)-(\d+)", r"(?:\s+\((\d+)-(\d+)\))?"
MODERN = rf"(?U)^\s+{_TIME}(.+?)\s+v\s+(.+?)\s+{_SCORE}{_HALF}\s*$"
LEGACY = rf"(?U)^\s+{_TIME}(.+?)\s+{_SCORE}{_HALF}\s+(.+?)\s*$"
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


_SEP = "\x01"
# Kind, pattern, and its groups in the order: time, home, away, goals, half-time goals.
_KINDS = (
    ("HEADER", HEADER + ".*$", (1,)),
    ("MATCHDAY", MATCHDAY, (1,)),
    ("DATE", DATE, (1, 2, 3)),
    ("MODERN", MODERN, (1, 2, 3, 4, 5, 6, 7)),
    ("LEGACY", LEGACY, (1, 2, 7, 3, 4, 5, 6)),
)


def _once(*columns: Column) -> Column:
    """Generate the columns: they are computed once per row, whatever reads them later."""
    return F.inline(F.array(F.struct(*columns)))


def month_number(name: Column) -> Column:
    position = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    return F.when(position > 0, position.cast("int"))


def classify_lines(lines: DataFrame) -> DataFrame:
    """lines(file, line_number, text) -> the fields every kind of line carries.

    A line is a header, else a matchday, else a date, else a match (modern form first).
    Other lines carry nothing and are dropped.
    """
    stripped = F.regexp_replace("text", r"(?U)[\s\x1c-\x1f]+$", "")
    base = lines.select("file", "line_number", _once(stripped.alias("line")))
    line = F.col("line")
    parts = F.lit(None).cast("array<string>")
    for kind, pattern, groups in reversed(_KINDS):
        picked = kind + _SEP + _SEP.join(f"${g}" for g in groups)
        parts = F.when(
            line.rlike(pattern), F.split(F.regexp_replace(line, pattern, picked), _SEP, -1)
        ).otherwise(parts)
    found = base.select("file", "line_number", _once(parts.alias("parts"))).filter("parts is not null")
    kind = F.col("parts")[0]

    def part(index: int, *kinds: str) -> Column:
        return F.when(kind.isin(*kinds), F.nullif(F.get("parts", F.lit(index)), F.lit("")))

    def number(index: int, *kinds: str) -> Column:
        return part(index, *kinds).try_cast("int")

    match = ("MODERN", "LEGACY")

    def team(index: int) -> Column:
        """Without outer white space of any kind; a blank name is null and a violation."""
        return F.nullif(F.regexp_replace(part(index, *match), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""), F.lit(""))

    return found.select(
        "file",
        "line_number",
        kind.alias("kind"),
        number(1, "HEADER").alias("header_year"),
        number(1, "MATCHDAY").alias("matchday_line"),
        month_number(part(1, "DATE")).alias("month"),
        number(2, "DATE").alias("day"),
        number(3, "DATE").alias("date_year"),
        part(1, *match).alias("time"),
        team(2).alias("home_team"),
        team(3).alias("away_team"),
        number(4, *match).alias("home_goals"),
        number(5, *match).alias("away_goals"),
        number(6, *match).alias("home_ht_goals"),
        number(7, *match).alias("away_ht_goals"),
    )


def carried_state(classified: DataFrame, block_lines: int = 65_536) -> DataFrame:
    """Matchday, date and kickoff in force at every line of its file.

    A header sets the year and forgets the month; an explicit year sets the year; any
    other date starts a new year when its month is before the previous date's month.

    A file is worked on in blocks of lines, so its size does not matter. Inside a block
    everything is relative to what enters it: a year is absolute once the block has seen an
    anchor, else it is "entering year + new years so far". Only the first date of a block
    can need the month before the block (``open``). One summary row per block is then
    scanned in order and joined back.
    """
    inside = Window.partitionBy("file", "block").orderBy("line_number")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)

    def last(column: Column | str, frame=upto) -> Column:
        return F.last(column, ignorenulls=True).over(frame)

    is_date, is_header = F.col("kind") == "DATE", F.col("kind") == "HEADER"
    plain_date = is_date & F.col("date_year").isNull()
    month, prior = F.col("month"), F.col("local_prior")
    marked = classified.select(
        "*",
        number_block(F.col("line_number"), block_lines).alias("block"),
        F.when(is_header, 0).when(is_date, month).alias("month_mark"),
        # A date line clears the kickoff: the empty text marks "nothing to inherit".
        F.when(is_date, F.lit("")).otherwise(F.col("time")).alias("time_mark"),
        F.coalesce("header_year", "date_year").alias("anchor_year"),
    ).withColumn("local_prior", last("month_mark", before))
    rolled = marked.select(
        "*",
        F.sum(F.when(plain_date & (prior > 0) & (month < prior), 1).otherwise(0)).over(upto).alias("rolls"),
        last(F.when(plain_date & prior.isNull(), month)).alias("open_month"),
    )
    anchored = rolled.withColumn(
        "local_year", last(F.col("anchor_year") - F.col("rolls")) + F.col("rolls")
    )
    local = anchored.select(
        *classified.columns, "block", "rolls", "open_month", "local_year",
        last("month_mark").alias("local_mark"),
        last("matchday_line").alias("local_matchday"),
        last("time_mark").alias("local_time"),
        last(
            F.when(
                is_date,
                F.struct("month", "day", "local_year", "rolls", F.col("open_month").isNotNull().alias("opened")),
            )
        ).alias("local_date"),
    )
    entering = _entering_state(local)
    open_roll = F.col("open_roll")
    year = F.coalesce(
        "local_year",
        F.col("enter_year") + F.col("rolls") + F.when(F.col("open_month").isNotNull(), open_roll).otherwise(0),
    )
    date = F.coalesce(_dated("local_date", "enter_year", open_roll), F.col("enter_date"))
    return (
        local.join(entering, ["file", "block"])
        .select(
            *classified.columns,
            year.alias("year"),
            F.coalesce("local_matchday", "enter_matchday").alias("matchday"),
            date.alias("date"),
            F.nullif(F.coalesce("local_time", "enter_time"), F.lit("")).alias("kickoff_local"),
        )
        .select(
            *classified.columns,
            "year",
            "matchday",
            F.try_to_date(F.format_string("%04d-%02d-%02d", "date.year", "date.month", "date.day"), "yyyy-MM-dd").alias(
                "date_local"
            ),
            F.col("date").isNotNull().alias("has_date"),
            "kickoff_local",
        )
    )


def _dated(date: str, entering_year: str, open_roll: Column) -> Column:
    """A block-relative date with its year made absolute."""
    d = F.col(date)
    relative = F.col(entering_year) + d["rolls"] + F.when(d["opened"], open_roll).otherwise(0)
    return F.when(
        d.isNotNull(),
        F.struct(
            F.coalesce(d["local_year"], relative).cast("int").alias("year"),
            d["month"].alias("month"), d["day"].alias("day"),
        ),
    )


def _entering_state(local: DataFrame) -> DataFrame:
    """(file, block) -> the state that earlier blocks hand over. Windows over block rows."""
    ends = local.groupBy("file", "block").agg(
        F.max_by(
            F.struct(
                "rolls", "open_month", "local_year", "local_mark", "local_matchday", "local_time", "local_date"
            ),
            "line_number",
        ).alias("end")
    ).select("file", "block", "end.*")
    by_block = Window.partitionBy("file").orderBy("block")
    upto = by_block.rowsBetween(Window.unboundedPreceding, 0)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)

    def entering(column: Column | str) -> Column:
        return F.last(column, ignorenulls=True).over(before)

    mark = F.col("enter_mark")
    opened = ends.withColumn("enter_mark", entering("local_mark")).withColumn(
        "open_roll", F.when((mark > 0) & (F.col("open_month") < mark), 1).otherwise(0)
    )
    summed = opened.withColumn("block_rolls", F.col("rolls") + F.col("open_roll")).withColumn(
        "all_rolls", F.sum("block_rolls").over(upto)
    )
    dated = summed.withColumn(
        "enter_year",
        entering(F.col("local_year") - F.col("all_rolls")) + F.col("all_rolls") - F.col("block_rolls"),
    ).withColumn("end_date", _dated("local_date", "enter_year", F.col("open_roll")))
    return dated.select(
        "file", "block", "open_roll", "enter_year",
        entering("local_matchday").alias("enter_matchday"),
        entering("local_time").alias("enter_time"),
        entering("end_date").alias("enter_date"),
    )


_IS_MATCH = "kind in ('MODERN', 'LEGACY')"


def match_rows(state: DataFrame, zone: str) -> DataFrame:
    """Match lines with everything in force. No canonical id and no known_at is assigned."""
    wall = F.try_to_timestamp(
        F.concat_ws(" ", F.date_format("date_local", "yyyy-MM-dd"), F.lpad("kickoff_local", 5, "0")),
        F.lit("yyyy-MM-dd HH:mm"),
    )
    _, strict = localize_strict(F.col("_wall"), F.lit(zone), F.lit(True))
    return (
        state.filter(_IS_MATCH)
        .filter("matchday is not null and date_local is not null and kickoff_local is not null")
        .filter("home_team is not null and away_team is not null")
        .withColumn("_wall", wall)
        .select(
            "file",
            "matchday",
            F.date_format("date_local", "yyyy-MM-dd").alias("date_local"),
            "kickoff_local",
            F.lit(zone).alias("timezone_assumption"),
            localize_lenient(F.col("_wall"), F.lit(zone)).alias("event_time_utc"),
            strict.alias("wall_time_status"),
            "home_team",
            "away_team",
            "home_goals",
            "away_goals",
            "home_ht_goals",
            "away_ht_goals",
            F.col("line_number").alias("source_line_number"),
            F.when(F.col("kind") == "MODERN", "HOME_V_AWAY_SCORE").otherwise("HOME_SCORE_AWAY").alias(
                "source_line_format"
            ),
        )
    )


def line_violations(state: DataFrame) -> DataFrame:
    """What makes a file unusable, as rows (file, line_number, code)."""
    is_date, is_match = F.col("kind") == "DATE", F.expr(_IS_MATCH)
    code = (
        F.when(is_date & F.col("month").isNull(), "UNSUPPORTED_MONTH")
        .when(is_date & F.col("year").isNull(), "YEAR_UNKNOWN")
        .when(is_date & F.col("date_local").isNull(), "IMPOSSIBLE_DATE")
        .when(is_match & F.col("matchday").isNull(), "MATCH_BEFORE_MATCHDAY")
        .when(is_match & ~F.col("has_date"), "MATCH_BEFORE_DATE")
        .when(is_match & F.col("kickoff_local").isNull(), "NO_KICKOFF_TIME")
        .when(is_match & (F.col("home_team").isNull() | F.col("away_team").isNull()), "EMPTY_TEAM_NAME")
    )
    return state.select("file", "line_number", code.alias("code")).filter("code is not null")


def duplicate_matches(matches: DataFrame) -> DataFrame:
    return (
        matches.groupBy("file", "event_time_utc", "home_team", "away_team")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def match_count_violations(matches: DataFrame, expected: DataFrame) -> DataFrame:
    """Files whose match count differs from ``expected`` (file, expected_matches)."""
    found = matches.groupBy("file").agg(F.count(F.lit(1)).alias("found_matches"))
    return (
        expected.join(found, "file", "left")
        .na.fill(0, ["found_matches"])
        .filter(F.col("expected_matches") != F.col("found_matches"))
    )


def teams(matches: DataFrame) -> DataFrame:
    """Distinct labels per file, home and away together."""
    home = matches.select("file", F.col("home_team").alias("team"))
    return home.union(matches.select("file", "away_team")).distinct()


def file_summary(matches: DataFrame) -> DataFrame:
    counts = matches.groupBy("file").agg(
        F.count(F.lit(1)).alias("match_count"),
        F.count(F.when(F.col("source_line_format") == "HOME_V_AWAY_SCORE", 1)).alias("home_v_away_score"),
        F.count(F.when(F.col("source_line_format") == "HOME_SCORE_AWAY", 1)).alias("home_score_away"),
    )
    labels = teams(matches).groupBy("file").agg(F.count(F.lit(1)).alias("team_count"))
    return counts.join(labels, "file")
