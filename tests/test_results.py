from __future__ import annotations

from datetime import timezone

import pytest

from knownby.operators import results as R
from knownby.sources.text_lines import read_numbered_lines

MODERN = """= Some League 2024/25

# Date       Fri Aug 16 2024 - Sun May 25 2025 (282d)

▪ Matchday 1
  Fri Aug 16 2024
    20:00  Red United FC      v Blue FC                1-0 (0-0)
  Sat Aug 17
    15:00  Green FC           v Grey FC                2-0 (1-0)
           Gold FC            v Pink FC                0-3 (0-1)

▪ Matchday 20
  Wed Jan 1
    15:00  Team A             v Team B                 0-0
"""
LEGACY = """# Date       Sat Aug 19 2000 - Sat May 19 2001 (273d)

▪ Matchday 1
Sat Aug 19
  15:00  Oak Athletic        4-0 (2-0)  Elm City
         Ash FC              4-2 (1-0)  Fir United
Mon Jan 1
  15:00  Team A                   0-0  Team B
"""


def lines(spark, **files):
    rows = [(f, n, t) for f, text in files.items() for n, t in enumerate(text.splitlines(), start=1)]
    return spark.createDataFrame(rows, "file string, line_number long, text string")


@pytest.mark.parametrize("block", [2, 5, 65_536])
def test_state_is_carried_whatever_the_block_size(spark, block):
    state = R.carried_state(R.classify_lines(lines(spark, new=MODERN, old=LEGACY)), block)
    got = {
        (r.file, r.source_line_number): (
            r.matchday, r.date_local, r.kickoff_local, r.event_time_utc.astimezone(timezone.utc).strftime("%m-%d %H:%M"),
            r.home_team, r.away_team, r.home_goals, r.away_goals, r.home_ht_goals, r.away_ht_goals, r.source_line_format,
        )
        for r in R.match_rows(state, "Europe/London").collect()
    }
    assert got == {
        ("new", 7): (1, "2024-08-16", "20:00", "08-16 19:00", "Red United FC", "Blue FC", 1, 0, 0, 0, "HOME_V_AWAY_SCORE"),
        ("new", 9): (1, "2024-08-17", "15:00", "08-17 14:00", "Green FC", "Grey FC", 2, 0, 1, 0, "HOME_V_AWAY_SCORE"),
        ("new", 10): (1, "2024-08-17", "15:00", "08-17 14:00", "Gold FC", "Pink FC", 0, 3, 0, 1, "HOME_V_AWAY_SCORE"),
        ("new", 14): (20, "2025-01-01", "15:00", "01-01 15:00", "Team A", "Team B", 0, 0, None, None, "HOME_V_AWAY_SCORE"),
        ("old", 5): (1, "2000-08-19", "15:00", "08-19 14:00", "Oak Athletic", "Elm City", 4, 0, 2, 0, "HOME_SCORE_AWAY"),
        ("old", 6): (1, "2000-08-19", "15:00", "08-19 14:00", "Ash FC", "Fir United", 4, 2, 1, 0, "HOME_SCORE_AWAY"),
        ("old", 8): (1, "2001-01-01", "15:00", "01-01 15:00", "Team A", "Team B", 0, 0, None, None, "HOME_SCORE_AWAY"),
    }
    assert R.line_violations(state).count() == 0
    summary = {r.file: (r.match_count, r.team_count) for r in R.file_summary(R.match_rows(state, "Europe/London")).collect()}
    assert summary == {"new": (4, 8), "old": (3, 6)}


def test_unusable_lines_are_named(spark):
    text = "  15:00  A  v B  1-0\nSat Aug 19\n▪ Matchday 1\n# Date  Fri Aug 16 2024 - Sun May 25 2025\nSat Feb 30\n  15:00 A v B 1-0\nSat Xyz 1\nSat Mar 2\n  A v B 1-0"
    state = R.carried_state(R.classify_lines(lines(spark, f=text)))
    assert {r.line_number: r.code for r in R.line_violations(state).collect()} == {
        1: "MATCH_BEFORE_MATCHDAY", 2: "YEAR_UNKNOWN", 5: "IMPOSSIBLE_DATE", 7: "UNSUPPORTED_MONTH", 9: "NO_KICKOFF_TIME",
    }


def test_files_are_numbered_across_splits(spark, tmp_path):
    texts = {"a.txt": "".join(f"line {i}\r\n" if i % 3 else f"x{i}\x0by{i}\n" for i in range(400)), "b.txt": MODERN}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = read_numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, text in texts.items():
        got = {r.line_number: r.text for r in found if r.file.endswith(name)}
        assert got == dict(enumerate(text.splitlines(), start=1))


def test_count_and_duplicate_checks(spark):
    state = R.carried_state(R.classify_lines(lines(spark, new=MODERN + "    15:00  Team A  v Team B  0-0\n")))
    matches = R.match_rows(state, "Europe/London")
    assert [r.n for r in R.duplicate_matches(matches).collect()] == [2]
    expected = spark.createDataFrame([("new", 4), ("absent", 1)], "file string, expected_matches long")
    assert {r.file: r.found_matches for r in R.match_count_violations(matches, expected).collect()} == {"new": 5, "absent": 0}
