"""Result lines, landed payloads and source manifests derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.operators import results as R
from knownby.operators.rules import violation_rows
from knownby.plans.registry import Tables, query
from knownby.sources import landing as L

# Every event is one line of one of three files; the line kind follows from its number.
_LINE = r"""CASE
  WHEN k % 97 = 0 THEN 'Goals: none'
  WHEN k % 400 = 0 THEN '# Date       Fri Aug 16 ' || (2000 + (k // 400) % 20) || ' - Sun May 25 2030 (282d)'
  WHEN k % 40 = 1 THEN '▪ Matchday ' || ((k // 40) % 38 + 1)
  WHEN k % 8 = 2 THEN '  Sat ' || MONTH || ' ' || ((k // 8) % 30 + 1) || CASE WHEN (k // 8) % 30 = 7 THEN ' ' || (2010 + (k // 8) % 10) ELSE '' END
  WHEN k % 2 = 0 AND k % 101 = 5 THEN '    15:00     v Côte ' || (user_id + 1) || '   ' || SCORE || HALF
  ELSE CASE WHEN k % 2 = 0 THEN '    ' || TIME || 'Team ' || user_id || ' FC  v Côte ' || (user_id + 1) || '   ' || SCORE || HALF
       ELSE '    ' || TIME || 'Team ' || user_id || ' FC   ' || SCORE || HALF || '  Côte ' || (user_id + 1) END END"""
_TIME = "CASE WHEN k % 8 = 3 OR k % 5 = 0 THEN (k % 10 + 10) || ':' || CASE WHEN k % 4 < 2 THEN '00' ELSE '30' END || '  ' ELSE '' END"
_SCORE = "(k % 5) || '-' || (k % 4)"
_HALF = "CASE WHEN k % 3 = 0 THEN ' (' || (k % 2) || '-0)' ELSE '' END"


def _line(engine: str) -> str:
    months = "'Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec','Abc'"
    index = "CASE WHEN k % 1600 = 802 THEN 13 ELSE (k // 8) % 12 + 1 END"
    array = f"element_at(array({months}), int({index}))" if engine == "spark" else f"([{months}])[{index}]"
    text = _LINE.replace("MONTH", array).replace("TIME", _TIME).replace("SCORE", _SCORE).replace("HALF", _HALF)
    return text.replace("//", "div") if engine == "spark" else text


def result_lines(t: Tables) -> DataFrame:
    base = t.events.selectExpr("event_id", "user_id", "event_id div 3 AS k")
    return base.select(
        F.concat(F.lit("file-"), (F.col("event_id") % 3).cast("string")).alias("file"),
        F.col("event_id").alias("line_number"),
        F.expr(_line("spark")).alias("text"),
    )


_STATE = (
    "WITH l AS (SELECT event_id, user_id, event_id // 3 AS k, 'file-' || event_id % 3 AS file FROM events), "
    "tx AS (SELECT *, " + _line("duckdb") + " AS text FROM l),"
    + r"""
kd AS (SELECT *, CASE WHEN text LIKE '# Date%' THEN 'H' WHEN text LIKE '▪%' THEN 'M' WHEN regexp_matches(text, '^  Sat ') THEN 'D'
         WHEN text LIKE '    %' THEN 'X' END AS kind FROM tx),
pa AS (SELECT *, CASE WHEN kind = 'H' THEN 2000 + (k // 400) % 20 WHEN kind = 'D' AND (k // 8) % 30 = 7 THEN 2010 + (k // 8) % 10 END AS anchor,
         CASE WHEN kind = 'D' AND k % 1600 <> 802 THEN (k // 8) % 12 + 1 END AS mon, CASE WHEN kind = 'D' THEN (k // 8) % 30 + 1 END AS dy,
         CASE WHEN kind = 'M' THEN (k // 40) % 38 + 1 END AS md,
         kind = 'X' AND k % 2 = 0 AND k % 101 = 5 AS blank,
         CASE WHEN kind = 'X' AND k % 2 = 0 AND k % 101 = 5 THEN '15:00' WHEN kind = 'X' AND (k % 8 = 3 OR k % 5 = 0) THEN (k % 10 + 10) || ':' || CASE WHEN k % 4 < 2 THEN '00' ELSE '30' END END AS tm
       FROM kd WHERE kind IS NOT NULL),
w1 AS (SELECT *, last_value(CASE WHEN kind = 'H' THEN 0 WHEN kind = 'D' THEN mon END IGNORE NULLS) OVER
         (PARTITION BY file ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM pa),
w2 AS (SELECT *, sum(CASE WHEN kind = 'D' AND anchor IS NULL AND pm > 0 AND mon < pm THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY event_id) AS rolls FROM w1),
w3 AS (SELECT *, last_value(anchor IGNORE NULLS) OVER (PARTITION BY file ORDER BY event_id)
         + rolls - last_value(CASE WHEN anchor IS NOT NULL THEN rolls END IGNORE NULLS) OVER (PARTITION BY file ORDER BY event_id) AS yr,
         last_value(md IGNORE NULLS) OVER (PARTITION BY file ORDER BY event_id) AS matchday,
         nullif(last_value(CASE WHEN kind = 'D' THEN '' ELSE tm END IGNORE NULLS) OVER (PARTITION BY file ORDER BY event_id), '') AS kickoff_local FROM w2),
w4 AS (SELECT *, CASE WHEN kind = 'D' THEN event_id END AS dl, CASE WHEN kind = 'D' AND mon IS NOT NULL AND yr IS NOT NULL AND NOT (mon = 2 AND dy > 28 + (CASE WHEN yr % 4 = 0 THEN 1 ELSE 0 END))
         AND NOT (mon IN (4, 6, 9, 11) AND dy > 30) THEN make_date(CAST(yr AS BIGINT), mon, dy) END AS dt FROM w3),
w5 AS (SELECT *, last_value(dl IGNORE NULLS) OVER (PARTITION BY file ORDER BY event_id) AS date_line FROM w4),
w6 AS (SELECT w5.*, d.dt AS date_local FROM w5 LEFT JOIN (SELECT event_id AS dline, dt FROM w4 WHERE kind = 'D') d ON w5.date_line = d.dline),
mt AS (SELECT file, CAST(matchday AS INTEGER) AS matchday, strftime(date_local, '%Y-%m-%d') AS date_local, kickoff_local,
         strptime(strftime(date_local, '%Y-%m-%d') || ' ' || kickoff_local, '%Y-%m-%d %H:%M') AS wall,
         'Team ' || user_id || ' FC' AS home_team, 'Côte ' || (user_id + 1) AS away_team, CAST(k % 5 AS INTEGER) AS home_goals, CAST(k % 4 AS INTEGER) AS away_goals,
         CASE WHEN k % 3 = 0 THEN CAST(k % 2 AS INTEGER) END AS home_ht_goals, CASE WHEN k % 3 = 0 THEN 0 END AS away_ht_goals,
         event_id AS source_line_number, CASE WHEN k % 2 = 0 THEN 'HOME_V_AWAY_SCORE' ELSE 'HOME_SCORE_AWAY' END AS source_line_format
       FROM w6 WHERE kind = 'X' AND NOT blank AND matchday IS NOT NULL AND date_local IS NOT NULL AND kickoff_local IS NOT NULL)
"""
)


def line_state(t: Tables) -> DataFrame:
    return R.carried_state(R.classify_lines(result_lines(t)), block_lines=1024)


@query(
    "result_text_matches",
    _STATE + """SELECT * EXCLUDE (wall), 'Europe/London' AS timezone_assumption, epoch_us(wall AT TIME ZONE 'Europe/London') AS event_micros FROM mt""",
)
def result_text_matches(t: Tables) -> DataFrame:
    matches = R.match_rows(line_state(t), "Europe/London")
    return matches.withColumn("event_micros", F.unix_micros("event_time_utc")).drop("event_time_utc", "wall_time_status")


@query(
    "result_text_violations",
    _STATE + """SELECT file, event_id AS line_number, CASE WHEN kind = 'D' AND mon IS NULL THEN 'UNSUPPORTED_MONTH' WHEN kind = 'D' AND yr IS NULL THEN 'YEAR_UNKNOWN'
      WHEN kind = 'D' AND dt IS NULL THEN 'IMPOSSIBLE_DATE' WHEN kind = 'X' AND matchday IS NULL THEN 'MATCH_BEFORE_MATCHDAY'
      WHEN kind = 'X' AND date_line IS NULL THEN 'MATCH_BEFORE_DATE' WHEN kind = 'X' AND kickoff_local IS NULL THEN 'NO_KICKOFF_TIME'
      WHEN blank THEN 'EMPTY_TEAM_NAME' END AS code FROM w6
      WHERE code IS NOT NULL""",
)
def result_text_violations(t: Tables) -> DataFrame:
    return R.line_violations(line_state(t))


@query(
    "result_file_summary",
    _STATE + """, tm AS (SELECT file, home_team AS team FROM mt UNION SELECT file, away_team FROM mt)
      SELECT file, count(*) AS match_count, count(*) FILTER (source_line_format = 'HOME_V_AWAY_SCORE') AS home_v_away_score,
        count(*) FILTER (source_line_format = 'HOME_SCORE_AWAY') AS home_score_away, any_value(tc) AS team_count
      FROM mt JOIN (SELECT file, count(*) AS tc FROM tm GROUP BY file) USING (file) GROUP BY file""",
)
def result_file_summary(t: Tables) -> DataFrame:
    return R.file_summary(R.match_rows(line_state(t), "Europe/London"))


@query(
    "result_duplicate_matches",
    _STATE + """SELECT file, epoch_us(wall AT TIME ZONE 'Europe/London') AS event_micros, home_team, away_team, count(*) AS n FROM mt GROUP BY ALL HAVING count(*) > 1""",
)
def result_duplicate_matches(t: Tables) -> DataFrame:
    found = R.duplicate_matches(R.match_rows(line_state(t), "Europe/London"))
    return found.select("file", F.unix_micros("event_time_utc").alias("event_micros"), "home_team", "away_team", "n")


@query(
    "result_match_count_check",
    _STATE + """, e AS (SELECT file, count(*) AS expected_matches FROM kd WHERE kind = 'X' OR file = 'file-9' GROUP BY file), c AS (SELECT file, count(*) AS n FROM mt GROUP BY file)
      SELECT e.file, expected_matches, coalesce(n, 0) AS found_matches FROM e LEFT JOIN c ON e.file = c.file WHERE expected_matches <> coalesce(n, 0)""",
)
def result_match_count_check(t: Tables) -> DataFrame:
    """Expectation: every match-looking line counts; lines that lack state must show up."""
    state = line_state(t)
    expected = state.filter("kind in ('MODERN', 'LEGACY')").groupBy("file").agg(F.count(F.lit(1)).alias("expected_matches"))
    return R.match_count_violations(R.match_rows(state, "Europe/London"), expected)


# ---- landing --------------------------------------------------------------------------


def _responses(t: Tables) -> DataFrame:
    i = F.col("page_id")
    body = F.when(i % 3 == 0, F.concat(F.lit('{"id":'), i.cast("string"), F.lit("}"))).otherwise(F.col("html"))
    at = F.timestamp_micros(F.lit(1_704_067_200_000_000) + i * 1_000_000)
    return t.pages.select(
        i.alias("page_id"), F.lit("provider-a").alias("provider"), F.concat(F.lit("probe-"), i.cast("string")).alias("probe_name"),
        at.alias("requested_at"), at.alias("received_at"), F.concat("url", F.lit("")).alias("request_url"),
        F.lit(200).alias("http_status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Set-Cookie"), F.lit("x=1"), F.lit("ETag"), i.cast("string")).alias("headers"),
        F.encode(body, "utf-8").alias("content"),
    )


@query(
    "raw_payload_landing",
    """WITH b AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '{"id":' || page_id || '}' ELSE html END AS body FROM pages)
      SELECT 'probe-' || page_id AS probe_name, sha256(body) AS payload_sha256, CAST(strlen(body) AS BIGINT) AS payload_bytes,
        CASE WHEN page_id % 3 = 0 THEN 'JSON' ELSE 'TEXT' END AS payload_kind, 'Content-Type=text/html,ETag=' || page_id AS headers,
        false AS canonical_known_at_assigned FROM b""",
)
def raw_payload_landing(t: Tables) -> DataFrame:
    headers = F.array_join(
        F.array_sort(F.transform(F.map_entries("selected_response_headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ","
    )
    return L.land(_responses(t)).select(
        "probe_name", "payload_sha256", "payload_bytes", "payload_kind", headers.alias("headers"), "canonical_known_at_assigned"
    )


@query(
    "capture_metadata_gate",
    """SELECT 'probe-' || page_id AS probe_name, code, field FROM (
        SELECT page_id, 'NOT_RESEARCH_ONLY' AS code, 'research_only' AS field FROM pages WHERE page_id % 5 IN (0, 1)
        UNION ALL SELECT page_id, 'KNOWN_AT_ASSIGNED', 'canonical_known_at_assigned' FROM pages WHERE page_id % 7 IN (0, 1)
        UNION ALL SELECT page_id, 'MISSING_FIELD', 'payload_file' FROM pages WHERE page_id % 11 = 0)""",
)
def capture_metadata_gate(t: Tables) -> DataFrame:
    i = F.expr("cast(substring(probe_name, 7) as bigint)")
    meta = L.land(_responses(t)).select(
        "*",
        F.when(i % 11 != 0, F.concat("probe_name", F.lit(".json"))).alias("payload_file"),
    ).withColumn("research_only", F.when(i % 5 == 0, False).when(i % 5 != 1, True)).withColumn(
        "canonical_known_at_assigned", F.when(i % 7 == 0, True).when(i % 7 != 1, False)
    )
    return violation_rows(meta, L.metadata_rules(), ["probe_name"])


@query(
    "source_manifest_comparison",
    r"""WITH f AS (SELECT doc_id, 'doc/' || doc_id AS path, sha1(encode('blob ' || strlen(text)) || '\x00'::BLOB || encode(text)) AS sha FROM documents),
      m AS (SELECT path, CASE WHEN doc_id % 10 = 1 THEN repeat('0', 40) ELSE sha END AS sha FROM f WHERE doc_id % 10 <> 0
            UNION ALL SELECT 'old/' || doc_id, sha FROM f WHERE doc_id % 10 = 2)
      SELECT coalesce(f.path, m.path) AS path, f.sha AS found_sha, m.sha AS recorded_sha,
        CASE WHEN f.sha IS NULL THEN 'MISSING' WHEN m.sha IS NULL THEN 'EXTRA' WHEN f.sha <> m.sha THEN 'CHANGED' ELSE 'OK' END AS status
      FROM f FULL JOIN m ON f.path = m.path""",
)
def source_manifest_comparison(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    found = t.documents.select(
        i, F.concat(F.lit("doc/"), i.cast("string")).alias("path"), L.blob_sha1(F.encode("text", "utf-8")).alias("sha")
    )
    recorded = found.filter(i % 10 != 0).select(
        "path", F.when(i % 10 == 1, "0" * 40).otherwise(F.col("sha")).alias("sha")
    ).union(found.filter(i % 10 == 2).select(F.concat(F.lit("old/"), i.cast("string")), "sha"))
    return L.compare_to_manifest(found, recorded)
