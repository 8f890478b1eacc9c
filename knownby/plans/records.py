"""Record rules, digests, time and URL columns over the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knownby import domains as D
from knownby.functions import scalars as S
from knownby.functions import timeops, urls
from knownby.functions.canonical import canonical_json, row_digest
from knownby.operators import contracts as C
from knownby.operators.rules import Rule, violation_rows
from knownby.plans.registry import Tables, query
from knownby.sources.contract_json import strict_records


def _summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return violation_rows(df, rules, ["id"]).groupBy("code", "field").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum")
    )


def _rules_sql(source: str, rules: Sequence[tuple[str, str, str]]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{code}' AS code, '{field}' AS field, id FROM src WHERE {cond}" for code, field, cond in rules
    )
    return f"""WITH src AS ({source}) SELECT code, field, count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum
      FROM ({parts}) GROUP BY ALL"""


def _pick(number: str, values: Sequence[str | None]) -> Column:
    """values[number % len(values)] as a column."""
    column = F.col(number) % len(values)
    out = F.lit(None).cast("string")
    for i, value in enumerate(values):
        if value is not None:
            out = F.when(column == i, F.lit(value)).otherwise(out)
    return out


def _pick_sql(number: str, values: Sequence[str | None]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {number} % {len(values)} {cases} END"


# ---- digests and canonical text -------------------------------------------------------


@query(
    "record_content_digest",
    r"""SELECT doc_id, sha256('{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"lang":"' || lang || '","n_chars":'
      || CAST(n_chars AS VARCHAR) || ',"source":"' || source || '","text":"' || array_to_string(list_transform(
        string_split(text, ''), lambda c: CASE
          WHEN ord(c) = 34 THEN '\"' WHEN ord(c) = 92 THEN '\\' WHEN ord(c) = 10 THEN '\n' WHEN ord(c) = 13 THEN '\r'
          WHEN ord(c) = 9 THEN '\t' WHEN ord(c) BETWEEN 32 AND 126 THEN c
          WHEN ord(c) < 65536 THEN '\u' || format('{:04x}', ord(c))
          ELSE '\u' || format('{:04x}', 55296 + ((ord(c) - 65536) >> 10)) || '\u'
               || format('{:04x}', 56320 + ((ord(c) - 65536) & 1023)) END), '') || '"}') AS record_digest
      FROM documents""",
)
def record_content_digest(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text", "lang", "source", "n_chars")
    return docs.select("doc_id", row_digest(docs.schema).alias("record_digest"))


@query(
    "canonical_record_text",
    r"""SELECT o_orderkey, '{"at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00","open":'
      || CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END || ',"priority":'
      || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || ',"total":'
      || CAST(o_totalprice AS VARCHAR) || '}' AS canonical FROM orders""",
)
def canonical_record_text(t: Tables) -> DataFrame:
    records = t.orders.select(
        "o_orderkey",
        F.struct(
            F.col("o_totalprice").alias("total"),
            F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"),
            (F.col("o_orderstatus") == "O").alias("open"),
            F.col("o_orderdate").alias("at"),
        ).alias("record"),
    )
    return records.select("o_orderkey", canonical_json(F.col("record"), records.schema["record"].dataType).alias("canonical"))


# ---- time -----------------------------------------------------------------------------

_ZONES = ("Europe/London", "America/New_York", "Australia/Lord_Howe", "Not/AZone")


@query(
    "local_time_conversion",
    f"""WITH w AS (SELECT o_orderkey, o_orderdate + (o_orderkey % 48) * INTERVAL 30 MINUTE AS wall,
        {_pick_sql('o_orderkey', _ZONES)} AS zone FROM orders),
      k AS (SELECT *, CASE WHEN zone = 'Not/AZone' THEN 'UTC' ELSE zone END AS z FROM w),
      u AS (SELECT *, wall AT TIME ZONE z AS i FROM k),
      s AS (SELECT *, CASE WHEN zone = 'Not/AZone' THEN 'UNKNOWN_ZONE'
        WHEN (i AT TIME ZONE z) <> wall THEN 'NONEXISTENT'
        WHEN ((i + INTERVAL 1 HOUR) AT TIME ZONE z) = wall OR ((i - INTERVAL 1 HOUR) AT TIME ZONE z) = wall
          OR ((i + INTERVAL 30 MINUTE) AT TIME ZONE z) = wall OR ((i - INTERVAL 30 MINUTE) AT TIME ZONE z) = wall
        THEN 'AMBIGUOUS' ELSE 'OK' END AS status FROM u)
      SELECT o_orderkey, zone, status, CASE WHEN status = 'OK' THEN epoch_us(i) END AS utc_micros FROM s""",
)
def local_time_conversion(t: Tables) -> DataFrame:
    zones = [z for z in _ZONES if z != "Not/AZone"]
    wall = F.timestamp_micros(
        F.unix_micros("o_orderdate") + (F.col("o_orderkey") % 48) * F.lit(1_800_000_000)
    )
    rows = t.orders.select("o_orderkey", wall.alias("wall"), _pick("o_orderkey", _ZONES).alias("zone"))
    utc, status = timeops.localize_strict(F.col("wall"), F.col("zone"), F.col("zone").isin(*zones))
    return rows.select("o_orderkey", "zone", status.alias("status"), F.unix_micros(utc).alias("utc_micros"))


_STAMPS = "CASE event_id % 5 WHEN 0 THEN base || 'Z' WHEN 1 THEN base || '+02:00' WHEN 2 THEN base WHEN 3 THEN 'n/a' ELSE NULL END"


@query(
    "timestamp_text_parsing",
    f"""WITH b AS (SELECT event_id, date_trunc('second', ts) AS s, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS base FROM events),
      x AS (SELECT *, {_STAMPS} AS stamp FROM b)
      SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch_us(s) WHEN 1 THEN epoch_us(s - INTERVAL 2 HOUR) END AS any_offset,
        CASE WHEN event_id % 5 = 0 THEN epoch_us(s) END AS utc_z_only,
        CASE event_id % 5 WHEN 2 THEN 'NAIVE_DATETIME' WHEN 3 THEN 'INVALID_TIMESTAMP' END AS violation FROM x""",
)
def timestamp_text_parsing(t: Tables) -> DataFrame:
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 5
    stamp = (
        F.when(kind == 0, F.concat(base, F.lit("Z")))
        .when(kind == 1, F.concat(base, F.lit("+02:00")))
        .when(kind == 2, base)
        .when(kind == 3, "n/a")
    )
    rows = t.events.select("event_id", stamp.alias("stamp"))
    return rows.select(
        "event_id",
        F.unix_micros(timeops.text_instant(F.col("stamp"))).alias("any_offset"),
        F.unix_micros(timeops.utc_z_instant(F.col("stamp"))).alias("utc_z_only"),
        timeops.text_instant_violation(F.col("stamp")).alias("violation"),
    )


# ---- URLs -----------------------------------------------------------------------------

_PAIRS = r"""
  p AS (SELECT page_id, url, regexp_extract(url, '^([^:]+)://([^/?#]*)([^?#]*)', 1) AS scheme,
     regexp_extract(url, '^([^:]+)://([^/?#]*)([^?#]*)', 2) AS auth, regexp_extract(url, '^([^:]+)://([^/?#]*)([^?#]*)', 3) AS path,
     regexp_extract(url, '\?([^#]*)', 1) AS qs, regexp_extract(url, '#(.*)$', 1) AS frag FROM pages),
  q AS (SELECT *, CASE WHEN qs = '' THEN [] ELSE string_split(qs, '&') END AS items FROM p)"""


@query(
    "url_redaction",
    "WITH " + _PAIRS + r"""
    SELECT page_id, scheme || '://' || auth || path || CASE WHEN qs = '' THEN '' ELSE '?' || array_to_string(
        list_transform(items, lambda x: CASE WHEN split_part(x, '=', 1) IN ('ref', 'key', 'token')
          THEN split_part(x, '=', 1) || '=%2A%2A%2AREDACTED%2A%2A%2A' ELSE x END), '&') END
        || CASE WHEN frag = '' THEN '' ELSE '#' || frag END AS redacted FROM q""",
)
def url_redaction(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.redact_url(F.col("url"), ["ref"]).alias("redacted"))


@query(
    "url_hygiene",
    "WITH " + _PAIRS + r"""
    SELECT page_id, concat_ws(',', CASE WHEN scheme <> 'https' THEN 'NOT_HTTPS' END,
      CASE WHEN contains(auth, '@') THEN 'CREDENTIALS_IN_URL' END,
      CASE WHEN list_contains(list_transform(items, lambda x: split_part(x, '=', 1)), 'ref') THEN 'SENSITIVE_QUERY_KEY' END)
      AS violations FROM q""",
)
def url_hygiene(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", F.array_join(urls.url_violations(F.col("url"), ["ref"]), ",").alias("violations")
    )


@query(
    "snapshot_request_timing",
    """WITH r AS (SELECT event_id, date_trunc('second', ts) AS req,
        date_trunc('second', ts) - (event_id % 600 - 60) * INTERVAL 1 SECOND AS prov FROM events)
      SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN epoch_us(req) END AS requested_micros,
        CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 600 - 60 AS DOUBLE) END AS snapshot_lag_seconds,
        CASE WHEN event_id % 7 <> 0 THEN prov <= req END AS snapshot_not_after_request FROM r""",
)
def snapshot_request_timing(t: Tables) -> DataFrame:
    """Every 7th request carries an offset instead of Z and must be refused."""
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    stamp = F.concat(base, F.when(F.col("event_id") % 7 == 0, "%2B00%3A00").otherwise("Z"))
    url = F.concat(
        F.lit("https://provider.example/v4/history?regions=eu&date="), F.replace(stamp, F.lit(":"), F.lit("%3A"))
    )
    provider = F.timestamp_micros(
        F.unix_micros(F.date_trunc("second", "ts")) - (F.col("event_id") % 600 - 60) * F.lit(1_000_000)
    )
    rows = t.events.select(
        "event_id", urls.requested_snapshot_at(url).alias("requested"), provider.alias("provider")
    )
    return rows.select(
        "event_id",
        F.unix_micros("requested").alias("requested_micros"),
        timeops.lag_seconds(F.col("requested"), F.col("provider")).alias("snapshot_lag_seconds"),
        (F.col("provider") <= F.col("requested")).alias("snapshot_not_after_request"),
    )


# ---- small columns --------------------------------------------------------------------

_TIER_LABELS = (*D.SOURCE_TIERS, *D.LEGACY_SOURCE_TIERS, "official", "BLOG", " OFFICIAL")


@query(
    "source_tier_normalization",
    f"""WITH src AS (SELECT {_pick_sql('o_orderkey', _TIER_LABELS)} AS label FROM orders)
      SELECT label, CASE WHEN label IN ({', '.join(repr(x) for x in D.SOURCE_TIERS)}) THEN label
        WHEN label LIKE 'LICENSED %' THEN 'LICENSED_PRO' WHEN label IN ('SOCIAL', 'SOCIAL/UNVERIFIED') THEN 'SOCIAL_UNVERIFIED'
        END AS tier, CASE WHEN label IN ('official', 'BLOG', ' OFFICIAL') THEN 'UNKNOWN_SOURCE_TIER' END AS violation,
        count(*) AS rows FROM src GROUP BY ALL""",
)
def source_tier_normalization(t: Tables) -> DataFrame:
    label = _pick("o_orderkey", _TIER_LABELS).alias("label")
    tier = S.normalize_source_tier(F.col("label"))
    return (
        t.orders.select(label)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("label", tier.alias("tier"), F.when(tier.isNull(), "UNKNOWN_SOURCE_TIER").alias("violation"), "rows")
    )


@query(
    "source_version_identity",
    """SELECT source_id, revision_id, count(*) AS rows FROM (SELECT CASE WHEN l_linenumber <> 7 THEN 's' || l_suppkey % 3 END AS source_id,
       CASE WHEN l_linenumber <> 7 THEN 'r' || l_linenumber END AS revision_id FROM lineitem) GROUP BY ALL""",
)
def source_version_identity(t: Tables) -> DataFrame:
    revision = F.when(F.col("l_linenumber") != 7, F.concat(F.lit("r"), F.col("l_linenumber").cast("string")))
    source = F.concat(F.lit("s"), (F.col("l_suppkey") % 3).cast("string"))
    rows = t.lineitem.select(S.source_version(source, revision).alias("version"))
    return rows.groupBy("version").agg(F.count(F.lit(1)).alias("rows")).select(
        F.col("version.source_id"), F.col("version.revision_id"), "rows"
    )


@query(
    "market_risk_ordinals",
    """SELECT mr, CASE WHEN mr <> 'MR9' THEN CAST(substr(mr, 3) AS INTEGER) END AS ordinal, count(*) AS rows FROM
       (SELECT 'MR' || CASE WHEN p_size % 7 = 6 THEN 9 ELSE p_size % 7 + 1 END AS mr FROM part) GROUP BY ALL""",
)
def market_risk_ordinals(t: Tables) -> DataFrame:
    digit = F.when(F.col("p_size") % 7 == 6, 9).otherwise(F.col("p_size") % 7 + 1)
    rows = t.part.select(F.concat(F.lit("MR"), digit.cast("string")).alias("mr"))
    return rows.groupBy("mr").agg(F.count(F.lit(1)).alias("rows")).select(
        "mr", S.risk_ordinal(F.col("mr")).alias("ordinal"), "rows"
    )


@query(
    "market_edges",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount * 5 - l_tax * 4 AS edge_calibrated,
       l_discount * 4 - l_tax * 4 AS edge_safe FROM lineitem""",
)
def market_edges(t: Tables) -> DataFrame:
    market = F.col("l_tax") * 4
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        S.edge(F.col("l_discount") * 5, market).alias("edge_calibrated"),
        S.edge(F.col("l_discount") * 4, market).alias("edge_safe"),
    )


@query(
    "classification_bands",
    """SELECT CASE WHEN p >= 0.85 THEN 'P90' WHEN p >= 0.75 THEN 'P80' WHEN p >= 0.65 THEN 'P70' WHEN p >= 0.6 THEN 'P60'
        WHEN p >= 0.5 THEN 'P50' WHEN p >= 0.4 THEN 'P40' WHEN p >= 0.25 THEN 'P25' ELSE 'Reject' END AS p_band,
       CASE WHEN r < 2 THEN 'R1' WHEN r < 3 THEN 'R2' WHEN r < 5 THEN 'R3' WHEN r < 10 THEN 'R4' WHEN r < 20 THEN 'R5' ELSE 'R6' END AS r_band,
       CASE WHEN n < 2 THEN NULL WHEN n <= 5 THEN 'L1' WHEN n <= 7 THEN 'L2' WHEN n <= 10 THEN 'L3' WHEN n <= 15 THEN 'L4'
        WHEN n <= 20 THEN 'L5' ELSE 'L6' END AS l_band, count(*) AS rows
       FROM (SELECT l_discount * 10 AS p, l_quantity / 2 AS r, l_partkey % 25 AS n FROM lineitem) GROUP BY ALL""",
)
def classification_bands(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(
        S.probability_band(F.col("l_discount") * 10).alias("p_band"),
        S.return_band(F.col("l_quantity") / 2).alias("r_band"),
        S.leg_band(F.col("l_partkey") % 25).alias("l_band"),
    ).agg(F.count(F.lit(1)).alias("rows"))


# ---- rule tables ----------------------------------------------------------------------

_PROB_SRC = """SELECT l_orderkey AS id, CASE WHEN l_linenumber = 7 THEN '  ' ELSE 's' || l_partkey END AS selection_id,
  l_discount * 10 AS p_raw, l_quantity / 40 AS p_calibrated, l_tax * 12 AS p_safe FROM lineitem"""
_PROB_RULES = [
    ("EMPTY_VALUE", "selection_id", "trim(selection_id) = ''"),
    ("PROBABILITY_OUT_OF_BOUNDS", "p_raw", "p_raw < 0 OR p_raw > 1"),
    ("PROBABILITY_OUT_OF_BOUNDS", "p_calibrated", "p_calibrated < 0 OR p_calibrated > 1"),
    ("PROBABILITY_OUT_OF_BOUNDS", "p_safe", "p_safe < 0 OR p_safe > 1"),
    ("P_SAFE_EXCEEDS_CALIBRATED", "p_safe", "p_safe > p_calibrated"),
]


def _estimates(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_linenumber") == 7, "  ")
        .otherwise(F.concat(F.lit("s"), F.col("l_partkey").cast("string")))
        .alias("selection_id"),
        (F.col("l_discount") * 10).alias("p_raw"),
        (F.col("l_quantity") / 40).alias("p_calibrated"),
        (F.col("l_tax") * 12).alias("p_safe"),
    )


@query("probability_rules", _rules_sql(_PROB_SRC, _PROB_RULES))
def probability_rules(t: Tables) -> DataFrame:
    return _summary(_estimates(t), C.probability_estimate())


@query(
    "edge_rules",
    _rules_sql(
        f"""SELECT *, p_raw / 2 AS p_market_no_vig, CASE WHEN id % 4 = 0 THEN p_calibrated ELSE p_calibrated - p_raw / 2 END AS edge_calibrated,
          CASE WHEN id % 6 = 0 THEN -1.0 ELSE p_safe - p_raw / 2 END AS edge_safe FROM ({_PROB_SRC})""",
        [
            *_PROB_RULES,
            ("PROBABILITY_OUT_OF_BOUNDS", "p_market_no_vig", "p_market_no_vig < 0 OR p_market_no_vig > 1"),
            ("EDGE_FORMULA_MISMATCH", "edge_calibrated", "edge_calibrated <> p_calibrated - p_market_no_vig"),
            ("EDGE_FORMULA_MISMATCH", "edge_safe", "edge_safe <> p_safe - p_market_no_vig"),
        ],
    ),
)
def edge_rules(t: Tables) -> DataFrame:
    market = F.col("p_raw") / 2
    rows = _estimates(t).select(
        "*",
        market.alias("p_market_no_vig"),
        F.when(F.col("id") % 4 == 0, F.col("p_calibrated")).otherwise(F.col("p_calibrated") - market).alias("edge_calibrated"),
        F.when(F.col("id") % 6 == 0, -1.0).otherwise(F.col("p_safe") - market).alias("edge_safe"),
    )
    return _summary(rows, C.edge_assessment())


_STATES = ("QUALIFIED", "NO_BET", "WAIT", "REVIEW", "BLOCKED", "qualified")


@query(
    "state_edge_rules",
    _rules_sql(
        f"SELECT l_orderkey AS id, {_pick_sql('l_partkey', _STATES)} AS state, l_discount - l_tax AS edge_safe FROM lineitem",
        [
            ("UNKNOWN_ENUM_VALUE", "state", "state = 'qualified'"),
            ("NEGATIVE_EDGE_SAFE_CANNOT_QUALIFY", "edge_safe", "state = 'QUALIFIED' AND edge_safe < 0"),
        ],
    ),
)
def state_edge_rules(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("id"), _pick("l_partkey", _STATES).alias("state"),
        (F.col("l_discount") - F.col("l_tax")).alias("edge_safe"),
    )
    return _summary(rows, C.state_and_edge())


@query(
    "observation_rules",
    _rules_sql(
        """SELECT l_orderkey AS id, l_partkey AS p, l_suppkey AS s, l_linenumber AS n FROM lineitem""",
        [
            ("EMPTY_VALUE", "logical_key", "p % 11 = 0"),
            ("EMPTY_VALUE", "revision_id", "p % 13 = 0"),
            ("INVALID_DIGEST", "payload_sha256", "p % 17 = 0"),
            ("UNKNOWN_ENUM_VALUE", "provenance.source.tier", "n = 7"),
            ("EMPTY_VALUE", "provenance.external_id", "p % 29 = 0"),
            ("UNKNOWN_ENUM_VALUE", "provenance.temporal.known_at_basis", "p % 12 = 8"),
            ("KNOWN_AT_BASIS_MISMATCH", "provenance.temporal.known_at_basis", "n = 6 AND p % 12 <> 5 OR n <> 6 AND p % 12 = 5"),
            ("KNOWN_AT_RECEIPT_MISMATCH", "provenance.temporal.known_at",
             "p % 12 NOT IN (5, 8) AND (n = 6 OR s % 10 IN (3, 4))"),
            ("INVALID_VALIDITY_WINDOW", "provenance.temporal.valid_from", "p % 31 = 0"),
            ("UNKNOWN_ENUM_VALUE", "provenance.data_state.freshness", "p % 37 = 0"),
            ("RECEIVED_AT_MISSING", "provenance.temporal.received_at", "s % 10 = 4"),
            ("KNOWN_AT_MISSING", "provenance.temporal.known_at", "n = 6 AND p % 2 = 0"),
            ("EMPTY_VALUE", "raw_snapshot.request_identity", "s % 10 <> 0 AND p % 41 = 0"),
            ("INVALID_DIGEST", "raw_snapshot.payload_sha256", "s % 10 <> 0 AND p % 43 = 0"),
            ("RAW_SNAPSHOT_SOURCE_MISMATCH", "raw_snapshot.source_id", "s % 10 = 7"),
            ("RAW_SNAPSHOT_RECEIVED_AT_MISMATCH", "raw_snapshot.received_at", "s % 10 IN (4, 8)"),
        ],
    ),
)
def observation_rules(t: Tables) -> DataFrame:
    """Nested observations built from line items, spoiled by remainder; all rules at once."""
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    at = F.col("l_shipdate")
    day = F.expr("interval 1 day")
    good, bad = F.sha2(p.cast("string"), 256), F.upper(F.sha2(p.cast("string"), 256))
    bad = F.concat(F.lit("X"), bad)
    received = F.when(s % 10 != 4, F.when(s % 10 == 3, at - day).otherwise(at))
    null_text = F.lit(None).cast("string")
    temporal = F.struct(
        at.alias("event_time"), at.alias("published_at"), received.alias("received_at"),
        F.when(p % 31 == 0, at + day).otherwise(at).alias("valid_from"), at.alias("valid_to"),
        F.lit(None).cast("timestamp").alias("expires_at"),
        F.when(n != 6, at).alias("known_at"),
        F.when(p % 12 == 5, null_text).when(p % 12 == 8, "GUESSED").otherwise("SYSTEM_RECEIPT").alias("known_at_basis"),
    )
    source = F.struct(
        F.lit("provider-a").alias("source_id"),
        F.when(n == 7, "official").otherwise("OFFICIAL").alias("tier"), null_text.alias("source_version"),
    )
    state = F.struct(
        F.lit("VALID").alias("quality"),
        F.when(p % 37 == 0, "FRESH").otherwise("LIVE").alias("freshness"),
        F.lit("VERIFIED").alias("verification"), F.lit("NONE").alias("conflict"),
    )
    raw = F.when(
        s % 10 != 0,
        F.struct(
            F.when(s % 10 == 7, "provider-b").otherwise("provider-a").alias("source_id"),
            F.when(p % 41 == 0, " ").otherwise("GET /x").alias("request_identity"),
            F.when(p % 43 == 0, bad).otherwise(good).alias("payload_sha256"),
            F.when(s % 10 == 8, at + day).when(s % 10 == 3, at - day).otherwise(at).alias("received_at"),
            F.lit("ingest-1").alias("ingestion_version"),
        ),
    )
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.when(p % 11 == 0, " ").otherwise("key").alias("logical_key"),
        F.when(p % 13 == 0, "").otherwise("r1").alias("revision_id"),
        F.when(p % 17 == 0, bad).otherwise(good).alias("payload_sha256"),
        F.struct(
            source.alias("source"),
            F.when(p % 29 == 0, "\t").otherwise("ext").alias("external_id"),
            temporal.alias("temporal"), state.alias("data_state"), (p % 2 == 0).alias("critical"),
        ).alias("provenance"),
        raw.alias("raw_snapshot"),
    )
    return _summary(rows, C.observation())


@query(
    "gate_rules",
    _rules_sql(
        "SELECT event_id AS id FROM events",
        [
            ("INVALID_IDENTIFIER", "gate_id", "id % 7 = 0"),
            ("UNKNOWN_ENUM_VALUE", "outcome", "id % 6 = 5"),
            ("INVALID_IDENTIFIER", "reason_codes", "id % 11 = 0"),
            ("DUPLICATE_VALUE", "reason_codes", "id % 11 = 1"),
            ("EMPTY_VALUE", "evidence", "id % 13 = 0"),
            ("DUPLICATE_VALUE", "evidence", "id % 13 = 1"),
            ("REASON_CODE_REQUIRED", "reason_codes", "id % 11 = 2 AND id % 6 IN (1, 2, 3, 4)"),
        ],
    ),
)
def gate_rules(t: Tables) -> DataFrame:
    i = F.col("event_id")
    codes = (
        F.when(i % 11 == 0, F.array(F.lit("LATE_DATA"), F.lit("late")))
        .when(i % 11 == 1, F.array(F.lit("LATE_DATA"), F.lit("LATE_DATA")))
        .when(i % 11 == 2, F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("LATE_DATA")))
    )

    def ref(key: str, reference: str):
        return F.struct(F.lit(key).alias("key"), F.lit(reference).alias("reference"))

    evidence = (
        F.when(i % 13 == 0, F.array(ref("snapshot", " ")))
        .when(i % 13 == 1, F.array(ref("snapshot", "s:1"), ref("snapshot", "s:2")))
        .otherwise(F.array(ref("snapshot", "s:1")))
    )
    rows = t.events.select(
        i.alias("id"),
        F.when(i % 7 == 0, "1_GATE").otherwise("DATA_GATE").alias("gate_id"),
        _pick("event_id", _STATES).alias("outcome"),
        codes.alias("reason_codes"), evidence.alias("evidence"), F.col("ts").alias("evaluated_at"),
    )
    return _summary(rows, C.gate_result())


@query(
    "market_rules",
    _rules_sql(
        f"""SELECT p_partkey AS id, {_pick_sql('p_partkey', (*D.MARKET_FAMILIES, 'FOOTBALL_CORNERS'))} AS family,
          p_size AS z FROM part""",
        [
            ("UNKNOWN_ENUM_VALUE", "market_family", "family = 'FOOTBALL_CORNERS'"),
            ("EMPTY_VALUE", "market_type", "z % 5 = 0"),
            ("MARKET_SPORT_MISMATCH", "sport", "z % 4 = 0 AND family <> 'FOOTBALL_CORNERS'"),
            ("MR_BASE_MISMATCH", "mr_base", "z % 3 = 0 AND family <> 'FOOTBALL_CORNERS'"),
        ],
    ),
)
def market_rules(t: Tables) -> DataFrame:
    z = F.col("p_size")
    rows = t.part.select(
        F.col("p_partkey").alias("id"),
        F.when(z % 4 == 0, "TENNIS").otherwise("FOOTBALL").alias("sport"),
        _pick("p_partkey", (*D.MARKET_FAMILIES, "FOOTBALL_CORNERS")).alias("market_family"),
        F.when(z % 5 == 0, " ").otherwise("MATCH_RESULT").alias("market_type"),
        F.lit("m:1").alias("market_instance"),
        F.when(z % 3 == 0, "MR3").otherwise("MR2").alias("mr_base"),
    )
    return _summary(rows, C.market_descriptor())


@query(
    "entity_rules",
    _rules_sql(
        "SELECT c_custkey AS id, c_nationkey AS n FROM customer",
        [
            ("UNKNOWN_ENUM_VALUE", "canonical_id.sport", "n % 6 = 0"),
            ("EMPTY_VALUE", "canonical_id.value", "n % 7 = 0"),
            ("EMPTY_VALUE", "provider_refs", "n % 5 = 0"),
            ("UNKNOWN_ENUM_VALUE", "provider_refs", "n % 5 = 1"),
            ("ENTITY_KIND_MISMATCH", "provider_refs", "n % 5 IN (1, 2)"),
            ("DUPLICATE_VALUE", "provider_refs", "n % 5 = 3"),
        ],
    ),
)
def entity_rules(t: Tables) -> DataFrame:
    n = F.col("c_nationkey")

    def ref(provider: str, kind: str, external: str):
        return F.struct(
            F.lit(provider).alias("provider_id"), F.lit(kind).alias("kind"), F.lit(external).alias("external_id")
        )

    refs = (
        F.when(n % 5 == 0, F.array(ref("", "TEAM", "1")))
        .when(n % 5 == 1, F.array(ref("a", "SQUAD", "1")))
        .when(n % 5 == 2, F.array(ref("a", "EVENT", "1"), ref("b", "TEAM", "1")))
        .when(n % 5 == 3, F.array(ref("a", "TEAM", "1"), ref("a", "TEAM", "1")))
        .otherwise(F.array(ref("a", "TEAM", "1"), ref("a", "TEAM", "2")))
    )
    rows = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.when(n % 6 == 0, "CHESS").otherwise("FOOTBALL").alias("sport"), F.lit("TEAM").alias("kind"),
            F.when(n % 7 == 0, "").otherwise(F.col("c_name")).alias("value"),
        ).alias("canonical_id"),
        refs.alias("provider_refs"),
    )
    return _summary(rows, C.entity_ref())


@query(
    "dependency_rules",
    _rules_sql(
        f"""SELECT l_orderkey AS id, l_partkey % 50 AS a, l_suppkey % 50 AS b,
          {_pick_sql('l_linenumber', (*D.DEPENDENCY_CLASSES, 'INDEPENDENT'))} AS k FROM lineitem""",
        [
            ("UNKNOWN_ENUM_VALUE", "dependency_class", "k = 'INDEPENDENT'"),
            ("SELF_DEPENDENCY", "selection_b", "a = b"),
        ],
    ),
)
def dependency_rules(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        (F.col("l_partkey") % 50).cast("string").alias("selection_a"),
        (F.col("l_suppkey") % 50).cast("string").alias("selection_b"),
        _pick("l_linenumber", (*D.DEPENDENCY_CLASSES, "INDEPENDENT")).alias("dependency_class"),
        F.lit("shared fixture").alias("basis"),
    )
    return _summary(rows, C.dependency())


@query(
    "reproducibility_rules",
    _rules_sql(
        "SELECT o_orderkey AS id FROM orders",
        [
            ("EMPTY_VALUE", "run_id", "id % 5 = 0"),
            ("INVALID_COMMIT_REF", "code_version.commit", "id % 3 = 0"),
            ("ARTIFACT_KIND_MISMATCH", "data_ref.kind", "id % 7 = 0"),
            ("UNKNOWN_ENUM_VALUE", "config_ref.kind", "id % 11 = 0"),
            ("EMPTY_VALUE", "model_refs", "id % 13 = 0"),
            ("ARTIFACT_KIND_MISMATCH", "model_refs", "id % 13 = 1"),
            ("DUPLICATE_VALUE", "model_refs", "id % 13 = 2"),
        ],
    ),
)
def reproducibility_rules(t: Tables) -> DataFrame:
    i = F.col("o_orderkey")

    def ref(kind, identifier="x"):
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), F.lit(identifier).alias("identifier"), F.lit("1").alias("version"))

    commit = F.sha1(i.cast("string"))
    rows = t.orders.select(
        i.alias("id"),
        F.when(i % 5 == 0, "").otherwise("run").alias("run_id"),
        F.struct(F.when(i % 3 == 0, F.substring(commit, 1, 12)).otherwise(commit).alias("commit")).alias("code_version"),
        ref(F.when(i % 7 == 0, "MODEL").otherwise("SNAPSHOT")).alias("data_ref"),
        ref(F.when(i % 11 == 0, "CONFIG").otherwise("CONFIGURATION")).alias("config_ref"),
        F.when(i % 13 == 0, F.array(ref("MODEL", "")))
        .when(i % 13 == 1, F.array(ref("DATASET")))
        .when(i % 13 == 2, F.array(ref("MODEL"), ref("MODEL")))
        .otherwise(F.array(ref("MODEL"), ref("CALIBRATOR")))
        .alias("model_refs"),
    )
    return _summary(rows, C.reproducibility())


@query(
    "claim_rules",
    _rules_sql(
        "SELECT event_id AS id FROM events",
        [
            ("EMPTY_VALUE", "statement", "id % 5 = 0"),
            ("UNKNOWN_ENUM_VALUE", "claim_type", "id % 7 = 0"),
            ("EMPTY_VALUE", "subjects", "id % 11 = 0"),
            ("UNKNOWN_ENUM_VALUE", "subjects", "id % 11 = 1"),
            ("DUPLICATE_VALUE", "subjects", "id % 11 = 2"),
            ("UNKNOWN_ENUM_VALUE", "effect_channels", "id % 13 = 0"),
            ("DUPLICATE_VALUE", "effect_channels", "id % 13 = 1"),
        ],
    ),
)
def claim_rules(t: Tables) -> DataFrame:
    i, at = F.col("event_id"), F.col("ts")

    def subject(value: str, sport: str = "FOOTBALL"):
        return F.struct(F.lit(sport).alias("sport"), F.lit("TEAM").alias("kind"), F.lit(value).alias("value"))

    none = F.lit(None)
    provenance = F.struct(
        F.struct(F.lit("s").alias("source_id"), F.lit("OFFICIAL").alias("tier"), none.cast("string").alias("source_version")).alias("source"),
        none.cast("string").alias("external_id"),
        F.struct(
            *[none.cast("timestamp").alias(c) for c in ("event_time", "published_at")], at.alias("received_at"),
            *[none.cast("timestamp").alias(c) for c in ("valid_from", "valid_to", "expires_at")],
            at.alias("known_at"), F.lit("SYSTEM_RECEIPT").alias("known_at_basis"),
        ).alias("temporal"),
        F.struct(F.lit("VALID").alias("quality"), F.lit("LIVE").alias("freshness"),
                 F.lit("UNVERIFIED").alias("verification"), F.lit("OPEN").alias("conflict")).alias("data_state"),
        F.lit(True).alias("critical"),
    )
    rows = t.events.select(
        i.alias("id"), F.lit("claim").alias("claim_id"),
        F.when(i % 7 == 0, "GOSSIP").otherwise("RUMOR").alias("claim_type"),
        F.when(i % 11 == 0, F.array(subject(" ")))
        .when(i % 11 == 1, F.array(subject("a", "CHESS")))
        .when(i % 11 == 2, F.array(subject("a"), subject("a")))
        .otherwise(F.array(subject("a"), subject("b"))).alias("subjects"),
        F.when(i % 5 == 0, "").otherwise("text").alias("statement"),
        provenance.alias("provenance"),
        F.when(i % 13 == 0, F.array(F.lit("ODDS")))
        .when(i % 13 == 1, F.array(F.lit("GATES"), F.lit("GATES")))
        .otherwise(F.array(F.lit("GATES"))).alias("effect_channels"),
    )
    return _summary(rows, C.claim())


@query(
    "assessment_rules",
    _rules_sql(
        "SELECT o_orderkey AS id FROM orders",
        [
            ("INVALID_ASSESSMENT_VERSION", "assessment_version", "id % 5 = 0"),
            ("INVALID_IDENTIFIER", "market_family", "id % 7 = 0"),
            ("INVALID_COMPETITION", "competition", "id % 11 IN (1, 2)"),
            ("EMPIRICAL_CLASS_REQUIRED", "predictability_empirical", "id % 13 = 0"),
            ("INVALID_METRIC", "oos_brier", "id % 17 = 0"),
            ("INVALID_METRIC", "oos_log_loss", "id % 19 = 0"),
            ("NON_FINITE_NUMBER", "oos_skill", "id % 23 = 0"),
            ("PROBABILITY_OUT_OF_BOUNDS", "oos_ece", "id % 29 = 0"),
            ("NEGATIVE_SAMPLE_SIZE", "sample_sizes", "id % 31 = 0"),
            ("DUPLICATE_VALUE", "sample_sizes", "id % 31 = 1"),
            ("EMPTY_VALUE", "drift", "id % 37 = 0"),
            ("INVALID_EVALUATION_PERIOD", "evaluation_period.start", "id % 41 = 0"),
            ("ARTIFACT_KIND_MISMATCH", "dataset_version_or_snapshot.kind", "id % 43 = 0"),
            ("KNOWN_AT_BEFORE_EVALUATION_END", "known_at", "id % 47 = 0"),
        ],
    ),
)
def assessment_rules(t: Tables) -> DataFrame:
    i, at, day = F.col("o_orderkey"), F.col("o_orderdate"), F.expr("interval 1 day")

    def entity(sport: str, kind: str):
        return F.struct(F.lit(sport).alias("sport"), F.lit(kind).alias("kind"), F.lit("c1").alias("value"))

    def size(label: str, count: int):
        return F.struct(F.lit(label).alias("label"), F.lit(count).alias("count"))

    rows = t.orders.select(
        i.alias("id"),
        F.when(i % 5 == 0, 0).otherwise(1).alias("assessment_version"),
        F.lit("FOOTBALL").alias("sport"),
        F.when(i % 7 == 0, "football-1x2").otherwise("FOOTBALL_1X2").alias("market_family"),
        F.when(i % 11 == 1, entity("FOOTBALL", "TEAM")).when(i % 11 == 2, entity("TENNIS", "COMPETITION"))
        .when(i % 11 == 3, entity("FOOTBALL", "COMPETITION")).alias("competition"),
        F.lit("SP3").alias("predictability_prior"), F.lit(None).cast("string").alias("predictability_empirical"),
        F.when(i % 13 == 0, "VALIDATED").otherwise("INSUFFICIENT").alias("evidence_status"),
        F.when(i % 17 == 0, -0.1).otherwise(0.2).alias("oos_brier"),
        F.when(i % 19 == 0, -0.1).otherwise(0.6).alias("oos_log_loss"),
        F.when(i % 23 == 0, float("inf")).otherwise(0.1).alias("oos_skill"),
        F.when(i % 29 == 0, 1.5).alias("oos_ece"),
        F.when(i % 31 == 0, F.array(size("a", -1))).when(i % 31 == 1, F.array(size("a", 1), size("a", 2)))
        .otherwise(F.array(size("a", 1), size("b", 0))).alias("sample_sizes"),
        *[F.lit("n/a").alias(c) for c in ("stability", "data_quality", "baseline_scope", "model_scope")],
        F.when(i % 37 == 0, "").otherwise("n/a").alias("drift"),
        F.struct(
            F.when(i % 41 == 0, at + day).otherwise(at - day).alias("start"), at.alias("end")
        ).alias("evaluation_period"),
        F.struct(
            F.when(i % 43 == 0, "MODEL").otherwise("SNAPSHOT").alias("kind"), F.lit("x").alias("identifier"),
            F.lit("1").alias("version"),
        ).alias("dataset_version_or_snapshot"),
        F.struct(F.sha1(i.cast("string")).alias("commit")).alias("code_version"),
        F.when(i % 47 == 0, at - day).otherwise(at).alias("known_at"),
    )
    return _summary(rows, C.assessment())


# ---- strict JSON records --------------------------------------------------------------

_STRICT = T.StructType(
    [
        T.StructField("selection_id", T.StringType(), False),
        T.StructField("p_raw", T.DoubleType(), False),
        T.StructField("rank", T.LongType(), True),
        T.StructField("known_at", T.TimestampType(), True),
        T.StructField(
            "source",
            T.StructType([T.StructField("source_id", T.StringType(), False), T.StructField("critical", T.BooleanType(), False)]),
            False,
        ),
    ]
)
_STRICT_TEXT = r"""'{"selection_id":' || CASE WHEN k = 1 THEN '7' ELSE '"s"' END || ',"p_raw":' || CASE WHEN k = 2 THEN '1' ELSE '0.25' END
  || CASE WHEN k = 3 THEN '' ELSE ',"rank":' || CASE WHEN k = 4 THEN '1.5' ELSE 'null' END END
  || ',"known_at":' || CASE WHEN k = 5 THEN '"2024-01-01T00:00:00"' WHEN k = 6 THEN '"soon"' ELSE '"2024-01-01T00:00:00Z"' END
  || CASE WHEN k = 7 THEN ',"extra":1' ELSE '' END
  || ',"source":' || CASE WHEN k = 8 THEN '[]' WHEN k = 9 THEN '{"source_id":"a","critical":"yes","tier":"X"}' ELSE '{"source_id":"a","critical":true}' END
  || CASE WHEN k = 10 THEN '' ELSE '}' END"""


@query(
    "strict_json_records",
    """SELECT event_id, CASE event_id % 12 WHEN 1 THEN 'INVALID_TYPE:selection_id' WHEN 2 THEN 'INVALID_TYPE:p_raw'
      WHEN 3 THEN 'MISSING_FIELD:rank' WHEN 4 THEN 'INVALID_TYPE:rank' WHEN 5 THEN 'NAIVE_DATETIME:known_at'
      WHEN 6 THEN 'INVALID_TIMESTAMP:known_at' WHEN 7 THEN 'UNKNOWN_FIELD:extra' WHEN 8 THEN 'INVALID_TYPE:source'
      WHEN 9 THEN 'UNKNOWN_FIELD:source.tier,INVALID_TYPE:source.critical' WHEN 10 THEN 'INVALID_TYPE:$' ELSE '' END AS violations,
      CASE WHEN event_id % 12 IN (0, 11) THEN 's' END AS selection_id,
      CASE WHEN event_id % 12 IN (0, 11) THEN 0.25::DOUBLE END AS p_raw FROM events""",
)
def strict_json_records(t: Tables) -> DataFrame:
    """JSON texts built per event, 10 of 12 spoiled in one known way each."""
    text = F.expr(_STRICT_TEXT)
    texts = t.events.select("event_id", (F.col("event_id") % 12).alias("k")).withColumn("text", text)
    read = strict_records(texts, "text", _STRICT, ["event_id"])
    return read.select(
        "event_id",
        F.array_join(
            F.transform("violations", lambda v: F.concat_ws(":", v["code"], v["field"])), ","
        ).alias("violations"),
        F.col("record.selection_id").alias("selection_id"),
        F.col("record.p_raw").alias("p_raw"),
    )
