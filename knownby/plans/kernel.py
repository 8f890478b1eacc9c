"""Kernel queries over line items projected onto versioned observations."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.domains import DISPOSITIONS, REJECTION_REASONS
from knownby.operators.asof import by_key, select_as_of
from knownby.operators.eligibility import evaluate_eligibility, known_at_violation
from knownby.operators.manifest import (
    DatasetRef,
    audit,
    disposition_counts,
    eligibility_rules,
    manifest_table,
    materialize,
    reason_counts,
    replay_difference,
    verify_replay,
)
from knownby.operators.replay_tree import descend, write_tree
from knownby.operators.rules import violation_rows
from knownby.plans.registry import Tables, query
from knownby.storage import shared_folder, written

UTC = timezone.utc
CUTOFF = datetime(1998, 7, 1, tzinfo=UTC)
ONE_CUTOFF = [("c1", CUTOFF)]
THREE_CUTOFFS = [
    ("y1996", datetime(1996, 7, 1, tzinfo=UTC)),
    ("y1997", datetime(1997, 7, 1, tzinfo=UTC)),
    ("y1998", CUTOFF),
]
CODE_VERSION = "0" * 40
DATASET = DatasetRef("SNAPSHOT", "lineitem", "1")


def lineitem_observations(t: Tables) -> DataFrame:
    """Order = logical key, line number = revision, ship date = known_at."""
    later = F.col("l_shipdate") + F.expr("interval 400 days")
    source = F.when(F.col("l_orderkey") % 5 == 0, F.col("l_suppkey") % 2).otherwise(0)
    content = F.when(F.col("l_linenumber").isin(1, 2, 3), F.col("l_linenumber").cast("long")).otherwise(
        F.col("l_partkey") % 2
    )
    return t.lineitem.select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("logical_key"),
        F.sha2(
            F.concat_ws(
                "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                F.date_format("l_shipdate", "yyyy-MM-dd"),
            ),
            256,
        ).alias("record_digest"),
        F.concat(F.lit("src-"), source.cast("string")).alias("source_id"),
        F.when(F.col("l_linenumber") != 7, F.concat(F.lit("r"), F.col("l_linenumber").cast("string"))).alias(
            "revision_id"
        ),
        F.sha2(content.cast("string"), 256).alias("payload_sha256"),
        F.when(F.col("l_tax") != 0.08, F.col("l_shipdate")).alias("known_at"),
        F.when(F.col("l_tax") != 0.08, F.lit("VERIFIED_SOURCE_AVAILABILITY")).alias("known_at_basis"),
        F.when(F.col("l_discount") == 0.10, later).alias("valid_from"),
        F.when(F.col("l_discount") == 0.09, later).alias("valid_to"),
        F.when(F.col("l_discount") == 0.08, later).alias("expires_at"),
        F.when(F.col("l_returnflag") == "A", F.sha2(F.col("l_suppkey").cast("string"), 256)).alias(
            "raw_payload_sha256"
        ),
    )


_OBS = """
obs0 AS (
  SELECT 'order-' || CAST(l_orderkey AS VARCHAR) AS logical_key,
         sha256(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
           CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
           strftime(l_shipdate, '%Y-%m-%d'))) AS record_digest,
         'src-' || CAST(CASE WHEN l_orderkey % 5 = 0 THEN l_suppkey % 2 ELSE 0 END AS VARCHAR) AS source_id,
         CASE WHEN l_linenumber <> 7 THEN 'r' || CAST(l_linenumber AS VARCHAR) END AS revision_id,
         sha256(CAST(CASE WHEN l_linenumber IN (1,2,3) THEN l_linenumber ELSE l_partkey % 2 END AS VARCHAR)) AS payload_sha256,
         CASE WHEN l_tax <> 0.08 THEN l_shipdate END AS known_at,
         CASE WHEN l_discount = 0.10 THEN l_shipdate + INTERVAL 400 DAY END AS valid_from,
         CASE WHEN l_discount = 0.09 THEN l_shipdate + INTERVAL 400 DAY END AS valid_to,
         CASE WHEN l_discount = 0.08 THEN l_shipdate + INTERVAL 400 DAY END AS expires_at,
         CASE WHEN l_returnflag = 'A' THEN sha256(CAST(l_suppkey AS VARCHAR)) END AS raw_payload_sha256
  FROM lineitem),
obs1 AS (
  SELECT logical_key, record_digest, source_id, revision_id, payload_sha256, known_at,
         valid_from, valid_to, expires_at, raw_payload_sha256, count(*) AS copies
  FROM obs0 GROUP BY ALL)
"""


def _kernel_sql(cutoffs: str) -> str:
    return f"""
WITH {_OBS},
cuts(cutoff_id, cutoff) AS (VALUES {cutoffs}),
ev AS (
  SELECT c.cutoff_id, c.cutoff, o.*,
    (known_at IS NULL) AS m0, coalesce(known_at > cutoff, false) AS m1,
    coalesce(valid_from > cutoff, false) AS m2,
    (coalesce(valid_to < cutoff, false) OR coalesce(expires_at <= cutoff, false)) AS m3,
    (revision_id IS NULL) AS m4
  FROM obs1 o, cuts c),
ev2 AS (
  SELECT *, NOT (m0 OR m1) AS visible, NOT (m0 OR m1 OR m2 OR m3 OR m4) AS ok,
    (m4 AND NOT (m0 OR m1 OR m2 OR m3)) AS blocker,
    concat_ws(',', CASE WHEN m0 THEN 'MISSING_KNOWN_AT' END, CASE WHEN m1 THEN 'KNOWN_AFTER_CUTOFF' END,
      CASE WHEN m2 THEN 'NOT_YET_VALID_AT_CUTOFF' END, CASE WHEN m3 THEN 'EXPIRED_AT_CUTOFF' END,
      CASE WHEN m4 THEN 'SOURCE_VERSION_UNRESOLVED' END) AS reasons
  FROM ev),
ver AS (
  SELECT cutoff_id, logical_key, source_id, revision_id,
    count(DISTINCT CASE WHEN visible THEN payload_sha256 END) AS contents,
    min(CASE WHEN ok THEN known_at END) AS usable_from
  FROM ev2 WHERE revision_id IS NOT NULL GROUP BY ALL),
cand AS (
  SELECT cutoff_id, logical_key, max(contents) AS contents,
    count(DISTINCT CASE WHEN usable_from IS NOT NULL THEN source_id END) AS sources,
    max(usable_from) AS latest
  FROM ver GROUP BY ALL),
top AS (
  SELECT v.cutoff_id, v.logical_key, count(*) AS at_top, min(v.source_id) AS source_id,
    min(v.revision_id) AS revision_id
  FROM ver v JOIN cand c ON v.cutoff_id = c.cutoff_id AND v.logical_key = c.logical_key
   AND v.usable_from = c.latest GROUP BY ALL),
blk AS (
  SELECT cutoff_id, logical_key, max(CASE WHEN blocker THEN known_at END) AS blocker_at,
    count(*) AS distinct_count, CAST(sum(copies) AS BIGINT) AS input_count
  FROM ev2 GROUP BY ALL),
st AS (
  SELECT b.cutoff_id, b.logical_key, b.distinct_count, b.input_count, c.latest,
    CASE WHEN c.contents > 1 THEN 'CONTENT_CONFLICT' WHEN c.sources > 1 THEN 'SEVERAL_SOURCES'
         WHEN t.at_top > 1 THEN 'VERSION_TIE'
         WHEN b.blocker_at IS NOT NULL AND (c.latest IS NULL OR b.blocker_at >= c.latest)
         THEN 'UNIDENTIFIED_VERSION' END AS unresolved_cause,
    t.source_id AS top_source, t.revision_id AS top_revision
  FROM blk b LEFT JOIN cand c ON b.cutoff_id = c.cutoff_id AND b.logical_key = c.logical_key
  LEFT JOIN top t ON b.cutoff_id = t.cutoff_id AND b.logical_key = t.logical_key),
st2 AS (
  SELECT *, CASE WHEN unresolved_cause IS NOT NULL THEN 'UNRESOLVED' WHEN latest IS NOT NULL THEN 'SELECTED'
            ELSE 'NO_ELIGIBLE_VERSION' END AS status FROM st),
dig AS (
  SELECT e.cutoff_id, e.logical_key, min(e.record_digest) AS selected_record_digest
  FROM ev2 e JOIN st2 s ON e.cutoff_id = s.cutoff_id AND e.logical_key = s.logical_key
  WHERE s.status = 'SELECTED' AND e.ok AND e.known_at = s.latest AND e.source_id = s.top_source
    AND e.revision_id = s.top_revision GROUP BY ALL),
outc AS (
  SELECT s.*, d.selected_record_digest FROM st2 s
  LEFT JOIN dig d ON s.cutoff_id = d.cutoff_id AND s.logical_key = d.logical_key),
dec AS (
  SELECT e.cutoff_id, e.cutoff, e.logical_key, e.record_digest, e.source_id, e.revision_id, e.payload_sha256,
    e.known_at, e.raw_payload_sha256, e.reasons, e.copies,
    CASE WHEN e.reasons <> '' THEN 'REJECTED' WHEN o.status = 'UNRESOLVED' THEN 'UNRESOLVED'
      WHEN e.record_digest = o.selected_record_digest THEN 'SELECTED'
      WHEN e.source_id = o.top_source AND e.revision_id = o.top_revision THEN 'DUPLICATE_OBSERVATION'
      ELSE 'ELIGIBLE_NOT_LATEST' END AS disposition
  FROM ev2 e JOIN outc o ON e.cutoff_id = o.cutoff_id AND e.logical_key = o.logical_key)
"""


_C1 = "('c1', TIMESTAMP '1998-07-01')"
_C3 = "('y1996', TIMESTAMP '1996-07-01'), ('y1997', TIMESTAMP '1997-07-01'), ('y1998', TIMESTAMP '1998-07-01')"
_ONE, _THREE = _kernel_sql(_C1), _kernel_sql(_C3)
_DISPOSITION_DIM = ("(VALUES (0,'SELECTED'),(1,'DUPLICATE_OBSERVATION'),(2,'ELIGIBLE_NOT_LATEST'),"
                    "(3,'REJECTED'),(4,'UNRESOLVED')) AS d(position, disposition)")
_REASON_DIM = ("(VALUES (0,'MISSING_KNOWN_AT'),(1,'KNOWN_AFTER_CUTOFF'),(2,'NOT_YET_VALID_AT_CUTOFF'),"
               "(3,'EXPIRED_AT_CUTOFF'),(4,'SOURCE_VERSION_UNRESOLVED')) AS d(position, reason)")


def _decision_report(decisions: DataFrame) -> DataFrame:
    return decisions.select(
        "cutoff_id", "logical_key", "record_digest", "source_id", "revision_id", "payload_sha256",
        F.date_format("known_at", "yyyy-MM-dd").alias("known_on"), "raw_payload_sha256",
        "disposition", F.array_join("reasons", ",").alias("reasons"),
    )


_DECISION_SELECT = """SELECT cutoff_id, logical_key, record_digest, source_id, revision_id, payload_sha256,
  strftime(known_at, '%Y-%m-%d') AS known_on, raw_payload_sha256, disposition, reasons FROM dec"""


@query(
    "pit_status_summary",
    _ONE + """SELECT status, unresolved_cause, count(*) AS key_count,
      CAST(sum(distinct_count) AS BIGINT) AS observation_count FROM outc GROUP BY ALL""",
)
def pit_status_summary(t: Tables) -> DataFrame:
    outcomes = select_as_of(lineitem_observations(t), ONE_CUTOFF).outcomes
    return outcomes.groupBy("status", "unresolved_cause").agg(
        F.count(F.lit(1)).alias("key_count"), F.sum("distinct_count").alias("observation_count")
    )


@query(
    "pit_key_outcomes",
    _ONE + """SELECT cutoff_id, logical_key, status, selected_record_digest, unresolved_cause,
      distinct_count, input_count FROM outc""",
)
def pit_key_outcomes(t: Tables) -> DataFrame:
    return select_as_of(lineitem_observations(t), ONE_CUTOFF).outcomes.select(
        "cutoff_id", "logical_key", "status", "selected_record_digest", "unresolved_cause",
        "distinct_count", "input_count",
    )


@query("pit_record_decisions", _ONE + _DECISION_SELECT)
def pit_record_decisions(t: Tables) -> DataFrame:
    return _decision_report(select_as_of(lineitem_observations(t), ONE_CUTOFF).decisions)


@query("pit_replay_cutoffs", _THREE + _DECISION_SELECT)
def pit_replay_cutoffs(t: Tables) -> DataFrame:
    return _decision_report(select_as_of(lineitem_observations(t), THREE_CUTOFFS).decisions)


@query(
    "pit_selected_observations",
    _ONE + """SELECT e.logical_key, e.record_digest, e.source_id, e.revision_id,
      strftime(e.known_at, '%Y-%m-%d') AS known_on FROM ev2 e JOIN outc o
      ON e.logical_key = o.logical_key AND e.record_digest = o.selected_record_digest""",
)
def pit_selected_observations(t: Tables) -> DataFrame:
    return select_as_of(lineitem_observations(t), ONE_CUTOFF).selected.select(
        "logical_key", "record_digest", "source_id", "revision_id",
        F.date_format("known_at", "yyyy-MM-dd").alias("known_on"),
    )


@query(
    "pit_eligibility",
    _ONE + """SELECT e.record_digest, e.logical_key, e.ok AS eligible, e.reasons,
      strftime(e.known_at, '%Y-%m-%d') AS known_on,
      CASE WHEN known_at IS NULL THEN 'KNOWN_AT_MISSING' WHEN known_at > cutoff THEN 'KNOWN_AT_AFTER_CUTOFF' END
      AS known_at_violation FROM ev2 e, range(1, 1000) g(n) WHERE n <= e.copies""",
)
def pit_eligibility(t: Tables) -> DataFrame:
    rows = evaluate_eligibility(lineitem_observations(t), ONE_CUTOFF)
    return rows.select(
        "record_digest", "logical_key", "eligible", F.array_join("reasons", ",").alias("reasons"),
        F.date_format("known_at", "yyyy-MM-dd").alias("known_on"),
        known_at_violation(F.col("known_at"), F.col("decision_cutoff_at")).alias("known_at_violation"),
    )


@query(
    "pit_disposition_counts",
    _THREE + f"""SELECT c.cutoff_id, d.position, d.disposition, count(x.record_digest) AS "count"
      FROM cuts c CROSS JOIN {_DISPOSITION_DIM}
      LEFT JOIN dec x ON x.cutoff_id = c.cutoff_id AND x.disposition = d.disposition GROUP BY ALL""",
)
def pit_disposition_counts(t: Tables) -> DataFrame:
    return disposition_counts(select_as_of(lineitem_observations(t), THREE_CUTOFFS).decisions)


@query(
    "pit_reason_counts",
    _THREE + f"""SELECT c.cutoff_id, d.position, d.reason, count(x.record_digest) AS "count"
      FROM cuts c CROSS JOIN {_REASON_DIM}
      LEFT JOIN ev2 x ON x.cutoff_id = c.cutoff_id AND contains(x.reasons, d.reason) GROUP BY ALL""",
)
def pit_reason_counts(t: Tables) -> DataFrame:
    return reason_counts(select_as_of(lineitem_observations(t), THREE_CUTOFFS).decisions)


def _tree_sql(source: str, name: str) -> str:
    return f"""
{name}1 AS (SELECT cutoff_id, substr(line, 1, 6) AS p, sha256(string_agg(line, '' ORDER BY line)) AS d FROM {source} GROUP BY ALL),
{name}2 AS (SELECT cutoff_id, substr(p, 1, 3) AS p, sha256(string_agg(d, '' ORDER BY d)) AS d FROM {name}1 GROUP BY cutoff_id, substr(p, 1, 3)),
{name} AS (SELECT cutoff_id, sha256(string_agg(d, '' ORDER BY d)) AS root FROM {name}2 GROUP BY cutoff_id)"""


_MANIFEST_SQL = _ONE + r""",
dl AS (SELECT cutoff_id, sha256('{"disposition":"' || disposition || '","known_at":'
   || coalesce('"' || strftime(known_at, '%Y-%m-%dT%H:%M:%S') || '+00:00"', 'null')
   || ',"logical_key":"' || logical_key || '","payload_sha256":"' || payload_sha256
   || '","raw_payload_sha256":' || coalesce('"' || raw_payload_sha256 || '"', 'null')
   || ',"reasons":[' || CASE WHEN reasons = '' THEN '' ELSE '"' || replace(reasons, ',', '","') || '"' END
   || '],"record_digest":"' || record_digest || '","revision_id":' || coalesce('"' || revision_id || '"', 'null')
   || ',"source_id":"' || source_id || '"}') AS line FROM dec),
ol AS (SELECT cutoff_id, sha256('{"logical_key":"' || logical_key || '","selected_record_digest":'
   || coalesce('"' || selected_record_digest || '"', 'null') || ',"status":"' || status || '"}') AS line FROM outc),
""" + _tree_sql("dl", "dr") + "," + _tree_sql("ol", "orr") + """,
tot AS (SELECT cutoff_id, CAST(sum(input_count) AS BIGINT) AS input_record_count,
   CAST(sum(distinct_count) AS BIGINT) AS decision_count, count(*) AS key_count FROM outc GROUP BY cutoff_id)
SELECT tot.cutoff_id, input_record_count, decision_count, key_count, orr.root AS outcomes_root, dr.root AS decisions_root,
  dc.counts AS dispositions, rc.counts AS reasons,
  sha256('{"code_version":"' || repeat('0', 40) || '","dataset_ref":{"identifier":"lineitem","kind":"SNAPSHOT","version":"1"},"decision_count":'
    || decision_count || ',"decision_cutoff_at":"1998-07-01T00:00:00+00:00","decisions_root":"' || dr.root || '","disposition_counts":{' || dc.counts
    || '},"input_record_count":' || input_record_count || ',"key_count":' || key_count || ',"outcomes_root":"' || orr.root
    || '","reason_counts":{' || rc.counts || '}}') AS content_hash
FROM (SELECT string_agg('"' || disposition || '":' || n, ',' ORDER BY disposition) AS counts FROM (
    SELECT d.disposition, count(x.record_digest) AS n FROM """ + _DISPOSITION_DIM + r""" LEFT JOIN dec x ON x.disposition = d.disposition GROUP BY ALL)) dc,
  (SELECT string_agg('"' || reason || '":' || n, ',' ORDER BY reason) AS counts FROM (
    SELECT d.reason, count(x.record_digest) AS n FROM """ + _REASON_DIM + r""" LEFT JOIN ev2 x ON contains(x.reasons, d.reason) GROUP BY ALL)) rc,
  tot JOIN dr ON tot.cutoff_id = dr.cutoff_id JOIN orr ON tot.cutoff_id = orr.cutoff_id"""


def _listed(counts: str, names: tuple[str, ...]):
    return F.concat_ws(",", *[F.format_string(f'"{n}":%d', F.col(counts)[n]) for n in sorted(names)])


@query("pit_manifest", _MANIFEST_SQL)
def pit_manifest(t: Tables) -> DataFrame:
    made = materialize(lineitem_observations(t), ONE_CUTOFF, CODE_VERSION, DATASET)
    return made.manifest.select(
        "cutoff_id", "input_record_count", "decision_count", "key_count", "outcomes_root",
        "decisions_root", _listed("disposition_counts", DISPOSITIONS).alias("dispositions"),
        _listed("reason_counts", REJECTION_REASONS).alias("reasons"), "content_hash",
    )


_GONE = _ONE + """, gone AS (SELECT logical_key FROM ev2 WHERE raw_payload_sha256 IS NOT NULL AND m3 GROUP BY ALL)
    SELECT d.cutoff_id, d.logical_key, count(*) AS missing_in_replay, CAST(0 AS BIGINT) AS new_in_replay,
      CAST(0 AS BIGINT) AS changed, 'REPLAY_MISMATCH' AS code
    FROM dec d JOIN gone g ON d.logical_key = g.logical_key GROUP BY ALL"""


def _recorded_and_replayed(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Decisions on all keys, and without the keys that hold an expired, raw-linked observation."""
    given = lineitem_observations(t)
    observations = by_key(given)
    # Keys are counted where the rows are read: behind the shuffle, they would be shuffled for the count alone.
    hot = select_as_of(given, ONE_CUTOFF).hot
    recorded = select_as_of(observations, ONE_CUTOFF, known_hot=hot)
    cutoff = F.lit(CUTOFF)
    expired = (F.col("valid_to") < cutoff) | (F.col("expires_at") <= cutoff)
    gone = observations.filter(F.col("raw_payload_sha256").isNotNull() & expired).select("logical_key").distinct()
    replayed = select_as_of(observations.join(gone, "logical_key", "left_anti"), ONE_CUTOFF, known_hot=hot)
    return recorded.decisions, replayed.decisions


@query("pit_replay_difference", _GONE)
def pit_replay_difference(t: Tables) -> DataFrame:
    """Replay without some keys: each must show."""
    return replay_difference(*_recorded_and_replayed(t))


@query("pit_replay_descent", _GONE)
def pit_replay_descent(t: Tables) -> DataFrame:
    """The same difference from two stored trees, by the branches in which they differ."""
    trees = [
        write_tree(decisions, f"{shared_folder(decisions.sparkSession)}/knownby-tree-{uuid.uuid4().hex}")
        for decisions in _recorded_and_replayed(t)
    ]
    return descend(*trees)


@query(
    "pit_manifest_counts",
    _THREE + f"""SELECT c.cutoff_id, 'disposition' AS kind, d.disposition AS name, count(x.record_digest) AS n
      FROM (SELECT cutoff_id FROM cuts UNION ALL SELECT 'unused') c CROSS JOIN {_DISPOSITION_DIM}
      LEFT JOIN dec x ON x.cutoff_id = c.cutoff_id AND x.disposition = d.disposition GROUP BY ALL
      UNION ALL SELECT c.cutoff_id, 'reason', d.reason, count(x.record_digest)
      FROM (SELECT cutoff_id FROM cuts UNION ALL SELECT 'unused') c CROSS JOIN {_REASON_DIM}
      LEFT JOIN ev2 x ON x.cutoff_id = c.cutoff_id AND contains(x.reasons, d.reason) GROUP BY ALL""",
)
def pit_manifest_counts(t: Tables) -> DataFrame:
    """Counts in the manifest, also of a cutoff for which nothing was decided."""
    made = select_as_of(lineitem_observations(t), THREE_CUTOFFS)
    manifest = manifest_table(
        made.decisions, made.outcomes, CODE_VERSION, DATASET, cutoffs=[*THREE_CUTOFFS, ("unused", CUTOFF)]
    )
    counts = [
        F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("name"), F.col(column)[n].alias("n"))
        for kind, column, names in (
            ("disposition", "disposition_counts", DISPOSITIONS), ("reason", "reason_counts", REJECTION_REASONS)
        )
        for n in names
    ]
    return manifest.select("cutoff_id", F.inline(F.array(*counts)))


@query(
    "pit_verify_replay",
    """SELECT 'y1997' AS cutoff_id, 'REPLAY_MISMATCH' AS code WHERE (SELECT count(*) FROM lineitem) > 0""",
)
def pit_verify_replay(t: Tables) -> DataFrame:
    """Replayed from the manifest alone; one row claims another code version than it was sealed with."""
    observations = lineitem_observations(t)
    manifest = written(materialize(observations, THREE_CUTOFFS, CODE_VERSION, DATASET).manifest)
    other = F.when(F.col("cutoff_id") == "y1997", "f" * 40).otherwise(F.col("code_version"))
    return verify_replay(manifest.withColumn("code_version", other), observations).select("cutoff_id", "code")


@query(
    "pit_audit",
    _ONE + """SELECT cutoff_id, logical_key, 'SELECTION_MISMATCH' AS code, 'selected decision matches outcome' AS detail
      FROM outc WHERE status = 'SELECTED' AND substr(selected_record_digest, 1, 1) = '0'
      UNION ALL SELECT cutoff_id, logical_key, 'DISPOSITION_MISMATCH', 'rejected exactly with reasons'
      FROM dec WHERE disposition = 'SELECTED' AND substr(record_digest, 1, 1) = '0'""",
)
def pit_audit(t: Tables) -> DataFrame:
    """Decisions are tampered with (some SELECTED turned REJECTED); the audit must find them."""
    made = select_as_of(lineitem_observations(t), ONE_CUTOFF)
    tampered = made.decisions.withColumn(
        "disposition",
        F.when(
            (F.col("disposition") == "SELECTED") & F.col("record_digest").startswith("0"), "REJECTED"
        ).otherwise(F.col("disposition")),
    )
    return audit(tampered, made.outcomes)


@query(
    "pit_manifest_audit",
    """SELECT 'y1997' AS cutoff_id, CAST(NULL AS VARCHAR) AS logical_key, 'CONTENT_HASH_MISMATCH' AS code, 'content_hash must hash the body' AS detail
       WHERE (SELECT count(*) FROM lineitem) > 0""",
)
def pit_manifest_audit(t: Tables) -> DataFrame:
    """The dataset version of one manifest row is changed after sealing; only that shows."""
    made = materialize(lineitem_observations(t), THREE_CUTOFFS, CODE_VERSION, DATASET)
    changed = F.when(F.col("cutoff_id") == "y1997", "2").otherwise(F.col("dataset_ref.version"))
    tampered = made.manifest.withColumn("dataset_ref", F.col("dataset_ref").withField("version", changed))
    return audit(made.decisions, made.outcomes, tampered)


@query(
    "pit_eligibility_audit",
    _ONE + """SELECT e.record_digest, 'ELIGIBILITY_MISMATCH' AS code, 'eligible' AS field FROM ev2 e, range(1, 1000) g(n)
      WHERE n <= e.copies AND e.ok AND e.source_id = 'src-1'""",
)
def pit_eligibility_audit(t: Tables) -> DataFrame:
    """Eligible rows of one source are flipped and must be found."""
    source = lineitem_observations(t).select("logical_key", "record_digest", "source_id").distinct()
    rows = evaluate_eligibility(lineitem_observations(t), ONE_CUTOFF).join(source, ["logical_key", "record_digest"])
    flipped = rows.withColumn("eligible", F.col("eligible") & (F.col("source_id") != "src-1"))
    return violation_rows(flipped, eligibility_rules(), ["record_digest"])
