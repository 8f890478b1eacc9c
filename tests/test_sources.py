from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from knownby import schemas
from knownby.operators import contracts as C
from knownby.operators import coverage as V
from knownby.operators.checks import fixture_violations, plan_cutoff_violations, plan_query_violations
from knownby.operators.reconcile import Reconciliation
from knownby.operators.rules import fail_on, validate, violation_rows
from knownby.sources import documents, landing, sinks, snapshots

EVENTS = [
    {"id": f"e{i}", "commence_time": "2024-08-16T19:00:00Z", "home_team": h, "away_team": a}
    for i, (h, a) in enumerate([("Red", "Blue"), ("Green", "Grey"), ("Gold", "Nobody")])
]


def fixture(index, home, away, kickoff="2024-08-16T19:00:00Z"):
    return {
        "fixture_index": index, "matchweek": "MW1", "official_home_name": home, "official_away_name": away,
        "kickoff_utc": kickoff, "kickoff_group_id": "G1", "canonical_event_id": None, "provider_event_ids": {},
        "source_identity_home_key": home.lower(), "source_identity_away_key": away.lower(),
    }


def write(path, value):
    path.write_text(json.dumps(value), encoding="utf-8")
    return str(path)


def test_documents_to_reconciliation_and_coverage(spark, tmp_path):
    fixtures_path = write(tmp_path / "fixtures.json", {
        "fixture_count": 3,
        "fixtures": [fixture(1, "Red", "Blue"), fixture(2, "Green", "Grey"), fixture(3, "Gold", "Pink")],
    })
    books = [
        {"key": "b1", "markets": [
            {"key": "h2h", "outcomes": [{"name": n, "price": 2.5} for n in ("Red", "Blue", "Draw", "Extra")]},
            {"key": "totals", "outcomes": [{"name": "Over", "price": 1.9, "point": 2.5}, {"name": "Under", "price": 1.9, "point": 2.5}]},
        ]},
        {"key": "b2", "markets": [{"key": "h2h", "outcomes": [{"name": "Red", "price": 2}, {"name": "Blue", "price": 3}]}]},
        "junk",
    ]
    payload = {"timestamp": "2024-08-16T17:55:00Z", "next_timestamp": "2024-08-16T18:00:00Z",
               "data": [{**EVENTS[0], "bookmakers": books}, {**EVENTS[1], "bookmakers": None}, EVENTS[2], 5]}
    payload_path = write(tmp_path / "payload.json", payload)
    alias_path = write(tmp_path / "alias.json", {n: n.lower() for n in ("Red", "Blue", "Green", "Grey", "Gold")})

    fixtures = documents.fixtures_of(documents.read_fixture_document(spark, fixtures_path))
    texts = documents.read_payload_text(spark, payload_path)
    aliases = documents.alias_entries(documents.read_payload_text(spark, alias_path))
    assert aliases.filter("code is not null").count() == 0
    made = Reconciliation(fixtures, snapshots.provider_events(texts, ["file"]), aliases.select("provider_label", "identity_key"))
    assert {r.fixture_index: r.status for r in made.fixture_results.collect()} == {
        1: "RESOLVED_EXACT_ALIAS", 2: "RESOLVED_EXACT_ALIAS", 3: "UNRESOLVED",
    }
    assert made.groups.first().group_status == "KICKOFF_CANDIDATES"
    assert [r.provider_event_id for r in made.unmatched_events.collect()] == ["e2"]
    assert made.totals.first().resolved_fixture_count == 2

    rows = snapshots.outcome_rows(snapshots.envelopes(texts, ["file"]).withColumn("snapshot_id", F.lit("s")), ["snapshot_id"])
    assert not any("next" in c for c in rows.columns)
    summary = {r.provider_event_id: r for r in V.event_market_summary(rows).collect()}
    first = summary["e0"]
    assert (first.bookmaker_count, first.h2h_bookmaker_count, first.complete_h2h_bookmaker_count, first.totals_bookmaker_count) == (2, 2, 1, 1)
    assert first.totals_distinct_points == [2.5]
    assert summary["e1"].bookmaker_count == 0
    pairs = made.resolved_pairs.withColumn("snapshot_id", F.lit("s"))
    expected = spark.createDataFrame([("s", 40)], "snapshot_id string, expected_fixture_count long")
    line = V.coverage(V.resolved_summaries(pairs, V.event_market_summary(rows)), expected).first()
    assert (line.resolved_fixture_count, line.unresolved_fixture_count, line.h2h_coverage) == (2, 38, 1 / 40)
    assert line.bookmaker_count_median == 1.0


def test_text_kickoffs_meet_only_when_spelled_alike(spark):
    fixtures = spark.createDataFrame([(1, "2024-08-16T19:00:00Z", "a", "b", "G")], "fixture_index int, kickoff string, home_key string, away_key string, kickoff_group_id string")
    aliases = spark.createDataFrame([("A", "a"), ("B", "b")], "provider_label string, identity_key string")
    for text, status in (("2024-08-16T19:00:00Z", "RESOLVED_EXACT_ALIAS"), ("2024-08-16T19:00:00+00:00", "UNRESOLVED")):
        events = spark.createDataFrame([("e", text, "A", "B")], "provider_event_id string, kickoff string, provider_home_team string, provider_away_team string")
        assert Reconciliation(fixtures, events, aliases).fixture_results.first().status == status


def test_plan_and_fixture_documents(spark, tmp_path):
    cutoffs = {"T-24h": "2024-08-15T19:00:00Z", "T-1h": "2024-08-16T18:00:00Z", "T-15m": "2024-08-16T18:45:00Z"}
    plan = {"kickoff_groups": [{"group_id": "G1", "matchweek": "MW1", "kickoff_utc": "2024-08-16T19:00:00Z", "cutoffs": cutoffs}],
            "query_plan": [{"group_id": "G1", "cutoff": c, "requested_snapshot_at_utc": v} for c, v in cutoffs.items()]}

    def groups(document):
        g = documents.plan_groups_of(documents.read_plan_document(spark, write(tmp_path / f"p{len(list(tmp_path.iterdir()))}.json", document)))
        return g.withColumn("kickoff", F.col("kickoff").cast("timestamp")).withColumn("cutoffs", F.transform_values("cutoffs", lambda _, v: v.cast("timestamp")))

    good = groups(plan)
    queries = documents.plan_queries_of(documents.read_plan_document(spark, write(tmp_path / "q.json", plan))).withColumn("requested_at", F.col("requested_at").cast("timestamp"))
    assert plan_cutoff_violations(good).count() == 0
    assert plan_query_violations(queries, good, list(cutoffs)).count() == 0
    plan["kickoff_groups"][0]["cutoffs"] = {**cutoffs, "T-1h": "2024-08-16T18:01:00Z"}
    assert [r.code for r in plan_cutoff_violations(groups(plan)).collect()] == ["CUTOFF_DELTA_MISMATCH"]

    rows = [fixture(1, "Red", "Blue"), fixture(2, "Red", "Red"), {**fixture(3, "Green", "Grey"), "canonical_event_id": "x"}]
    fixtures = documents.fixtures_of(documents.read_fixture_document(spark, write(tmp_path / "f.json", {"fixtures": rows})))
    found = {(r.code, r.subject) for r in fixture_violations(
        fixtures.withColumn("kickoff", F.col("kickoff").cast("timestamp")), good, ["MW1"]).collect()}
    assert found == {("SELF_MATCH", "2"), ("CANONICAL_ID_ASSIGNED", "3")}


def test_landing_and_source_manifest(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"x": 1}')
    (tmp_path / "b.txt").write_bytes("café \x00".encode())
    raw = landing.read_raw_files(spark, str(tmp_path))
    got = {r.path[-5:]: r for r in raw.select("path", *landing.payload_columns(F.col("content")), landing.blob_sha1(F.col("content")).alias("sha")).collect()}
    for name, kind in (("a.json", "JSON"), ("b.txt", "TEXT")):
        body = (tmp_path / name).read_bytes()
        line = got[name[-5:]]
        assert (line.payload_sha256, line.payload_bytes, line.payload_kind) == (hashlib.sha256(body).hexdigest(), len(body), kind)
        assert line.sha == hashlib.sha1(b"blob %d\0" % len(body) + body).hexdigest()


def test_rules_report_everything_and_can_fail(spark):
    rows = spark.createDataFrame(
        [("s", 0.5, 0.5, 0.4), (" ", 1.5, 0.2, 0.3), (None, float("nan"), 0.1, 0.1)],
        "selection_id string, p_raw double, p_calibrated double, p_safe double",
    )
    found = [[v.code for v in r.violations] for r in validate(rows, C.probability_estimate()).collect()]
    assert found == [[], ["EMPTY_VALUE", "PROBABILITY_OUT_OF_BOUNDS", "P_SAFE_EXCEEDS_CALIBRATED"], ["INVALID_TYPE", "NON_FINITE_NUMBER"]]
    with pytest.raises(ValueError, match="EMPTY_VALUE"):
        fail_on(violation_rows(rows, C.probability_estimate(), []), ["EMPTY_VALUE"])
    fail_on(violation_rows(rows.limit(1), C.probability_estimate(), []))


def test_time_rules(spark):
    rows = spark.sql(
        """select * from values
          (1, timestamp'2024-01-02', timestamp'2024-01-02', 'SYSTEM_RECEIPT', null, null),
          (2, timestamp'2024-01-03', timestamp'2024-01-02', 'SYSTEM_RECEIPT', null, null),
          (3, timestamp'2024-01-02', timestamp'2024-01-02', null, null, null),
          (4, null, timestamp'2024-01-02', 'VERIFIED_SOURCE_AVAILABILITY', null, null),
          (5, null, null, null, timestamp'2024-01-03', timestamp'2024-01-02'),
          (6, null, null, null, timestamp'2024-01-02', timestamp'2024-01-02')
          t(id, known_at, received_at, known_at_basis, valid_from, valid_to)"""
    )
    got = {(r.id, r.code) for r in violation_rows(rows, C.temporal(), ["id"]).collect()}
    assert got == {(2, "KNOWN_AT_RECEIPT_MISMATCH"), (3, "KNOWN_AT_BASIS_MISMATCH"), (4, "KNOWN_AT_BASIS_MISMATCH"), (5, "INVALID_VALIDITY_WINDOW")}


def test_report_sinks(spark, tmp_path):
    sinks.write_report({"a": spark.range(3), "b": spark.range(2)}, str(tmp_path / "r"))
    assert spark.read.schema("id long").json(str(tmp_path / "r" / "a")).count() == 3
    assert "logical_key" in schemas.OBSERVATION


def test_ordered_files_keep_their_order(spark, tmp_path):
    from knownby.sources.sinks import read_ordered, write_ordered

    rows = [(i * 37 % 101 if i % 9 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(7)
    for fmt in ("json", "parquet"):
        path = str(tmp_path / fmt)
        write_ordered(df, ["a", "b"], path, fmt, rows_per_file=60)
        found = [(r.a, r.b) for r in read_ordered(spark, path, "a long, b long", fmt).orderBy("ordinal").collect()]
        assert found == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    write_ordered(df.limit(0), ["a", "b"], str(tmp_path / "none"))
    assert read_ordered(spark, str(tmp_path / "none"), "a long, b long").count() == 0
