"""Operators compute what they read once, whatever is asked of it."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from knownby.operators.asof import select_as_of
from knownby.operators.coverage import event_market_summary
from knownby.operators.manifest import DatasetRef, audit, materialize, verify_replay
from knownby.plans import kernel
from knownby.sources.contract_json import strict_records
from knownby.sources.snapshots import envelopes, outcome_rows
from observations import CUTOFF, SCHEMA, expected, histories

DECISION = (
    "cutoff_id string, logical_key string, record_digest string, source_id string, revision_id string, "
    "payload_sha256 string, disposition string, reasons array<string>"
)
OUTCOME = "cutoff_id string, logical_key string, status string, selected_record_digest string, input_count bigint"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_audit_reads_both_tables_once_and_counts_every_violation(spark, tmp_path):
    bad = ("c", "k", "d1", "s", "r", "p", "SELECTED", ["MISSING_KNOWN_AT"])
    rows = [bad] * 3 + [("c", "k", "d2", "s", "r", "p", "ELIGIBLE_NOT_LATEST", ["B", "A"])]
    rows += [("c", None, "d3", "s", "r", "p", "SELECTED", []), ("c", "fine", "d4", "s", "r", "p", "SELECTED", [])]
    given = [("c", "k", "SELECTED", "d1", 1), ("c", "fine", "SELECTED", "d4", 1)]
    spark.createDataFrame(rows, DECISION).write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(given, OUTCOME).write.parquet(f"{tmp_path}/o")
    found = audit(spark.read.parquet(f"{tmp_path}/d"), spark.read.parquet(f"{tmp_path}/o"))
    assert optimized(found).count("Relation [") == 2
    assert sorted((r["logical_key"] or "", r["code"], r["detail"]) for r in found.collect()) == sorted(
        [("k", "DISPOSITION_MISMATCH", "rejected exactly with reasons")] * 4
        + [("k", "NON_CANONICAL_REASONS", "reasons"), ("k", "NON_CANONICAL_DECISIONS", "repeated decision"),
           ("k", "COUNT_MISMATCH", "fewer inputs than decisions"),
           ("k", "SELECTION_MISMATCH", "selected decision matches outcome"),
           ("", "NON_CANONICAL_MANIFEST", "every key needs decisions")]
    )


def test_replay_difference_counts_hot_keys_once_on_the_rows_as_read(spark, monkeypatch):
    counted = []

    def hot_values(rows, *_):
        counted.append(optimized(rows))
        return [], True

    monkeypatch.setattr("knownby.operators.asof.hot_values", hot_values)
    lines = spark.range(20).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "0.09D AS l_discount", "0.0D AS l_tax",
        "'A' AS l_returnflag", "timestamp'1996-01-01' AS l_shipdate",
    )
    tables = type("Tables", (), {"lineitem": lines})()
    recorded, replayed = kernel._recorded_and_replayed(tables)
    assert recorded.count() == 20 and replayed.count() == 0
    assert len(counted) == 1 and "Repartition" not in counted[0]


def test_known_hot_keys_take_the_split_way_to_the_same_decisions(spark):
    lines = spark.range(40).selectExpr(
        "id % 4 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "0.0D AS l_discount", "0.0D AS l_tax",
        "'A' AS l_returnflag", "timestamp'1996-01-01' AS l_shipdate",
    )
    observations = kernel.lineitem_observations(type("Tables", (), {"lineitem": lines})())
    plain = select_as_of(observations, kernel.ONE_CUTOFF, known_hot=([], True)).decisions
    split = select_as_of(observations, kernel.ONE_CUTOFF, known_hot=(["order-1"], True)).decisions
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0 and plain.count() == 40


def test_payloads_are_parsed_once(spark):
    text = (
        '{"timestamp":"2024-01-01T00:00:00Z","data":[{"id":"e","home_team":"H","away_team":"A","bookmakers":[{"key":"b","markets":'
        '[{"key":"totals","outcomes":[{"name":"Over","point":2.5},{"name":"Under","point":-0.0},{"name":"Under","point":0.0}]}]}]}]}'
    )
    payloads = spark.createDataFrame([("s", text), ("t", "[]"), ("u", None)], "snapshot_id string, payload string")
    summary = event_market_summary(outcome_rows(envelopes(payloads, ["snapshot_id"]), ["snapshot_id"]))
    row, = summary.collect()
    assert row["totals_bookmaker_count"] == 1 and list(map(str, row["totals_distinct_points"])) == ["0.0", "2.5"]
    read = payloads.select("snapshot_id", F.concat("payload", F.lit("")).alias("payload")).cache()
    plan = optimized(event_market_summary(outcome_rows(envelopes(read, ["snapshot_id"]), ["snapshot_id"])))
    read.unpersist()
    assert len(re.findall(r"parse_?json\(", plan, re.I)) == 1


def test_strict_records_look_at_every_value_once(spark):
    names = [f"f{i}" for i in range(6)]
    schema = T.StructType([T.StructField(n, T.StringType(), False) for n in names])
    texts = spark.range(3).select("id", F.concat(F.lit('{"f0":"'), F.col("id").cast("string"), F.lit('"}')).alias("t"))
    read = strict_records(texts, "t", schema, ["id"])
    assert all([v["field"] for v in r["violations"]] == names[1:] for r in read.collect())
    assert len(re.findall(r"schema_?of_?variant\(", optimized(read), re.I)) <= len(names)


def test_cutoffs_are_judged_side_by_side_on_rows_that_are_sorted_once(spark):
    rows = spark.createDataFrame(histories(40), SCHEMA)
    cuts = [(f"c{i}", CUTOFF + timedelta(hours=i)) for i in (-6, 0, 6, 7, 30)]
    made = select_as_of(rows, cuts, known_hot=([], True))
    three = select_as_of(rows, cuts[:3], known_hot=([], True)).decisions
    plan = three._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Generate", 1)[0].count("Window") == 0 and "Generate" in plan and len(re.findall(r"\bSort \[", plan)) == 1
    hot = ([f"key-{n}" for n in range(40)], False)
    chained = select_as_of(rows, cuts, known_hot=hot)
    for name in ("decisions", "outcomes", "selected"):
        one, other = getattr(made, name), getattr(chained, name).select(*getattr(made, name).columns)
        assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0 and one.count() > 0
    for cut, when in cuts:
        outcomes, decisions = expected(histories(40), when)
        found = {(r["logical_key"], r["record_digest"]): (r["disposition"], tuple(r["reasons"]))
                 for r in made.decisions.where(F.col("cutoff_id") == cut).collect()}
        assert found == decisions


def test_a_replay_of_several_codes_is_one_selection(spark, monkeypatch):
    rows = spark.createDataFrame(histories(12), SCHEMA)
    cuts, dataset = [("a", CUTOFF), ("b", CUTOFF + timedelta(hours=3))], DatasetRef("SNAPSHOT", "test", "1")
    manifest = materialize(rows, cuts, "0" * 40, dataset).manifest
    other = F.when(F.col("cutoff_id") == "b", "f" * 40).otherwise(F.col("code_version"))
    sealed = spark.createDataFrame(manifest.collect(), manifest.schema)
    ran = []

    def counted(observations, cutoffs, *args, **named):
        ran.append([c for c, _ in cutoffs])
        return select_as_of(observations, cutoffs, *args, **named)

    monkeypatch.setattr("knownby.operators.manifest.select_as_of", counted)
    assert [r["cutoff_id"] for r in verify_replay(sealed.withColumn("code_version", other), rows).collect()] == ["b"]
    assert ran == [["a", "b"]]
    ran.clear()
    twice = sealed.where("cutoff_id = 'a'").unionByName(sealed.where("cutoff_id = 'a'").withColumn("code_version", F.lit("f" * 40)))
    assert verify_replay(twice, rows).count() == 2 and ran == [["a"], ["a"]]
