from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from knownby.functions import scalars as S
from knownby.functions import timeops, urls
from knownby.functions.canonical import canonical_json, row_digest
from knownby.sources.contract_json import canonical_lines

TEXTS = ["plain", "", 'q"u\\o', "tab\tnl\n\r\b\f", "\x01\x1f\x7f", "é▪", "😀 a", "\\u0022", "ünï\n\"x\""]


def test_strings_match_ascii_json(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    made = df.select("i", canonical_json(F.col("t"), df.schema["t"].dataType).alias("j"))
    assert {r.i: r.j for r in made.collect()} == {i: json.dumps(t) for i, t in enumerate(TEXTS)}


def test_doubles_print_in_their_shortest_form(spark):
    values = [0.0, -0.0, 1.0, 0.1, -2.5, 1e-4, 1.5e-5, 12345678.0, 1.5e7, 123456789.125, 1e15, 1e16, 1.5e22, 3e-10, 0.001, 99999.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    made = [r[0] for r in df.select(canonical_json(F.col("v"), df.schema["v"].dataType)).collect()]
    assert made == [json.dumps(v + 0.0) for v in values]


def test_record_text_and_digest(spark):
    ddl = "b string, a struct<z:boolean,y:array<string>,x:timestamp>, n long"
    when = datetime(2024, 1, 2, 3, 4, 5, 678, tzinfo=timezone.utc)
    df = spark.createDataFrame([("x", (True, ["p", "q"], when), None), (None, None, 5)], ddl)
    rows = [
        {"b": "x", "a": {"z": True, "y": ["p", "q"], "x": when.isoformat()}, "n": None},
        {"b": None, "a": None, "n": 5},
    ]
    texts = [json.dumps(r, sort_keys=True, separators=(",", ":")) for r in rows]
    record = df.select(F.struct("*").alias("r"))
    assert sorted(r.value for r in canonical_lines(record, "r", df.schema).collect()) == sorted(texts)
    digests = {hashlib.sha256(t.encode()).hexdigest() for t in texts}
    assert {r[0] for r in df.select(row_digest(df.schema)).collect()} == digests


@pytest.mark.parametrize(
    ("wall", "zone", "status", "utc"),
    [
        ("2024-08-16 20:00:00", "Europe/London", "OK", "2024-08-16 19:00:00"),
        ("2024-12-16 20:00:00", "Europe/London", "OK", "2024-12-16 20:00:00"),
        ("2024-08-16 20:00:00", "Europe/Paris", "OK", "2024-08-16 18:00:00"),
        ("2024-08-16 20:00:00", "America/New_York", "OK", "2024-08-17 00:00:00"),
        ("2024-08-16 20:00:00", "UTC", "OK", "2024-08-16 20:00:00"),
        ("2024-10-27 01:30:00", "Europe/London", "AMBIGUOUS", None),
        ("2024-03-31 01:30:00", "Europe/London", "NONEXISTENT", None),
        ("2024-11-03 01:30:00", "America/New_York", "AMBIGUOUS", None),
        ("2024-03-10 02:30:00", "America/New_York", "NONEXISTENT", None),
        ("2024-04-07 01:45:00", "Australia/Lord_Howe", "AMBIGUOUS", None),
        ("2024-08-16 20:00:00", "Not/AZone", "UNKNOWN_ZONE", None),
        ("2024-08-16 20:00:00", "", "UNKNOWN_ZONE", None),
    ],
)
def test_local_times(spark, wall, zone, status, utc):
    df = spark.createDataFrame([(wall, zone)], "w string, z string").select(F.col("w").cast("timestamp").alias("w"), "z")
    known = F.col("z").isin("Europe/London", "Europe/Paris", "America/New_York", "UTC", "Australia/Lord_Howe")
    instant, found = timeops.localize_strict(F.col("w"), F.col("z"), known)
    got = df.select(found.alias("s"), instant.cast("string").alias("u")).first()
    assert (got.s, got.u) == (status, utc)


def test_lenient_local_time_takes_the_first_reading(spark):
    df = spark.sql("select timestamp'2024-10-27 01:30:00' a, timestamp'2024-03-31 01:30:00' b")
    z = F.lit("Europe/London")
    got = df.select(timeops.localize_lenient(F.col("a"), z).cast("string"), timeops.localize_lenient(F.col("b"), z).cast("string")).first()
    assert tuple(got) == ("2024-10-27 00:30:00", "2024-03-31 01:30:00")


def test_urls(spark):
    cases = {
        "https://h.x/p?a=1&API_KEY=s%20x&b=#f": "https://h.x/p?a=1&API_KEY=%2A%2A%2AREDACTED%2A%2A%2A&b=#f",
        "https://h.x/p?q=a+b~*%7E": "https://h.x/p?q=a+b~%2A~",
        "https://h.x/p": "https://h.x/p",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.r for r in df.select("u", urls.redact_url(F.col("u")).alias("r")).collect()} == cases
    bad = spark.createDataFrame([("http://u:p@h/?token=1",)], "u string").select(urls.url_violations(F.col("u")).alias("v"))
    assert bad.first().v == ["NOT_HTTPS", "CREDENTIALS_IN_URL", "SENSITIVE_QUERY_KEY"]
    date = spark.createDataFrame([("https://h/?date=x&date=2024-01-01T00%3A00%3A00Z",)], "u string")
    assert date.select(urls.requested_snapshot_at(F.col("u")).cast("string")).first()[0] == "2024-01-01 00:00:00"


def test_blank_text_and_ratio(spark):
    df = spark.createDataFrame([(" \t\n",), ("  ",), ("\x1c",), (" a ",), ("",)], "t string")
    assert [r[0] for r in df.select(S.is_blank(F.col("t"))).collect()] == [True, True, True, False, True]
    assert spark.range(1).select(S.ratio(F.lit(1), F.lit(0))).first()[0] is None
