from __future__ import annotations

import hashlib
import json
from datetime import datetime, timedelta, timezone

from knownby import schemas
from knownby.operators import contracts as C
from knownby.operators.asof import select_as_of
from knownby.operators.eligibility import observation_view
from knownby.operators.rules import violation_rows

NOON = datetime(2024, 8, 16, 12, tzinfo=timezone.utc)


def record(revision, hours, note="é"):
    at = NOON - timedelta(hours=hours, microseconds=250)
    sha = hashlib.sha256(note.encode()).hexdigest()
    temporal = dict.fromkeys(("event_time", "published_at", "valid_from", "valid_to", "expires_at"))
    return {
        "logical_key": "fixture-1", "revision_id": revision, "payload_sha256": sha,
        "provenance": {
            "source": {"source_id": "provider-a", "tier": "LICENSED_PRO", "source_version": None},
            "external_id": note,
            "temporal": {**temporal, "received_at": at, "known_at": at, "known_at_basis": "SYSTEM_RECEIPT"},
            "data_state": {"quality": "VALID", "freshness": "RECENT", "verification": "VERIFIED", "conflict": "NONE"},
            "critical": True,
        },
        "raw_snapshot": {
            "source_id": "provider-a", "request_identity": "GET /x", "payload_sha256": sha, "received_at": at,
            "ingestion_version": "1",
        },
    }


def digest(value):
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), default=lambda d: d.isoformat())
    return hashlib.sha256(text.encode()).hexdigest()


def test_nested_records_reach_the_kernel_with_their_digest(spark):
    rows = [record("v1", 3), record("v2", 1), record("v3", -1)]
    nested = spark.createDataFrame(rows, schemas.OBSERVATION)
    assert violation_rows(nested, C.observation(), ["revision_id"]).count() == 0
    view = observation_view(nested)
    assert {r.record_digest for r in view.collect()} == {digest(r) for r in rows}
    outcome = select_as_of(view, [("c", NOON)]).outcomes.first()
    assert (outcome.status, outcome.selected_record_digest) == ("SELECTED", digest(rows[1]))
