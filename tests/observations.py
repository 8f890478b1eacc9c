"""Literal observations and an independent, loop-based reading of the selection rules."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

SCHEMA = (
    "logical_key string, record_digest string, source_id string, revision_id string, "
    "payload_sha256 string, known_at timestamp, known_at_basis string, valid_from timestamp, "
    "valid_to timestamp, expires_at timestamp, raw_payload_sha256 string"
)
DAY = datetime(2024, 8, 16, tzinfo=timezone.utc)
CUTOFF = DAY + timedelta(hours=12)


def at(hours: float) -> datetime:
    return DAY + timedelta(hours=hours)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def row(key, revision, known_at, payload=None, source="provider-a", valid_from=None, valid_to=None,
        expires_at=None, raw=None, note=""):
    payload = f"value@{known_at}" if payload is None else payload
    content = (key, revision, known_at, payload, source, valid_from, valid_to, expires_at, raw, note)
    return (
        key, sha(repr(content)), source, revision, sha(payload), known_at,
        None if known_at is None else "SYSTEM_RECEIPT", valid_from, valid_to, expires_at,
        None if raw is None else sha(raw),
    )


def golden():
    return [
        row("lineup", "v1", at(10), "A", raw="A"), row("lineup", "v2", at(14), "B", raw="B"),
        row("odds", "o1", at(9)), row("odds", "o2", at(10)), row("odds", "o3", at(11)),
        row("injury", "i-now", at(20)),
        row("weather", "w1", at(11), "sun"), row("weather", "w2", at(11), "rain"),
        row("referee", "r1", None),
    ]


def histories(count: int):
    """``count`` random histories, one logical key each."""
    rng, rows = random.Random(20240816), []
    for n in range(count):
        for _ in range(rng.randint(1, 6)):
            def maybe():
                return at(rng.randrange(0, 49) / 2) if rng.random() < 0.25 else None
            known = at(rng.randrange(0, 49) / 2) if rng.random() < 0.9 else None
            rows.append(
                row(f"key-{n}", rng.choice(["r1", "r2", "r3", None]), known, rng.choice("AB"),
                    source=rng.choice(["s1", "s1", "s1", "s2"]), valid_from=maybe(), expires_at=maybe(),
                    note=str(rng.randrange(3)))
            )
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def why_not(r, cutoff):
    known, valid_from, valid_to, expires = r[5], r[7], r[8], r[9]
    out = []
    if known is None:
        out.append("MISSING_KNOWN_AT")
    elif known > cutoff:
        out.append("KNOWN_AFTER_CUTOFF")
    if valid_from is not None and valid_from > cutoff:
        out.append("NOT_YET_VALID_AT_CUTOFF")
    if (valid_to is not None and valid_to < cutoff) or (expires is not None and expires <= cutoff):
        out.append("EXPIRED_AT_CUTOFF")
    if r[3] is None:
        out.append("SOURCE_VERSION_UNRESOLVED")
    return out


def expected(rows, cutoff):
    """{key: (status, digest)}, {(key, digest): (disposition, reasons)} by plain loops."""
    by_key = defaultdict(dict)
    for r in rows:
        by_key[r[0]][r[1]] = r
    outcomes, decisions = {}, {}
    for key, records in by_key.items():
        known = [r for r in records.values() if r[5] is not None and r[5] <= cutoff]
        contents, good = defaultdict(set), defaultdict(list)
        for r in known:
            if r[3] is not None:
                contents[r[2], r[3]].add(r[4])
                if not why_not(r, cutoff):
                    good[r[2], r[3]].append((r[5], r[1]))
        first = {v: min(seen) for v, seen in good.items()}
        stuck = any(len(c) > 1 for c in contents.values()) or len({s for s, _ in good}) > 1
        winner = None
        if first and not stuck:
            top = max(t for t, _ in first.values())
            ahead = [v for v, (t, _) in first.items() if t == top]
            stuck = len(ahead) > 1
            winner = None if stuck else ahead[0]
        for r in known:
            if why_not(r, cutoff) == ["SOURCE_VERSION_UNRESOLVED"]:
                stuck = stuck or winner is None or r[5] >= first[winner][0]
        digest = None if stuck or winner is None else first[winner][1]
        outcomes[key] = ("UNRESOLVED" if stuck else "SELECTED" if digest else "NO_ELIGIBLE_VERSION", digest)
        for d, r in records.items():
            reasons = why_not(r, cutoff)
            if reasons:
                kind = "REJECTED"
            elif stuck:
                kind = "UNRESOLVED"
            elif d == digest:
                kind = "SELECTED"
            else:
                kind = "DUPLICATE_OBSERVATION" if (r[2], r[3]) == winner else "ELIGIBLE_NOT_LATEST"
            decisions[key, d] = (kind, tuple(reasons))
    return outcomes, decisions
