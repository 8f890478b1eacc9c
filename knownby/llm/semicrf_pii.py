"""Personal data by a semi-Markov conditional random field beside exact base patterns.

Candidate segments are runs of up to ``MOST_TOKENS`` tokens around digits or an at sign; features look
at a whole segment (its shape in digit groups, number of digits, check digit, octets, signs, the word before).
A text is a lattice in which every place outside a segment scores 0 and a segment of type t scores
w . f(segment, t). The probability of a segmentation is proportional to exp(total score), and bounded
dynamic programming over places and segments picks boundaries and types together.

Weights are fitted by conditional likelihood (forward and backward sums over the lattice) on a bounded
sample of labelled places: the base patterns' finds, the same with their give-away signs changed (a phone
without its plus, "(at)" for "@"), spoiled ones that must not be found (a wrong check digit, an octet of
300) and other numbers of the corpus. So the model finds what the patterns' rules miss and adds it where
its log odds exceed ``LEAST_LOG_ODDS``; spans of the base patterns always stay.

Defined cases: a null text counts as empty and has no spans; repeated rows get equal spans; without any
labelled place the model adds nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 6
#: Bound of the training sample: places with the smallest hashes.
MAX_PLACES = 3_000
EPOCHS, RATE, SHRINK = 4, 0.3, 1e-4
LEAST_LOG_ODDS = 2.0
RESULT = "struct<n_email:bigint,n_ip:bigint,n_card:bigint,n_phone:bigint,base_sha256:string,spans:string>"

# The base patterns, written so that no digit or letter is looked at twice.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
_DIGIT = re.compile(r"[0-9]")

_NUMBERS = re.compile(r"[+(]{0,2}[0-9](?:[0-9().\-/]|\x20(?=[(+0-9]))*")
# Only from the head of a run: what fails there fails further on.
_AT = re.compile(r"(?<![^\s\"'<>()\[\],;])[^\s\"'<>()\[\],;]+(?:@|\x20?[(\[]at[)\]]\x20?)[^\s\"'<>()\[\],;]+(?:\x20?[(\[]dot[)\]]\x20?[^\s\"'<>()\[\],;]+)*")
_GROUP = re.compile(r"[0-9]+")
_WORD_BEFORE = re.compile(r"([^\W\d_]+)\W{0,3}\Z")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text[begin - 1]).end():
            begin -= 1
        found = _HOST.match(text, at) if begin < at else None
        if found:
            done = found.end()
            yield begin, done, "email"
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The base patterns' spans by start, then kind as listed."""
    if not _TRIGGER.search(text):
        return []
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass(frozen=True)
class Place:
    """A stretch of text that may hold segments: candidate (start, end) with the features of each."""

    candidates: tuple[tuple[int, int], ...]
    features: tuple[tuple[str, ...], ...]


def segment_features(text: str, start: int, end: int, whole: bool) -> tuple[str, ...]:
    """Features of the segment as one unit; they are paired with its type when scored."""
    own = text[start:end]
    groups = _GROUP.findall(own)
    digits = "".join(groups)
    found = ["bias", f"whole {whole}", f"digits {min(len(digits), 20)}"]
    before = _WORD_BEFORE.search(text[max(0, start - 24) : start])
    if before:
        found.append(f"after {before[1].lower()}")
    if end < len(text) and (text[end].isalnum() or text[end] in "@_"):
        found.append("cut")
    if start and (text[start - 1].isalnum() or text[start - 1] in "@_"):
        found.append("cut before")
    if "@" in own or "at" in own:
        host = re.split(r"@|\x20?[(\[]at[)\]]\x20?", own)[-1]
        found += ["sign @", f"dotted {bool(re.search(r'[.]|dot', host))}", f"ends {bool(re.search(r'[a-z]{2,}$', host))}"]
    else:
        found += [
            f"shape {re.sub(r'[0-9]+', lambda m: str(len(m[0])), own)}", f"groups {len(groups)} of {min(len(digits), 20)}",
            f"octets {len(groups) == 4 and own.count('.') == 3 and all(len(g) < 4 and int(g) < 256 for g in groups)}",
            f"check {12 <= len(digits) <= 19 and luhn(digits)}", f"signs {''.join(sorted(set(re.sub('[0-9]', '', own))))}",
        ]
    return tuple(found)


def place_of(text: str, start: int, end: int) -> Place:
    """The lattice of one stretch: all runs of its tokens, or the stretch if it holds an at sign."""
    if "@" in text[start:end] or "at" in text[start:end]:
        spans = [(start, end)]
    else:
        tokens = [(start + m.start(), start + m.end()) for m in re.finditer(r"[^\x20]+", text[start:end])]
        spans = [
            (tokens[i][0], _trimmed(text, tokens[i][0], tokens[j][1]))
            for i in range(len(tokens)) for j in range(i, min(len(tokens), i + MOST_TOKENS))
        ]
        spans = [s for s in dict.fromkeys(spans) if len(_DIGIT.findall(text[s[0] : s[1]])) >= 7]
    return Place(tuple(spans), tuple(segment_features(text, a, b, (a, b) == (start, end)) for a, b in spans))


def _trimmed(text: str, start: int, end: int) -> int:
    while end > start and not text[end - 1].isdigit():
        end -= 1
    return end


def stretches(text: str) -> list[tuple[int, int]]:
    if not _TRIGGER.search(text):
        return []
    found = [(m.start(), _trimmed(text, *m.span())) for m in _NUMBERS.finditer(text)]
    found = [s for s in found if len(_DIGIT.findall(text[s[0] : s[1]])) >= 7]
    if "@" in text or "at)" in text or "at]" in text:
        found += [(m.start(), m.start() + len(m[0].rstrip(".!?:"))) for m in _AT.finditer(text)]
    return sorted(found)


class Taken:
    """Disjoint stretches of a text in order, so that one search tells whether a span meets any of them."""

    def __init__(self, spans: list[Span]) -> None:
        """``spans``: by start; they may overlap."""
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end, _ in spans:
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end) - 1
        return i >= 0 and self.ends[i] > start

    def add(self, start: int, end: int) -> None:
        """A span that meets none so far."""
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


Weights = dict[str, float]


def _scores(place: Place, weights: Weights) -> list[tuple[float, ...]]:
    return [tuple(sum(weights.get(f"{k}|{x}", 0.0) for x in f) for k in KINDS) for f in place.features]


def _lattice(place: Place) -> tuple[list[int], dict[int, int]]:
    cuts = sorted({p for c in place.candidates for p in c})
    return cuts, {p: i for i, p in enumerate(cuts)}


def best_segments(place: Place, weights: Weights) -> list[tuple[int, int, str, float]]:
    """(start, end, type, score) of the best segmentation."""
    cuts, index = _lattice(place)
    best: list[tuple[float, tuple | None]] = [(0.0, None)] * max(1, len(cuts))
    arriving: dict[int, list] = {}
    for (a, b), scores in zip(place.candidates, _scores(place, weights)):
        arriving.setdefault(index[b], []).append((index[a], max(zip(scores, KINDS)), a, b))
    for i in range(1, len(cuts)):
        best[i] = (best[i - 1][0], ("skip", i - 1))
        for j, (score, kind), a, b in arriving.get(i, ()):
            if best[j][0] + score > best[i][0]:
                best[i] = (best[j][0] + score, ("take", j, a, b, kind, score))
    found, i = [], len(cuts) - 1
    while i > 0 and best[i][1] is not None:
        step = best[i][1]
        if step[0] == "take":
            found.append(step[2:])
        i = step[1]
    return found[::-1]


def sums(n: int, edges: list[tuple[int, int, int, str, float]]) -> tuple[list[float], list[float]]:
    """Log sums over all segmentations up to, and from, each of ``n`` cuts; ``edges``: (from, to, candidate, type, score)."""
    arriving: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    leaving: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, _, _, s in edges:
        arriving[b].append((a, s))
        leaving[a].append((b, s))
    forward, backward = [0.0] * n, [0.0] * n
    for i in range(1, n):
        forward[i] = _log_sum([forward[i - 1], *(forward[a] + s for a, s in arriving[i])])
    for i in range(n - 2, -1, -1):
        backward[i] = _log_sum([backward[i + 1], *(backward[b] + s for b, s in leaving[i])])
    return forward, backward


def fit(examples: list[tuple[Place, dict[tuple[int, int], str]]]) -> Weights:
    """Conditional likelihood by adaptive gradient steps; ``examples``: places and their true segments."""
    weights: Weights = {}
    squares: Weights = {}
    for _ in range(EPOCHS):
        for place, truth in examples:
            cuts, index = _lattice(place)
            n = max(1, len(cuts))
            edges = [
                (index[a], index[b], c, k, s)
                for c, ((a, b), scores) in enumerate(zip(place.candidates, _scores(place, weights)))
                for k, s in zip(KINDS, scores)
            ]
            forward, backward = sums(n, edges)
            for a, b, c, kind, s in edges:
                p = math.exp(forward[a] + s + backward[b] - forward[-1])
                miss = float(truth.get(place.candidates[c]) == kind) - p
                if abs(miss) < 1e-4:
                    continue
                for x in place.features[c]:
                    name = f"{kind}|{x}"
                    g = miss - SHRINK * weights.get(name, 0.0)
                    squares[name] = squares.get(name, 1e-2) + g * g
                    weights[name] = weights.get(name, 0.0) + RATE * g / math.sqrt(squares[name])
    return weights


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms))


def variants(before: str, own: str, kind: str, after: str) -> list[tuple[str, str | None]]:
    """(text of the segment, its type) for a labelled find: itself, disguised, and spoiled."""
    found: list[tuple[str, str | None]] = [(own, kind)]
    if kind == "phone":
        bare = re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", own)
        found += [(v, "phone") for v in (own[1:], bare, bare.replace(" ", "-")) if len(_DIGIT.findall(v)) >= 9]
    elif kind == "email":
        found += [(own.replace("@", sign), "email") for sign in (" (at) ", "[at]")]
    elif kind == "card":
        spoiled = own[:-1] + str((int(own[-1]) + 1) % 10)
        found += [(spoiled, None), (re.sub(r"[0-9]{4}(?=[0-9])", r"\g<0> ", own), "card")]
    else:
        found += [("300." + own.split(".", 1)[1], None), (own.replace(".", "-"), None)]
    return found


def training_examples(text: str) -> list[tuple[Place, dict[tuple[int, int], str]]]:
    """Labelled places of one piece of text with its surroundings."""
    base = base_spans(text)
    found = []
    for start, end, kind in base:
        before, after = text[max(0, start - 24) : start], text[end : end + 8]
        for own, label in variants(before, text[start:end], kind, after):
            shown = before + own + after
            span = (len(before), len(before) + len(own))
            for stretch in stretches(shown):
                if stretch[0] < span[1] and span[0] < stretch[1]:
                    found.append((place_of(shown, *stretch), {span: label} if label else {}))
    taken = Taken(base)
    for stretch in stretches(text):
        if not taken.meets(*stretch):
            found.append((place_of(text, *stretch), {}))
    return found


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches that may hold personal data, with the text around them."""
    for b in batches:
        found = []
        for text in b["text"].to_pylist():
            if text:
                spans = base_spans(text) + [(*s, "") for s in stretches(text)]
                found += dict.fromkeys(text[max(0, a - 24) : e + 8] for a, e, _ in spans)
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(found, pa.string()), "rank": pa.array([zlib.crc32(x.encode()) for x in found], pa.int64()),
        })


def train(docs: DataFrame) -> Weights:
    """Weights from a bounded sample of the stretches in ``docs`` (text)."""
    pieces = docs.select("text").mapInArrow(_surroundings, "piece string, rank bigint")
    sample = pieces.orderBy("rank", "piece").limit(MAX_PLACES)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = sorted(dict.fromkeys(t for b in batches for t in b["piece"].to_pylist()), key=lambda t: zlib.crc32(t.encode()))
        weights = fit([e for t in texts for e in training_examples(t)])
        yield pa.RecordBatch.from_pydict({
            "name": pa.array(list(weights), pa.string()), "weight": pa.array(list(weights.values()), pa.float64()),
        })

    learned = sample.coalesce(1).mapInArrow(learn, "name string, weight double").toArrow()
    return dict(zip(learned["name"].to_pylist(), learned["weight"].to_pylist()))


def all_spans(text: str, base: list[Span], weights: Weights) -> list[Span]:
    """Base spans, and those of the model that touch none of them."""
    found, own, taken = list(base), Taken(base), Taken(base)
    for stretch in stretches(text):
        place = place_of(text, *stretch)
        free = [i for i, span in enumerate(place.candidates) if not own.meets(*span)]
        if free:
            place = Place(tuple(place.candidates[i] for i in free), tuple(place.features[i] for i in free))
            for a, b, kind, score in best_segments(place, weights):
                if score >= LEAST_LOG_ODDS and not taken.meets(a, b):
                    found.append((a, b, kind))
                    taken.add(a, b)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base counts and digest, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    @F.arrow_udf(RESULT)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            text = text or ""
            base = base_spans(text)
            row = {f"n_{k}": sum(s[2] == k for s in base) for k in KINDS}
            row["base_sha256"] = hashlib.sha256(_joined(base).encode()).hexdigest()
            row["spans"] = _joined(all_spans(text, base, shared.value))
            rows.append(row)
        number = pa.int64()
        return pa.array(rows, pa.struct([(f"n_{k}", number) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())]))

    return docs.select("doc_id", find("text").alias("found")).select("doc_id", "found.*")
