"""Personal data in texts: patterns, and a semi-Markov conditional random field beside them.

Base spans are the checked matches of four patterns (email, ip, card, phone), leftmost and
non-overlapping per kind; a match that fails its check is dropped and not tried shorter.
So two numbers that stand together, or a phone number before an address, are missed.

The field reads regions: words with a digit or an ``@``, and those that follow after
single spaces. A region is cut into tokens (runs of letters, of digits, of other
letters; single marks). A segment of at most ``MOST_TOKENS`` tokens that could be of a
kind is a candidate; features of the whole span (its digits and their groups, checksum,
number ranges, marks, ends, what stands before and after) score it, every other token
scores 0, and weights of label pairs score what follows what. Dynamic programming over
the tokens chooses boundaries and kinds together. Regions without a candidate, and
everything outside regions, need no choice. Spans that the field adds never touch
base ones.

The field is trained on at most ``SAMPLE`` distinct regions of each kind, and as many
of none, by their base spans, as they are and joined in pairs with a space; the regions
are those with the least hashes of all rows given. Regions in which a match was dropped
for its length alone are left out, since what they hold is not told. Phone numbers with
brackets are also shown without their country code, and the digits of phone numbers
one by one, as no number at all. The fit runs in one task.

Results for the odd cases: NULL and empty texts have no spans; rows that repeat an id are
searched each; without any base span nothing is added; an empty table gives an empty
result; further columns are ignored. Every step is linear in the length of the text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm.ship import ready
from planefold.operators.ordering import top_per_group
from planefold.session import settle

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
SAMPLE = 200
#: Longest region, in characters, to be trained on.
EXAMPLE_CHARS = 200
MOST_TOKENS = 40
MOST_DIGITS = 19
EPOCHS = 12
RATE = 0.3
DECAY = 1e-4
SEED = 13
SPANS = "doc_id long, base array<struct<kind:int,start:int,stop:int>>, added array<struct<kind:int,start:int,stop:int>>"
Span = tuple[int, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Matches start where a run of digits does: a later start in the run would fail the same way.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_REGION = re.compile(r"\S*?[0-9@]\S*(?: [^\s0-9@]*+[0-9@]\S*)*")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\x00-\x7f]+|[\x00-\x7f]")
_DIGITS = re.compile(r"[0-9]+")
_COUNTRY = re.compile(r"\+[0-9]+ (?=\()")


def passes_luhn(digits: str) -> bool:
    """Whether the digits' checksum is right."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        total += value if place % 2 == 0 else (2 * value - 9 if value > 4 else 2 * value)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, at, free = [], text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > free and not _NOT_LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                found.append((0, start, domain.end()))
                free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans ``(kind, start, stop)`` by kind and start, and the matches that were dropped for too many digits."""
    found, long = _emails(text) if "@" in text else [], []
    for match in _IP.finditer(text):
        if all(len(part) < 4 and int(part or "0") < 256 for part in (p.lstrip("0") for p in match[0].split("."))):
            found.append((1, *match.span()))
    for kind, pattern, least, most in ((2, _CARD, 13, 19), (3, _PHONE, 9, 15)):
        for match in pattern.finditer(text):
            digits = "".join(_DIGITS.findall(match[0]))
            if len(digits) > most:
                long.append((kind, *match.span()))
            elif len(digits) >= least and (kind == 3 or passes_luhn(digits)):
                found.append((kind, *match.span()))
    return found, long


def _class(text: str, at: int) -> str:
    """Sort of character at a place: itself for the marks that matter."""
    if not 0 <= at < len(text):
        return "|"
    c = text[at]
    if c.isascii():
        return "d" if c.isdigit() else "l" if c.isalpha() else c if c in " .-+()@" else "_" if c in "_%" else "*"
    return "x"


def _features(text: str, a: int, b: int, kind: int) -> list[str]:
    """Names of the features of a whole span as one of a kind."""
    span = text[a:b]
    runs = _DIGITS.findall(span)
    digits = "".join(runs)
    marks = "".join(sorted({_class(span, i) for i in range(len(span))} - {"d", "l"}))
    after = _class(text, b)
    names = [
        "bias",
        "first " + _class(text, a),
        "last " + _class(text, b - 1),
        "before " + _class(text, a - 1),
        "after " + after,
        "marks " + marks,
    ]
    if after in " .-":
        names.append("after " + after + _class(text, b + 1))
    if kind == 0:
        local, _, domain = span.partition("@")
        names += [f"local {_LOCAL.fullmatch(local) is not None}", f"domain {_DOMAIN.fullmatch(domain) is not None}"]
        names.append(f"end {min(len(domain.rpartition('.')[2]), 7)}")
    elif kind == 1:
        names.append(f"octets {len(runs) == 4 and all(len(x) < 4 and int(x) < 256 for x in runs)} {marks == '.'}")
    else:
        names += [f"digits {len(digits)}", f"groups {len(runs)}", "widths " + "-".join(str(len(x)) for x in runs[:6])]
        if kind == 2:
            names.append(f"checksum {13 <= len(digits) <= 19 and passes_luhn(digits)}")
        else:
            names.append(f"brackets {span.count('(') == span.count(')')} {'(' in span}")
    return [f"{KINDS[kind]} {name}" for name in names]


@dataclass
class Lattice:
    """Candidate segments of a region: by end token, ``(start token, kind, features)``; and the tokens' bounds."""

    bounds: list[int]
    ending: list[list[tuple[int, int, list]]]


def lattice(text: str) -> Lattice | None:
    """All candidates of a region, or None if there is none."""
    n_digits = sum(map(len, _DIGITS.findall(text)))
    dots = text.count(".")
    if "@" not in text and n_digits < 8 and not (dots >= 3 and n_digits >= 4):
        return None
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    bounds = [0, *(end for _, end in tokens)]
    sort = [_class(text, start) for start, _ in tokens]
    ending: list[list[tuple[int, int, list]]] = [[] for _ in bounds]
    any_ = False
    for i, first in enumerate(sort):
        if first not in "dl+(_.-":
            continue
        ats = points = digits = 0
        numeric = first in "d+("
        for j in range(i, min(i + MOST_TOKENS, len(sort))):
            c = sort[j]
            ats += c == "@"
            points += c == "."
            digits += tokens[j][1] - tokens[j][0] if c == "d" else 0
            numeric = numeric and c in "d .-+()"
            if ats > 1 or (ats and c in " *()x") or (not numeric and not ats and c in " *()x"):
                break
            if not ats and not numeric and "@" not in text[bounds[j] :]:
                break
            if numeric and digits > MOST_DIGITS and not ats:
                break
            if c not in "dl":
                continue
            a, b = bounds[i], bounds[j + 1]
            kinds = [0] if ats else []
            if numeric and points == 3 and first == "d" and digits >= 4:
                kinds.append(1)
            if numeric and c == "d" and digits >= 12 and first == "d":
                kinds.append(2)
            if numeric and c == "d" and digits >= 8 and first in "+(d":
                kinds.append(3)
            for kind in kinds:
                any_ = True
                ending[j + 1].append((i, kind, _features(text, a, b, kind)))
    return Lattice(bounds, ending) if any_ else None


class Field:
    """Weights of features and of label pairs."""

    def __init__(self, weights: dict[str, float] | None = None, pairs: list[list[float]] | None = None) -> None:
        self.weights = weights or {}
        self.pairs = np.array(pairs) if pairs else np.zeros((NONE + 1, NONE + 1))

    def score(self, features: list[str]) -> float:
        get = self.weights.get
        return sum(get(name, 0.0) for name in features)

    def best(self, region: Lattice) -> list[Span]:
        """The segments of the best labelling: kind and bounds in characters."""
        pairs = self.pairs
        value = np.full((len(region.bounds), NONE + 1), -np.inf)
        value[0, NONE] = 0.0
        back: list[list[tuple[int, int] | None]] = [[None] * (NONE + 1) for _ in region.bounds]
        for end in range(1, len(region.bounds)):
            into = value[end - 1] + pairs[:, NONE]
            value[end, NONE], back[end][NONE] = into.max(), (end - 1, int(into.argmax()))
            for start, kind, features in region.ending[end]:
                into = value[start] + pairs[:, kind]
                total = into.max() + self.score(features)
                if total > value[end, kind]:
                    value[end, kind], back[end][kind] = total, (start, int(into.argmax()))
        found, end, label = [], len(region.bounds) - 1, int(value[-1].argmax())
        while end > 0:
            start, before = back[end][label]
            if label != NONE:
                found.append((label, region.bounds[start], region.bounds[end]))
            end, label = start, before
        return found[::-1]

    def slope(self, region: Lattice, gold: set[tuple[int, int, int]]) -> tuple[dict[str, float], np.ndarray, float]:
        """Gradient of the log likelihood of the gold segments ``(kind, start token, end token)``, and its value."""
        n, pairs = len(region.bounds), self.pairs
        forward, backward = np.full((n, NONE + 1), -np.inf), np.full((n, NONE + 1), -np.inf)
        forward[0, NONE], backward[-1] = 0.0, 0.0
        scored = [[(start, kind, features, self.score(features)) for start, kind, features in ending] for ending in region.ending]
        for end in range(1, n):
            forward[end, NONE] = np.logaddexp.reduce(forward[end - 1] + pairs[:, NONE])
            for start, kind, _, score in scored[end]:
                into = np.logaddexp.reduce(forward[start] + pairs[:, kind]) + score
                forward[end, kind] = np.logaddexp(forward[end, kind], into)
        for end in range(n - 1, 0, -1):
            backward[end - 1] = np.logaddexp(backward[end - 1], pairs[:, NONE] + backward[end, NONE])
            for start, kind, _, score in scored[end]:
                backward[start] = np.logaddexp(backward[start], pairs[:, kind] + score + backward[end, kind])
        whole = np.logaddexp.reduce(forward[-1])
        slope: dict[str, float] = {}
        pair_slope, likelihood = np.zeros_like(pairs), -whole
        label_at = {end: (start, kind) for kind, start, end in gold}
        inside = {t for _, start, end in gold for t in range(start + 1, end)}
        before = NONE
        for end in range(1, n):
            plain = np.exp(forward[end - 1] + pairs[:, NONE] + backward[end, NONE] - whole)
            pair_slope[:, NONE] -= plain
            for start, kind, features, score in scored[end]:
                share = np.exp(forward[start] + pairs[:, kind] + score + backward[end, kind] - whole)
                pair_slope[:, kind] -= share
                here = float((label_at.get(end) == (start, kind)))
                likelihood += here * score
                change = here - float(share.sum())
                for name in features:
                    slope[name] = slope.get(name, 0.0) + change
            if end in label_at or end not in inside:
                now = label_at[end][1] if end in label_at else NONE
                pair_slope[before, now] += 1
                likelihood += pairs[before, now]
                before = now
        return slope, pair_slope, float(likelihood)

    def fit(self, examples: list[tuple[str, list[Span]]]) -> Field:
        """Gradient ascent, step sizes by the gradients so far."""
        ready_ = []
        for text, spans in examples:
            region = lattice(text)
            if region is None:
                continue
            place = {b: i for i, b in enumerate(region.bounds)}
            gold = {(kind, place[a], place[b]) for kind, a, b in spans}
            known = {(kind, start, end) for end, ending in enumerate(region.ending) for start, kind, _ in ending}
            if gold <= known:
                ready_.append((region, gold))
        seen: dict[str, float] = {}
        pair_seen = np.zeros_like(self.pairs)
        random = np.random.default_rng(SEED)
        for _ in range(EPOCHS):
            for at in random.permutation(len(ready_)):
                slope, pair_slope, _ = self.slope(*ready_[at])
                for name, g in slope.items():
                    g -= DECAY * self.weights.get(name, 0.0)
                    seen[name] = seen.get(name, 1e-8) + g * g
                    self.weights[name] = self.weights.get(name, 0.0) + RATE * g / seen[name] ** 0.5
                pair_seen += pair_slope**2
                self.pairs = self.pairs + RATE * pair_slope / np.sqrt(pair_seen + 1e-8)
        return self


def _apart(spans: list[Span]) -> list[Span]:
    """Spans without those that overlap an earlier kind's."""
    kept: list[Span] = []
    for kind, a, b in spans:
        if all(b <= c or d <= a for _, c, d in kept):
            kept.append((kind, a, b))
    return kept


def regions(text: str, base: list[Span], long: list[Span]) -> Iterator[tuple[int, str, list[Span]]]:
    """Regions to learn from: most frequent kind or ``NONE``, the text, and its spans."""
    spans = sorted(_apart(base), key=lambda s: s[1])
    cut = sorted((a, b) for _, a, b in long)
    for match in _REGION.finditer(text):
        a, b = match.span()
        if b - a > EXAMPLE_CHARS or any(c < b and a < d for c, d in cut):
            continue
        own = [(kind, c - a, d - a) for kind, c, d in spans if a <= c and d <= b]
        if not own and lattice(match[0]) is None:
            continue
        yield (min(k for k, _, _ in own) if own else NONE), match[0], own


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (kind, region, json.dumps(own)) for text in batch.column("text").to_pylist() for kind, region, own in regions(text, *base_spans(text))
        ]
        kinds, texts, spans = zip(*dict.fromkeys(rows)) if rows else ((), (), ())
        yield pa.RecordBatch.from_pydict(
            {"kind": pa.array(kinds, pa.int32()), "region": pa.array(texts, pa.string()), "spans": pa.array(spans, pa.string())}
        )


def varied(rows: list[tuple[str, list[Span]]]) -> list[tuple[str, list[Span]]]:
    """Regions as they are, in pairs with a space between, and phone numbers rewritten."""
    random = np.random.default_rng(SEED)
    out = list(rows)
    for text, spans in rows:
        if spans and spans[0][0] == 3:
            out.append((" ".join(c for c in text if c.isdigit()), []))
        bare = _COUNTRY.match(text)
        if bare and spans and spans[0][:2] == (3, 0):
            cut = bare.end()
            out.append((text[cut:], [(k, max(a - cut, 0), b - cut) for k, a, b in spans]))
    for i, j in zip(random.permutation(len(rows)), random.permutation(len(rows))):
        (left, own), (right, other) = rows[i], rows[j]
        shift = len(left) + 1
        # a match across the seam that passes its check would be a base span of its own
        out.append((f"{left} {right}", [*own, *((k, a + shift, b + shift) for k, a, b in other)]))
    return out


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r["region"], r["spans"]) for batch in batches for r in batch.to_pylist())
    examples = [(text, [tuple(s) for s in json.loads(spans)]) for text, spans in rows]
    field = Field()
    if any(spans for _, spans in examples):
        field.fit(varied(examples))
    yield pa.RecordBatch.from_pydict({"field": [json.dumps([field.weights, field.pairs.tolist()])]})


def _with_signs(docs: DataFrame) -> DataFrame:
    """Texts that have a digit or an ``@``; the others can have no span."""
    return docs.filter(F.col("text").rlike("[0-9@]"))


def train(docs: DataFrame, size: int = SAMPLE) -> Field:
    """Field learned from the base spans of ``text``."""
    ready(docs.sparkSession)
    texts = _with_signs(docs.select(F.col("text").cast("string").alias("text")))
    found = settle(texts.mapInArrow(_examples, "kind int, region string, spans string").distinct())
    found = found.withColumn("h", F.xxhash64(F.lit(SEED), "region"))
    sample = top_per_group(found, ["kind"], ["h", "region", "spans"], size, "rank")
    # at most size * (kinds + 1) regions of EXAMPLE_CHARS characters
    fitted = sample.select("region", "spans").coalesce(1).mapInArrow(_fitted, "field string").collect()
    return Field(*json.loads(fitted[0]["field"])) if fitted else Field()


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans of the field that touch no base span, by kind and start."""
    taken = sorted((a, b) for _, a, b in base)
    ends = [b for _, b in taken]
    found = []
    if not field.weights:
        return found
    for match in _REGION.finditer(text):
        region = lattice(match[0])
        if region is None:
            continue
        shift = match.start()
        for kind, a, b in field.best(region):
            a, b = a + shift, b + shift
            at = int(np.searchsorted(ends, a, side="right")) if len(ends) > 8 else 0
            if all(b <= c or d <= a for c, d in taken[at:]):
                found.append((kind, a, b))
    return sorted(found)


def _searched(field):
    def spans(found: list[Span]) -> list[dict]:
        return [{"kind": k, "start": a, "stop": b} for k, a, b in found]

    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added = [], []
            for text in batch.column("text").to_pylist():
                base.append(base_spans(text)[0] if text else [])
                added.append(added_spans(text, base[-1], field.value) if text else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([spans(x) for x in side], kind) for side in (base, added))],
                names=["doc_id", "base", "added"],
            )

    return run


def find_pii(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, base, added`` of every row of ``doc_id, text``: arrays of (kind number, start, stop) in code points."""
    spark = docs.sparkSession
    ready(spark)
    text = F.col("text").cast("string")
    # texts that can have no span need not reach Python
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text.rlike("[0-9@]"), text).alias("text"))
    return docs.mapInArrow(_searched(spark.sparkContext.broadcast(field)), SPANS)
