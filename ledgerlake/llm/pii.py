"""Personal data: fixed base patterns, widened by boosted candidate scoring.

Base spans (email, ip, card, phone) come from the contract's patterns, leftmost
and non-overlapping per kind, each in time linear in the text. Generators of
high recall then propose further, overlapping spans: loosely written addresses,
number groups, key assignments and key-like tokens. Gradient-boosted trees score
their format and context, and a span is added when its probability reaches its
kind's calibrated threshold; secrets of an unmistakable form (``SURE``) are added
without asking. Base spans always stay; added ones never overlap them. No span is too
long to be found whole.

The trees are fitted (``fit_scorer``) on all candidates of all documents with an id. Base
matches and secrets by ``SECRET`` are positive, as are other spellings of them (``name [at] host``, a
secret's value under another name or bare); other candidates are negative. A third of the documents sets each kind's
threshold: the lowest probability at and above which ``PRECISION`` of the
candidates are positive (halfway to the next one below), or none. Detection covers every whole text.

Defined results: a null text is empty and has no spans; positions are code
points, end exclusive; every row gives one row, repeated rows alike; without
candidates to learn from only base spans and sure secrets are found. Other columns pass through
``redact`` untouched and are dropped by ``find_pii``.

Scale: one pass to find, no shuffle; the model is a few KB. The fit takes another pass over the texts, which writes
some 120 bytes a distinct candidate; each level of each tree reads those and shuffles sums per bin (``_boost.fit_rows``). Documents that no pattern or
generator can match are told from their bytes (``_marked``) and never decoded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import _boost
from ledgerlake.llm._store import stored
from ledgerlake.llm._text import Run, map_runs, record

PRECISION = 0.98
STEPS = 100_000  # of a probability, where thresholds are set
KINDS = ("email", "ip", "card", "phone", "secret")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a digit run begins: a later start in the run fails alike.
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

GENERATORS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]+(?:(?:\.|\x20?(?:\[dot\]|\(dot\))\x20?)[A-Za-z0-9-]+)*")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}(?![0-9.])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{3,6}(?:[\x20.-]?[0-9]{2,6}){2,5}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){2,5}(?![0-9])")),
    ("secret", re.compile(r"(?i:password|passwd|pwd|secret|token|api_?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_-]{6,}[\"']?")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9_-]{16,}+")),
)
TOKEN_LENGTH = 16
# What a text must hold for any base pattern or generator to match; ``_marked`` finds the same in bytes.
POSSIBLE = r"[0-9@]|\[at\]|\(at\)|[dtnyDTNY]\x20?[=:]|[A-Za-z0-9_-]{16}"
_KEY_END, _TOKEN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_KEY_END[list(b"dtnyDTNY")] = True
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")] = True
# Positive examples of the fit.
SECRET = re.compile(r"(?:AKIA[0-9A-Z]{16}|(?:password|passwd|secret|token|api_?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_-]{12,}[\"']?)")
# Secrets that need no judging: key ids of a known form, and values given to a name that says so. A plain
# lower-case word after "secret:" or "token:" may be prose and is left to the trees.
SURE = re.compile(
    r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
    r"|(?i:password|passwd|pwd|api_?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_-]{8,}[\"']?"
    r"|(?i:secret|token)\x20?=\x20?[\"']?[A-Za-z0-9+/_-]{8,}[\"']?"
    r"|(?i:secret|token)\x20?:\x20?[\"']?(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{8,}[\"']?"
)
HINT = re.compile(r"(?i)(mail|tel|phone|fax|mobile|call|card|visa|ip|addr|key|token|password|secret)[^\s]{0,4}\s?[:=]?\s?$")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans as (kind, start, end), by kind and start."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            out.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    return [(kind, m.start(), m.end()) for kind, pattern in GENERATORS for m in pattern.finditer(text)]


def features(kind: str, span: str, before: str, after: str) -> list[float]:
    """Format of the span and its context (at most 24 characters each side)."""
    n = len(span)
    digits = [c for c in span if c.isdigit()]
    letters = sum(c.isalpha() for c in span)
    groups = re.findall(r"[0-9]+", span)
    return [
        float(KINDS.index(kind)), n, len(digits), len(digits) / n, letters / n, sum(c.isupper() for c in span) / n, span.count("."), span.count("-"), span.count(" "), float("@" in span),
        float("[" in span or "(at)" in span), float(span.startswith("+")), float("(" in span), float("=" in span or ":" in span), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        max((int(g) if len(g) < 6 else 99999 for g in groups), default=0), len(set(span)) / n, len(span.rsplit(".", 1)[-1]), float(13 <= len(digits) <= 19 and luhn("".join(digits))),
        float(bool(HINT.search(before))), float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after), float(before[-1:].isalnum()), float(span.isalpha()), float(span.islower()),
    ]


def _context(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[start:end], text[max(0, start - 24) : start], text[end : end + 24]


def _masked(kind: str, span: str) -> list[str]:
    if kind == "email":
        name, _, host = span.partition("@")
        return [f"{name} [at] {host}", f"{name}(at){host}", f"{name} [at] {host.replace('.', ' [dot] ')}"]
    if kind == "secret":
        # its value under other names, bare, and longer
        value = re.split("[=:]", span, maxsplit=1)[-1].strip(" \"'")
        bare = [value, value + value[::-1], value * 4] if len(value) >= TOKEN_LENGTH and any(c.isdigit() for c in value) else []
        return [f"{name}{value}" for name in ("password=", "api_key: ", "token=")] + bare
    return [span.replace("-", ".").replace(" (", " ").replace(")", "")] if kind == "phone" else []


def sure_spans(text: str) -> list[tuple[str, int, int]]:
    """Secrets by ``SURE``, which are added whatever the trees say."""
    return [("secret", m.start(), m.end()) for m in SURE.finditer(text)]


def examples(text: str) -> tuple[list[list[float]], list[int], list[str]]:
    """Candidates of one text with labels, and masked spellings of its matches."""
    known = base_spans(text) + [("secret", m.start(), m.end()) for m in SECRET.finditer(text)]
    x, y, kinds = [], [], []
    for kind, s, e in candidates(text):
        x.append(features(kind, *_context(text, s, e)))
        y.append(int(any(k == kind and s <= ks and ke <= e + 1 for k, ks, ke in known)))
        kinds.append(kind)
    for kind, s, e in known:
        span, before, after = _context(text, s, e)
        for other in _masked(kind, span):
            x.append(features(kind, other, before, after))
            y.append(1)
            kinds.append(kind)
    return x, y, kinds


def candidate_rows(docs: DataFrame) -> DataFrame:
    """Examples of all documents with an id: part (of three, by doc_id), x (float32 features), y and kind."""

    def rows_of(part: pa.RecordBatch, run: Run) -> pa.RecordBatch | None:
        keep, xs, ys, ks = [], [], [], []
        ids = part.column(0)
        for i in np.flatnonzero(_marked(run)):
            if not ids[i].is_valid:
                continue
            x, y, kinds = examples(run.text(i))
            keep += [int(hashlib.md5(str(ids[i].as_py()).encode()).hexdigest(), 16) % 3] * len(x)
            xs += x
            ys += y
            ks += [KINDS.index(k) for k in kinds]
        if not xs:
            return None
        return record(part=pa.array(keep, pa.int32()), x=pa.array([v.tobytes() for v in np.array(xs, np.float32)], pa.binary()), y=pa.array(ys, pa.int32()), kind=pa.array(ks, pa.int32()))

    return map_runs(docs, ["doc_id", "text"], rows_of, "part int, x binary, y int, kind int")


def fit_scorer(docs: DataFrame, precision: float = PRECISION) -> dict:
    """The trees and each kind's threshold, from all candidates of all documents with an id."""
    # equal examples become one with a weight
    rows = stored(candidate_rows(docs).groupBy("part", "x", "y", "kind").agg(F.count("*").alias("w")), "candidates")
    model: dict = {"trees": None, "threshold": {}}
    sizes = {(r.held, r.y): r.w for r in rows.groupBy((F.col("part") == 0).alias("held"), "y").agg(F.sum("w").alias("w")).collect()}
    total = {k: sum(w for key, w in sizes.items() if key[1] == k) for k in (0, 1)}
    if sum(total.values()) < 50 or min(total.values()) == 0 or min(sum(w for key, w in sizes.items() if key[0] == held) for held in (True, False)) == 0:
        return model
    trees = model["trees"] = _boost.fit_rows(rows.where("part > 0").select("x", "y", "w"))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield record(kind=batch.column(1), y=batch.column(2), w=batch.column(3), step=np.rint(_boost.predict(trees, _boost.matrix(batch.column(0))) * STEPS).astype(np.int32))

    held = rows.where("part = 0").select("x", "kind", "y", "w").mapInArrow(steps, "kind int, y int, w long, step int")
    ranked = held.groupBy("kind", "step").agg(F.sum("w").alias("all"), F.sum(F.col("w") * F.col("y")).alias("good")).orderBy("kind", F.desc("step")).collect()  # len(KINDS) * STEPS at most
    for k, kind in enumerate(KINDS):
        step, every, good = (np.array([r[c] for r in ranked if r.kind == k], dtype=float) for c in ("step", "all", "good"))
        last = np.flatnonzero(np.cumsum(good) >= precision * np.cumsum(every))
        if len(last):
            # halfway to the next candidate below, where the examples leave the choice
            step = np.append(step, 0.0)
            model["threshold"][kind] = max(0.5, float(step[last[-1]] + step[last[-1] + 1]) / 2 / STEPS)
    return model


def _scored(found: list[list[tuple[str, int, int]]], texts: list[str], model: dict) -> list[np.ndarray]:
    """The trees' probabilities of each text's candidates, for all texts in one call."""
    rows = [features(k, *_context(text, s, e)) for text, some in zip(texts, found, strict=True) for k, s, e in some]
    p = _boost.predict(model["trees"], np.array(rows, dtype=np.float32).astype(float)) if rows else np.zeros(0)
    return np.split(p, np.cumsum([len(f) for f in found])[:-1])


def all_spans(text: str, model: dict) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: base ones plus the candidates that pass."""
    return spans_of([text], model)[0]


def spans_of(texts: list[str], model: dict) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """``all_spans`` of several texts, whose candidates are scored together."""
    found = [[c for c in candidates(text) if c[0] in model["threshold"]] if model["trees"] else [] for text in texts]
    return [_passing(text, f, p, model) for text, f, p in zip(texts, found, _scored(found, texts, model) if texts else [], strict=True)]


def _passing(text: str, found: list[tuple[str, int, int]], p: np.ndarray, model: dict) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    base, sure = base_spans(text), sure_spans(text)
    if not found and not sure:
        return base, base
    taken = sorted((s, e) for _, s, e in base)
    ends = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0, int)
    starts = np.array([s for s, _ in taken])
    extra: list[tuple[str, int, int]] = []
    passing = sorted([(-q, s, e, k) for q, (k, s, e) in zip(p, found, strict=True) if q >= model["threshold"][k]] + [(-2.0, s, e, k) for k, s, e in sure])
    free: list[tuple[int, int, float, str]] = []
    for q, s, e, k in passing:
        i = int(np.searchsorted(starts, e)) - 1
        if i < 0 or ends[i] <= s:
            free.append((s, e, q, k))
    # of overlapping candidates the likelier stays; sweep groups of overlapping ones in order
    free.sort()
    group: list[tuple[int, int, float, str]] = []
    reach = -1
    for c in [*free, (1 << 62, 1 << 62, 0.0, "")]:
        if c[0] >= reach and group:
            chosen: list[tuple[int, int, float, str]] = []
            for s, e, q, k in sorted(group, key=lambda g: (g[2], g[0], -g[1], g[3])):
                if all(e <= cs or ce <= s for cs, ce, _, _ in chosen):
                    chosen.append((s, e, q, k))
            extra += [(k, s, e) for s, e, _, k in chosen]
            group = []
        group.append(c)
        reach = max(reach, c[1])
    return base, sorted(base + extra, key=lambda t: (KINDS.index(t[0]), t[1], t[2]))


def _marked(run: Run) -> np.ndarray:
    """Documents that can hold a span of any kind, told from their bytes.

    Base patterns and number generators need a digit or an ``@``. The others need a
    masked ``@``, the last letter of a key word before ``=`` or ``:``, or 16 token
    characters in a row; no character beyond ASCII matches those last letters.
    """
    data, out = run.data, np.zeros(run.n, dtype=bool)
    hit = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(((data >= 0x30) & (data <= 0x39)) | (data == 0x40), out=hit[1:])
    out |= np.diff(hit[run.offsets]) > 0
    padded = np.concatenate([np.zeros(2, np.uint8), data, np.zeros(4, np.uint8)])
    at = np.flatnonzero((data == 0x5B) | (data == 0x28))
    masked = at[(padded[at + 3] == 0x61) & (padded[at + 4] == 0x74) & (padded[at + 5] == data[at] + np.where(data[at] == 0x5B, 2, 1))]
    at = np.flatnonzero((data == 0x3D) | (data == 0x3A))
    back = np.where(padded[at + 1] == 0x20, 2, 1)
    named = _KEY_END[padded[at + 2 - back]]
    held = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_TOKEN[data], out=held[1:])
    long = np.flatnonzero(held[TOKEN_LENGTH:] - held[:-TOKEN_LENGTH] == TOKEN_LENGTH)
    for start, end in ((masked, masked + 4), ((at - back)[named], at[named] + 1), (long, long + TOKEN_LENGTH)):
        doc = run.owner(start)
        out[doc[end <= run.offsets[doc + 1]]] = True
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, model: dict) -> DataFrame:
    """Per document: base counts and digest, and all spans as text."""
    empty = hashlib.sha256(b"").hexdigest()

    def find(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        counts = np.zeros((4, run.n), dtype=np.int64)
        digest, spans = [empty] * run.n, [""] * run.n
        marked = np.flatnonzero(_marked(run))
        for i, (base, every) in zip(marked, spans_of([run.text(i) for i in marked], model), strict=True):
            for k, _, _ in base:
                counts[KINDS.index(k), i] += 1
            digest[i], spans[i] = hashlib.sha256(written(base).encode()).hexdigest(), written(every)
        return record(doc_id=part.column(0), n_email=counts[0], n_ip=counts[1], n_card=counts[2], n_phone=counts[3], base_sha256=pa.array(digest, pa.string()), spans=pa.array(spans, pa.string()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_runs(docs, ["doc_id", "text"], find, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, model: dict) -> str:
    """The text with each stretch covered by spans replaced by its first kind's name."""
    return _replaced(text, all_spans(text, model)[1])


def _replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, done = [], 0
    merged: list[list] = []
    for k, s, e in sorted(spans, key=lambda t: (t[1], -t[2])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([k, s, e])
    for k, s, e in merged:
        out += [text[done:s], f"[{k.upper()}]"]
        done = e
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: dict) -> DataFrame:
    """The documents, all columns kept, with personal data replaced in ``text``."""
    names = docs.columns

    def clean(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        text = part.column(names.index("text"))
        marked = np.flatnonzero(_marked(run))
        if len(marked):
            new = text.to_pylist()
            for i, (_, spans) in zip(marked, spans_of([new[i] for i in marked], model), strict=True):
                new[i] = _replaced(new[i], spans)
            text = pa.array(new, text.type)
        columns = list(part.columns)
        columns[names.index("text")] = text
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_runs(docs, names, clean, docs.schema)
