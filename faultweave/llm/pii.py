"""Personal data: candidate spans from wide patterns, chosen by calibrated boosted trees.

Base spans (email, ip, card, phone) are fixed rules and always stay. Wider generators
propose further spans, also overlapping ones: spelled-out addresses ("name at host dot
org"), addresses with white space around their signs, dotted numbers with spaces, grouped
digits, phone numbers without "+". Boosted trees over format and context features give
each proposal a probability; proposals above their kind's calibrated threshold that overlap
no base span and no better proposal are added.

Training is weak supervision on every text. Positives are base spans rewritten in place into the wider forms, and proposals that
equal a base span. Negatives are proposals beside base spans that fail their kind's check
(check digit, parts over 255, number of digits, a date or four dotted parts as a phone number, a
sentence's end inside an address);
the others may be real and stay unlabelled. The trees never see the checks; a proposal must
pass its check and the trees to be added. Thresholds: on the documents held out, a third, the
lowest score above which at least SUPPORT labelled proposals lie and the share of positives
is at least PRECISION. A kind whose scores never reach it adds no span.

Base matching is linear in the text. Each pattern is anchored where its first character
class begins, which leaves the leftmost matches the same: if a match fails at the start of a
run of that class, it fails inside the run.

Defined results: a null or empty text has no spans; repeated rows are read each; rows with
equal spans are equal; an empty table gives no rows; further columns are ignored. Offsets
count code points.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.sources.workspace import materialise, release

# Kinds in the order in which spans at the same start are listed.
KINDS = ("email", "ip", "card", "phone")

TREES, DEPTH, RATE, BINS, LEAST = 40, 3, 0.3, 16, 8
SHARES = np.linspace(0, 1, BINS + 1)[1:-1].tolist()
# Gradients are counted in parts of 1 / UNIT, scores of thresholds in parts of 1 / STEPS.
UNIT = float(1 << 24)
STEPS = 1 << 12
PRECISION = 0.98
SUPPORT = 30
CONTEXT = 24

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_DOTTED = re.compile(r"[0-9]\.[0-9]")

# Wider generators. What they start from is found first, in one quick scan each: signs that
# can stand for @, and stretches of digits and what groups them.
_AT = re.compile(r"@|\(at\)|\[at\]| at ")
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s{0,2}\Z")
_HOST = re.compile(
    r"\s{0,2}[A-Za-z0-9-]{1,63}(?:\s{0,2}(?:\.|\(dot\)|\[dot\]| dot )\s{0,2}[A-Za-z0-9-]{1,63}){1,4}"
)
_NUMERIC = re.compile(r"[0-9][0-9 ().\-/]{5,}[0-9]")
_NUMBERS = (
    ("ip", re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[ .\-/]{1,2}[0-9]{3,6}){2,4}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?(?:[ .\-/]{1,2}[0-9]{2,4}){2,4}(?![0-9])")),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ in turn: the run of local characters in front of it, a dotted name behind."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            end = match.end()
        # The characters up to this @ belong to no other address.
        end = max(end, at + 1)
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, sorted."""
    spans = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text) if _DOTTED.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the wider generators propose; spans may overlap."""
    found = []
    for at in _AT.finditer(text):
        left = max(0, at.start() - 66)
        name = _NAME.search(text[left : at.start()])
        host = name and _HOST.match(text, at.end())
        if host:
            found.append((left + name.start(), 0, host.end()))
    for stretch in _NUMERIC.finditer(text):
        start = stretch.start() - (text[max(0, stretch.start() - 1)] == "(")
        for kind, wide in _NUMBERS:
            found += [(m.start(), KINDS.index(kind), m.end()) for m in wide.finditer(text, start, stretch.end())]
    return found


# A full stop, white space and a capital: the end of a sentence, not a part of a host's name.
_SENTENCE = re.compile(r"[^\s]\.\s+[A-Z]")
_TOP = re.compile(r"[A-Za-z]{2,}\Z")
_DATE = re.compile(r"\(?(?:19|20)[0-9]{2}[ .\-/]{1,2}(?:0?[1-9]|1[0-2])[ .\-/]{1,2}(?:0?[1-9]|[12][0-9]|3[01])(?![0-9])")
_QUAD = re.compile(r"[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}\Z")


def passes(kind: int, span: str) -> bool:
    """Whether a proposal can be what it is proposed as."""
    if kind == 0:
        return bool(_TOP.search(span)) and not _SENTENCE.search(span)
    digits = re.sub(r"[^0-9]", "", span)
    if kind == 1:
        return all(int(part) <= 255 for part in re.findall("[0-9]+", span))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not _DATE.match(span) and not _QUAD.match(span)


def wider_forms(kind: int, span: str) -> list[str]:
    """A base span as the wider generators could meet it."""
    if kind == 0:
        name, _, host = span.partition("@")
        dots = host.replace(".", " dot ")
        return [f"{name} at {dots}", f"{name} at {host}", f"{name}(at){host.replace('.', '(dot)')}",
                f"{name} [at] {host.replace('.', ' [dot] ')}", f"{name} @ {host.replace('.', ' . ')}"]
    if kind == 1:
        return [sign.join(span.split(".")) for sign in (". ", " .", " . ")]
    digits = re.sub(r"[^0-9]", "", span)
    if kind == 2:
        rest, n = digits[4:], -(-(len(digits) - 4) // 5)
        cuts = [len(rest) * i // n for i in range(n + 1)]
        groups = [digits[:4], *(rest[i:j] for i, j in zip(cuts, cuts[1:]))]
        return [sign.join(groups) for sign in (".", "/", "-", "  ")]
    plain = span[1:]
    return [plain, f"00{plain}", *(re.sub(r"[ ().-]+", sign, plain).strip(sign) for sign in "./- ")]


def rewritten(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int, int]]:
    """Text around a base span with the span in a wider form, and the proposal that finds it."""
    for start, kind, end in base:
        before, after = text[max(0, start - 80) : start], text[end : end + 80]
        for form in wider_forms(kind, text[start:end]):
            near, first, last = before + form + after, len(before), len(before) + len(form)
            inside = [
                (e - s, s, e) for s, k, e in candidates(near)
                if k == kind and first <= s and e <= last and passes(kind, near[s:e])
            ]
            if inside:
                yield near, max(inside)[1], kind, max(inside)[2]


def labelled(text: str) -> list[tuple[int, int, list[float]]]:
    """label, kind and features of the proposals in a text and its rewritten forms."""
    base = base_spans(text)
    rows = [(1, k, describe(near, s, k, e)) for near, s, k, e in rewritten(text, base)]
    for start, kind, end in candidates(text):
        if (start, kind, end) in base:
            rows.append((1, kind, describe(text, start, kind, end)))
        elif not any(start < e and s < end for s, _, e in base) and not passes(kind, text[start:end]):
            rows.append((0, kind, describe(text, start, kind, end)))
    return rows


# Context words that often stand before such data.
_CUES = (
    ("mail", "contact", "write"), ("ip", "host", "server", "address"), ("card", "visa", "credit", "pay"),
    ("phone", "tel", "call", "fax", "mobile"),
)


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context features of a span."""
    span, before = text[start:end], text[max(0, start - CONTEXT) : start].lower()
    after = text[end : end + 2]
    parts = re.split(r"[^A-Za-z0-9]+", span)
    digits, letters = sum(c.isdigit() for c in span), sum(c.isalpha() for c in span)
    return [
        kind, end - start, digits, letters, len(parts), max(map(len, parts)), min(map(len, parts)),
        sum(c in "@" for c in span), sum(c == "." for c in span), sum(c.isspace() for c in span),
        sum(c in "-/()" for c in span), float(span[:1] == "0"), float(before[-1:] == "+"),
        float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after),
        float(after[:1] in ".,;:!?#"), sum(c.isdigit() for c in before), sum(c.isalpha() for c in before),
        float(any(c in before for c in _CUES[kind])), float(" at " in span or "dot" in span), len(set(span)),
    ]


@dataclass(frozen=True)
class Trees:
    """Boosted regression trees for the logistic loss, over binned features."""

    edges: list[np.ndarray]
    trees: list[list[tuple[int, int, np.ndarray]]]
    leaves: list[np.ndarray]
    start: float
    thresholds: dict[int, float] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        binned, z = self.bins(x), np.full(len(x), self.start)
        for splits, leaf in zip(self.trees, self.leaves):
            z += leaf[_place(binned, splits)]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _place(binned: np.ndarray, levels: list[tuple[int, int]]) -> np.ndarray:
    """Leaf of each row: every level asks one question, the same in all its nodes."""
    at = np.zeros(len(binned), np.int64)
    for feature, cut in levels:
        at = at * 2 + (binned[:, feature] > cut)
    return at


def tally(model: Trees, levels: list[tuple[int, int]], binned: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Gradient, curvature and number of rows per node and bin, the bins of all features side by side.

    `n` says how often a row counts. Gradients are whole multiples of 1 / UNIT, so that sums don't
    depend on their order.
    """
    z = np.full(len(binned), model.start)
    for splits, leaf in zip(model.trees, model.leaves):
        z += leaf[_place(binned, splits)]
    p = 1 / (1 + np.exp(-z))
    parts = (np.rint((y - p) * UNIT) * n, np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT) * n, n)
    at, nodes, blocks = _place(binned, levels), 1 << len(levels), []
    for j, edges in enumerate(model.edges):
        key, width = at * (len(edges) + 1) + binned[:, j], len(edges) + 1
        blocks.append(np.stack([np.bincount(key, v, nodes * width).reshape(nodes, width) for v in parts]))
    return np.concatenate(blocks, 2)


def grow(model: Trees, sums: Callable[[list[tuple[int, int]]], np.ndarray]) -> Trees:
    """Adds the trees, level by level; `sums` gives the `tally` of all rows for the levels so far."""
    ends = np.cumsum([len(e) + 1 for e in model.edges])
    for _ in range(TREES):
        levels: list[tuple[int, int]] = []
        leaf = np.zeros(1)
        for _ in range(DEPTH):
            best, halves = (0.0, 0, 0), None
            for j, found in enumerate(np.split(sums(levels), ends[:-1], 2)):
                g, h, counts = found.cumsum(2)
                g, h = g / UNIT, h / UNIT
                (gl, hl), (gt, ht) = (s[:, :-1] for s in (g, h)), (s[:, -1:] for s in (g, h))
                ok = (counts[:, :-1] >= LEAST) & (counts[:, -1:] - counts[:, :-1] >= LEAST)
                gain = np.where(ok, gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1), 0).sum(0)
                if len(gain) and gain.max() > best[0]:
                    cut = int(gain.argmax())
                    best = (float(gain.max()), j, cut)
                    left, right = (gl[:, cut], hl[:, cut]), (gt[:, 0] - gl[:, cut], ht[:, 0] - hl[:, cut])
                    halves = [RATE * g / (h + 1) for g, h in (left, right)]
            if halves is None:
                break
            levels.append(best[1:])
            leaf = np.stack(halves, 1).ravel()
        if not levels:
            break
        model.trees.append(levels)
        model.leaves.append(leaf)
    return model


def _start(share: float) -> float:
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    return float(np.log(share / (1 - share)))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees of rows at hand."""
    edges = [np.unique(np.quantile(x[:, j], SHARES)) for j in range(x.shape[1])]
    model = Trees(edges, [], [], _start(y.mean()))
    binned, once = model.bins(x), np.ones(len(x))
    return grow(model, lambda levels: tally(model, levels, binned, y, once))


def boost_table(rows: DataFrame) -> Trees:
    """The same of a table of label, features and n, how often a row counts; a job per level."""
    width = len(rows.select("features").first()[0])
    cuts = [F.percentile(F.get("features", F.lit(j)), list(SHARES), F.col("n")).alias(f"c{j}") for j in range(width)]
    first = rows.agg((F.sum(F.col("label") * F.col("n")) / F.sum("n")).alias("share"), *cuts).first()
    model = Trees([np.unique(first[f"c{j}"]) for j in range(width)], [], [], _start(first["share"]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binned = model.bins(_matrix(batch)).astype(np.uint8)
            bins = pa.array([row.tobytes() for row in binned], pa.binary())
            yield pa.record_batch([batch.column("label"), bins, batch.column("n")], names=["label", "bins", "n"])

    packed = rows.select("label", "features", "n").mapInArrow(pack, "label int, bins binary, n long")
    table = materialise(packed.groupBy("label", "bins").agg(F.sum("n").alias("n")), "pii-bins")
    total = sum(len(e) + 1 for e in model.edges)

    def sums(levels: list[tuple[int, int]]) -> np.ndarray:
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros((3, 1 << len(levels), total), np.int64)
            for batch in batches:
                binned = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
                y, n = (batch.column(c).to_numpy().astype(float) for c in ("label", "n"))
                held += tally(model, levels, binned.astype(np.int64), y, n).astype(np.int64)
            cells = np.flatnonzero(held[2])
            columns = [cells, *(part.ravel()[cells] for part in held)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["cell", "g", "h", "n"])

        added = table.mapInArrow(read, "cell long, g long, h long, n long").groupBy("cell")
        out = np.zeros((3, (1 << len(levels)) * total))
        for r in added.agg(*[F.sum(c).alias(c) for c in "ghn"]).collect():
            out[:, r["cell"]] = r["g"], r["h"], r["n"]
        return out.reshape(3, 1 << len(levels), total)

    grow(model, sums)
    release(table)
    return model


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("features")
    return column.flatten().to_numpy().reshape(len(column), -1)


def thresholds(model: Trees, rows: DataFrame) -> dict[int, float]:
    """Per kind the lowest score, in steps of 1 / STEPS, above which enough of the rows are positives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            step = np.floor(model.probability(x) * STEPS).astype(np.int64)
            columns = [pa.array(x[:, 0].astype(np.int64)), pa.array(step), batch.column("label"), batch.column("n")]
            yield pa.record_batch(columns, names=["kind", "step", "label", "n"])

    scored = rows.select("label", "features", "n").mapInArrow(read, "kind long, step long, label int, n long")
    counts = scored.groupBy("kind", "step").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("positives")
    )
    found: dict[int, float] = {}
    seen = np.zeros((len(KINDS), 2))
    for r in sorted(counts.collect(), key=lambda r: -r["step"]):
        seen[r["kind"]] += r["n"], r["positives"]
        n, positives = seen[r["kind"]]
        if n >= SUPPORT and positives >= PRECISION * n:
            found[r["kind"]] = max(0.5, r["step"] / STEPS)
    return found


def train(docs: DataFrame) -> Trees | None:
    """Trees and thresholds learnt from every text; None where none has a base span to learn from.

    Equal rows are one row with a count. The trees travel to the tasks, and sums per node and bin
    come back: a few thousand numbers a level, whatever the number of rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, bool, list[float]]] = []
            for text in batch.column("text").to_pylist():
                held = zlib.crc32(text.encode()) % 3 == 0
                rows += [(label, held, list(map(float, x))) for label, _, x in labelled(text)]
            types = (pa.int32(), pa.bool_(), pa.list_(pa.float64()))
            yield pa.record_batch(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["label", "held", "features"]
            )

    texts = docs.select("text").filter(F.col("text").isNotNull())
    found = texts.mapInArrow(read, "label int, held boolean, features array<double>")
    rows = materialise(found.groupBy("label", "held", "features").agg(F.count("*").alias("n")), "pii-rows")
    kept = rows.filter(~F.col("held"))
    if kept.filter(F.col("label") == 1).isEmpty():
        return None
    model = boost_table(kept)
    model.thresholds.update(thresholds(model, rows.filter("held")))
    release(rows)
    return model


def all_spans(text: str, base: list[tuple[int, int, int]], model: Trees | None) -> list[tuple[int, int, int]]:
    """Base spans and the proposals that the model selects."""
    if model is None or not model.thresholds:
        return base
    proposed = [c for c in candidates(text) if c[1] in model.thresholds and passes(c[1], text[c[0] : c[2]])]
    if not proposed:
        return base
    scores = model.probability(np.array([describe(text, *c) for c in proposed]))
    spans = list(base)
    for i in sorted(range(len(proposed)), key=lambda i: (-scores[i], proposed[i])):
        start, kind, end = proposed[i]
        if scores[i] < model.thresholds[kind]:
            continue
        if not any(start < e and s < end for s, _, e in spans):
            spans.append(proposed[i])
    return sorted(spans)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def find(docs: DataFrame, model: Trees | None) -> DataFrame:
    """Counts of base spans, their digest, and all spans of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))])
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(all_spans(text or "", base, shared.value)))
            numbers = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            yield pa.record_batch(
                [batch.column("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(read, RESULT)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans as one."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
