"""Toxicity scores from confirmed toxic examples and unlabelled text.

Non-negative positive-unlabelled learning of a linear model over distinct words and beginnings
of words: the risk on negatives is estimated from unlabelled text less the class prior's share of positives,
and is kept from falling below zero. Score: the logistic function of the model, so about
the probability of the label.

Fitting uses a bounded sample: at most about MAX_POSITIVE confirmed examples and
MAX_UNLABELLED unlabelled documents, each kept by a hash of its id against a share that is
computed from exact counts. Which features tell toxic text from other text is counted over all
documents that may be learnt from. The prior is the share of toxic among all labelled rows that
may be learnt from. The fit is a few numpy arrays on the driver; every document is scored
in its own partition.

Defined results: a null or empty text has no words and gets the score of the bias; null
labels are ignored; several labels of one id count once if any is toxic; without a
confirmed example every score is 0; repeated rows are scored each; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.llm.common import REMEMBERED, Memory, chunks, fold_of, words_folded
from faultweave.sources.workspace import materialise

MAX_POSITIVE = 6_000
MAX_UNLABELLED = 12_000
# Features that enter the model: seen in so many positives at least, the most telling first,
# no more than half as many as there are positives.
MIN_POSITIVE = 5
MAX_FEATURES = 2_048
MIN_FEATURES = 64
# Characters of the beginnings of words.
BEGINNINGS = (4, 5, 6, 7)
STEPS = 400
RATE = 0.1
# Ridge penalty of a feature that stands in this share of the positives; rarer ones get it
# times the square of how much rarer they are: what only a few copies of one text share is
# not learnt as a trait of toxic text.
PENALTY = 5e-5
PENALTY_SHARE = 0.05
THRESHOLD = 0.7
HELD_OUT = 1
FOLDS = 3


def features(word: bytes) -> list[str]:
    """The word, and its beginnings, which take in its inflected forms."""
    text = word.decode(errors="replace")
    return [text] + [f"{text[:n]}-" for n in BEGINNINGS if len(text) > n]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    # Features of words met so far that the model knows; one memory per worker.
    met: dict[bytes, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def logit(self, text: bytes) -> float:
        found: set[str] = set()
        for word in set(words_folded(text)):
            if word not in self.met:
                if len(self.met) >= REMEMBERED:  # few words make up most of a text: they are soon back
                    self.met.clear()
                self.met[word] = tuple(f for f in features(word) if f in self.weights)
            found.update(self.met[word])
        # fsum: the order of a set must not show in the score.
        return fsum(map(self.weights.__getitem__, found)) + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return _sigmoid(np.array([self.logit(t) for t in texts], float))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(chosen: list[str], supports: list[float], positive: list[list[int]], unlabelled: list[list[int]], prior: float) -> Model:
    """Non-negative PU fit with logistic loss, Adam over the full sample.

    `supports`: the share of positives that each chosen feature stands in; the examples list
    the indices of the chosen features that they hold.
    """
    n_p, n_u, size = len(positive), len(unlabelled), len(chosen)

    def matrix(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = [len(x) for x in lists]
        columns = np.fromiter((c for x in lists for c in x), np.int64, sum(lengths))
        return np.repeat(np.arange(len(lists)), lengths), columns

    (p_rows, p_cols), (u_rows, u_cols) = matrix(positive), matrix(unlabelled)
    weights = np.zeros(size + 1)  # the bias last
    weights[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    penalty = np.array([PENALTY * max(1.0, PENALTY_SHARE / share) ** 2 for share in supports])
    first, second = np.zeros(size + 1), np.zeros(size + 1)

    def logits(rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(rows, weights[cols], n) + weights[-1]

    def gradient(rows: np.ndarray, cols: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(cols, per_row[rows], size), per_row.sum())

    for step in range(1, STEPS + 1):
        z_p, z_u = logits(p_rows, p_cols, n_p), logits(u_rows, u_cols, n_u)
        negative_risk = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        towards_one = gradient(p_rows, p_cols, (_sigmoid(z_p) - 1) * prior / n_p)
        towards_zero = gradient(u_rows, u_cols, _sigmoid(z_u) / n_u) - gradient(
            p_rows, p_cols, _sigmoid(z_p) * prior / n_p
        )
        # Below zero the estimate fits noise: that part is undone and nothing else learnt.
        slope = towards_one + towards_zero if negative_risk >= 0 else -towards_zero
        slope[:-1] += penalty * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(dict(zip(chosen, weights[:-1].tolist())), float(weights[-1]))


NOTHING = Model({}, -40.0)


def _share(limit: int, count: int) -> float:
    return min(1.0, limit / count) if count else 0.0


class _Held(Memory):
    """Those of the given features that a word has."""

    def __init__(self, wanted: frozenset[str]):
        super().__init__(REMEMBERED)
        self.wanted = wanted

    def compute(self, word: bytes) -> tuple[str, ...]:
        return tuple(f for f in features(word) if f in self.wanted)


def documents_with(docs: DataFrame, wanted: frozenset[str] | None = None) -> DataFrame:
    """feature and n: in how many of the texts each feature stands, of those wanted only or of all."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if shared.value is None else _Held(shared.value)
        counts: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"]
            )

        for _, texts in chunks(batches):
            for text in texts:
                words = set(words_folded(text))
                counts.update({f for w in words for f in (features(w) if held is None else held[w])})
            if len(counts) > REMEMBERED:
                yield rows()
                counts.clear()
        yield rows()

    partial = docs.select("text").mapInArrow(read, "feature string, n long")
    return partial.groupBy("feature").agg(F.sum("n").alias("n"))


def choose(positive: DataFrame, unlabelled: DataFrame, n_p: int, n_u: int) -> list[tuple[str, int]]:
    """(feature, p): the features whose share among positives exceeds that in all text most, in
    deviations.

    What the positives hold often enough comes from their bounded sample; how often the same
    stands elsewhere is counted over all of `unlabelled`.
    """
    often = documents_with(positive).filter(F.col("n") >= min(MIN_POSITIVE, n_p)).collect()
    p = {r["feature"]: r["n"] for r in often}
    u = {r["feature"]: r["n"] for r in documents_with(unlabelled, frozenset(p)).collect()}
    found = []
    for feature, n in p.items():
        here, there = n / n_p, (u.get(feature, 0) + 0.5) / (n_u + 1)
        if here > there:
            found.append((-(here - there) / (there / n_p) ** 0.5, feature, n))
    limit = min(MAX_FEATURES, max(MIN_FEATURES, n_p // 2))
    return [(feature, n) for _, feature, n in sorted(found)[:limit]]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on documents and labels outside the held-out fold.

    Gathers at most MAX_FEATURES features and, of each example of the bounded sample, the
    indices of those it holds.
    """
    learnt = fold_of("doc_id", FOLDS) != HELD_OUT
    known = labels.filter(learnt & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known, n_toxic = known.agg(F.count("*"), F.count(F.when(F.col("toxic") == 1, 1))).first()
    usable = docs.filter(learnt & F.col("doc_id").isNotNull()).select("doc_id", "text")
    n_docs = usable.count()
    if not n_toxic or not n_docs:
        return NOTHING
    draw = lambda seed: F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    confirmed = known.filter((F.col("toxic") == 1) & (draw(1) < _share(MAX_POSITIVE, n_toxic))).select("doc_id")
    # About MAX_POSITIVE ids by construction: small enough to send everywhere.
    positive = usable.join(F.broadcast(confirmed), "doc_id", "left_semi")
    unlabelled = usable.filter(draw(2) < _share(MAX_UNLABELLED, n_docs))
    sample = materialise(
        positive.select(F.lit(True).alias("positive"), "text").union(unlabelled.select(F.lit(False), "text")), "sample"
    )
    sizes = dict(sample.groupBy("positive").count().collect())
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return NOTHING
    rows = choose(sample.filter("positive"), usable, n_p, n_docs)
    index = {feature: i for i, (feature, _) in enumerate(rows)}

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            held = [
                sorted({index[f] for w in set(words_folded(t)) for f in features(w) if f in index}) for t in texts
            ]
            yield pa.record_batch(
                [batch.column("positive"), pa.array(held, pa.list_(pa.int32()))], names=["positive", "held"]
            )

    examples = sample.mapInArrow(hold, "positive boolean, held array<int>").collect()
    parts = [sorted(list(e["held"]) for e in examples if e["positive"] == side) for side in (True, False)]
    return fit(list(index), [n / n_p for _, n in rows], *parts, n_toxic / n_known)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(shared.value.scores(texts))],
                names=["doc_id", "held_out", "score"],
            )

    rows = docs.select("doc_id", "text", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    scored = rows.mapInArrow(read, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns.

    Scores are appended in the same pass, so no join and no shuffle of texts is needed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            yield batch.filter(pa.array(shared.value.scores(texts) < threshold))

    return docs.mapInArrow(read, docs.schema)
