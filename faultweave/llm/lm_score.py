"""Log10 probabilities of texts under a hashed maximum-entropy model.

Outcomes. The most frequent training tokens, fewer than KNOWN, the end of a text among them,
and one leaf for all rarer words are the leaves of a tree, in order of their endings, so that
classes hold words of one kind. Its depth and width follow their number: the fewest levels whose width is at most WIDTH. The softmax is
factored along the tree: the first class, the class below it, the word. A rarer word has its
smoothed share of its leaf, (c + 0.5) over the leaf's sum, which includes 0.5 for one
unknown word; so all probabilities add up to one.

Features of a position at each level: the previous word, the word before it (a skip), each in
place of itself its class if it is met seldom, and both words' top classes together; hashed to
the rows of the class reached so far, of which a class has as many as its share of the training
tokens, all within MODEL_BYTES. A row counts which child came next. The weight of a
feature for a child is the log of the child's smoothed share of the row over its share without
context, times a factor; factors belong to the level, the template and the binary
magnitude of the row's count.

Training. The rows are counted by aggregation over all training text; only rows that are
touched are sent. The factors are learnt in ROUNDS rounds, which part the training documents by
hash: each task adds up the gradient and the curvature of the log-likelihood over its
documents, in which a token's own count is left out of its row; their sum over all tasks
makes one Newton step. Counts and sums don't depend on how the input is cut.

Word counts are exact and cover all training documents. The known words and the rows go to
every executor (of bounded size); the rarer words of a document are joined with their counts.

Defined results: a null or empty text is the end alone; texts are read whole; without
training documents all counts are 0 and the base gives every token probability 1, as the
formula does; a null id counts as the empty text in the fold; repeated rows are scored
each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.llm.common import chunks, distinct_words, fold_of, objects, release_memory
from faultweave.sources.workspace import materialise, release

FOLDS, HELD_OUT = 5, 1
KNOWN = 1 << 18
# Children of a class at most.
WIDTH = 24
# Bytes of all rows at most, and training tokens per row of a template.
MODEL_BYTES, ROW_TOKENS = 1 << 25, 4
TEMPLATES = 3
ROUNDS = 2
BATCH = 1 << 12
# Counts that the share without context is worth in a row.
PRIOR = 16.0
# Occurrences from which a word is a context of its own.
OFTEN = 16
# Binary magnitudes of a row's count, factors to begin with, and the curvature that holds them there.
MAGNITUDES, START, HOLD = 20, 0.5, 10.0
# Partial word counts are passed on when a task holds so many words.
FLUSH = 300_000
# Cells of rows that are sent and added together.
BLOCK = 1 << 16
# The end of a text; no word can hold a line feed.
END = b"\n"


def word_counts(docs: DataFrame) -> DataFrame:
    """word and c of all words of the documents; ends are not among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            words = list(counts)
            return pa.record_batch(
                [
                    pa.array(words, pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["word", "n"],
            )

        for _, texts in chunks(batches):
            words, index, _ = distinct_words(texts)
            for word, n in zip(objects(words), np.bincount(index, minlength=len(words)).tolist()):
                counts[word] += n
            if len(counts) > FLUSH:
                yield rows()
                counts.clear()
        yield rows()

    partial = docs.select("text").mapInArrow(count, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """Known words with their counts, in order of endings, and what the rarer ones add up to."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int
    rare_sum: float

    def __post_init__(self) -> None:
        self.codes: dict[bytes, int] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"codes": None}

    def encode(self, words: list[bytes]) -> np.ndarray:
        """Leaf of each word; a word that is not known is the last leaf."""
        if self.codes is None:
            # Frequent words first: they lie together, and most lookups meet them.
            self.codes = {self.words[i]: i for i in np.argsort(-self.counts, kind="stable").tolist()}
        return np.fromiter(map(self.codes.get, words, repeat(len(self.words))), np.int64, len(words))

    @property
    def leaves(self) -> int:
        return len(self.words) + 1

    @property
    def levels(self) -> int:
        levels = 1
        while WIDTH**levels < self.leaves:
            levels += 1
        return levels

    @property
    def width(self) -> int:
        width = 1
        while width**self.levels < self.leaves:
            width += 1
        return width


def ending(word: bytes) -> tuple[bytes, bytes]:
    """Brings words of one ending together, whatever stands behind their letters."""
    letters = word.rstrip(b".,;:!?")
    return letters[::-1], word


def vocabulary(counts: DataFrame, n_docs: int) -> Vocabulary:
    """The bounded part of the counts, and the sums over all of them."""
    top = counts.orderBy(F.col("c").desc(), "word").limit(KNOWN - 2).toArrow()
    words, c = top.column("word").to_pylist(), top.column("c").to_pylist()
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    rare_sum = int(totals[0]) - sum(c) + 0.5 * (int(totals[1]) - len(c)) + 0.5
    ordered = sorted(zip([*words, END], [*c, n_docs]), key=lambda word: ending(word[0]))
    words, c = [list(column) for column in zip(*ordered)]
    return Vocabulary(words, np.array(c, np.int64), int(totals[0]) + n_docs, int(totals[1]) + (n_docs > 0), rare_sum)


@dataclass
class Model:
    """Counts of the rows by level, the log ratios that follow from them, and the factors.

    The rows of a template and level are dealt to the classes by their share of the tokens, so
    that a row belongs to one class.
    """

    first: list[np.ndarray]  # per level: first row of every class
    rows: list[np.ndarray]  # per level: number of rows of every class
    shares: list[np.ndarray]  # per level: classes, width
    counts: list[np.ndarray]  # per level: TEMPLATES, rows, width
    sums: list[np.ndarray]  # per level: TEMPLATES, rows
    ratios: list[np.ndarray]  # per level: TEMPLATES, rows, width
    factors: np.ndarray  # levels, TEMPLATES, MAGNITUDES
    # What tokens of one row share, by level, worked out where it is first asked for.
    tables: dict = field(default_factory=dict, init=False, repr=False)

    def __getstate__(self) -> dict:
        """Counts and tables stay behind; ratios travel in half precision."""
        ratios = [r.astype(np.float16) for r in self.ratios]
        sums = [n.astype(np.int64) for n in self.sums]
        return self.__dict__ | {"counts": [], "ratios": ratios, "sums": sums, "tables": {}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.ratios = [r.astype(np.float32) for r in self.ratios]
        self.sums = [n.astype(np.float64) for n in self.sums]

    @property
    def width(self) -> int:
        return self.shares[0].shape[1]

    @property
    def levels(self) -> int:
        return len(self.shares)

    def classes(self, level: int) -> np.ndarray:
        """The class of each row."""
        return np.repeat(np.arange(len(self.rows[level])), self.rows[level])

    def log_shares(self, level: int) -> np.ndarray:
        if ("shares", level) not in self.tables:
            self.tables["shares", level] = np.log(self.shares[level])
        return self.tables["shares", level]

    def odds(self, level: int) -> np.ndarray:
        """By template and row, what a row multiplies its children's odds with; the shares without
        context are in the first template's."""
        if ("odds", level) not in self.tables:
            table = np.empty(self.ratios[level].shape, np.float32)
            for t in range(TEMPLATES):
                factor = self.factors[level, t, _magnitudes(self.sums[level][t])].astype(np.float32)
                np.multiply(self.ratios[level][t], factor[:, None], out=table[t])
            table[0] += self.log_shares(level)[self.classes(level)]
            self.tables["odds", level] = np.exp(table, out=table)
        return self.tables["odds", level]

    def left_out(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """By template and row, each child's ratio with one token of its own left out, and the
        magnitude of the row's count without that token."""
        if ("left out", level) not in self.tables:
            table = np.empty(self.ratios[level].shape, np.float32)
            share = self.shares[level].astype(np.float64)[self.classes(level)]
            for t in range(TEMPLATES):
                sums = self.sums[level][t][:, None]
                # The count that the ratio came from, a whole number.
                own = np.rint(np.exp(self.ratios[level][t].astype(np.float64)) * (sums + PRIOR) * share - PRIOR * share) - 1.0
                table[t] = log_ratios(np.maximum(own, 0.0), sums, share)
            self.tables["left out", level] = table, _magnitudes(self.sums[level] - 1).astype(np.int8)
            release_memory()
        return self.tables["left out", level]


def rows_for(vocab: Vocabulary) -> int:
    """Rows per template and level that are dealt to the classes."""
    # A ratio takes four bytes in a worker, two on the way there.
    most = MODEL_BYTES // (4 * TEMPLATES * vocab.levels * vocab.width)
    return min(max(vocab.tokens // ROW_TOKENS, 1 << 10), most)


def deal_rows(vocab: Vocabulary) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """First row and number of rows of every class, by level; one row at least for each."""
    width, levels, total = vocab.width, vocab.levels, rows_for(vocab)
    mass = np.zeros(width**levels)
    mass[: vocab.leaves - 1] = vocab.counts + 0.5
    mass[vocab.leaves - 1] = vocab.rare_sum
    first, rows = [], []
    for level in range(levels):
        share = mass.reshape(width**level, -1).sum(1) / mass.sum()
        rows.append(np.maximum(1, np.floor(share * total)).astype(np.int64))
        first.append(np.cumsum(rows[-1]) - rows[-1])
    return first, rows


def without_context(vocab: Vocabulary) -> list[np.ndarray]:
    """Shares of the children of every class, by level."""
    width, levels = vocab.width, vocab.levels
    mass = np.zeros(width**levels)
    mass[: vocab.leaves - 1] = vocab.counts + 0.5
    mass[vocab.leaves - 1] = vocab.rare_sum
    # A child without words is as good as impossible.
    mass = np.maximum(mass, 1e-20)
    shares = []
    for level in range(levels):
        sums = mass.reshape(width ** (level + 1), -1).sum(1).reshape(-1, width)
        shares.append(np.maximum(sums / sums.sum(1, keepdims=True), 1e-25).astype(np.float32))
    return shares


def _hash(*parts: np.ndarray | int) -> np.ndarray:
    value = np.uint64(0x243F6A8885A308D3)
    with np.errstate(over="ignore"):
        for part in parts:
            value = (value ^ np.asarray(part).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            value = value ^ (value >> np.uint64(29))
    return value


def contexts_of(vocab: Vocabulary, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of the three contexts of every token; texts end to end."""
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(len(codes)) - np.repeat(starts, lengths)
    # A word met often speaks for itself, another one for its neighbours in the tree.
    often = np.append(vocab.counts >= OFTEN, False)[codes]
    group = codes // vocab.width
    word = np.where(often, codes, vocab.leaves + group)
    top = codes // vocab.width ** (vocab.levels - 1)
    begin = 2 * vocab.leaves

    def before(values: np.ndarray, back: int) -> np.ndarray:
        return np.where(inside >= back, np.concatenate([np.full(back, begin), values])[: len(codes)], begin)

    return np.stack([_hash(1, before(word, 1)), _hash(2, before(word, 2)), _hash(3, before(top, 1), before(top, 2))])


def _at(codes: np.ndarray, width: int, levels: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The class that each leaf lies under at a level, and the child that leads to it."""
    child = codes // width ** (levels - 1 - level)
    return child // width, child % width


def _hashed(contexts: np.ndarray) -> np.ndarray:
    return _hash(contexts) >> np.uint64(20)


def _places(hashed: np.ndarray, classes: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return first[classes] + (hashed % rows[classes].astype(np.uint64)).astype(np.int64)


def _rows(contexts: np.ndarray, classes: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return _places(_hashed(contexts), classes, first, rows)


def _tokens(vocab: Vocabulary, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, tuple[pa.BinaryArray, np.ndarray]]:
    """Leaf of each word and of each text's end, tokens per text, and the words: the distinct ones
    and the place among them of each."""
    words, index, counts = distinct_words(texts)
    leaves = vocab.encode([*objects(words), END])
    codes = np.insert(leaves[index], np.cumsum(counts), leaves[-1])
    return codes, counts + 1, (words, index)


def _rare_words(codes: np.ndarray, lengths: np.ndarray, words: pa.BinaryArray, index: np.ndarray, last: int) -> pa.ListArray:
    """Of each text its distinct words in the last leaf, and how often each stands there."""
    is_rare = np.delete(codes, np.cumsum(lengths) - 1) == last
    of = np.repeat(np.arange(len(lengths)), lengths - 1)[is_rare]
    found, n = np.unique(of * (len(words) + 1) + index[is_rare], return_counts=True)
    offsets = np.searchsorted(found, np.arange(len(lengths) + 1) * (len(words) + 1))
    pairs = [words.take(pa.array(found % (len(words) + 1))), pa.array(n, pa.int32())]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(pairs, ["word", "n"]))


def log_ratios(counts: np.ndarray, sums: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log of the smoothed shares of a row's children over their shares without context."""
    share = share.astype(np.float64)
    return np.log((counts + PRIOR * share) / ((sums + PRIOR) * share))


def count_rows(training: DataFrame, vocab: Vocabulary, shared) -> Model:
    """The model with the rows counted over all training documents and the factors' start."""
    width, levels = vocab.width, vocab.levels
    first, rows = deal_rows(vocab)
    sizes = [int(r.sum()) * width for r in rows]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, totals = shared.value, [np.zeros(TEMPLATES * size, np.int32) for size in sizes]
        for _, texts in chunks(batches):
            codes, lengths, _ = _tokens(words, texts)
            hashed = _hashed(contexts_of(words, codes, lengths))
            for level, total in enumerate(totals):
                classes, child = _at(codes, width, levels, level)
                cells = _places(hashed, classes, first[level], rows[level]) * width + child[None, :]
                for template in range(TEMPLATES):
                    part = total[template * sizes[level] : (template + 1) * sizes[level]]
                    part += np.bincount(cells[template], minlength=sizes[level]).astype(np.int32)
        for level, total in enumerate(totals):
            # Blocks of cells; what a task never touched is not sent.
            for start in range(0, len(total), BLOCK):
                block = total[start : start + BLOCK]
                if block.any():
                    packed = zlib.compress(block.astype("<i4").tobytes(), 1)
                    kinds = (pa.int32(), pa.int32(), pa.binary())
                    yield pa.record_batch(
                        [pa.array([v], k) for v, k in zip((level, start // BLOCK, packed), kinds)],
                        names=["level", "block", "counts"],
                    )

    def add(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BLOCK)
        for batch in batches:
            for packed in batch.column("counts").to_pylist():
                counts = np.frombuffer(zlib.decompress(packed), "<i4")
                total[: len(counts)] += counts
        packed = zlib.compress(total.astype("<f4").tobytes(), 1)
        yield pa.record_batch(
            [pa.array([keys[0].as_py()], pa.int32()), pa.array([keys[1].as_py()], pa.int32()), pa.array([packed])],
            names=["level", "block", "counts"],
        )

    # Every task holds one table of fixed size; a task a core keeps all cores busy.
    tasks = training.sparkSession.sparkContext.defaultParallelism
    schema = "level int, block int, counts binary"
    partial = training.select("text").coalesce(tasks).mapInArrow(count, schema)
    flat = [np.zeros(-(-TEMPLATES * size // BLOCK) * BLOCK, np.float32) for size in sizes]
    for row in partial.groupBy("level", "block").applyInArrow(add, schema).collect():
        at = row["block"] * BLOCK
        flat[row["level"]][at : at + BLOCK] = np.frombuffer(zlib.decompress(row["counts"]), "<f4")
    shares = without_context(vocab)
    counts = [f[: TEMPLATES * size].reshape(TEMPLATES, -1, width) for f, size in zip(flat, sizes)]
    sums = [c.sum(2, dtype=np.float64) for c in counts]
    ratios = [
        log_ratios(c, n[:, :, None], np.repeat(share, r, axis=0)[None]).astype(np.float32)
        for c, n, share, r in zip(counts, sums, shares, rows)
    ]
    return Model(first, rows, shares, counts, sums, ratios, np.full((levels, TEMPLATES, MAGNITUDES), START))


def _logits(model: Model, level: int, classes: np.ndarray, ratios: list[np.ndarray], magnitudes: np.ndarray) -> np.ndarray:
    logits = np.take(model.log_shares(level), classes, axis=0)
    factors = model.factors[level].astype(np.float32)
    part = np.empty_like(logits)
    for template in range(TEMPLATES):
        logits += np.multiply(ratios[template], factors[template].take(magnitudes[template])[:, None], out=part)
    return logits


def _magnitudes(sums: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(sums, 0) + 1).astype(np.int64), MAGNITUDES - 1)


def log_probabilities(model: Model, codes: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each leaf; the share inside the last leaf is left out.

    A factor is at most 1.5 and a ratio at most the log of a share's inverse, so that odds stay
    below the share's inverse to the power 3.5, which single precision holds for 10^10 tokens.
    """
    out = np.zeros(len(codes))
    hashed, one = _hashed(contexts), np.ones(model.width, np.float32)
    # A level after the other, so that its rows stay in the cache.
    for level in range(model.levels):
        for a in range(0, len(codes), BATCH):
            part = codes[a : a + BATCH]
            at = np.arange(len(part)) * model.width
            classes, child = _at(part, model.width, model.levels, level)
            rows = _places(hashed[:, a : a + BATCH], classes, model.first[level], model.rows[level])
            odds, picked, own = None, 1.0, at + child
            for table, row in zip(model.odds(level), rows):
                found = np.take(table, row, axis=0)
                picked = picked * found.take(own).astype(np.float64)
                odds = found if odds is None else np.multiply(odds, found, out=odds)
            out[a : a + BATCH] += np.log(picked / (odds @ one))
    return out


def without_own(
    model: Model, level: int, classes: np.ndarray, child: np.ndarray, rows: np.ndarray
) -> tuple[list[np.ndarray], np.ndarray]:
    """Ratios of each token's rows with the token itself left out, and their magnitudes.

    Leaving it out of the row's sum moves all children's ratios alike.
    """
    own, magnitude = model.left_out(level)
    at = np.arange(len(child)) * model.width + child
    ratios = []
    for t in range(TEMPLATES):
        found = np.take(model.ratios[level][t], rows[t], axis=0)
        found.reshape(-1)[at] = own[t].take(rows[t] * model.width + child)
        ratios.append(found)
    return ratios, np.stack([magnitude[t].take(rows[t]) for t in range(TEMPLATES)]).astype(np.int64)


def slopes(model: Model, codes: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log-likelihood of the tokens in the factors, summed.

    A token touches one factor per template: its gradient is the distance of the token's own
    ratio from the expected one, the curvature the covariance of the templates' ratios.
    """
    gradient = np.zeros((model.levels, TEMPLATES, MAGNITUDES))
    curvature = np.zeros((model.levels, TEMPLATES, MAGNITUDES, TEMPLATES, MAGNITUDES))
    hashed, one, diagonal = _hashed(contexts), np.ones(model.width, np.float32), np.arange(MAGNITUDES)
    for level in range(model.levels):
        for a in range(0, len(codes), BATCH):
            part = codes[a : a + BATCH]
            at = np.arange(len(part)) * model.width
            classes, child = _at(part, model.width, model.levels, level)
            rows = _places(hashed[:, a : a + BATCH], classes, model.first[level], model.rows[level])
            ratios, magnitudes = without_own(model, level, classes, child, rows)
            p = _logits(model, level, classes, ratios, magnitudes)
            np.exp(p, out=p)  # as in log_probabilities
            total = p @ one
            expected = [(np.einsum("ij,ij->i", p, r) / total).astype(float) for r in ratios]
            own, weighted = at + child, np.empty_like(p)
            for t in range(TEMPLATES):
                gradient[level, t] += np.bincount(magnitudes[t], ratios[t].take(own) - expected[t], MAGNITUDES)
                np.multiply(p, ratios[t], out=weighted)
                for u in range(t, TEMPLATES):
                    both = np.einsum("ij,ij->i", weighted, ratios[u]) / total - expected[t] * expected[u]
                    if u == t:
                        curvature[level, t, diagonal, t, diagonal] += np.bincount(magnitudes[t], both, MAGNITUDES)
                    else:
                        pair = magnitudes[t] * MAGNITUDES + magnitudes[u]
                        found = np.bincount(pair, both, MAGNITUDES**2).reshape(MAGNITUDES, MAGNITUDES)
                        curvature[level, t, :, u] += found
                        curvature[level, u, :, t] += found.T
    return gradient.reshape(model.levels, -1), curvature.reshape(model.levels, -1)


def _step(model: Model, gradient: np.ndarray, curvature: np.ndarray) -> Model:
    """One Newton step, held near the start where few tokens speak."""
    size = TEMPLATES * MAGNITUDES
    factors = model.factors.copy()
    for level in range(model.levels):
        now = factors[level].ravel()
        pull = gradient[level] - HOLD * (now - START)
        bend = curvature[level].reshape(size, size) + HOLD * np.eye(size)
        factors[level] = np.clip(now + np.linalg.solve(bend, pull), 0.0, 1.5).reshape(TEMPLATES, MAGNITUDES)
    return replace(model, factors=factors)


def learn_round(docs: DataFrame, shared_vocab, shared_model) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature summed over all tokens of the documents: a row per task reaches the
    aggregation, a number per entry the driver."""
    size = TEMPLATES * MAGNITUDES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shared_vocab.value, shared_model.value
        gradient, curvature = np.zeros((model.levels, size)), np.zeros((model.levels, size * size))
        for _, texts in chunks(batches):
            codes, lengths, _ = _tokens(words, texts)
            g, c = slopes(model, codes, contexts_of(words, codes, lengths))
            gradient += g
            curvature += c
        flat = np.concatenate([gradient, curvature], axis=1).ravel()
        entries = np.flatnonzero(flat)
        yield pa.record_batch([pa.array(entries.astype(np.int32)), pa.array(flat[entries])], names=["entry", "value"])

    partial = docs.select("text").mapInArrow(add, "entry int, value double")
    found = partial.groupBy("entry").agg(F.sum("value").alias("value")).toArrow()
    levels = shared_model.value.levels
    flat = np.zeros(levels * (size + size * size))
    flat[found.column("entry").to_numpy()] = found.column("value").to_numpy()
    flat = flat.reshape(levels, -1)
    return flat[:, :size], flat[:, size:]


def train(training: DataFrame, vocab: Vocabulary) -> Model:
    context = training.sparkSession.sparkContext
    shared_vocab = context.broadcast(vocab)
    model = count_rows(training, vocab, shared_vocab)
    for number in range(ROUNDS):
        turn = F.pmod(F.xxhash64(F.lit(99), "doc_id", "text"), F.lit(ROUNDS)) == number
        shared = context.broadcast(model)
        model = _step(model, *learn_round(training.filter(turn), shared_vocab, shared))
        shared.destroy()
    shared_vocab.destroy()
    return model


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, "
    "rare array<struct<word:binary,n:int>>"
)


def score_documents(docs: DataFrame, vocab: Vocabulary, model: Model) -> DataFrame:
    """Per document what needs no further counts, and its words beyond the known ones."""
    context = docs.sparkSession.sparkContext
    shared_vocab, shared_model = context.broadcast(vocab), context.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared_vocab.value, shared_model.value
        # Of the last leaf the word's share of it: its count is added when it is known.
        base_logs = np.append(np.log10(words.counts + 0.5), 0.0)
        counted = np.append(words.counts > 0, False)
        last = words.leaves - 1
        ln10, log_rare = np.log(10), np.log10(words.rare_sum)
        for batch, texts in chunks(batches):
            codes, lengths, found = _tokens(words, texts)
            starts = np.cumsum(lengths) - lengths
            parts = log_probabilities(weights, codes, contexts_of(words, codes, lengths)) / ln10
            parts -= np.where(codes == last, log_rare, 0.0)
            sums = [np.add.reduceat(x, starts) for x in (counted[codes].astype(np.int64), base_logs[codes], parts)]
            yield pa.record_batch(
                [
                    batch.column("row"), batch.column("doc_id"), batch.column("held_out"),
                    pa.array(lengths, pa.int64()), pa.array(sums[0], pa.int64()), pa.array(sums[1]), pa.array(sums[2]),
                    _rare_words(codes, lengths, *found, last),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"],
            )

    held_out = (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out, "text")
    return rows.mapInArrow(read, SCORED)


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per document."""
    training = docs.filter(fold_of("doc_id", FOLDS) != HELD_OUT)
    counts = materialise(word_counts(training), "word-counts")
    vocab = vocabulary(counts, training.count())
    model = train(training, vocab)
    scored = materialise(score_documents(docs, vocab, model), "lm-scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    # An unknown word has count 0.
    met = rare.join(counts.select(F.col("word").alias("_word"), "c"), F.col("word") == F.col("_word"), "left")
    added = met.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("added"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("found"),
    )
    full = scored.drop("rare").join(added, "row", "left")
    extra = F.coalesce("added", F.lit(0.0))
    total = np.log10(vocab.tokens + 0.5 * (vocab.distinct + 1))
    return full.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * F.lit(float(total))).alias("base_score"),
        (F.col("model") + extra).alias("score"),
    )
