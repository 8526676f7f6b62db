"""Training documents that hold passages of benchmark items, edited or not.

A document holds an item if its best local alignment (Smith-Waterman over words, the whole
document against the whole item) reaches a share of the item's score against itself, or is
worth LONG_WORDS equal words.

An accepted alignment is worth many words and spans few: with p of the item's pairs of words
(next to each other or with one word between, however the text spaces them) its score is at
most MATCH * (p + 1), since two matches in a row cost nothing between them, one if they make a
pair, else two at least; and since every word beyond the matches costs a point, it spans at
most three times the item's words less twice the words it must be worth.

1. The corpus is read with a bitmap of all items' pairs, made by aggregation and of fixed
   size; the distinct pairs of each document are kept, and counted over all documents.
2. Seeds: an item's rarest pairs, taken until the pairs left, each counted as often as it
   stands in the item, are at most half of those that an accepted alignment needs. Absent pairs
   are the rarest. A document goes on if it shares as many seeds with an item as are then needed.
3. Only these documents are read again. Their texts are cut into passages of twice the longest
   accepted span of an item's size class, each half over the next, so that every alignment
   lies wholly in one. Passage and item go on where they share the seeds that are still needed.
4. The passages that go on are read as words; those with enough of the item's pairs are aligned.
   Equal texts count once.

No step loses an alignment, and a long text meets only the items of which a passage holds rare
pairs.

Defined results: null or empty texts hold nothing; items of fewer than LEAST_WORDS words match
nothing, nor do items without an id; of items with equal ids the best counts; repeated rows
are found each; a null doc_id is carried; empty tables give no rows; further columns are
ignored. Words are compared without case and ASCII punctuation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.llm.common import chunks, distinct_words, folded, hash_tokens, hashes_of, mix, text_of, words_folded
from faultweave.sources.workspace import materialise, release

LEAST_WORDS = 3
# Bits of the bitmap: 2^27, 16 MB whatever the benchmark's size.
LOG_BITS = 27
MATCH, MISMATCH, SKIP = 2, -1, -1
THRESHOLD = 0.5
# Pairs that are no seeds: at most this share of those that an alignment needs.
REST = 0.5
# An alignment worth so many words is enough by itself, however long the item.
LONG_WORDS = 50


# Words whose pairs are looked up at once.
BLOCK_WORDS = 1 << 14


def pairs_of(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every pair of words with at most one word between them."""
    flat, counts = hash_tokens(split)
    text = np.repeat(np.arange(len(split)), counts)
    of, pairs = [], []
    with np.errstate(over="ignore"):
        first = flat * np.uint64(0x9E3779B97F4A7C15)
        for apart in (1, 2):
            inside = text[:-apart] == text[apart:]
            of.append(text[:-apart][inside])
            pairs.append(mix((first[:-apart] + flat[apart:])[inside]))
    return np.concatenate(of), np.concatenate(pairs)


def known_pairs(texts: list[bytes], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of all texts those that the bitmap lets through: text, hash, and the place of
    the first word in the text.

    A word is hashed once however often it stands in the texts; where a pair stands is asked only
    of the pairs let through.
    """
    words, index, counts = distinct_words(texts, folded)
    hashes = hashes_of(words)
    with np.errstate(over="ignore"):
        flat, first = hashes[index], (hashes * np.uint64(0x9E3779B97F4A7C15))[index]
        pairs = []
        for start in range(0, len(flat), BLOCK_WORDS):
            for apart in (1, 2):
                second = flat[start + apart : start + BLOCK_WORDS + apart]
                found = mix(first[start : start + len(second)] + second)
                hit = np.flatnonzero(_known(bits, found))
                pairs.append(np.stack([found[hit], hit.astype(np.uint64) + np.uint64(start), np.full(len(hit), apart, np.uint64)]))
    pair, at, apart = np.concatenate(pairs, axis=1) if pairs else np.empty((3, 0), np.uint64)
    at, apart = at.astype(np.int64), apart.astype(np.int64)
    ends = np.cumsum(counts)
    of = np.searchsorted(ends, at, side="right")
    inside = at + apart < ends[of]
    of, at = of[inside], at[inside]
    return of, pair[inside], at - (ends - counts)[of]


def item_pairs(entries: DataFrame) -> DataFrame:
    """entry, gram, times, n_words: the distinct pairs of every item text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "item"):
            split = [ws if len(ws) >= LEAST_WORDS else [] for ws in map(words_folded, texts)]
            of, pairs = pairs_of(split)
            sizes = np.array([len(ws) for ws in split], np.int64)
            yield pa.record_batch(
                [batch.column("entry").take(pa.array(of)), pa.array(pairs.view(np.int64)), pa.array(sizes[of])],
                names=["entry", "gram", "n_words"],
            )

    rows = entries.select("entry", "item").mapInArrow(read, "entry long, gram long, n_words long")
    return rows.groupBy("entry", "gram", "n_words").agg(F.count("*").alias("times"))


def bitmap(gram_rows: DataFrame) -> np.ndarray:
    """Bitmap over the leading bits of `gram`, gathered as at most 2^(LOG_BITS - 6) numbers."""
    slot = F.shiftrightunsigned("gram", 64 - LOG_BITS)
    words = gram_rows.select(slot.alias("slot")).selectExpr(
        "shiftright(slot, 6) AS w", "shiftleft(1L, cast(slot & 63 AS int)) AS bits"
    )
    rows = words.groupBy("w").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (LOG_BITS - 6), "<i8")
    out[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def _known(bits: np.ndarray, gram: np.ndarray) -> np.ndarray:
    slot = gram >> np.uint64(64 - LOG_BITS)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def span_class(n_words: Column, threshold: float) -> Column:
    """c for items whose accepted alignments span at most 2 ** c words of a text."""
    span = 3 * n_words - F.floor(2 * wanted_words(n_words, threshold))
    return F.ceil(F.log2(F.greatest(span, F.lit(8)))).cast("int")


def wanted_words(n_words: Column, threshold: float) -> Column:
    return F.least(n_words * threshold, F.lit(LONG_WORDS))


def pair_hits(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """row, doc_id, key, grams: the distinct pairs of each document that the bitmap lets through.

    key: the digest of the text. Documents without such pairs give no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch, texts in chunks(batches):
            of, pairs, _ = known_pairs(texts, bits)
            order = np.lexsort((pairs, of))
            of, pairs = of[order], pairs[order]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (pairs[1:] != pairs[:-1])
            of, pairs = of[new], pairs[new]
            texts_hit, starts = np.unique(of, return_index=True)
            taken = batch.select(["row", "doc_id", "key"]).take(pa.array(texts_hit))
            offsets = pa.array(np.append(starts, len(of)).astype(np.int32))
            grams = pa.ListArray.from_arrays(offsets, pa.array(pairs.view(np.int64)))
            yield pa.record_batch([*taken.columns, grams], names=["row", "doc_id", "key", "grams"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _key().alias("key"), "text")
    return rows.mapInArrow(read, "row long, doc_id long, key string, grams array<long>")


def rare_seeds(pairs: DataFrame, often: DataFrame, threshold: float) -> DataFrame:
    """entry, gram, times, class and least: of each item its rarest pairs, and how many of them,
    each counted as often as it stands in the item, an accepted alignment has at least.

    An alignment needs so many of all pairs; those left out here are too few to make up more
    than the share REST of that.
    """
    counted = pairs.join(often, "gram", "left")
    item = Window.partitionBy("entry")
    rarest = item.orderBy(F.coalesce("often", F.lit(0)), "gram").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    needed = wanted_words(F.col("n_words"), threshold) - 1
    ranked = counted.withColumn("kept", F.sum("times").over(rarest) > needed * REST)
    left_out = F.sum(F.when(F.col("kept"), 0).otherwise(F.col("times"))).over(item)
    # A pair that the corpus lacks is a seed that nothing meets.
    seeds = ranked.withColumn("least", needed - left_out).filter("kept AND often IS NOT NULL")
    return seeds.select("entry", "gram", "times", span_class(F.col("n_words"), threshold).alias("class"), "least")


def _key() -> Column:
    return F.md5(text_of().cast("binary"))


def passage_hits(docs: DataFrame, keys: np.ndarray, bits: np.ndarray, classes: list[int]) -> DataFrame:
    """row, key, hits: for each text of the first bitmap its distinct (class, passage, gram) of the pairs
    that the second one lets through.

    Passage p of class c holds the words from p * 2 ** c up to (p + 2) * 2 ** c.
    """
    context = docs.sparkSession.sparkContext
    shared_keys, shared = context.broadcast(keys), context.broadcast(bits)
    kind = pa.struct([("class", pa.int32()), ("passage", pa.int32()), ("gram", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bits = shared_keys.value, shared.value
        asked = (b.filter(pa.array(_known(keys, b.column("k").to_numpy(zero_copy_only=False).view(np.uint64)))) for b in batches)
        for batch, texts in chunks(asked):
            of, pairs, place = known_pairs(texts, bits)
            parts = []
            for c in classes:
                for back in (0, 1):
                    passage = (place >> c) - back
                    inside = passage >= 0
                    parts.append((of[inside], np.full(inside.sum(), c), passage[inside], pairs[inside]))
            of, c, passage, pairs = map(np.concatenate, zip(*parts))
            order = np.lexsort((pairs, passage, c, of))
            of, c, passage, pairs = of[order], c[order], passage[order], pairs[order]
            new = np.ones(len(of), bool)
            for column in (of, c, passage, pairs):
                new[1:] &= column[1:] == column[:-1]
            new[1:] = ~new[1:]
            of, c, passage, pairs = of[new], c[new], passage[new], pairs[new]
            texts_hit, starts = np.unique(of, return_index=True)
            taken = batch.select(["row", "key"]).take(pa.array(texts_hit))
            offsets = pa.array(np.append(starts, len(of)).astype(np.int32))
            columns = [pa.array(c, pa.int32()), pa.array(passage, pa.int32()), pa.array(pairs.view(np.int64))]
            hits = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(kind)))
            yield pa.record_batch([*taken.columns, hits], names=["row", "key", "hits"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), _key().alias("key"), F.xxhash64(_key()).alias("k"), "text"
    )
    return rows.mapInArrow(read, "row long, key string, hits array<struct<class:int,passage:int,gram:long>>")


def _passage_hash(key: np.ndarray, c: np.ndarray | int, passage: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(key.view(np.uint64) + mix(np.asarray(passage).astype(np.uint64) * np.uint64(64) + np.asarray(c).astype(np.uint64)))


def passage_words(docs: DataFrame, wanted_passages: DataFrame, classes: list[int]) -> DataFrame:
    """key, class, passage, words: the words of the passages asked for, and a few of others."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, c, passage = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            yield pa.record_batch([pa.array(_passage_hash(key, c, passage).view(np.int64))], names=["gram"])

    asked = wanted_passages.select(F.xxhash64("key").alias("k"), "class", "passage").distinct()
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(asked.mapInArrow(hashes, "gram long")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch, texts in chunks(batches):
            keys, numbers = batch.column("key"), batch.column("k").to_numpy(zero_copy_only=False)
            # A word takes two bytes at least, the white space after it among them.
            most = np.fromiter(map(len, texts), np.int64, len(texts)) // 2
            wanted_here: dict[int, list[tuple[int, int]]] = {}
            for c in classes:
                n = (most >> c) + 1
                of = np.repeat(np.arange(len(texts)), n)
                passages = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                hit = np.flatnonzero(_known(bits, _passage_hash(numbers[of], c, passages)))
                for i, p in zip(of[hit].tolist(), passages[hit].tolist()):
                    wanted_here.setdefault(i, []).append((c, p))
            rows = []
            for i, asked_here in wanted_here.items():
                words = words_folded(texts[i])
                for c, p in asked_here:
                    if words[p << c :]:
                        rows.append((keys[i].as_py(), c, p, b" ".join(words[p << c : (p + 2) << c])))
            columns = zip(*rows) if rows else [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
            yield pa.record_batch(
                [pa.array(x, k) for x, k in zip(columns, kinds)], names=["key", "class", "passage", "words"]
            )

    rows = docs.select(_key().alias("key"), F.xxhash64(_key()).alias("k"), "text")
    found = rows.mapInArrow(read, "key string, class int, passage int, words binary")
    return found.groupBy("key", "class", "passage").agg(F.first("words").alias("words"))


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two id sequences, and where in `a` it first ends.

    Word by word of `b`; gaps along `a` are a running maximum.
    """
    slope = -SKIP * np.arange(1, len(a) + 1)
    previous = np.zeros(len(a) + 1, np.int64)
    best, end = 0, 0
    for token in b.tolist():
        row = np.maximum(previous[:-1] + np.where(a == token, MATCH, MISMATCH), previous[1:] + SKIP)
        row = np.maximum.accumulate(np.maximum(row, 0) + slope) - slope
        previous[1:] = np.maximum(row, 0)
        at = int(previous.argmax())
        if previous[at] > best or (previous[at] == best and at < end):
            best, end = int(previous[at]), at
    return best, end


def score_passages(met: DataFrame, threshold: float) -> DataFrame:
    """key, entry, score, end of the passages and items that reach the threshold."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words, grams = None, [], np.empty(0, np.uint64)
        for batch in batches:
            kept, scores, ends = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("class", "passage", "words", "item"))
            for i, (c, passage, text, item) in enumerate(zip(*columns)):
                if text != known:
                    known, words = text, text.split()
                    grams = np.unique(pairs_of([words])[1])
                b = words_folded(item.encode())
                need = wanted(len(b), threshold)
                # Every pair of the item as often as it stands there.
                if np.isin(pairs_of([b])[1], grams).sum() + 1 < need:
                    continue
                number: dict[bytes, int] = {}
                for w in b:
                    number.setdefault(w, len(number))
                ids = np.array([number.get(w, -1) for w in words])
                best, end = align(ids, np.array([number[w] for w in b]))
                if best >= MATCH * need:
                    kept.append(i)
                    scores.append(best / (MATCH * len(b)))
                    ends.append((passage << c) + end)
            rows = batch.select(["key", "entry"]).take(pa.array(kept, pa.int64()))
            yield pa.record_batch(
                [*rows.columns, pa.array(scores, pa.float64()), pa.array(ends, pa.int64())],
                names=["key", "entry", "score", "end_word"],
            )

    return met.select("key", "entry", "class", "passage", "words", "item").mapInArrow(
        read, "key string, entry long, score double, end_word long"
    )


def wanted(n_words: int, threshold: float) -> float:
    """Words that an alignment with an item of n_words must be worth."""
    return min(n_words * threshold, LONG_WORDS)


def _found(docs: DataFrame, items: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The documents with seeds (row, doc_id, key), and (key, item_id, best) of all texts that hold an item."""
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", F.col("text").alias("item"))
    entries = materialise(
        items.select("item").distinct().withColumn("entry", F.monotonically_increasing_id()), "items"
    )
    pairs = materialise(item_pairs(entries), "pairs")
    found = materialise(pair_hits(docs, bitmap(pairs)), "hits")
    often = found.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("often"))
    seeds = materialise(rare_seeds(pairs, often, threshold), "seeds")
    # At most one class per power of two of an item's words.
    classes = sorted(r["class"] for r in seeds.select("class").distinct().collect())
    seeded = found.select("row", "key", F.explode("grams").alias("gram")).join(seeds, "gram")
    seeded = seeded.groupBy("row", "key", "entry", "least").agg(F.sum("times").alias("n")).filter("n >= least")
    keys = bitmap(seeded.select(F.xxhash64("key").alias("gram")).distinct())
    passages = passage_hits(docs, keys, bitmap(seeds), classes or [0])
    hits = passages.select("row", "key", F.explode("hits").alias("hit"))
    hits = hits.select("row", "key", "hit.class", "hit.passage", "hit.gram")
    shared = hits.join(seeds, ["class", "gram"]).groupBy("row", "key", "class", "passage", "entry", "least")
    enough = shared.agg(F.sum("times").alias("n")).filter(F.col("n") >= F.col("least"))
    # Copies of a text have the same passages.
    met = materialise(enough.select("key", "class", "passage", "entry").distinct(), "met")
    words = passage_words(docs, met, classes or [0])
    scored = score_passages(met.join(words, ["key", "class", "passage"]).join(entries, "entry"), threshold)
    named = scored.join(entries, "entry").join(items, "item")
    # Of equal scores the one that ends first.
    best = named.groupBy("key", "item_id").agg(F.max(F.struct("score", (-F.col("end_word")).alias("back"))).alias("best"))
    best = materialise(best, "best")
    release(pairs, seeds, met)
    return found, best


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score and end_word: every document with every item it holds.

    score: the best alignment as a share of the item's own; end_word: where it first ends.
    """
    found, best = _found(docs, items, threshold)
    return found.select("doc_id", "key").join(best, "key").select(
        "doc_id", "item_id", "best.score", (-F.col("best.back")).alias("end_word")
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose texts hold no benchmark item, with all their columns."""
    hit = _found(docs, items, threshold)[1].select("key").distinct()
    rows = docs.select(F.struct("*").alias("doc"), _key().alias("key"))
    return rows.join(hit, "key", "left_anti").select("doc.*")
