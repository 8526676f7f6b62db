"""Near-duplicate documents: SetSketch registers, banded; joint likelihood; full sets.

1. One pass over the texts gives each document the number of its distinct word shingles, a
   128-bit digest of the set, REGISTERS SetSketch registers and the hash of each band.
   A register is the smallest of exponential variables of the set's elements on a scale of
   exponentially spaced, truncated steps: it merges by maximum, and two sets share a
   register with a probability that follows their similarity. Written to the shared folder.
2. Documents with equal sets are one class, named by its smallest id. Only classes go on.
3. Each bucket (band and hash) names its smallest class as leader; members are paired with
   their leader, never with each other.
4. A pair is kept if the likelihood of its registers, given both set sizes, is highest at a
   similarity of no less than the threshold minus five standard deviations.
5. The pairs' texts are brought together and compared as full sets. That makes the links.
6. Components of the links. In buckets that several components share, each member outside the
   largest meets one member of it, drawn anew per bucket and round, for ROUNDS rounds; this
   takes in nearly all that belong to a large group, with a row per member.
7. Buckets whose members are now all in one component are done. The members of the others
   are paired by their rarest shingles: with sizes x and y a link needs an intersection of at
   least o = percent * (x + y) / (100 + percent), so in any common order of all shingles
   the first one that both have is among the first x - o + 1 of the one and the first y - o + 1
   of the other. The order starts with shingles that stand in one component only, which
   pair nobody, and goes on with the rarest. Two documents meet only in a shingle whose place
   in both leaves room for the intersection, in cells of about equal size. Documents whose
   own words alone rule out a link, as in a large group around one passage, thus meet nobody,
   and no link is lost. Steps 4 and 5 again for these pairs.

So no link that step 3 skips between members is lost: both ends are in one component, or
step 7 compares them.

What banding misses: two sets with similarity s share none of 40 bands of 6 registers with
probability (1 - s^6)^40: 5e-6 at s = 0.8, less above.

Defined results: a null or empty text, or one without words, has 0 shingles and is linked
with nothing; a text with fewer words than a shingle is one shingle; repeated rows get the
same component; of rows with one id but different texts each has the component of its own
text; rows with a null id are linked with nothing, their component_id is null; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.llm.common import chunks, hash_words, mix
from faultweave.llm.graph import components
from faultweave.sources.workspace import materialise, release

BANDS = 40
ROWS = 6
REGISTERS = BANDS * ROWS
# SetSketch: base of the steps, rate of the variables, largest register.
BASE = 1.001
RATE = 20.0
LAST = 65535
DEVIATIONS = 5
ROUNDS = 2
# Shingles per block of the register loop: the block stays in the processor's cache.
BLOCK = 1 << 16

_rng = np.random.default_rng(20240229)
_ADD = _rng.integers(0, 1 << 64, REGISTERS, np.uint64)
_TIMES = _rng.integers(0, 1 << 64, REGISTERS, np.uint64) | np.uint64(1)

# Ratio of neighbouring cells of set sizes, finer than the ratio of two linked sizes.
SIZE_STEP = 1.03

FIGURES = (
    "doc_id long, n_shingles long, k1 long, k2 long, sketch binary, bands array<long>"
)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Distinct 64-bit hashes of the k-word shingles of each text."""
    words, counts = hash_words(texts)
    ends = np.cumsum(counts)
    n = len(words)
    rolled = np.zeros(max(n - k + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(rolled)]
        rolled = mix(rolled)
        sets = []
        for end, count in zip(ends.tolist(), counts.tolist()):
            start = end - count
            if count >= k:
                sets.append(np.unique(rolled[start : end - k + 1]))
            elif count:
                whole = np.uint64(count)
                for word in words[start:end]:
                    whole = whole * np.uint64(0x9E3779B97F4A7C15) + word
                sets.append(mix(np.array([whole])))
            else:
                sets.append(np.empty(0, np.uint64))
    return sets


def registers(smallest: np.ndarray) -> np.ndarray:
    """SetSketch registers from the smallest 64-bit hash per register."""
    uniform = (smallest.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LAST).astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of every non-empty set, a row each."""
    smallest = np.empty((len(sets), REGISTERS), np.uint64)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (not size or size + len(sets[last]) <= BLOCK):
            size += len(sets[last])
            last += 1
        flat = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first : last - 1]])
        with np.errstate(over="ignore"):
            for j in range(REGISTERS):
                hashed = (flat ^ _ADD[j]) * _TIMES[j]
                smallest[first:last, j] = np.minimum.reduceat(hashed, starts)
        first = last
    return registers(smallest)


def _band_hashes(rows: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            value = np.full(len(rows), band + 1, np.uint64)
            for j in range(band * ROWS, (band + 1) * ROWS):
                value = value * np.uint64(0x9E3779B97F4A7C15) + rows[:, j]
            out[:, band] = mix(value)
    return out.view(np.int64)


def figures(docs: DataFrame, k: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sets = shingle_sets(texts, k)
            full = [i for i, s in enumerate(sets) if len(s)]
            digests = np.zeros((len(sets), 2), np.int64)
            sketch: list[bytes | None] = [None] * len(sets)
            bands: list[np.ndarray | None] = [None] * len(sets)
            if full:
                some = [sets[i] for i in full]
                rows = sketches(some)
                hashes = _band_hashes(rows)
                with np.errstate(over="ignore"):
                    for i, s, row, band in zip(full, some, rows, hashes):
                        digests[i, 0] = mix(s).sum(dtype=np.uint64).view(np.int64)
                        digests[i, 1] = mix(s ^ _ADD[0]).sum(dtype=np.uint64).view(np.int64)
                        sketch[i] = row.astype("<u2").tobytes()
                        bands[i] = band
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests[:, 0]),
                    pa.array(digests[:, 1]),
                    pa.array(sketch, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "k1", "k2", "sketch", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(read, FIGURES)


def joint_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of each pair of register rows with known set sizes.

    The counts of registers that are larger in a, larger in b, or equal have the likelihood
    of the SetSketch paper; it has one maximum in the similarity, found by thirds.
    """
    more = (a > b).sum(1).astype(float)
    less = (a < b).sum(1).astype(float)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def loglike(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-300
        return (
            more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, tiny))
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        left = loglike(low + third) < loglike(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose registers don't rule out a similarity of percent / 100."""
    share = percent / 100
    floor = share - DEVIATIONS * (share * (1 - share) / REGISTERS) ** 0.5

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                a, b = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                    for c in ("sketch_a", "sketch_b")
                )
                sizes = [part.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
                good = joint_similarity(a, b, *sizes) >= floor
                yield part.select(["a", "b"]).filter(pa.array(good))

    for end in ("a", "b"):
        side = classes.select(
            F.col("rep").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}")
        )
        pairs = pairs.join(side, end)
    return pairs.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(keep, "a long, b long")


def _set_of(text: str | None, k: int) -> set:
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(k)))) if len(words) >= k else {tuple(words)}


def links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs of ids whose texts have 100 * intersection >= percent * union, on full sets.

    `texts`: doc_id and text of all ids in the pairs.
    """

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_set = None, set()
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")]
            for a, b, text_a, text_b in zip(*columns):
                if text_a != known:
                    known, known_set = text_a, _set_of(text_a, k)
                other = _set_of(text_b, k)
                both = len(known_set & other)
                if 100 * both >= percent * (len(known_set) + len(other) - both) and both:
                    found.append((a, b))
            yield pa.record_batch(
                [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    written = pairs = materialise(pairs, "pairs")
    for end in ("b", "a"):
        pairs = pairs.join(texts.select(F.col("doc_id").alias(end), F.col("text").alias(f"text_{end}")), end)
    ordered = pairs.select("a", "b", "text_a", "text_b")
    found = materialise(ordered.mapInArrow(confirm, "a long, b long").distinct(), "links")
    release(written)
    return found


def open_members(classes: DataFrame, roots: DataFrame, leaders: DataFrame) -> DataFrame:
    """bucket, largest, rep, root: members of the buckets that more than one component shares,
    and the component that has most members in the bucket."""
    rooted = classes.select("rep", "bands").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = rooted.select("rep", F.coalesce("root", "rep").alias("root"), F.explode("bands").alias("bucket"))
    shared = materialise(rooted.join(leaders.select("bucket"), "bucket"), "shared")
    shares = shared.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    largest = shares.groupBy("bucket").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("roots")
    )
    members = shared.join(largest.filter("roots > 1").drop("roots"), "bucket")
    members = materialise(members.select("bucket", "largest", "rep", "root"), "open-members")
    release(shared)
    return members


def open_sets(rows: DataFrame, k: int) -> DataFrame:
    """rep, root, size, set (a name) and the shingle hashes of each text. `rows`: rep, root, text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sets = [s.view(np.int64) for s in shingle_sets(texts, k)]
            yield pa.record_batch(
                [
                    batch.column("rep"),
                    batch.column("root"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(mix(s.view(np.uint64)).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                    pa.array(sets, pa.list_(pa.int64())),
                ],
                names=["rep", "root", "size", "set", "shingles"],
            )

    return rows.select("rep", "root", "text").mapInArrow(
        read, "rep long, root long, size long, set long, shingles array<long>"
    )


def meeting(sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different components whose rarest shingles allow a link (step 7)."""
    of_set = ["rep", "root", "size", "set"]
    shingles = sets.select("rep", "root", "size", "set", F.explode("shingles").alias("h"))
    crossing = shingles.groupBy("h").agg(
        F.count("*").alias("often"), F.min("root").alias("low"), F.max("root").alias("high")
    ).filter("low < high").select("h", "often")
    rarest = Window.partitionBy(*of_set).orderBy("often", "h")
    shared = shingles.join(crossing, "h").withColumns(
        {"rank": F.row_number().over(rarest), "n": F.count("*").over(Window.partitionBy(*of_set))}
    )
    size = F.col("size")
    # Shingles of this set from this one on: no intersection that begins here is larger.
    left = F.col("n") - F.col("rank") + 1
    placed = shared.select("h", "rep", "root", "size", left.alias("left"))
    smallest = F.greatest(F.lit(1), F.floor(size * percent / 100))
    largest = F.ceil(F.least(size * 100 / percent, F.col("left") * (100 + percent) / percent - size))

    def cell(n: Column) -> Column:
        return F.floor(F.log(n) / F.lit(np.log(SIZE_STEP))).cast("int")

    # Sizes of partners for which there is still room, as cells.
    met = placed.filter(F.col("left") * 100 >= size * percent).select(
        "h", "rep", "root", "size", "left", cell(size).alias("own"),
        F.explode(F.sequence(cell(smallest), cell(F.greatest(largest, smallest)))).alias("other"),
    )
    x = met.select("h", *[F.col(c).alias(f"{c}_x") for c in ("rep", "root", "size", "left")], F.col("own").alias("p"), F.col("other").alias("q"))
    y = met.select("h", *[F.col(c).alias(f"{c}_y") for c in ("rep", "root", "size", "left")], F.col("other").alias("p"), F.col("own").alias("q"))
    both = percent * (F.col("size_x") + F.col("size_y"))
    pairs = x.join(y, ["h", "p", "q"]).filter(
        (F.col("rep_x") < F.col("rep_y")) & (F.col("root_x") != F.col("root_y"))
        & (F.col("left_x") * (100 + percent) >= both) & (F.col("left_y") * (100 + percent) >= both)
    )
    return pairs.select(F.col("rep_x").alias("a"), F.col("rep_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, k1, k2, component_id and kept of every document."""
    all_figures = materialise(figures(docs, k), "sketches")
    linkable = all_figures.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    named = materialise(linkable.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    # The smallest id of each class stands for it. Repeated rows of that id only repeat its bands.
    members = linkable.join(named, ["k1", "k2"])
    classes = materialise(
        members.filter("doc_id = rep").select("rep", "n_shingles", "sketch", "bands", "k1", "k2")
        .dropDuplicates(["rep", "k1", "k2"]), "reps"
    )
    banded = classes.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    leaders = materialise(
        banded.groupBy("bucket").agg(F.min("rep").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n"),
        "leaders",
    )
    led = banded.join(leaders, "bucket").select("a", F.col("rep").alias("b"), "n_shingles")
    met = materialise(led.filter("a < b").select("a", "b").distinct(), "led")
    # Whoever shares a bucket is in these pairs, so their texts serve the later steps as well.
    ids = met.select(F.col("a").alias("doc_id")).union(met.select("b")).distinct()
    # Always a shuffled join: the ids grow with the documents.
    texts = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")
    texts = materialise(texts, "texts")
    linked = links(likely(met, classes, percent), texts, k, percent)
    roots = components(linked)

    for number in range(ROUNDS):
        members = open_members(classes, roots, leaders)
        # A member of the bucket's largest component, another one in every bucket and round.
        inner = members.filter("root = largest").groupBy("bucket").agg(
            F.min_by("rep", F.xxhash64("rep", "bucket", F.lit(number))).alias("partner")
        )
        outer = members.filter("root <> largest").join(inner, "bucket")
        tried = outer.select(F.least("rep", "partner").alias("a"), F.greatest("rep", "partner").alias("b"))
        tried = materialise(tried.distinct().join(met, ["a", "b"], "left_anti"), "tried")
        found = links(likely(tried, classes, percent), texts, k, percent)
        both = materialise(linked.union(found), "links"), materialise(met.union(tried), "met")
        release(linked, met, found, tried, members, roots)
        linked, met = both
        roots = components(linked)

    members = open_members(classes, roots, leaders)
    nodes = members.select("rep", "root").distinct()
    sets = materialise(open_sets(texts.join(nodes, F.col("doc_id") == F.col("rep")), k), "open-sets")
    fresh = materialise(meeting(sets, percent).join(met, ["a", "b"], "left_anti"), "crossing")
    more = links(likely(fresh, classes, percent), texts, k, percent)
    if not more.isEmpty():
        release(roots)
        roots = components(linked.union(more))
    release(classes, leaders, met, texts, members, sets, fresh, linked, more)

    with_class = all_figures.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    empty = F.col("n_shingles").eqNullSafe(0) | F.col("doc_id").isNull()
    with_class = with_class.withColumn("rep", F.when(empty, F.col("doc_id")).otherwise(F.col("rep")))
    result = with_class.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    return result.select(
        "doc_id", "n_shingles", "k1", "k2", F.coalesce("root", "rep").alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all columns; texts without words stay."""
    found = near_duplicates(docs, k, percent).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct("*").alias("doc"))
    met = rows.join(found, F.col("doc.doc_id").eqNullSafe(F.col("kept_id")))
    # Repeated rows of a kept id are copies of each other unless their texts differ.
    keyed = met.select("doc", "kept_id", F.md5(F.coalesce("doc.text", F.lit(""))).alias("text_key"))
    return keyed.dropDuplicates(["kept_id", "text_key"]).select("doc.*")
