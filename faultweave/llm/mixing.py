"""Mixing sources to target weights with a low-discrepancy schedule. DataFrame functions only.

1. `source_targets`: the words each source gives, by water-filling.
2. `document_stream`: each source's documents in a fixed shuffled order, laid end to end.
   The running length never needs a whole source in one task: documents are dealt into
   cells by the leading digits of their shuffle key, cells are summed before the shuffle,
   and only the sums are accumulated over a source.
3. `schedule`: slots of `block_words` words. Slot t has the point t * g mod N, g being a
   whole number next to N / golden ratio without a common divisor with N: the golden-ratio
   sequence rounded to N points. It meets every point once, so cutting the
   points by cumulative quotas gives each source exactly its quota of slots, evenly
   interleaved. Each source lists its own points and finds their slots with the inverse of
   g, which needs no join; ranks per source come from counts per stretch of slots.
4. `mix`: slots joined with the blocks of the streams. Turn r of a source takes block r
   modulo the source's blocks; the last turn of a source is cut to the target.

Targets are at most twice a source's words, so no document is taken more than twice.

Defined results: null or empty texts have size 0 and are never taken; the null source is a
source like any other, last in order; repeated rows are separate documents, adjacent in
the stream; further columns are ignored; an empty table gives no rows. A source whose
target rounds to no word gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.llm.common import text_of, words_of
from faultweave.sources.workspace import materialise

BLOCK_WORDS = 256
WEIGHTS = (5, 2, 1)
# Percent of all words that the mix takes, and how often it takes a word at most.
SHARE = 150
REPEATS = 2
# Rows per cell of the streams, slots per stretch of the schedule.
CELL_ROWS = 2_000
STRETCH = 1 << 16


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.size(words_of(text_of())).cast("long").alias("size"))


def source_targets(sized: DataFrame) -> DataFrame:
    """source, rank, n_docs, source_size, target: one row per source.

    Where the level of the water lies is found by sorting sources by (limit / weight): a
    source is at its limit exactly if those up to it, at their limits, leave a level above
    its own. One row per source; the unpartitioned windows see nothing else.
    """
    totals = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = totals.select(
        "*",
        (F.row_number().over(by_name) - 1).alias("rank"),
        F.sum("source_size").over(everything).alias("all"),
    ).withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    upto = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # In hundredths of words, so that all sums are whole numbers.
    wide = "decimal(38,0)"
    levels = ranked.withColumns(
        {
            "n": F.count("*").over(upto),
            "left": F.col("all") * SHARE - F.sum("source_size").over(upto) * 100 * REPEATS,
            "open": F.sum("weight").over(everything) - F.sum("weight").over(upto),
        }
    ).withColumn(
        "full",
        (F.col("left") * F.col("weight")).cast(wide)
        >= (F.col("source_size") * 100 * REPEATS).cast("decimal(19,0)") * F.col("open").cast("decimal(18,0)"),
    )
    # Full sources come first in the order, so the level is what the last full one leaves.
    last = F.max(F.when(F.col("full"), F.struct("n", "left", "open"))).over(everything)
    level = levels.withColumn("last", last).withColumns(
        {
            "left": F.coalesce(F.col("last.left"), F.col("all") * SHARE),
            "open": F.coalesce(F.col("last.open"), F.sum("weight").over(everything)),
        }
    )
    target = F.when(F.col("full"), (F.col("source_size") * REPEATS).cast("double")).otherwise(
        (F.col("weight") * F.col("left")).cast("double") / (F.col("open") * 100).cast("double")
    )
    return level.select("source", "rank", "n_docs", "source_size", target.alias("target"))


def _running(df: DataFrame, group: list[str], cell: str, order: list[Column | str], sums: dict[str, str]) -> DataFrame:
    """Adds running sums of columns, the current row left out, over `group` by cell and order.

    `cell` must not fall with the order. Cells are summed first, the sums accumulated, and
    rows accumulated within their cells only.
    """
    per_cell = df.groupBy(*group, cell).agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    ahead = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    bases = per_cell.select(
        *[F.col(c).alias(f"_{c}") for c in (*group, cell)],
        *[F.coalesce(F.sum(f"_{name}").over(ahead), F.lit(0)).alias(f"_{name}") for name in sums],
    )
    inside = Window.partitionBy(*group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(name) for name, c in sums.items()])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*group, cell)]
    joined = local.join(bases, same)
    return joined.select(*df.columns, *[(F.col(name) + F.col(f"_{name}")).alias(name) for name in sums])


def document_stream(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds rank, source_size, target, place and start to the documents: where each one lies
    in its source's stream. The order is by md5 of the id, the id and the size."""
    names = targets.select(F.col("source").alias("_source"), "rank", "n_docs", "source_size", "target")
    with_source = sized.join(names, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # 32 leading bits of the key, cut into as many equal cells as the source needs.
    cells = F.ceil(F.col("n_docs") / CELL_ROWS)
    leading = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    placed = with_source.withColumns(
        {"key": key, "one": F.lit(1), "cell": F.floor(leading * cells / F.lit(1 << 32))}
    )
    stream = _running(placed, ["rank"], "cell", ["key", "doc_id", "size"], {"place": "one", "start": "size"})
    return stream.drop("key", "one", "cell", "n_docs")


def quotas(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per source that gives words: rank, blocks of its stream, turns and what the last takes.

    An epoch is one run through all blocks. low and high bound the source's points.
    """
    words = F.floor(F.col("target") + 0.5).cast("long")
    rows = targets.select("rank", "source_size", words.alias("words")).filter("words > 0")
    rest = F.col("words") % F.col("source_size")
    blocks = F.ceil(F.col("source_size") / block_words)
    rest_turns = F.ceil(rest / block_words)
    turns = F.floor(F.col("words") / F.col("source_size")) * blocks + rest_turns
    # NULL if whole epochs suffice: then every turn takes its whole block.
    cut = F.when(rest > 0, rest - (rest_turns - 1) * block_words)
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("rank", blocks.alias("blocks"), turns.alias("turns"), cut.alias("cut")).select(
        "*", F.sum("turns").over(upto).alias("high"), (F.sum("turns").over(upto) - F.col("turns")).alias("low")
    )


def _quotients(a: int, b: int) -> int:
    """Largest partial quotient of a / b, the measure of how unevenly its multiples lie."""
    largest = 0
    while a:
        largest = max(largest, b // a)
        a, b = b % a, a
    return largest


def _step(n: int) -> int:
    """A step near n / golden ratio without a common divisor with n, whose multiples lie evenly.

    Rounding spoils the golden ratio's last partial quotients; among the whole numbers around
    it the one with the smallest quotients is taken, the nearest of equals.
    """
    near = round(n * (math.sqrt(5) - 1) / 2)
    around = [s for s in range(max(1, near - 200), min(n, near + 200) + 1) if math.gcd(s, n) == 1]
    return min(around, key=lambda s: (_quotients(s, n), abs(s - near)), default=1)


def schedule(quota: DataFrame) -> DataFrame:
    """slot, rank, block and words: which block stands in which slot, and how much of it.

    Reads one number, the count of slots, to fix the step. `words` is NULL for a whole block.
    """
    n = quota.agg(F.max("high")).first()[0] or 1
    back = pow(_step(n), -1, n) if n > 1 else 0
    # Every source's points, first as stretches dealt evenly, so that none lists a large share alone.
    stretches = quota.withColumn(
        "from", F.explode(F.sequence("low", F.col("high") - 1, F.lit(STRETCH)))
    ).repartition("rank", "from")
    points = stretches.select(
        "rank", "blocks", "turns", "cut",
        F.explode(F.sequence("from", F.least(F.col("from") + STRETCH, F.col("high")) - 1)).alias("point"),
    )
    # Whole numbers of up to 38 digits: the product may exceed 64 bits.
    slot = (F.col("point").cast("decimal(19,0)") * F.lit(back).cast("decimal(18,0)")) % F.lit(n).cast("decimal(18,0)")
    slots = points.withColumns({"slot": slot.cast("long"), "one": F.lit(1)})
    slots = slots.withColumn("cell", F.floor(F.col("slot") / STRETCH))
    ranked = _running(slots, ["rank"], "cell", ["slot"], {"turn": "one"})
    return ranked.select(
        "slot", "rank",
        (F.col("turn") % F.col("blocks")).alias("block"),
        F.when(F.col("turn") == F.col("turns") - 1, F.col("cut")).alias("words"),
    )


def pieces(stream: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document and block it touches; begin and end count words inside the block."""
    end = F.col("start") + F.col("size")
    touched = F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))
    cut = stream.filter("size > 0").withColumn("block", F.explode(touched))
    first = F.col("block") * block_words
    return cut.withColumns(
        {
            "begin": F.greatest(F.col("start") - first, F.lit(0)),
            "end": F.least(end - first, F.lit(block_words)),
        }
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The mix: (slot, rank, place, doc_id, begin, end), words begin to end of the document
    standing in a slot; and the documents with their place in the streams.

    Sizes are written to the shared folder first, so texts are read once.
    """
    sized = materialise(sizes(docs), "sizes")
    targets = source_targets(sized)
    stream = document_stream(sized, targets)
    slots = schedule(quotas(targets, block_words))
    parts = pieces(stream, block_words).select("rank", "block", "place", "doc_id", "start", "begin", "end")
    met = slots.join(parts, ["rank", "block"])
    upto = F.coalesce(F.least("end", "words"), F.col("end"))
    offset = F.col("block") * block_words - F.col("start")
    mixed = met.filter(upto > F.col("begin")).select(
        "slot", "rank", "place", "doc_id", (F.col("begin") + offset).alias("begin"), (upto + offset).alias("end")
    )
    return mixed, stream


def taken(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken: words of each document in the mix."""
    mixed, stream = mix(docs, block_words)
    counts = mixed.groupBy("rank", "place").agg(F.sum(F.col("end") - F.col("begin")).alias("taken"))
    return stream.join(counts, ["rank", "place"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Whole documents as often as the mix takes their words, rounded half up: 0, 1 or 2 times."""
    counts = taken(docs, block_words).filter("size > 0").groupBy("doc_id", "source", "size").agg(
        # Repeated rows share their turns evenly.
        F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("times")
    )
    sized = docs.select(F.struct("*").alias("doc"), F.size(words_of(text_of())).cast("long").alias("words"))
    met = sized.join(
        counts,
        F.col("doc.doc_id").eqNullSafe(F.col("doc_id"))
        & F.col("doc.source").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size")),
    )
    return met.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("doc.*")
