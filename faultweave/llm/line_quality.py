"""Quality rules over a text, and cross-document line frequency. DataFrame functions only.

Lines are normalised (A-Z lower-cased, white space runs to one space, ends cut) and
hashed. A line that stands in more than `max_docs` distinct documents of a host counts as
removed; a document that keeps less than `keep_percent` of its words is depleted and
rejected. A host is a source. The limit is a number, so that a line's fate doesn't depend on
how large its host is.

Texts are read once: the figures of each document and its distinct lines, as hashes with
word counts, are written to the shared folder. Documents per line are partial counts, so
a line that stands everywhere costs a row per task. Frequent lines are written as well, so
that Spark knows their size when it joins them; beyond its broadcast limit the join is a
plain equi-join with a unique side, whose hot keys adaptive execution splits.

Defined results: a null or empty text has no words and fails the base rule; the null
source is a host; rows of one id are one document of the line counts and each give a row,
rows without an id are a document each; an empty table gives no rows; further columns are
ignored. Lines and word windows are compared by 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultweave.llm.common import SPACES, text_of
from faultweave.sources.workspace import materialise

MAX_DOCS = 10
KEEP_PERCENT = 30
MIN_WORDS = 50
REPEAT_PERCENT = 50

# What counts as a symbol, and as white space.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice among `words`."""

    def windows(ws: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ws) - 3),
            lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)),
        )

    def covered(hashes: Column) -> Column:
        # Sorting brings equal windows together; their places, sorted, cover 3 words each.
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda rows: let(places(rows), lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(3)), F.lit(3))),
            F.lit(0).cast("long"), lambda total, n: total + n,
        )))

    def places(rows: Column) -> Column:
        twice = F.filter(
            rows,
            lambda r, k: F.coalesce(
                (r["h"] == F.get(rows, k - 1)["h"]) | (r["h"] == F.get(rows, k + 1)["h"]),
                r["h"] == F.coalesce(F.get(rows, k - 1)["h"], F.get(rows, k + 1)["h"]),
                F.lit(False),
            ),
        )
        return F.sort_array(F.transform(twice, lambda r: r["i"]))

    found = let(windows(words), lambda hashes: F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes)
    ))
    return F.coalesce(F.when(F.size(words) >= 3, found), F.lit(0).cast("long"))


def _distinct_lines(lines: Column) -> Column:
    """(h, n) of lines sorted by hash to distinct (h, n), n the words of all equal lines."""

    def merge(rows: Column) -> Column:
        firsts = F.filter(
            F.sequence(F.lit(0), F.size(rows) - 1),
            lambda i: (i == 0) | (F.get(rows, i)["h"] != F.get(rows, F.greatest(i - 1, F.lit(0)))["h"]),
        )
        return let(firsts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(rows, i)["h"].alias("h"),
            (F.get(rows, i)["n"] * (F.coalesce(F.get(at, k + 1), F.size(rows)) - i)).cast("long").alias("n"),
        )))

    empty = F.array().cast("array<struct<h:bigint,n:bigint>>")
    return let(lines, lambda ls: F.when(F.size(ls) > 0, let(F.sort_array(ls), merge)).otherwise(empty))


def figures(docs: DataFrame) -> DataFrame:
    """row, doc_id, source, the base figures, and the distinct lines of each document."""
    text = text_of()
    raw = F.split(text, "\n")
    spoken = F.filter(raw, lambda line: F.translate(line, BLANKS, "") != "")
    lowered = F.translate(text, UPPER, UPPER.lower())
    line_words = F.transform(
        F.split(lowered, "\n"), lambda line: F.filter(F.split(line, SPACES), lambda w: w != "")
    )
    lines = F.transform(
        F.filter(line_words, lambda ws: F.size(ws) > 0),
        lambda ws: F.struct(F.xxhash64(F.array_join(ws, " ")).alias("h"), F.size(ws).alias("n")),
    )
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "source",
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(spoken, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        let(words, lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"), repeated_words(ws).alias("n_repeat_words")
        )).alias("w"),
        _distinct_lines(lines).alias("lines"),
    ).select("*", "w.n_words", "w.n_repeat_words").drop("w")


def frequent_lines(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(source, h) of lines in more than `max_docs` documents. `lines`: source, h, doc_id and row."""
    # Of rows without an id each is a document.
    lone = F.when(F.col("doc_id").isNull(), F.col("row"))
    once = lines.groupBy("source", "h", "doc_id", lone.alias("lone")).agg(F.lit(1).alias("one"))
    return once.groupBy("source", "h").agg(F.count("*").alias("n")).filter(F.col("n") > max_docs).select("source", "h")


def quality(
    docs: DataFrame,
    max_docs: int = MAX_DOCS,
    keep_percent: float = KEEP_PERCENT,
) -> DataFrame:
    """Per document: the base figures, base_failed, n_removed_words and kept."""
    base = materialise(figures(docs), "line-quality")
    lines = base.select("row", "doc_id", "source", F.explode("lines").alias("line"))
    lines = lines.select("row", "doc_id", "source", "line.h", "line.n")
    frequent = materialise(frequent_lines(lines, max_docs), "frequent-lines")
    frequent = frequent.select(F.col("source").alias("_host"), F.col("h").alias("_h"))
    hit = lines.join(frequent, (F.col("h") == F.col("_h")) & F.col("source").eqNullSafe(F.col("_host")))
    removed = hit.groupBy("row").agg(F.sum("n").alias("removed"))
    joined = base.drop("lines").join(removed, "row", "left")
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < MIN_WORDS) | (repeats * 100 > n * REPEAT_PERCENT)
    lost = F.coalesce("removed", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        lost.alias("n_removed_words"),
        (~failed & ((n - lost) * 100 >= n * keep_percent)).alias("kept"),
    )
