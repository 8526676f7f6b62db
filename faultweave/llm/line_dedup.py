"""Removal of lines that many sites share.

A site is a source. Lines are normalised (A-Z lower-cased, white space runs to one space,
ends cut) and hashed. Lines in fewer documents than `min_sites` can't reach it and go no
further. For the others a HyperLogLog sketch of the sites is built per line hash; sketches
merge map-side, so a line that stands everywhere costs a sketch per task. Estimates beyond
`margin` of the threshold decide; the lines between get exact distinct counts. Lines at or
above the threshold are removed from every text.

The margin is six standard errors of the sketch, so the outcome is that of exact counts.

Each text meets the list of its own lines to remove over the hash of the text. Equal texts
share a list, and every hash in any list is a line to remove, so a clash of hashes changes
nothing.

Defined results: a null or empty text has no lines and becomes the empty text; lines without
words are neither counted nor removed; documents without a source count for no site, but
lose the lines that others make boilerplate; repeated rows give a row each; an empty table
gives no rows; further columns are ignored by `boilerplate` and kept by `remove`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultweave.llm.common import text_of
from faultweave.sources.workspace import materialise

MIN_SITES = 10
LOG_REGISTERS = 12
# Six times 1.04 / sqrt(2^12).
MARGIN = 0.1


# Letters that are lower-cased, and white space inside lines.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = "\t\x0b\x0c\r"


def _folded(line: Column) -> Column:
    return F.translate(line, UPPER + BLANKS, UPPER.lower() + " " * len(BLANKS))


def _hash(folded: Column) -> Column:
    """Hash of the normalised line; NULL for a line without words."""
    runs = F.when(F.contains(folded, F.lit("  ")), F.regexp_replace(folded, " +", " ")).otherwise(folded)
    words = F.trim(runs)
    return F.when(words != "", F.xxhash64(words))


def lines(docs: DataFrame) -> DataFrame:
    """text_key, source, h: a row per document and distinct line."""
    folded = F.transform(F.split(text_of(), "\n"), _folded)
    hashes = F.array_distinct(F.array_compact(F.transform(folded, _hash)))
    return docs.select(F.xxhash64(text_of()).alias("text_key"), "source", F.explode(hashes).alias("h"))


def boilerplate(
    rows: DataFrame, min_sites: int = MIN_SITES, log_registers: int = LOG_REGISTERS, margin: float = MARGIN
) -> DataFrame:
    """h of the lines with at least `min_sites` distinct sources, from the rows of `lines`."""
    sited = rows.filter("source IS NOT NULL").select("source", "h")
    often = materialise(
        sited.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites).select("h"), "often"
    )
    sketched = sited.join(often, "h").groupBy("h").agg(F.hll_sketch_agg("source", log_registers).alias("sketch"))
    spread = materialise(sketched.select("h", F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    near = F.col("sites").between(min_sites * (1 - margin) - 1, min_sites * (1 + margin) + 1)
    close = spread.filter(near).select("h")
    exact = sited.join(close, "h").groupBy("h", "source").agg(F.lit(1)).groupBy("h").agg(F.count("*").alias("sites"))
    return (
        spread.filter(~near & (F.col("sites") >= min_sites)).select("h")
        .union(exact.filter(F.col("sites") >= min_sites).select("h"))
    )


def remove(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The documents with boilerplate lines cut from `text`, and n_lines and n_removed added.

    Both count lines with words.
    """
    columns = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    rows = materialise(lines(docs), "lines")
    cut = materialise(boilerplate(rows, min_sites), "boilerplate")
    lists = rows.join(cut, "h").select("text_key", "h").distinct().groupBy("text_key").agg(F.collect_list("h").alias("_cut"))
    # Always joined by a shuffle: the lists grow with the documents, so what is moved should too.
    lists = materialise(lists, "cut-lists").withColumnRenamed("text_key", "_key").hint("merge")
    # The further columns travel as one, whatever their names.
    keyed = docs.select(F.struct(*columns).alias("doc"), text_of().alias("_text"))
    met = keyed.join(lists, F.xxhash64("_text") == F.col("_key"), "left")
    stays = lambda line: ~F.coalesce(F.array_contains("_cut", _hash(_folded(line))), F.lit(False))
    spoken = lambda c: F.size(F.filter(c, lambda line: F.trim(_folded(line)) != "")).cast("long")
    split = met.withColumn("_lines", F.split("_text", "\n"))
    # Most documents have nothing to remove; only the others are taken apart.
    kept = split.withColumn("_kept", F.when(F.col("_cut").isNotNull(), F.filter("_lines", stays)))
    return kept.select(
        "doc.*",
        F.coalesce(F.array_join("_kept", "\n"), "_text").alias("text"),
        spoken("_lines").alias("n_lines"),
        F.when(F.col("_cut").isNull(), F.lit(0).cast("long"))
        .otherwise(spoken("_lines") - spoken("_kept"))
        .alias("n_removed"),
    )
