"""Every operator on odd rows and on an empty table."""

from __future__ import annotations

import plain
import pytest
from pyspark.sql import functions as F

from faultweave.llm import (
    decontamination, line_dedup, line_quality, lm_score, mixing, near_dedup, pii, token_counts, token_store, toxicity,
)
from faultweave.llm.common import BYTE_BPE, WORD_BPE, vocabulary
from faultweave.sources.workspace import new_path

ROWS = 13


def _labels(spark, rows=((1, 0, 0), (2, 1, 1), (-5, 0, 1), (None, 1, 1), (4, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def _items(spark):
    rows = [(1, "one"), (2, None), (None, "one two three"), (3, "ba ro ti len sa"), (3, "ba ro ti len sa")]
    return spark.createDataFrame(rows, "item_id long, text string")


def _store(docs):
    spark = docs.sparkSession
    path = new_path(spark, "store")
    token_store.write_store(docs, vocabulary(WORD_BPE), path)
    return token_store.read_documents(spark, path)


OPERATORS = {
    "near_duplicates": lambda d: near_dedup.near_duplicates(d, k=2),
    "line_dedup": line_dedup.remove,
    "token_counts": lambda d: token_counts.token_counts(d, vocabulary(BYTE_BPE)),
    "lm_scores": lm_score.lm_scores,
    "toxicity": lambda d: toxicity.score(d, toxicity.train(d, _labels(d.sparkSession))),
    "line_quality": line_quality.quality,
    "mixing": mixing.taken,
    "pii": lambda d: pii.find(d, pii.train(d)),
    "token_store": _store,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_give_a_row_each(edge_docs, name):
    rows = OPERATORS[name](edge_docs).collect()
    assert len(rows) == ROWS
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted(
        (i is None, i or 0) for (i,) in edge_docs.select("doc_id").collect()
    )


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(no_docs, name):
    assert OPERATORS[name](no_docs).count() == 0


def test_near_duplicates_of_odd_rows(edge_docs):
    rows = plain.grouped(near_dedup.near_duplicates(edge_docs, k=2).collect(), "doc_id")
    assert [r["component_id"] for r in rows[1] + rows[2]] == [1, 1]
    assert [r["kept"] for r in rows[1] + rows[2]] == [True, False]
    assert [(r["component_id"], r["kept"]) for r in rows[3]] == [(3, True)] * 2
    assert [(rows[i][0]["n_shingles"], rows[i][0]["component_id"]) for i in (4, 5, 6)] == [(0, 4), (0, 5), (0, 6)]
    assert rows[8][0]["n_shingles"] == 1
    assert {r["component_id"] for r in rows[None]} == {None}


def test_one_of_each_group_stays(edge_docs):
    kept = [r["doc_id"] for r in near_dedup.keep_one(edge_docs).collect()]
    assert sorted(i for i in kept if i is not None) == [-5, 1, 3, 4, 5, 6, 7, 8, 9]
    assert kept.count(None) == 2
    assert near_dedup.keep_one(edge_docs).columns == edge_docs.columns


def test_filters_keep_the_columns(spark, edge_docs):
    for kept in (
        toxicity.remove_toxic(edge_docs, _labels(spark)),
        decontamination.remove_contaminated(edge_docs, _items(spark)),
        mixing.mix_documents(edge_docs),
    ):
        assert kept.columns == edge_docs.columns
        kept.collect()


def test_contamination_of_odd_rows(spark, edge_docs, no_docs):
    items = _items(spark)
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contamination(edge_docs, items).collect()}
    assert all(item is not None for _, item in found)
    assert decontamination.contamination(no_docs, items).count() == 0
    assert decontamination.contamination(edge_docs, items.limit(0)).count() == 0


def test_no_label_gives_no_toxic_row(spark, edge_docs):
    model = toxicity.train(edge_docs, _labels(spark, [(1, 0, 0)]))
    rows = toxicity.score(edge_docs, model).collect()
    assert all(r["predicted"] == 0 and r["score"] < 1e-9 for r in rows)


def test_line_dedup_keeps_further_columns(edge_docs):
    out = line_dedup.remove(edge_docs)
    assert set(edge_docs.columns) <= set(out.columns)
    rows = plain.grouped(out.collect(), "doc_id")
    assert rows[9][0]["n_lines"] == 3 and rows[4][0]["text"] == ""


def test_quality_of_odd_rows(edge_docs):
    rows = plain.grouped(line_quality.quality(edge_docs).collect(), "doc_id")
    nine = rows[9][0]
    assert (nine["n_words"], nine["word_chars"], nine["n_dup_lines"], nine["n_repeat_words"]) == (6, 18, 2, 6)
    assert rows[4][0]["base_failed"] and not rows[4][0]["kept"]
    assert rows[7][0]["n_words"] == 60_000


def test_token_rows(edge_docs):
    rows = plain.grouped(_store(edge_docs.filter(F.col("doc_id").isNotNull())).collect(), "doc_id")
    assert rows[4][0]["n_tokens"] == 1 and rows[4][0]["ids_crc32"] == plain.crc_of([1])
    ordered = sorted((r["start"], r["doc_id"], r["n_tokens"]) for g in rows.values() for r in g)
    assert [d for _, d, _ in ordered] == sorted(d for _, d, _ in ordered)
    assert all(a[0] + a[2] == b[0] for a, b in zip(ordered, ordered[1:]))
