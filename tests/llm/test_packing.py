"""Packing: every id once, sequences without gaps, sources near their targets all along."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from faultweave.llm import packing
from faultweave.llm.common import WORD_BPE, vocabulary

import plain


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary(WORD_BPE))


def ids_of(tokenizer, text: str | None) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def checked(docs, tokenizer, window: int, **options) -> dict[int, list]:
    """Pieces by sequence, after checking that they hold every id of every document once."""
    pieces = packing.pack(docs, vocabulary(WORD_BPE), window=window, **options).collect()
    sequences, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 2 * p["length"] > 0
        sequences[p["sequence_id"]].append(p)
        texts[p["doc_id"], p["source"], p["doc_tokens"]].append(p)
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or at < window and at & (at - 1) == 0
    assert sorted(sequences) == list(range(len(sequences)))
    # Rows of one id and length may be several documents: their pieces hold the same ids as these.
    want = defaultdict(Counter)
    for r in docs.collect():
        ids = ids_of(tokenizer, r["text"])
        want[r["doc_id"], r["source"], len(ids)].update(enumerate(ids))
    got = {
        key: Counter((p["start"] + i, t) for p in found for i, t in enumerate(np.frombuffer(p["ids"], "<u2").tolist()))
        for key, found in texts.items()
    }
    assert got == want
    return sequences


def test_odd_rows(edge_docs, tokenizer):
    for window, windows in ((2048, 512), (64, 3), (32, 1)):
        checked(edge_docs, tokenizer, window, block_windows=windows, atom=16)


def test_no_rows(no_docs):
    assert packing.pack(no_docs, vocabulary(WORD_BPE)).collect() == []


def test_sources_stay_near_their_targets(spark, prose, tokenizer):
    rows = []
    for i in range(240):
        source = "hot" if i % 3 == 0 else f"s{i % 5}"
        rows.append((i, prose(900 if i == 7 else 20 + i % 90, i), "en", source, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    window, atom = 256, 32
    sequences = checked(docs, tokenizer, window, block_windows=4, atom=atom)
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(ids_of(tokenizer, r["text"]))
    total, given, so_far = sum(sizes.values()), Counter(), 0
    # After every window, across all blocks, each source has had its share up to the bound of the docstring.
    for number in sorted(sequences):
        for p in sequences[number]:
            given[p["source"]] += p["length"]
            so_far += p["length"]
        for source, size in sizes.items():
            share = size / total
            assert abs(given[source] - share * so_far) <= atom + 2 * window * share + len(sizes), (number, source)


def test_spans_part_each_queue():
    sizes, block = [1, 7, 1000, 333, 2], 50
    total = sum(sizes)
    lengths = Counter()
    for n in sizes:
        at = 0
        for number, a, b in packing.spans(0, n, n, total, block):
            assert a == at and b > a
            assert n * number * block // total <= a and b <= n * min((number + 1) * block, total) // total
            lengths[number] += b - a
            at = b
        assert at == n
    assert sum(lengths.values()) == total
    assert all(abs(length - block) <= len(sizes) for number, length in lengths.items() if number < total // block)


def test_last_sequences_are_powers_of_two():
    total, window = 2048 * 2 + 1100, 2048
    places = [packing.room(p, total, window)[:2] for p in range(total)]
    sizes = Counter(sequence for sequence, _ in places)
    assert [sizes[i] for i in sorted(sizes)] == [2048, 2048, 1024, 64, 8, 4]


def test_sequences_hold_their_pieces(spark, prose):
    rows = [(i, prose(50, i), "en", "s", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    packed = packing.pack(docs, vocabulary(WORD_BPE), window=64, block_windows=2, atom=16)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for number, found in plain.grouped(packed.collect(), "sequence_id").items():
        assert whole[number]["ids"] == b"".join(p["ids"] for p in sorted(found, key=lambda p: p["offset"]))
        assert whole[number]["n_tokens"] == len(whole[number]["ids"]) // 2
    crcs = {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.with_crc(packed).collect()}
    assert crcs == {
        (p["sequence_id"], p["offset"]): plain.crc_of(np.frombuffer(p["ids"], "<u2").tolist()) for p in packed.collect()
    }
