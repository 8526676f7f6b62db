"""Pairs of words that a bitmap lets through."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faultweave.llm import common, decontamination

SPACED = st.text(st.sampled_from("aAbÉé.\x1c\x85\xa0　 \t\n\v\f\r"), max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(SPACED, min_size=1, max_size=6), st.integers(1, 1 << 20), st.sampled_from([1, 2, 3, 1 << 14]))
def test_known_pairs_are_the_pairs_let_through(texts, seed, block):
    texts = [t.encode() for t in texts]
    bits = np.random.default_rng(seed).integers(0, 256, 1 << 24, np.uint8)
    of, pairs = decontamination.pairs_of([common.words_folded(t) for t in texts])
    hit = decontamination._known(bits, pairs)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontamination, "BLOCK_WORDS", block)
        found_of, found, place = decontamination.known_pairs(texts, bits)
    assert Counter(zip(of[hit].tolist(), pairs[hit].tolist())) == Counter(zip(found_of.tolist(), found.tolist()))
    for i, p, pair in zip(found_of.tolist(), place.tolist(), found.tolist()):
        words = common.words_folded(texts[i])[p : p + 3]
        assert pair in decontamination.pairs_of([words])[1].tolist() and len(words) > 1


def test_words_of_documents_are_hashed_once_per_slice(monkeypatch):
    asked = Counter()

    class Hashes(common.WordHashes):
        def __getitem__(self, word):
            asked[word] += 1
            return super().__getitem__(word)

    monkeypatch.setattr(common, "_hashes", Hashes(100))
    bits = np.full(1 << 24, 255, np.uint8)
    of, _, _ = decontamination.known_pairs([b"One two. one TWO one", b"", b"two"], bits)
    assert dict(asked) == {b"one": 1, b"two": 1} and of.tolist().count(0) == 7 and len(of) == 7
