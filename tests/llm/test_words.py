"""Words of many texts at once, without an object per word."""

from __future__ import annotations

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from faultweave.llm import common, lm_score, token_store, wavelet

SPACED = st.text(st.sampled_from("aAbÉé.\x1c\x85\xa0　 \t\n\v\f\r"), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(SPACED, max_size=6))
def test_words_are_those_of_split(texts):
    texts = [t.encode() for t in texts]
    for fold, split in ((bytes.lower, [t.lower().split() for t in texts]), (common.folded, [common.words_folded(t) for t in texts])):
        words, index, counts = common.distinct_words(texts, fold)
        assert counts.tolist() == [len(ws) for ws in split]
        assert [common.objects(words)[i] for i in index] == [w for ws in split for w in ws]
        assert len(set(common.objects(words))) == len(words)


class Asked(dict):
    """Counts what it is asked for."""

    asked = 0

    def get(self, key, default=None):
        type(self).asked += 1
        return super().get(key, default)


def test_known_words_are_looked_up_once_each():
    words = [lm_score.END, *(b"w%d" % i for i in range(20))]
    vocab = lm_score.Vocabulary(words, np.arange(21, 0, -1), 231, 21, 0.5)
    vocab.codes = Asked({w: i for i, w in enumerate(words)})
    texts = [b" ".join(b"W%d" % (i * j % 25) for i in range(400)) for j in (1, 3)] + [b"", b" \n"]
    codes, lengths, _ = lm_score._tokens(vocab, texts)
    plain = [dict.get(vocab.codes, w, 21) for t in texts for w in [*t.lower().split(), lm_score.END]]
    assert codes.tolist() == plain and lengths.tolist() == [401, 401, 1, 1]
    assert Asked.asked <= 26


def test_rare_words_of_each_text():
    vocab = lm_score.Vocabulary([lm_score.END, b"a"], np.array([4, 9]), 13, 2, 0.5)
    texts = [b"x a X y", b"", b"a a", b"y y z \n"]
    codes, lengths, found = lm_score._tokens(vocab, texts)
    rare = lm_score._rare_words(codes, lengths, *found, vocab.leaves - 1).to_pylist()
    want = [Counter(w for w in t.lower().split() if w != b"a") for t in texts]
    assert [{r["word"]: r["n"] for r in row} for row in rare] == want
    assert [len(row) for row in rare] == [2, 0, 0, 2]
    no_texts = lm_score._tokens(vocab, [b""])
    assert lm_score._rare_words(no_texts[0], no_texts[1], *no_texts[2], 2).to_pylist() == [[]]


MIXED = st.lists(
    st.sampled_from([" ", "\n", "a", "B", "é", "ÀB", "'s", "1", "漢", "İ", "<|endoftext|>", "<|x", "ab,c", "Ab"]), max_size=8
).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=6))
def test_texts_encoded_together_equal_the_library(texts):
    ids = token_store._ids(common.vocabulary(common.WORD_BPE))
    want = [ids.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    flat, lengths = ids.encode_all([t.encode() for t in texts], 1)
    assert lengths.tolist() == list(map(len, want)) and flat.tolist() == [i for one in want for i in one]


def test_words_are_encoded_once_per_slice():
    path, asked = common.vocabulary(common.WORD_BPE), Counter()

    class Ids(token_store.WordIds):
        def __getitem__(self, word):
            asked[word] += 1
            return super().__getitem__(word)

    ids = Ids(token_store._ids(path).tokenizer)
    flat, lengths = ids.encode_all([b"one two One two", b"", b"two\nthree"], 1)
    assert max(asked.values()) == 1 and len(asked) == 3
    assert lengths.sum() == len(flat) and (flat == 1).sum() == 3


def test_letters_are_encoded_once_whatever_stands_around_them():
    path, asked = common.vocabulary(common.WORD_BPE), Counter()

    class Ids(token_store.WordIds):
        def compute(self, word):
            asked[word] += 1
            return super().compute(word)

    ids = Ids(token_store._ids(path).tokenizer)
    texts = ["thon, (thon) thon.", "\"thon\" \u00e9t\u00e9, \u00e9t\u00e9"]
    flat, lengths = ids.encode_all([t.encode() for t in texts], 1)
    want = [ids.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert flat.tolist() == sum(want, []) and lengths.tolist() == list(map(len, want))
    assert asked[b"thon"] == asked["\u00e9t\u00e9".encode()] == 1
    assert not any(b"thon" in w and w != b"thon" for w in asked)


# Characters at the borders of what may be parted, and some that compose or change with case.
BORDERS = [*"aZ09.,'<>|_~ \n\x00\x1c\x7f", *map(chr, (
    0x85, 0xA0, 0xAA, 0xB2, 0xB5, 0xBF, 0xC0, 0xD7, 0xDF, 0xF7, 0x130, 0x131, 0x149, 0x17F, 0x1BB, 0x1F0, 0x23A, 0x24F,
    0x250, 0x301, 0x307, 0x338, 0x3A3, 0x1E9E, 0x200D, 0x2019, 0x212A, 0x1112, 0xD55C, 0x6F22, 0x1F600,
))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BORDERS), max_size=10).map("".join), min_size=1, max_size=4))
def test_parted_words_equal_the_library(texts):
    ids = token_store._ids(common.vocabulary(common.WORD_BPE))
    want = [ids.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    flat, lengths = ids.encode_all([t.encode() for t in texts], 1)
    assert lengths.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])


def test_wavelet_levels_dealt_in_slices():
    drawn = np.random.default_rng(0)
    for n in (0, 1, wavelet.DEALT, wavelet.DEALT + 1, 3 * wavelet.DEALT - 1):
        ids = drawn.integers(0, 1 << 16, n).astype(np.uint16)
        matrix = wavelet.WaveletMatrix(wavelet.build(ids, np.array([n])))
        assert np.array_equal(matrix.ids(), ids)
        assert all(matrix[i] == ids[i] for i in range(0, n, 9973))
