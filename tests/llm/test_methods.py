"""Operators against plain code, round trips and held-out rows."""

from __future__ import annotations

import dataclasses
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import plain
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from faultweave.llm import (
    common, decontamination, graph, line_dedup, line_quality, lm_score, mixing, near_dedup, pii, token_counts, token_store, toxicity,
)
from faultweave.llm.common import BYTE_BPE, WORD_BPE, vocabulary
from faultweave.llm.wavelet import WaveletMatrix, build
from faultweave.sources.workspace import new_path

DOC = "doc_id long, text string, source string"


def edited(text: str, share: float, rng: random.Random) -> str:
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


# ---- near duplicates -------------------------------------------------------


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_against_all_pairs(spark, prose, k):
    rng = random.Random(k)
    texts = {i: prose(rng.randrange(3, 200), 1000 + i) for i in range(60)}
    base = prose(300, 77)
    for i in range(100, 160):  # edits that straddle the threshold
        texts[i] = edited(base, rng.choice([0.01, 0.03, 0.05, 0.08]), rng)
    passage = prose(90, 78)
    for i in range(200, 240):  # a shared passage makes no near-duplicates by itself
        texts[i] = f"{prose(60, 3000 + i)} {passage}"
    want = plain.components(texts, k)
    docs = spark.createDataFrame([(i, t, "a") for i, t in texts.items()], DOC)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs, k).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(plain.shingles(t, k)) for i, t in texts.items()}


def test_group_around_one_passage_meets_few_candidates(spark, prose, monkeypatch):
    """Seven tenths alike everywhere: no pair is a link but those planted, and hardly any is compared."""
    rng = random.Random(6)
    passage = prose(160, 50)
    texts = {i: f"{prose(34, 9000 + i)} {passage}" for i in range(700)}
    for i in range(700, 730):
        texts[i] = edited(texts[i - 700], 0.01, rng)
    candidates = []
    real = near_dedup.meeting

    def counted(*args):
        candidates.append(real(*args).count())
        return real(*args)

    monkeypatch.setattr(near_dedup, "meeting", counted)
    docs = spark.createDataFrame([(i, t, "a") for i, t in texts.items()], DOC)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, 2).collect()}
    assert got == plain.components(texts, 2) and len(set(got.values())) < 730
    assert len(candidates) == 1 and candidates[0] < 20 * len(texts)


def test_rarest_shingles_lose_no_link(spark):
    """Sets around the threshold, of many sizes: all pairs of different components that are links meet."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 400)
    sets, rows = {}, []
    for i in range(220):
        size = int(rng.integers(20, 300))
        kept = base[rng.permutation(300)[: int(size * rng.uniform(0.7, 1))]]
        sets[i] = set(np.concatenate([kept, rng.integers(0, 1 << 62, int(size * rng.uniform(0, 0.3)))]).tolist())
        if i % 3 and i > 5:  # a variant of an earlier one
            sets[i] = set(list(sets[i - 1 - i % 3])[int(rng.integers(0, 12)) :]) | {int(x) for x in rng.integers(0, 1 << 62, 4)}
        rows.append((i, i // 2, len(sets[i]), i, [int(x) for x in sets[i]]))
    frame = spark.createDataFrame(rows, "rep long, root long, size long, set long, shingles array<long>")
    met = {(r["a"], r["b"]) for r in near_dedup.meeting(frame, 80).collect()}
    links = {
        (a, b) for a in sets for b in sets
        if a < b and a // 2 != b // 2 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    assert links <= met and len(links) > 20


def test_large_group_of_copies(spark, prose):
    rng = random.Random(5)
    base = prose(150, 9)
    rows = [(i, base, "a") for i in range(400)] + [(1000 + i, edited(base, 0.01, rng), "a") for i in range(400)]
    docs = spark.createDataFrame(rows, DOC)
    assert {r["component_id"] for r in near_dedup.near_duplicates(docs, 2).select("component_id").collect()} == {0}


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        common, own = rng.integers(0, 1 << 63, int(2000 * share), np.uint64), int(2000 * (1 - share) / 2)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, own, np.uint64)])) for _ in range(2)]
        rows = near_dedup.sketches(sets)
        sizes = [np.array([float(len(s))]) for s in sets]
        estimate = near_dedup.joint_similarity(rows[:1], rows[1:], *sizes)[0]
        assert abs(estimate - share) < 5 * math.sqrt(share * (1 - share) / near_dedup.REGISTERS)


def test_registers_merge_by_maximum():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 63, 300, np.uint64), rng.integers(0, 1 << 63, 500, np.uint64)
    parts = near_dedup.sketches([a, b, np.concatenate([a, b])])
    assert (np.maximum(parts[0], parts[1]) == parts[2]).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (300, 200)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0}
    assert {got[i] for i in range(100, 150)} == {100}
    assert got[300] == 200 and graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- lines -----------------------------------------------------------------


def test_sites_near_the_threshold_are_counted_exactly(spark):
    rows = [(s * 100 + d, f"line of {n} sites", f"s{s}") for n in range(8, 14) for s in range(n) for d in range(2)]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], DOC)
    found = line_dedup.remove(docs, min_sites=10).filter("n_removed > 0").select("doc_id").collect()
    gone = {rows[r["doc_id"]][1] for r in found}
    assert gone == {f"line of {n} sites" for n in range(10, 14)}


# ---- tokens ----------------------------------------------------------------

PIECES = [
    "a", "b", " ", "  ", "\n", "\t", ".", ",", "'s", "'LL", "é", "1", "２", "\xa0", "\x1c", "\x85", "　",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "İ", "ﬁ", "́", "漢", "\U0001f600", "Z",
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
def test_encodings_equal_the_library(text):
    counts, ids = token_counts._counts(vocabulary(BYTE_BPE)), token_store._ids(vocabulary(WORD_BPE))
    assert counts.count(text) == len(counts.tokenizer.encode(text, add_special_tokens=False).ids)
    whole = ids.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids.encode(text.encode()), "<u2").tolist() == whole


def test_whole_tokens_encode_alone():
    tokenizer = Tokenizer.from_file(vocabulary(BYTE_BPE))
    whole = token_counts.whole_tokens(tokenizer)
    assert len(whole) > 40_000
    assert all(len(tokenizer.model.tokenize(s)) == 1 for s in list(whole)[:2000])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 65535) | st.integers(0, 3), max_size=1300))
def test_wavelet_matrix(ids):
    array = np.array(ids, np.int64)
    matrix = WaveletMatrix(build(array, np.array([len(ids)])))
    assert matrix.ids().tolist() == ids
    for i in range(0, len(ids), 97):
        assert matrix[i] == ids[i]
    for token in {*ids[:3], 2, 65535}:
        places = np.flatnonzero(array == token).tolist()
        assert matrix.count(token) == len(places)
        assert matrix.count(token, len(ids) // 3, len(ids) // 2) == int(
            (array[len(ids) // 3 : len(ids) // 2] == token).sum()
        )
        assert [matrix.find(token, k) for k in range(min(3, len(places)))] == places[:3]


def test_store_round_trip(spark, prose, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_TOKENS", 500)
    texts = {i * 7 - 50: prose(i * 3, i) for i in range(60)}
    docs = spark.createDataFrame([(i, t, "a") for i, t in texts.items()], DOC)
    path = new_path(spark, "store")
    token_store.write_store(docs, vocabulary(WORD_BPE), path)
    tokenizer = Tokenizer.from_file(vocabulary(WORD_BPE))
    start, everything = 0, []
    for row in sorted(token_store.read_documents(spark, path).collect()):
        ids = tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids + [1]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), plain.crc_of(ids))
        start += len(ids)
        everything += ids
    assert token_store.token_at(spark, path, 1234) == everything[1234]
    found = {r["token"]: r["n"] for r in token_store.occurrences(spark, path, [1, 5]).collect()}
    assert found == {1: 60, 5: everything.count(5)}


# ---- language model --------------------------------------------------------


def test_base_scores_and_normalisation(spark, prose):
    texts = {i: prose(40 + i % 50, i, vocabulary=400) for i in range(120)}
    docs = spark.createDataFrame([(i, t, "a") for i, t in texts.items()], DOC)
    rows = {r["doc_id"]: r for r in lm_score.lm_scores(docs).collect()}
    tokens = {i: t.encode().lower().split() + [None] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if plain.fold(i, 5) != 1 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        assert rows[i]["base_score"] == pytest.approx(base)
        assert rows[i]["n_known"] == sum(counts[w] > 0 for w in ws)
        assert (rows[i]["n_tokens"], rows[i]["train_tokens"], rows[i]["held_out"]) == (
            len(ws), total, plain.fold(i, 5) == 1,
        )


@pytest.mark.parametrize("known", [1 << 18, 40])
def test_probabilities_add_up_to_one(spark, prose, monkeypatch, known):
    monkeypatch.setattr(lm_score, "KNOWN", known)
    docs = spark.createDataFrame([(i, prose(200, i), "a") for i in range(30)], DOC)
    counts = lm_score.word_counts(docs)
    vocab = lm_score.vocabulary(counts, 30)
    model = lm_score.train(docs, vocab)
    assert vocab.levels > 1 or known == 40
    for context in lm_score._hash(np.arange(3)), lm_score._hash(np.arange(7, 10)):
        contexts = np.repeat(context[:, None], vocab.leaves, axis=1)
        sums = np.exp(lm_score.log_probabilities(model, np.arange(vocab.leaves), contexts)).sum()
        assert sums == pytest.approx(1, abs=1e-4)
    # Inside the last leaf the rarer words and one unknown word share everything.
    rarer = sum(r["c"] + 0.5 for r in counts.collect() if bytes(r["word"]) not in vocab.words)
    assert vocab.rare_sum == pytest.approx(rarer + 0.5)
    assert (vocab.tokens, vocab.distinct) == (30 * 201, counts.count() + 1)


def test_rows_count_what_follows_their_contexts(spark, prose):
    texts = [prose(120, i, vocabulary=60) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], DOC)
    vocab = lm_score.vocabulary(lm_score.word_counts(docs), 20)
    shared = spark.sparkContext.broadcast(vocab)
    model = lm_score.count_rows(docs, vocab, shared)
    want = Counter()
    for text in texts:
        codes, lengths, _ = lm_score._tokens(vocab, [text.encode()])
        contexts = lm_score.contexts_of(vocab, codes, lengths)
        for level in range(vocab.levels):
            classes, child = lm_score._at(codes, vocab.width, vocab.levels, level)
            for template, rows in enumerate(lm_score._rows(contexts, classes, model.first[level], model.rows[level])):
                want.update((level, template, row, c) for row, c in zip(rows.tolist(), child.tolist()))
    got = {
        (level, *map(int, cell)): int(counts[tuple(cell)])
        for level, counts in enumerate(model.counts) for cell in np.argwhere(counts)
    }
    assert got == want and sum(want.values()) == 20 * 121 * 3 * vocab.levels


def test_slopes_are_those_of_the_likelihood(spark, prose):
    docs = spark.createDataFrame([(i, prose(150, i, vocabulary=80), "a") for i in range(20)], DOC)
    vocab = lm_score.vocabulary(lm_score.word_counts(docs), 20)
    model = lm_score.count_rows(docs, vocab, spark.sparkContext.broadcast(vocab))
    codes, lengths, _ = lm_score._tokens(vocab, [r["text"].encode() for r in docs.collect()])
    contexts = lm_score.contexts_of(vocab, codes, lengths)

    def likelihood(factors) -> float:
        """Each token without its own count."""
        moved, total = dataclasses.replace(model, factors=factors), 0.0
        for level in range(model.levels):
            classes, child = lm_score._at(codes, model.width, model.levels, level)
            rows = lm_score._rows(contexts, classes, model.first[level], model.rows[level])
            logits = lm_score._logits(moved, level, classes, *lm_score.without_own(moved, level, classes, child, rows)).astype(float)
            total += (logits[np.arange(len(codes)), child] - np.log(np.exp(logits).sum(1))).sum()
        return total

    gradient, curvature = lm_score.slopes(model, codes, contexts)
    step = 1e-2
    for level, template, magnitude in np.argwhere(np.abs(gradient).reshape(model.factors.shape) > 20)[:6]:
        up, down = model.factors.copy(), model.factors.copy()
        up[level, template, magnitude] += step
        down[level, template, magnitude] -= step
        at = template * lm_score.MAGNITUDES + magnitude
        high, low, now = likelihood(up), likelihood(down), likelihood(model.factors)
        assert (high - low) / (2 * step) == pytest.approx(gradient[level, at], rel=0.02, abs=0.5)
        bend = curvature[level].reshape(len(gradient[level]), -1)[at, at]
        assert (2 * now - high - low) / step**2 == pytest.approx(bend, rel=0.1, abs=20)


def test_scores_do_not_depend_on_partitions(spark, prose):
    rows = [(i, prose(60 + i, i, vocabulary=300), "a") for i in range(90)]
    scores = []
    for parts in (1, 2, 41):
        docs = spark.createDataFrame(rows, DOC).repartition(parts)
        scores.append({r["doc_id"]: r["score"] for r in lm_score.lm_scores(docs).collect()})
    for other in scores[1:]:
        assert all(other[i] == pytest.approx(s, rel=1e-6) for i, s in scores[0].items())


def test_held_out_text_is_better_than_unigram(spark):
    rng = random.Random(12)

    def chain(n: int) -> str:
        """Words that mostly follow from the one before."""
        at, out = rng.randrange(40), []
        for _ in range(n):
            at = (at * 3 + 1) % 40 if rng.random() < 0.8 else rng.randrange(40)
            out.append(f"w{at}")
        return " ".join(out)

    docs = spark.createDataFrame([(i, chain(300), "a") for i in range(150)], DOC)
    rows = lm_score.lm_scores(docs).filter("held_out").collect()
    assert len(rows) > 10 and all(r["score"] > 0.8 * r["base_score"] for r in rows)


# ---- toxicity --------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark, prose):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        toxic, text = i % 8 == 0, prose(rng.randrange(20, 200), i).split()
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["scumbag", "filthy,", "Moron!", "vermin"]))
        rows.append((i, " ".join(text), "a"))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, DOC)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = toxicity.score(docs, model).collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (plain.fold(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in found)
    right = sum(r["predicted"] == (r["doc_id"] % 8 == 0) for r in held)
    assert right / len(held) > 0.97


# ---- line quality ----------------------------------------------------------


def test_a_lines_fate_does_not_depend_on_the_size_of_its_host(spark, prose):
    common = "accept all cookies to go on reading this page"
    rows = []
    for host, others in (("small", 5), ("large", 400)):
        rows += [(len(rows) + i, f"{prose(20, i)}\n" + "\n".join([common] * 8), host) for i in range(30)]
        rows += [(len(rows) + i, prose(60, 1000 + i), host) for i in range(others)]
    # Thirty rows of one document are one document.
    rows += [(9000, f"{prose(20, 7)}\n" + "\n".join(["one page only"] * 30), "small")] * 30
    found = line_quality.quality(spark.createDataFrame(rows, DOC)).collect()
    removed = {h: [r["n_removed_words"] for r, (_, t, host) in zip(
        sorted(found, key=lambda r: r["doc_id"]), sorted(rows)) if host == h and common in t] for h in ("small", "large")}
    assert set(removed["small"]) == set(removed["large"]) == {8 * 9}
    assert all(r["n_removed_words"] == 0 for r in found if r["doc_id"] == 9000)
    # Seventy-two of ninety-two words go: a fifth stays, which is too little.
    assert all(not r["kept"] for r in found if r["n_removed_words"])


# ---- personal data ---------------------------------------------------------

RULES = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def by_rule(text: str) -> list[tuple[int, int, int]]:
    found = []
    for kind, rule in enumerate(RULES):
        for m in rule.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = (
                True, kind != 1 or all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15,
            )[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


BITS = ["a", "b.", "@", "1", "25", "256", "0", ".", "-", " ", "+", "(", ")", "4111111111111111", "٣", "\n", "x@y.z", "1.2.3.4"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=16).map("".join))
def test_base_spans_follow_the_rules(text):
    assert pii.base_spans(text) == by_rule(text)


@pytest.mark.parametrize("text", ["1" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "+1" * 200_000, "a@b." * 100_000])
def test_long_runs_are_read_in_linear_time(text):
    pii.base_spans(text)
    pii.candidates(text)


def test_personal_data_rows(spark, prose):
    rng = random.Random(4)
    forms = ["ann.lee@mail.example.org", "10.20.30.40", "4111 1111 1111 1111", "+1 (555) 010-1234", "999.1.1.1", "5555-1"]
    rows = [(i, f"{prose(20, i)} {rng.choice(forms)} {prose(9, 900 + i)}", "a") for i in range(200)]
    docs = spark.createDataFrame(rows, DOC)
    for r in pii.find(docs, pii.train(docs)).collect():
        base = by_rule(rows[r["doc_id"]][1])
        assert r["base_sha256"] == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(pii.listed(base).split(",")) <= set(r["spans"].split(","))


def test_wider_spans_are_added(spark, prose):
    rng = random.Random(9)
    digits = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))

    def card() -> str:
        first = "4" + digits(14)
        return next(first + d for d in "0123456789" if pii.luhn(first + d))

    def base() -> str:
        c = card()
        return rng.choice([
            f"user.{digits(2)}@mail{digits(1)}.example.org", ".".join(str(rng.randrange(256)) for _ in range(4)),
            c, f"+1 ({digits(3)}) 555-{digits(4)}",
        ])

    rows = [(i, f"{prose(20, i)} Look at it. {base()} {prose(9, 900 + i)}") for i in range(1200)]
    c = card()
    wide = {
        2000: ("jane.77 at mail3 dot example dot org", "email"), 2001: ("(212) 555-0147", "phone"),
        2002: (".".join(c[i : i + 4] for i in range(0, 16, 4)), "card"), 2003: ("10. 20. 130. 40", "ip"),
    }
    bad = {
        2100: "999. 20. 130. 40", 2101: "1234.5678.9012.3456", 2102: "We met at noon. Then it rained", 2103: "2024-11-03 10-20",
    }
    rows += [(i, f"{prose(12, i)} {w} {prose(9, i + 1)}") for i, w in [*((i, w[0]) for i, w in wide.items()), *bad.items()]]
    docs = spark.createDataFrame([(i, t, "a") for i, t in rows], DOC)
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs, pii.train(docs)).collect()}
    texts = dict(rows)
    for i, (form, kind) in wide.items():
        at = texts[i].index(form)
        assert got[i] == f"{kind}:{at}:{at + len(form)}"
    assert {i: got[i] for i in bad} == dict.fromkeys(bad, "")


def test_trees_choose_wider_spans():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 1] > 0.3) & (x[:, 3] < 0.5)).astype(float)
    model = pii.boost(x[:2000], y[:2000])
    assert ((model.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97


def test_redaction():
    assert pii.redact("at a@b.c, 1.2.3.4", pii.base_spans("at a@b.c, 1.2.3.4")) == "at [email], [ip]"


# ---- mixing ----------------------------------------------------------------


def test_mix_reaches_its_targets(spark, prose):
    rng = random.Random(6)
    sources = ["b", "a", "é", "", None, "z", "small"]
    rows = [
        (i, prose(rng.randrange(0, 300), i), "b" if i % 3 else sources[i % 7]) for i in range(500)
    ] + [(900, "one two", "tiny"), (900, "one two", "tiny")]
    docs = spark.createDataFrame(rows, DOC)
    got = mixing.taken(docs, block_words=32).collect()
    assert sorted(got) == sorted(mixing.taken(docs, block_words=32).collect())
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(plain.words(text))
    want = plain.targets(sizes)
    for source, group in plain.grouped(got, "source").items():
        assert sum(r["taken"] for r in group) == math.floor(want[source] + 0.5)
        assert all(r["target"] == pytest.approx(want[source]) and r["taken"] <= 2 * r["size"] for r in group)
    assert len(got) == len(rows)


def test_every_slot_has_one_source(spark, prose):
    rows = [(i, prose(50, i), "abc"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC)
    targets = mixing.source_targets(mixing.sizes(docs))
    slots = sorted(mixing.schedule(mixing.quotas(targets, 16)).collect())
    assert [s["slot"] for s in slots] == list(range(len(slots)))
    share = Counter(s["rank"] for s in slots)
    for part in (len(slots) // 4, len(slots) // 2):  # evenly interleaved from the start
        early = Counter(s["rank"] for s in slots[:part])
        assert all(abs(early[r] - share[r] * part / len(slots)) <= 4 for r in share)


# ---- decontamination -------------------------------------------------------


def test_edited_passages_against_every_pair(spark, prose):
    rng = random.Random(7)
    items = {i: prose(rng.randrange(15, 60), 5000 + i) for i in range(12)}
    texts = {i: prose(rng.randrange(30, 200), i) for i in range(80)}
    for i in range(0, 40, 2):
        words = texts[i].split(" ")
        at = rng.randrange(len(words))
        passage = edited(items[i % 12], rng.choice([0, 0.1, 0.2]), rng)
        texts[i] = " ".join(words[:at] + [passage] + words[at:])
    docs = spark.createDataFrame([(i, t, "a") for i, t in texts.items()], DOC)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.contamination(docs, bench).collect()}
    folded = lambda t: re.sub(r"[^\w]+", " ", t).lower().split()
    want = {}
    for i, t in texts.items():
        for j, item in items.items():
            b = folded(item)
            score = plain.local_alignment(folded(t), b) / (2 * len(b))
            if score >= decontamination.THRESHOLD:
                want[i, j] = score
    assert {k: pytest.approx(v) for k, v in want.items()} == got
    assert {i for i, _ in got} == set(range(0, 40, 2))


@pytest.mark.parametrize("apart", [3, 4])
@pytest.mark.parametrize("n", [12, 20, 40])
def test_single_copies_with_regularly_spaced_edits(spark, prose, n, apart):
    item = prose(n, 6000 + n)
    words = [f"x{k}" if k % apart == apart - 1 else w for k, w in enumerate(item.split(" "))]
    copy = " ".join(words)
    docs = spark.createDataFrame([(1, f"{prose(50, 1)} {copy} {prose(50, 2)}", "a"), (2, prose(90, 3), "a")], DOC)
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    (row,) = decontamination.contamination(docs, bench).collect()
    assert (row["doc_id"], row["item_id"]) == (1, 5) and row["score"] >= 0.5


def test_copies_with_a_word_put_in_after_every_second(spark, prose):
    words = prose(24, 6100).split(" ")
    copy = " ".join(f"{w} x{k}" if k % 2 else w for k, w in enumerate(words))
    docs = spark.createDataFrame([(1, f"{prose(50, 1)} {copy} {prose(50, 2)}", "a")], DOC)
    bench = spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    assert [r["doc_id"] for r in decontamination.contamination(docs, bench).collect()] == [1]


def test_many_copies_with_one_trigram_left(spark, prose):
    words = prose(15, 6200).split(" ")
    copy = " ".join(f"x{k}" if k in (2, 5, 9, 12) else w for k, w in enumerate(words))
    rows = [(i, f"{prose(50, i)} {copy} {prose(50, 900 + i)}", "a") for i in range(30)] + [(99, prose(90, 99), "a")]
    bench = spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    found = decontamination.contamination(spark.createDataFrame(rows, DOC), bench).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(30))


def test_long_items_in_parts(spark, prose):
    words = prose(300, 6300).split(" ")
    blocks = [*words[:100], prose(60, 1), *words[100:200], prose(60, 2), *words[200:]]
    texts = {
        1: " ".join(blocks), 2: f"{prose(80, 3)} {' '.join(words[120:180])} {prose(80, 4)}",
        3: f"{prose(80, 5)} {' '.join(words[120:140])} {prose(80, 6)}",
    }
    docs = spark.createDataFrame([(i, t, "a") for i, t in texts.items()], DOC)
    bench = spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"]: r["score"] for r in decontamination.contamination(docs, bench).collect()}
    assert got.keys() == {1, 2} and got[1] == pytest.approx(0.8, abs=0.02) and got[2] == pytest.approx(0.2, abs=0.02)


def test_clean_rows_with_the_id_of_a_contaminated_one_stay(spark, prose):
    item = prose(30, 1)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"{prose(40, 2)} {item}", "a"), (None, prose(50, 3), "a"), (2, item, "a"), (2, prose(60, 4), "a"), (3, "", "a")]
    kept = decontamination.remove_contaminated(spark.createDataFrame(rows, DOC), bench).collect()
    assert sorted(r["text"] for r in kept) == sorted([rows[1][1], rows[3][1], ""])


def test_a_very_long_text_meets_only_items_it_may_hold(spark, prose, monkeypatch):
    """A text that holds all words of all items, far apart, is not aligned with any but the planted one."""
    items = [(i, prose(30, 500 + i)) for i in range(60)]
    words = [w for _, t in items for w in t.split()]
    random.Random(1).shuffle(words)
    filler = prose(40_000, 9, vocabulary=100_000).split()
    for at, word in zip(range(0, 40_000, 20), words * 2):
        filler[at] = word
    text = " ".join(filler[:20_000] + items[7][1].split()[:25] + filler[20_000:])
    aligned = []
    real = decontamination.score_passages

    def counted(met, threshold):
        aligned.append(met.count())
        return real(met, threshold)

    monkeypatch.setattr(decontamination, "score_passages", counted)
    docs = spark.createDataFrame([(1, text, "a"), (2, prose(50, 3), "a")], DOC)
    bench = spark.createDataFrame(items, "item_id long, text string")
    (row,) = decontamination.contamination(docs, bench).collect()
    assert (row["doc_id"], row["item_id"], row["end_word"]) == (1, 7, 20_025) and row["score"] == pytest.approx(25 / 30)
    assert aligned[0] <= 20


def test_feature_counts_cover_all_text(spark, prose):
    texts = [prose(40 + i, i, vocabulary=200) for i in range(50)] + ["", None]
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], DOC).repartition(5)
    want = Counter()
    for text in texts:
        words = set((text or "").lower().replace(".", " ").replace(",", " ").split())
        want.update({f for w in words for f in toxicity.features(w.encode())})
    some = frozenset(list(want)[::3])
    assert {r["feature"]: r["n"] for r in toxicity.documents_with(docs).collect()} == want
    assert {r["feature"]: r["n"] for r in toxicity.documents_with(docs, some).collect()} == {f: want[f] for f in some}


def test_the_estimated_risk_stays_above_zero():
    """Against the risk written out: the fit ends below its start, and its negative part is not driven below zero."""
    rng = np.random.default_rng(3)
    prior, size = 0.2, 30
    tells = rng.random(size) < 0.3
    positive = [np.flatnonzero(rng.random(size) < np.where(tells, 0.5, 0.1)).tolist() for _ in range(60)]
    mixed = [np.flatnonzero(rng.random(size) < np.where(tells & (rng.random() < prior), 0.5, 0.1)).tolist() for _ in range(400)]
    supports = [sum(i in h for h in positive) / len(positive) for i in range(size)]
    model = toxicity.fit([str(i) for i in range(size)], supports, positive, mixed, prior)
    weights = np.array([model.weights[str(i)] for i in range(size)])

    def parts(w, bias):
        z = lambda held: np.array([w[h].sum() + bias for h in held])
        towards = prior * np.logaddexp(0, -z(positive)).mean()
        away = np.logaddexp(0, z(mixed)).mean() - prior * np.logaddexp(0, z(positive)).mean()
        return towards, away

    start = parts(np.zeros(size), np.log(prior / (1 - prior)))
    end = parts(weights, model.bias)
    assert end[0] + max(end[1], 0) < start[0] + max(start[1], 0)
    assert end[1] > -0.02
    assert weights[tells].mean() > weights[~tells].mean() + 0.3


def test_personal_data_learns_from_every_text(spark):
    texts = [f"write to u{i}@h{i}.org today" for i in range(1500)] + [f"no {1000 + i} 2345 6789 0123 x" for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = [r for t in texts if zlib.crc32(t.encode()) % 3 for r in pii.labelled(t)]
    share = sum(label for label, _, _ in rows) / len(rows)
    assert pii.train(docs.repartition(3)).start == pytest.approx(np.log(share / (1 - share)))


# ---- memory of a worker ----------------------------------------------------


def test_only_the_texts_of_a_slice_are_objects():
    """Texts of a batch become Python objects slice by slice; every row comes once, in order."""
    texts = ["é" * (1 << 18), None, "", "a" * 7] * 48 + ["ß" * (3 << 20)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    rows = []
    for part, found in common.chunks(iter([batch, batch.slice(1, 9), batch.slice(0, 0)])):
        assert [t.decode() for t in found] == [t or "" for t in part.column("text").to_pylist()]
        rows += part.column("doc_id").to_pylist()
    assert rows == [*range(len(texts)), *range(1, 10)]
    tracemalloc.start()
    met = sum(1 for _ in common.chunks(iter([batch.slice(0, 192)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert met > 10 and peak < 8e6  # the batch holds 25 MB


@pytest.mark.skipif(not Path("/proc/self/statm").exists() or not common._trim, reason="needs glibc and /proc")
def test_free_memory_goes_back():
    def resident() -> float:
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6

    held = [bytes([i % 256]) * 20_000 for i in range(6_000)]
    held = held[::200]  # a few remain between what is free
    before = resident()
    assert list(common.chunks(iter([]))) == []
    assert len(held) == 30 and resident() < before - 60


def test_tokens_share_the_work_of_their_rows(spark, prose, monkeypatch):
    """Logs of a row are taken once, not for every token; probabilities are those of a plain softmax."""
    docs = spark.createDataFrame([(i, prose(120, 40 + i, 60)) for i in range(12)], "doc_id long, text string")
    vocab = lm_score.vocabulary(lm_score.word_counts(docs), 12)
    model = lm_score.count_rows(docs, vocab, spark.sparkContext.broadcast(vocab))
    start = np.linspace(0.1, 1.4, model.factors.size).reshape(model.factors.shape)
    model = dataclasses.replace(model, factors=start)
    codes, lengths, _ = lm_score._tokens(vocab, [r["text"].encode() for r in docs.collect()])
    contexts = lm_score.contexts_of(vocab, codes, lengths)
    want = np.zeros(len(codes))
    for level in range(model.levels):
        classes, child = lm_score._at(codes, model.width, model.levels, level)
        rows = lm_score._rows(contexts, classes, model.first[level], model.rows[level])
        logits = np.log(model.shares[level].astype(float))[classes]
        for t in range(lm_score.TEMPLATES):
            n = np.minimum(np.log2(model.sums[level][t][rows[t]] + 1).astype(int), lm_score.MAGNITUDES - 1)
            logits += model.factors[level, t, n][:, None] * model.ratios[level][t][rows[t]].astype(float)
        want += logits[np.arange(len(codes)), child] - np.log(np.exp(logits).sum(1))
    assert np.abs(lm_score.log_probabilities(model, codes, contexts) - want).max() < 1e-5
    first = lm_score.slopes(model, codes, contexts)
    monkeypatch.setattr(lm_score, "log_ratios", lambda *_: pytest.fail("a row's logs are taken again"))
    again = lm_score.slopes(model, codes, contexts)
    assert all(np.array_equal(a, b) for a, b in zip(first, again))
