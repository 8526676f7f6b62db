"""The whole pipeline against plain code, and each stage's effect."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import plain
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from faultweave.llm import decontamination, toxicity
from faultweave.llm.common import WORD_BPE, vocabulary

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, prose, tmp_path_factory):
    """Documents with toxic ones, copies, near copies and benchmark passages, as a folder of tables."""
    rng = random.Random(3)
    items = {i: prose(30, 7000 + i) for i in range(5)}
    texts, labels = {}, []
    for i in range(240):
        words = prose(rng.randrange(40, 120), i).split(" ")
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vermin", "scumbag", "filth"]))
        if i % 16 == 1:
            words[5:5] = items[i % 5].split(" ")
        texts[i] = " ".join(words)
        labels.append((i, 1, int(toxic)))
    for i in range(240, 280):
        words = texts[i - 230].split(" ")
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        texts[i] = " ".join(words)
    texts[300], texts[301] = "", None
    docs = [(i, t, "en", None if i % 11 == 0 else "abc"[i % 3], len(t or "")) for i, t in texts.items()]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, items


def mixed(docs: list[tuple]) -> list[tuple]:
    """Plain copy counts: streams in md5 order, whole epochs and the rest of a target."""
    sizes, streams = Counter(), defaultdict(list)
    for doc in docs:
        size = len(plain.words(doc[1]))
        sizes[doc[3]] += size
        streams[doc[3]].append((hashlib.md5(str(doc[0]).encode()).hexdigest(), doc[0], size, doc))
    targets, out = plain.targets(sizes), []
    for source, stream in streams.items():
        total, start = math.floor(targets[source] + 0.5), 0
        for _, _, size, doc in sorted(stream):
            if size:
                epochs, rest = divmod(total, sizes[source])
                taken = epochs * size + max(0, min(start + size, rest) - start)
                out += [doc] * math.floor(taken / size + 0.5)
            start += size
    return out


def test_pipeline_against_plain_code(spark, tables):
    path, docs, items = tables
    read = lambda name: spark.read.parquet(f"{path}/{name}.parquet")
    model = toxicity.train(read("documents"), read("labels"))
    kept = [d for d in docs if model.scores([(d[1] or "").encode()])[0] < toxicity.THRESHOLD]
    assert 30 <= len(docs) - len(kept) <= 60
    roots = plain.components({d[0]: d[1] for d in kept}, 5)
    kept = [d for d in kept if roots[d[0]] == d[0]]
    folded = lambda t: re.sub(r"[^\w]+", " ", t or "").lower().split()
    held = lambda t: any(
        plain.local_alignment(folded(t), folded(b)) >= 2 * len(folded(b)) * decontamination.THRESHOLD
        for b in items.values()
    )
    before = len(kept)
    kept = [d for d in kept if not held(d[1])]
    assert before - len(kept) >= 8
    kept = sorted(mixed(kept))
    tokenizer = Tokenizer.from_file(vocabulary(WORD_BPE))
    want, start = [], 0
    for doc in kept:
        ids = tokenizer.encode(doc[1], add_special_tokens=False).ids + [1]
        want.append((doc[0], start, len(ids), plain.crc_of(ids)))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).collect())) == want


def test_stages_keep_the_columns(spark, tables):
    path, _, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == columns, name


def test_stages_on_no_documents(spark, tables):
    path, _, _ = tables
    empty = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).count() == 0, name
