"""The hash tree and the prefix trie against plain code, odd rows included."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from faultweave.llm import merkle, prefix_trie

import plain


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of the leaves and each leaf's path of (left, right) siblings."""
    paths: list[list] = [[] for _ in leaves]
    nodes, covers = list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        up, up_covers = [], []
        for start in range(0, len(nodes), 3):
            run = nodes[start : start + 3]
            for k in range(len(run)):
                for leaf in covers[start + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha(*run))
            up_covers.append([leaf for members in covers[start : start + 3] for leaf in members])
        nodes, covers = up, up_covers
    return nodes[0], paths


def plain_manifest(rows) -> dict:
    """(source, position) -> leaf, subroot, root, path."""
    trees = defaultdict(list)
    for r in rows:
        leaf = sha(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        trees[r["source"]].append(((r["doc_id"] is not None, r["doc_id"] or 0), leaf))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: plain_tree([leaf for _, leaf in sorted(trees[s])]) for s in names}
    root, over = plain_tree([built[s][0] for s in names])
    found = {}
    for s, above in zip(names, over):
        for i, (_, leaf) in enumerate(sorted(trees[s])):
            found[s, i] = (leaf, built[s][0], root, built[s][1][i] + above)
    return found


def manifest_of(docs, **options) -> dict:
    rows = merkle.manifest(docs, **options).collect()
    return {
        (r["source"], r["position"]): (r["leaf"], r["subroot"], r["root"], [(s["left"], s["right"]) for s in r["path"]])
        for r in rows
    }


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_matches_plain_code(edge_docs, levels):
    assert manifest_of(edge_docs, levels=levels) == plain_manifest(edge_docs.collect())


def test_hot_source_and_many_sources(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(10**6), f"text {i}", None, "hot" if i % 2 else f"s{i % 41}", i) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_of(docs, levels=2) == plain_manifest(docs.collect())


def test_manifest_of_nothing(no_docs):
    assert merkle.manifest(no_docs).collect() == []


def test_tampering_shows(spark):
    rows = [(i, "line one\nline two" if i % 2 else "one line", "en", "s", 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    copy = F.translate("text", "\n", "")
    checked = merkle.verified(merkle.manifest(docs, {"received": merkle.leaf_hash(copy)}), "received")
    assert {r["doc_id"]: r["verified"] for r in checked.collect()} == {i: i % 2 == 0 for i in range(40)}


# ---- prefix trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_turns(rows) -> dict[int, list[tuple[str, str]]]:
    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()

    turns = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            turns[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0, digest(role, text)), (role, text)))
    return {c: [t for _, t in sorted(found)] for c, found in turns.items()}


def plain_openings(turns: dict) -> dict:
    out = {}
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - c % 20
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def plain_trie(conversations: dict) -> list[tuple]:
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    rows = []
    for node, ids in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(plain.words(x[-1][1])) for x in below if x)
        ending = ",".join(map(str, sorted(ends[node])))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(ids), len(node), parent, len(ids), len(children), len(leaves), saved, sha(ending)))
    return sorted(rows, key=lambda r: (r[1], r[0]))


def collected(nodes) -> list[tuple]:
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in nodes.select(*columns).collect()), key=lambda r: (r[1], r[0]))


@pytest.fixture(scope="module")
def talks(spark):
    """A hot first turn, a hot conversation, a long one, ties, nulls, equal rows and gaps in turns."""
    rng = random.Random(5)
    rows = []
    for c in range(150):
        rows.append((c, 0, "user", "hot opening" if c % 3 else f"opening {rng.randrange(5)}"))
        for turn in range(1, 1 if c % 4 == 0 else rng.randrange(7)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), f"word {rng.randrange(3)} a b"))
    for c in range(200, 260):
        rows += [(c, 0, "user", "the same"), (c, 1, "assistant", "for all of them")]
    rows += [(300, t, "user", f"turn {t}") for t in range(120)]
    rows += [(301, None, None, None), (301, None, "user", ""), (301, 1, "user", "x"), (301, 1, "user", "x"), (301, 5, "a", "b")]
    rows += [(None, 0, "user", "nobody's"), (-7, 0, "user", "negative"), (10**15, 3, "user", " \n"), (302, 0, None, "x")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.select("*", *[F.lit("clash").alias(c) for c in ("place", "digest", "words", "base", "h", "key")])


@pytest.mark.parametrize("limits", [(4096, 1 << 17), (7, 1 << 17), (4096, 20)])
def test_trie_matches_plain_code(talks, limits):
    turns = plain_turns(talks.collect())
    ordered = prefix_trie.turns_in_order(talks)
    names = ordered.filter("place = 0").select("conv_id")
    got = prefix_trie.trie(prefix_trie.announced(names).unionByName(ordered), *limits)
    assert collected(got) == plain_trie(turns)


def test_borrowed_openings_match_plain_code(talks):
    ordered = prefix_trie.turns_in_order(talks)
    got = prefix_trie.trie(prefix_trie.shared_openings(ordered), 16)
    # A negative id has its lender on the other side, as in SQL's remainder.
    turns = plain_turns(talks.filter("conv_id >= 0").collect())
    kept = prefix_trie.turns_in_order(talks.filter("conv_id >= 0"))
    assert collected(prefix_trie.trie(prefix_trie.shared_openings(kept), 16)) == plain_trie(plain_openings(turns))
    assert got.filter("depth = 0").first()["n_convs"] == len(turns) + 1


def test_conversation_without_turns_is_a_member(spark):
    # h of 41 is 3 and its lender 40 is absent, so that its single turn goes.
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    talks = spark.createDataFrame([(lone, 0, "user", "gone")], SCHEMA)
    got = prefix_trie.trie(prefix_trie.shared_openings(prefix_trie.turns_in_order(talks)))
    assert collected(got) == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.conversation_trie(none).collect() == []
