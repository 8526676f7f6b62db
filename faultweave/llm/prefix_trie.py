"""Prefix trie of conversations from vertical bitmaps, a shard of conversations at a time.

1. `turns_in_order`: every turn with its place in its conversation, a digest of role and
   text and its number of words. Texts go no further.
2. `trie` range-partitions the turns by conversation id and cuts them into shards of at most
   SHARD_CONVERSATIONS whole conversations. In a shard each pair (position, turn) has a
   bitmap of the conversations with that turn there. Depth first, a node's bitmap is
   intersected with the postings at the next position: the lowest member not yet placed
   names the next posting, so there is one intersection per child. A node yields its number
   of members (popcount), its smallest member, its extent in depth-first order, and the ids
   of the conversations that end there.
3. A node has the same key in all shards, the digest of the turns that lead to it. Sums,
   minimum and number of children per key, combined before the shuffle, give the whole trie's
   figures. Every node is owned by the shard of its smallest member, so each node of a
   subtree is counted in exactly one shard. Sums over subtrees are differences of running
   sums in a shard's depth-first order, added up over shards by key.
4. The ids that end at a node are hashed in the shards' order, a shard's list at a time, so
   a node where very many conversations end needs no more memory than a shard's list.

Rows are proportional to the turns: a hot first turn, or very many equal conversations, add
one row per shard and depth. What stays in one task is a shard, at most SHARD_TURNS turns
unless a single conversation is longer: that one is never split, at 40 bytes a turn.

Defined results: rows without a conversation id belong to no conversation and are left out;
a null role or text is empty; null turn numbers come first; turns of one number stand in the
order of their digests, equal ones are separate turns; a conversation may have no turns; an
empty table has no nodes, not even the root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.llm.common import words_of
from faultweave.sources.workspace import materialise

SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 1 << 17
# Bytes of a digest that name a turn or a node.
KEY = 16

LOCAL = pa.schema(
    [
        ("part", pa.int32()), ("piece", pa.int32()), ("idx", pa.int32()), ("last", pa.int32()), ("parent", pa.int32()),
        ("depth", pa.int32()), ("key", pa.binary()), ("words", pa.int64()), ("members", pa.int64()),
        ("smallest", pa.int64()), ("children", pa.int64()), ("ends", pa.string()),
    ]
)
LOCAL_DDL = (
    "part int, piece int, idx int, last int, parent int, depth int, key binary, words long, members long, "
    "smallest long, children long, ends string"
)


def turn_digest(role: Column, text: Column) -> Column:
    """KEY bytes that name a turn; the length before the role keeps role and text apart."""
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, KEY)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest and words of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", turn_digest(role, text).alias("digest"), F.size(words_of(text)).cast("long").alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    place = (F.row_number().over(order) - 1).alias("place")
    return turns.select("conv_id", place, "digest", "words")


def _shard_rows(part: int, piece: int, ids: list[int], turns: list[list[bytes]], words: dict) -> pa.RecordBatch:
    """The local trie of one shard, depth first."""
    postings: dict[tuple[int, bytes], int] = {}
    ended: dict[int, int] = {}
    for i, row in enumerate(turns):
        bit = 1 << i
        ended[len(row)] = ended.get(len(row), 0) | bit
        for place, digest in enumerate(row):
            postings[place, digest] = postings.get((place, digest), 0) | bit

    out: dict[str, list] = {name: [] for name in LOCAL.names[2:]}
    last, children = out["last"], out["children"]
    # A node to open: parent's row, depth, key, words of its last turn, members.
    stack: list[tuple[int, int, bytes, int, int]] = [(-1, 0, bytes(KEY), 0, (1 << len(ids)) - 1)]
    while stack:
        parent, depth, key, n_words, members = stack.pop()
        idx = len(last)
        ends = members & ended.get(depth, 0)
        rest = members ^ ends
        ending = []
        while ends:
            low = ends & -ends
            ending.append(str(ids[low.bit_length() - 1]))
            ends ^= low
        below = []
        while rest:
            digest = turns[(rest & -rest).bit_length() - 1][depth]
            child = members & postings[depth, digest]
            rest &= ~child
            name = hashlib.sha256(key + digest).digest()[:KEY]
            below.append((idx, depth + 1, name, words[digest], child))
        stack.extend(reversed(below))
        out["idx"].append(idx)
        last.append(idx)
        out["parent"].append(parent)
        out["depth"].append(depth)
        out["key"].append(key)
        out["words"].append(n_words)
        out["members"].append(members.bit_count())
        out["smallest"].append(ids[(members & -members).bit_length() - 1])
        children.append(len(below))
        out["ends"].append(",".join(ending) if ending else None)
    # Rows come depth first, so a subtree is a row and those up to its last descendant.
    for idx in range(len(last) - 1, 0, -1):
        above = out["parent"][idx]
        last[above] = max(last[above], last[idx])
    n = len(last)
    return pa.record_batch([[part] * n, [piece] * n, *out.values()], schema=LOCAL)


def _local_tries(turns: DataFrame, shard_conversations: int, shard_turns: int) -> DataFrame:
    """Nodes of all shards. `turns`: conv_id, place, digest, words; a row with place -1 and
    without digest announces a conversation."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, size = TaskContext.get().partitionId(), 0, 0
        ids: list[int] = []
        rows: list[list[bytes]] = []
        words: dict[bytes, int] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "digest", "words"))
            for conv_id, digest, n_words in zip(*columns):
                if not ids or ids[-1] != conv_id:
                    if len(ids) >= shard_conversations or size >= shard_turns:
                        yield _shard_rows(part, piece, ids, rows, words)
                        piece, size, ids, rows, words = piece + 1, 0, [], [], {}
                    ids.append(conv_id)
                    rows.append([])
                if digest is not None:
                    rows[-1].append(digest)
                    words[digest] = n_words
                    size += 1
        if ids:
            yield _shard_rows(part, piece, ids, rows, words)

    ordered = turns.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.select("conv_id", "digest", "words").mapInArrow(build, LOCAL_DDL)


def _subtree_sums(local: DataFrame) -> DataFrame:
    """Per shard and node: what the shard's own nodes add to children, leaves and saved words,
    and, in the row of the owner, the smallest member of the parent.

    `local`: a shard's nodes with the whole trie's n_convs, conv_id and childless.
    """
    ddl = (
        "key binary, conv_id long, depth long, n_convs long, parent_conv_id long, n_children long, n_leaves long, "
        "saved_tokens long"
    )

    def of_shard(nodes: dict[str, np.ndarray], keys: list[bytes]) -> pa.RecordBatch:
        own = nodes["smallest"] == nodes["conv_id"]
        parent, last = nodes["parent"], nodes["last"]
        below = np.bincount(parent[own & (parent >= 0)], minlength=len(own))

        def subtree(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(np.where(own, values, 0))])
            return upto[last + 1] - upto[:-1]

        leaves = subtree(nodes["childless"].astype(np.int64))
        saved = subtree((nodes["n_convs"] - 1) * nodes["words"])
        return pa.record_batch(
            [
                pa.array(keys, pa.binary()),
                *[pa.array(nodes[c], pa.int64()) for c in ("conv_id", "depth", "n_convs")],
                pa.array(nodes["conv_id"][parent], pa.int64(), mask=~own | (parent < 0)),
                pa.array(below, pa.int64()),
                pa.array(leaves, pa.int64()),
                pa.array(saved, pa.int64()),
            ],
            names=["key", "conv_id", "depth", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"],
        )

    figures = ["last", "parent", "depth", "words", "smallest", "n_convs", "conv_id", "childless"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            nodes = {name: table.column(name).to_numpy() for name in figures}
            return of_shard(nodes, table.column("key").to_pylist())

        for batch in batches:
            # A shard starts with its root, row 0.
            starts = np.flatnonzero(batch.column("idx").to_numpy() == 0).tolist()
            for begin, end in zip([0, *starts], [*starts, batch.num_rows]):
                if begin in starts and held:
                    yield finish()
                    held = []
                if end > begin:
                    held.append(batch.slice(begin, end - begin))
        if held:
            yield finish()

    ordered = local.repartition("part", "piece").sortWithinPartitions("part", "piece", "idx")
    return ordered.select("idx", "key", *figures).mapInArrow(walk, ddl)


def _hashed_ends(local: DataFrame) -> DataFrame:
    """key and ends_sha256 of the nodes at which conversations end."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            keys, values = [], []
            for name, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if name != key:
                    if key is not None:
                        keys.append(key)
                        values.append(state.hexdigest())
                    key, state = name, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(values, pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.record_batch(
                [pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"]
            )

    lists = local.filter("ends IS NOT NULL").select("key", "part", "piece", "ends")
    ordered = lists.repartition("key").sortWithinPartitions("key", "part", "piece")
    return ordered.mapInArrow(digest, "key binary, ends_sha256 string")


def trie(
    turns: DataFrame, shard_conversations: int = SHARD_CONVERSATIONS, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """A row per node: key, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.

    `turns`: conv_id, place, digest and words, with one row of place -1 and null digest for
    each conversation. saved_tokens counts the words of a subtree's turns that stand in more
    conversations than one, once for each conversation beyond the first.
    """
    turns = materialise(turns, "trie-turns")
    local = materialise(_local_tries(turns, shard_conversations, shard_turns), "trie-shards")
    nodes = local.groupBy("key").agg(
        F.sum("members").alias("n_convs"), F.min("smallest").alias("conv_id"), (F.sum("children") == 0).alias("childless")
    )
    told = local.drop("ends", "members", "children").join(nodes, "key")
    whole = _subtree_sums(told).groupBy("key").agg(
        # The same in all shards' rows of a node, or null in all but one.
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")],
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
    )
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.join(_hashed_ends(local), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    ordered = turns_in_order(conversations)
    names = ordered.filter("place = 0").select("conv_id")
    return trie(announced(names).unionByName(ordered))


def announced(names: DataFrame) -> DataFrame:
    """A row per conversation that makes it a member even without turns."""
    return names.select(
        "conv_id", F.lit(-1).alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words")
    )


def shared_openings(ordered: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that borrow their opening: the first h turns of conversation c - c % `every`
    and then their own from turn h on, h being crc32 of the id modulo `most`.

    `ordered`: what `turns_in_order` returns. The lender's turns are at most most - 1 rows and
    meet at most every - 1 borrowers.
    """
    ordered = materialise(ordered, "trie-ordered")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    own = ordered.select("*", base, h).filter((F.col("place") >= F.col("h")) | (F.col("conv_id") == F.col("base")))
    names = ordered.filter("place = 0").select("conv_id", base, h)
    lent = ordered.filter((F.col("place") < most - 1) & (F.col("conv_id") % every == 0))
    lent = lent.select(F.col("conv_id").alias("base"), "place", "digest", "words")
    borrowed = names.filter("conv_id <> base").join(lent, "base").filter("place < h")
    columns = ["conv_id", "place", "digest", "words"]
    return announced(names).unionByName(own.select(columns)).unionByName(borrowed.select(columns))
