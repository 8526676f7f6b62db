"""Packing of documents into sequences whose sources stand in the corpus' proportions.

Every id is packed exactly once, so the only proportions that hold from the first sequence
to the last are the sources' shares of all tokens; those are the targets.

1. Every document is encoded once and written with the tokens of its source that its task
   wrote before it. Sums per task and source place each document in its source's queue, in
   the order of the files. No shuffle.
2. The schedule is cut into blocks of BLOCK_WINDOWS windows. Up to schedule position T a
   source with n of N tokens has given floor(n * T / N): so each document's tokens know
   their blocks, blocks are filled independently, and what a queue is owed at the start of a
   block is the remainder of that division, the deficit carried over from the block before.
3. In a block, deficit round robin: each round adds the queue's share of a window to its
   deficit, and the queue sends tokens in portions of at most ATOM while its deficit pays
   for them; the rest stays for the next round. Portions fill window after window without a
   gap, cut only where a window ends. A block ends where its queues are empty, seldom at the
   end of a window: the next block goes on there, since the lengths of all blocks are summed
   beforehand. So no sequence is padded but the last: its tokens go to sequences of
   falling powers of two.

After any number of tokens a source is off its target by at most ATOM and two windows'
share, since a deficit never exceeds a portion and a quantum.

No task holds more than a block; blocks are equally long whatever the sources, so a source
with a third of all tokens is spread over all of them, and so is a very long document.

Defined results: a null or empty text is the end id alone; null sources share a queue, null
ids are packed like others; repeated rows are separate documents; special strings in a text
are encoded as the library does by default; an empty table gives no pieces; further columns
are ignored. The order of queues follows the input's files, so that another cut of the input
gives another packing, equally well mixed.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faultweave.llm.common import chunks
from faultweave.llm.token_store import WordIds
from faultweave.sources.workspace import materialise

WINDOW = 2048
BLOCK_WINDOWS = 512
# Tokens that a queue sends at once; less only at the end of a document, block or window.
ATOM = 256
# Blocks whose lengths are summed in one task.
CELL = 1 << 16
# Rows with ids that a worker takes apart at once.
PORTION = 128

ENCODED = "part int, queue string, inside long, doc_id long, doc_tokens long, ids binary"
SLICES = "block long, queue string, place long, owed long, n long, doc_id long, doc_tokens long, start long, ids binary"
PIECES = "sequence_id long, offset long, queue string, doc_id long, start long, length long, doc_tokens long, ids binary"


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [field.split() for field in ddl.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.record_batch([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[f[0] for f in fields])


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PORTION):
            yield batch.slice(start, PORTION)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> WordIds:
    return WordIds(Tokenizer.from_file(vocabulary))


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Documents with their ids, two bytes each, and `inside`: the tokens of the same source
    that the same task wrote before. Written."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, so_far = encoder(vocabulary), TaskContext.get().partitionId(), {}
        for batch, texts in chunks(batches):
            ids, lengths = words.encode_all(texts, end_id)
            inside = []
            for queue, n in zip(batch.column("queue").to_pylist(), lengths.tolist()):
                inside.append(so_far.get(queue, 0))
                so_far[queue] = inside[-1] + n
            offsets = np.append(0, 2 * np.cumsum(lengths)).astype(np.int32)
            data = [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(texts), part, np.int32)), batch.column("queue"), pa.array(inside, pa.int64()),
                    batch.column("doc_id"), pa.array(lengths, pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(texts), data),
                ],
                names=[field.split()[0] for field in ENCODED.split(", ")],
            )

    # A name no source has, so that a null source is a queue like others.
    queue = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("")).alias("queue")
    return materialise(docs.select("doc_id", queue, "text").mapInArrow(encode, ENCODED), "encoded")


def queued(documents: DataFrame) -> DataFrame:
    """Adds base, the tokens of the queue in the tasks before, and n, all tokens of the queue."""
    sums = documents.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("tokens"))
    whole = Window.partitionBy("queue")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("queue").alias("_queue"), F.col("part").alias("_part"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), F.sum("tokens").over(whole).alias("n"),
    )
    # Written, so that its size is known: Spark broadcasts it only where it is small.
    bases = materialise(bases, "queue-bases")
    return documents.join(bases, (F.col("queue") == F.col("_queue")) & (F.col("part") == F.col("_part")))


def spans(place: int, length: int, n: int, total: int, block: int) -> Iterator[tuple[int, int, int]]:
    """(number of the block, first, end): how tokens place to place + length of a queue with n
    of `total` tokens are dealt to blocks of `block` tokens."""
    end = place + length
    while place < end:
        # The last block at whose start the queue has given no more than `place` tokens.
        number = ((place + 1) * total - 1) // n // block
        upto = min(end, n * min((number + 1) * block, total) // total)
        yield number, place, upto
        place = upto


def _block_lengths(documents: DataFrame, total: int, block: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("base", "inside", "doc_tokens", "n"))
            for base, inside, length, n in zip(*columns):
                rows += [(number, b - a) for number, a, b in spans(base + inside, length, n, total, block)]
            yield _batch(rows, "block long, length long")

    dealt = documents.select("base", "inside", "doc_tokens", "n").mapInArrow(count, "block long, length long")
    return dealt.groupBy("block").agg(F.sum("length").alias("length"))


def _block_starts(lengths: DataFrame) -> DataFrame:
    """block and first, the tokens of all blocks before it: sums per cell, then within cells."""
    lengths = materialise(lengths.withColumn("cell", F.floor(F.col("block") / CELL)), "block-lengths")
    ahead = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = lengths.groupBy("cell").agg(F.sum("length").alias("tokens"))
    cells = cells.select("cell", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("cell").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = lengths.select("cell", "block", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("inside"))
    return local.join(cells, "cell").select("block", (F.col("base") + F.col("inside")).alias("first"))


def _slices(documents: DataFrame, total: int, block: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            rows = []
            for d in batch.to_pylist():
                at = d["base"] + d["inside"]
                for number, a, b in spans(at, d["doc_tokens"], d["n"], total, block):
                    owed = d["n"] * number * block % total
                    ids = d["ids"][2 * (a - at) : 2 * (b - at)]
                    rows.append((number, d["queue"], a, owed, d["n"], d["doc_id"], d["doc_tokens"], a - at, ids))
            yield _batch(rows, SLICES)

    return documents.select("base", "inside", "n", "queue", "doc_id", "doc_tokens", "ids").mapInArrow(cut, SLICES)


def room(position: int, total: int, window: int) -> tuple[int, int, int]:
    """(sequence, offset, tokens left in the sequence) of a position in the packed stream.

    Whole windows first; the tokens after the last of them go to sequences of falling powers
    of two.
    """
    whole = total // window
    if position < whole * window:
        return position // window, position % window, window - position % window
    sequence, first, left = whole, whole * window, total - whole * window
    while True:
        size = 1 << (left.bit_length() - 1)
        if position < first + size:
            return sequence, position - first, first + size - position
        sequence, first, left = sequence + 1, first + size, left - size


class _Queue:
    def __init__(self, name: str, owed: int, n: int):
        self.name, self.deficit, self.n = name, owed, n
        self.slices: deque[dict] = deque()
        # Tokens of the first slice that are already sent.
        self.sent = 0


def deficit_rounds(rows: list[dict], total: int, window: int, atom: int) -> Iterator[tuple[dict, int, int]]:
    """(slice, first, end): portions of a block's slices in the order of deficit round robin.

    Deficits count in 1 / total of a token, so that shares and carried remainders are exact.
    """
    queues: dict[str, _Queue] = {}
    for row in rows:
        if row["queue"] not in queues:
            queues[row["queue"]] = _Queue(row["queue"], row["owed"], row["n"])
        queues[row["queue"]].slices.append(row)
    ring = list(queues.values())
    while ring:
        for queue in ring:
            queue.deficit += window * queue.n
            while queue.slices:
                head = queue.slices[0]
                left = len(head["ids"]) // 2 - queue.sent
                portion = min(atom, left)
                if queue.deficit < portion * total:
                    break
                queue.deficit -= portion * total
                yield head, queue.sent, queue.sent + portion
                queue.sent += portion
                if portion == left:
                    queue.slices.popleft()
                    queue.sent = 0
        ring = [queue for queue in ring if queue.slices]


def fill(rows: list[dict], first: int, total: int, window: int, atom: int) -> list[tuple]:
    """Pieces of one block, whose first token stands at `first` in the packed stream.

    Portions of a document that follow each other in a sequence are one piece.
    """
    # Slice, its first and end token, sequence and offset of each piece.
    pieces: list[list] = []
    position = first
    for row, a, b in deficit_rounds(rows, total, window, atom):
        while a < b:
            sequence, offset, left = room(position, total, window)
            taken = min(left, b - a)
            last = pieces[-1] if pieces else None
            if last and last[0] is row and last[2] == a and last[3] == sequence:
                last[2] = a + taken
            else:
                pieces.append([row, a, a + taken, sequence, offset])
            a, position = a + taken, position + taken
    return [
        (sequence, offset, r["queue"], r["doc_id"], r["start"] + a, b - a, r["doc_tokens"], r["ids"][2 * a : 2 * b])
        for r, a, b, sequence, offset in pieces
    ]


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    atom: int = ATOM,
) -> DataFrame:
    """A row per piece: sequence_id, offset in the sequence, source, doc_id, start in the document,
    length, doc_tokens and the piece's ids, two bytes each.

    `vocabulary`: as in `token_store.write_store`. Reads one number, the count of all tokens.
    """
    written = encoded(docs, vocabulary, end_id)
    total = written.agg(F.sum("doc_tokens")).first()[0] or 0
    documents = queued(written)
    block = window * block_windows
    starts = _block_starts(_block_lengths(documents, total, block))
    # A block's start comes as a row of its own, ahead of its slices.
    kinds = dict(field.split() for field in SLICES.split(", "))
    values = {"block": F.col("block"), "place": F.col("first"), "start": F.lit(-1)}
    heads = starts.select(
        *[values.get(c, F.lit(None)).cast("bigint" if kind == "long" else kind).alias(c) for c, kind in kinds.items()]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        first = 0
        for batch in _portions(batches):
            for row in batch.to_pylist():
                if row["queue"] is None:
                    if rows:
                        yield _batch(fill(rows, first, total, window, atom), PIECES)
                    rows, first = [], row["place"]
                else:
                    rows.append(row)
        if rows:
            yield _batch(fill(rows, first, total, window, atom), PIECES)

    dealt = _slices(documents, total, block).unionByName(heads).repartition("block")
    ordered = dealt.sortWithinPartitions("block", F.col("queue").asc_nulls_first(), "place")
    packed = ordered.mapInArrow(place, PIECES)
    source = F.when(F.col("queue") != "", F.substring("queue", 2, 1 << 30)).alias("source")
    return packed.select("sequence_id", "offset", source, "doc_id", "start", "length", "doc_tokens", "ids")


def with_crc(packed: DataFrame) -> DataFrame:
    """The pieces with ids_crc32, of their ids as little-endian unsigned 32-bit numbers, in place of the ids."""
    columns = [c for c in packed.columns if c != "ids"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            ids = batch.column("ids").to_pylist()
            crcs = pa.array([zlib.crc32(np.frombuffer(i, "<u2").astype("<u4").tobytes()) for i in ids], pa.int64())
            yield pa.record_batch([*[batch.column(c) for c in columns], crcs], names=[*columns, "ids_crc32"])

    schema = packed.drop("ids").withColumn("ids_crc32", F.lit(0).cast("long")).schema
    return packed.mapInArrow(digest, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids, two bytes each, of every sequence, from its pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return whole.select("sequence_id", "n_tokens", joined.alias("ids"))
