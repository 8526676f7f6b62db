"""Token ids of all documents in files of wavelet matrices, in ascending id order.

`write_store` range-partitions the documents by id, encodes them and writes shards of
about SHARD_TOKENS ids; a document is never split. A shard is one row (place, sizes,
block) of a Parquet table, so Spark's committer discards what a lost or repeated task
leaves behind, and the store may be on any file system that Spark reaches. The block in
a row is the complete compressed file of `wavelet`.

Encoding. A text is cut at ASCII white space, which the vocabulary drops and over which no
token, special string or character composition reaches, so each word is encoded on its
own by the library and remembered per worker. Words of ASCII and Latin letters need no
composing; they are split into runs of letters, digits and runs of other characters, as the
vocabulary does, and go straight to the library's merges.

Defined results: a null or empty text is the end id alone; texts are encoded whole,
special strings in them as the library does by default; null ids sort first; repeated ids
stand beside each other, ordered by text; an empty table gives a store without shards;
further columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faultweave.llm.common import Memory, chunks, distinct_words, objects
from faultweave.llm.wavelet import BITS, WaveletMatrix, build

SHARD_TOKENS = 1 << 20
REMEMBERED = 800_000
# Words of ASCII and Latin letters beyond it, which no composition changes, without apostrophes;
# and what the vocabulary splits them into.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = re.compile(f"[!-&(-~{LATIN}]+")
PIECES = re.compile(f"[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")

# Bytes of words: 1 in letters of PLAIN, 2 in its other characters, 3 where a word may not be parted.
# Letters beyond ASCII have two bytes, the first from C3 to C8; of these ×, ÷ are none, and İ
# lower-cases to two characters.
_KINDS = np.full(256, 3, np.uint8)
_KINDS[0x21:0x7F] = 2
_KINDS[ord("'")] = 3
_KINDS[ord("a") : ord("z") + 1] = _KINDS[0x80:0xC0] = _KINDS[0xC3:0xC9] = 1
_KINDS[list(b"\t\n\v\f\r ")] = 0
_WHOLE = [c.encode() for c in "×÷İ"]
# Every id as its two bytes.
_PAIRS = [struct.pack("<H", i) for i in range(1 << BITS)]


def runs(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Parts lower-cased words into runs of letters and of other characters, for `distinct_words`.

    The vocabulary parts them there as well. Words with apostrophes, or with characters that may be
    composed with others, stay whole.
    """
    kinds = _KINDS[data]
    odd = kinds == 3
    for first, second in _WHOLE:
        odd[1:] |= (data[:-1] == first) & (data[1:] == second)
    if odd.any():
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        whole = np.logical_or.reduceat(odd, edges)[0::2]
        step = np.zeros(len(data), np.int8)
        step[edges[0::2][whole]], step[edges[1::2][whole]] = 1, -1
        kinds[np.cumsum(step, dtype=np.int8) > 0] = 3
    return kinds


STORE = "part int, piece int, n_docs long, n_tokens long, doc_ids binary, null_ids binary, block binary"


class WordIds(Memory):
    """Ids of a lower-cased word as 16-bit little-endian bytes, computed when first asked for."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__(REMEMBERED)
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        if tokenizer.get_vocab_size(with_added_tokens=True) > 1 << BITS:
            raise ValueError("more than 16 bits of ids")
        # A byte's character in the vocabulary: itself where it is printable, else one from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.characters = "".join(chr(256 + hidden.index(b) if b in hidden else b) for b in range(256))

    def _library(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def compute(self, word: bytes) -> bytes:
        lowered = word.decode().lower()
        # Letters of ASCII alone are one run.
        if word.isalpha():
            pieces = [lowered]
        elif PLAIN.fullmatch(lowered):
            pieces = PIECES.findall(lowered)
        else:
            return self._library(word)
        ids = []
        for piece in pieces:
            if not piece.isascii():
                piece = charmap_decode(piece.encode(), "strict", self.characters)[0]
            ids += [_PAIRS[t.id] for t in self.model.tokenize(piece)]
        return b"".join(ids)

    def encode(self, text: bytes) -> bytes:
        # Only a special string is sensitive to case; the library finds it before lower-casing.
        if b"<|" in text:
            return b"".join(map(self._library, text.split()))
        return b"".join(map(self.__getitem__, text.lower().split()))

    def encode_all(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the id `end` after it, and the number of each text's.

        What `encode` gives, but a word is looked up once, however often it stands in the texts, and
        so are its letters where other characters stand around them.
        """
        special = np.array([b"<|" in t for t in texts], bool)
        words, index, counts = distinct_words([b"" if s else t for t, s in zip(texts, special)], cut=runs)
        found = list(map(self.__getitem__, objects(words)))
        # A text with special strings is a word of its own, and so is the end.
        found += [self.encode(t) for t, s in zip(texts, special) if s]
        found.append(struct.pack("<H", end))
        entries = counts + 1 + special
        upto = np.cumsum(entries)
        order = np.full(upto[-1], len(found) - 1)
        order[(upto - 2)[special]] = np.arange(len(words), len(found) - 1)
        own = np.ones(len(order), bool)
        own[upto - 1] = own[(upto - 2)[special]] = False
        order[own] = index
        taken = pa.array(found, pa.large_binary()).take(pa.array(order))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[upto]
        ids = np.frombuffer(taken.buffers()[2], "<u2", ends[-1] // 2)
        return ids, np.diff(ends // 2, prepend=0)


@lru_cache(maxsize=2)
def _ids(path: str) -> WordIds:
    return WordIds(Tokenizer.from_file(path))


def write_store(docs: DataFrame, vocabulary: str, path: str, end_id: int = 1) -> None:
    """Encode all documents and write the store to `path`.

    `vocabulary`: a lower-casing tokenizer file with word-end BPE that drops white space,
    opened by every executor under this path.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _ids(vocabulary)
        part, piece = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        encoded: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(e) // 2 for e in encoded], np.int64)
            block = build(np.frombuffer(b"".join(encoded), "<u2"), lengths)
            number = np.array([i or 0 for i in ids], "<i8").tobytes()
            null = np.packbits(np.array([i is None for i in ids])).tobytes()
            row = (part, piece, len(ids), int(lengths.sum()), number, null, block)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3)
            return pa.record_batch(
                [pa.array([v], k) for v, k in zip(row, kinds)],
                names=["part", "piece", "n_docs", "n_tokens", "doc_ids", "null_ids", "block"],
            )

        for batch, texts in chunks(batches):
            flat, lengths = words.encode_all(texts, end_id)
            data, upto = flat.tobytes(), 2 * np.cumsum(lengths)
            places = zip((upto - 2 * lengths).tolist(), upto.tolist())
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), (data[a:b] for a, b in places)):
                if size and size + len(one) // 2 > SHARD_TOKENS:
                    yield shard()
                    piece += 1
                    ids, encoded, size = [], [], 0
                ids.append(doc_id)
                encoded.append(one)
                size += len(one) // 2
        if ids:
            yield shard()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, STORE).write.parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens and ids_crc32, from the files.

    The running start needs one row per shard in order, a millionth of the tokens.
    """
    store = shards(spark, path)
    order = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = store.select(
        "part", "piece", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("base")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix(row["block"])
                ids, lengths = matrix.ids().astype("<u4"), matrix.lengths
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=row["n_docs"]).astype(bool)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(lengths), row["part"], np.int32)),
                        pa.array(np.full(len(lengths), row["piece"], np.int32)),
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=null),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "piece", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    decoded = store.mapInArrow(
        decode, "part int, piece int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return decoded.join(bases, ["part", "piece"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The id at a position of the whole store; only the shard that holds it is unpacked."""
    order = Window.orderBy("part", "piece")
    ends = shards(spark, path).select("part", "piece", "n_tokens", F.sum("n_tokens").over(order).alias("upto"))
    hit = ends.filter((F.col("upto") > position) & (F.col("upto") - F.col("n_tokens") <= position)).first()
    if hit is None or position < 0:
        raise IndexError(position)
    here = (F.col("part") == hit["part"]) & (F.col("piece") == hit["piece"])
    block = shards(spark, path).filter(here).first()["block"]
    return WaveletMatrix(bytes(block))[position - hit["upto"] + hit["n_tokens"]]


def occurrences(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """How often each of a few tokens stands in the store: token, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix(row["block"])
                yield pa.record_batch(
                    [pa.array(tokens, pa.int32()), pa.array([matrix.count(t) for t in tokens], pa.int64())],
                    names=["token", "n"],
                )

    found = shards(spark, path).mapInArrow(count, "token int, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))
