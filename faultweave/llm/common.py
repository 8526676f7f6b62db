"""What several operators share: word patterns, hashing of words, row splits."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"

# A word is a run of anything but the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Words remembered per Python worker.
REMEMBERED = 160_000
# Characters of text handled at once inside a batch; single longer texts are handled alone.
CHUNK_CHARS = 1 << 21


def vocabulary(name: str) -> str:
    """A public tokenizer's file, which lies at the same place on every node.

    FAULTWEAVE_TOKENIZERS names another folder.
    """
    folder = os.environ.get("FAULTWEAVE_TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for texts without words."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def fold_of(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo `modulus`. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


_libc = ctypes.CDLL(None) if os.name == "posix" else None
# Only glibc has it.
_trim = getattr(_libc, "malloc_trim", None)


def release_memory() -> None:
    """Hands back to the system what is free but still held by this process.

    A Python worker runs one task after another, and its allocators keep what each of them freed:
    on pipelines that comes to about 100 MB a worker, beside what the next task takes.
    """
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about CHUNK_CHARS of text, and the texts as UTF-8.

    A null text becomes the empty one. Every row is in exactly one slice. Only the texts of a slice
    exist as Python objects, however large the batch. Free memory goes back to the system before
    the first and after the last.
    """
    release_memory()
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        start = size = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).tolist()):
            if size and size + n > CHUNK_CHARS:
                yield batch.slice(start, i - start), _texts(column, start, i)
                start, size = i, 0
            size += n
        if start < len(column):
            yield batch.slice(start), _texts(column, start, len(column))
    batch = column = None
    release_memory()


def _texts(column: pa.BinaryArray, start: int, end: int) -> list[bytes]:
    return [t or b"" for t in column.slice(start, end - start).to_pylist()]


# Letters, digits and bytes beyond ASCII stay; A-Z are lower-cased; the rest parts words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def folded(text: bytes) -> bytes:
    return text.translate(_FOLD)


def words_folded(text: bytes) -> list[bytes]:
    """Words without case and ASCII punctuation, for models and alignments."""
    return folded(text).split()


# Bytes that stand in words.
_IN_WORD = np.array([c not in b"\t\n\v\f\r " for c in range(256)])


def distinct_words(
    texts: list[bytes],
    fold: Callable[[bytes], bytes] = bytes.lower,
    cut: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """The distinct words of all folded texts, the place among them of each word in a row, and the
    number of words of each text.

    Words are what bytes.split makes of each folded text; `fold` maps single bytes. A text's words
    become no Python objects, so what is asked per word is asked once per distinct word. `cut` gets
    the bytes and which of them stand in words, and may part words further: it returns a kind per
    byte, 0 outside words, and a word ends where the kind changes.
    """
    data = np.frombuffer(fold(b" ".join([b"", *texts, b""])), np.uint8)
    inside = _IN_WORD[data]
    kinds = cut(data, inside) if cut else inside
    edges = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    starts, ends = (edges[0::2], edges[1::2]) if cut is None else (edges[inside[edges]], edges[inside[edges - 1]])
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    words = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    # Each text begins one space after the one before.
    upto = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False), np.diff(upto, prepend=0)


def objects(words: pa.BinaryArray) -> list[bytes]:
    """The words as Python objects; NumPy makes them many times as fast as Arrow."""
    return words.to_numpy(zero_copy_only=False).tolist()


class Memory(dict):
    """Values computed when first asked for, of which the last `most` asked for are remembered.

    The memory has two halves: a full half becomes the old one, and what is asked for again
    moves to the new one. So frequent keys stay, and rare ones go without a search for them.
    """

    def __init__(self, most: int):
        super().__init__()
        self.half, self.old = most // 2, {}

    def compute(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordHashes(Memory):
    """64-bit hash of each word."""

    def compute(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)


_hashes = WordHashes(REMEMBERED)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each text.

    A-Z are lower-cased; bytes.split cuts at just the six ASCII white-space characters.
    """
    return hash_tokens([t.lower().split() for t in texts])


def hash_tokens(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of given words in a row, and the number of words of each text."""
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(split)), np.uint64, int(counts.sum()))
    return flat, counts


def hashes_of(words: pa.BinaryArray) -> np.ndarray:
    """Hashes of distinct words, those that hash_tokens gives."""
    return np.fromiter(map(_hashes.__getitem__, objects(words)), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0x7FB5D329728EA185)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))

