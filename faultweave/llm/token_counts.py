"""Token counts of whole texts under a byte-level BPE vocabulary.

Before any text is seen, every vocabulary string is run through the merges once. The
strings that come out as one token are the whole tokens: a pre-token equal to one of them
counts as one without merging. Only the remaining pre-tokens are merged, each once per
worker as long as it is remembered.

Exactness. Texts are cut in front of each run of white space. The vocabulary's pre-token
pattern never matches from a non-space character into white space, and what it matches
after such a cut does not depend on what stands before, so counts of the pieces add up.
The one exception are white-space characters beyond ASCII, about which the regular
expressions of different libraries disagree; texts with them are encoded whole.

Defined results: a null or empty text has no tokens; texts of any length are counted
whole; repeated ids give repeated rows; an empty table gives no rows; further columns
are ignored. A special string inside a text is one token, the library's default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

REMEMBERED = 1_000_000

PIECE = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]")


class PieceCounts(dict):
    """Tokens per piece of text, computed when first asked for."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.whole = whole_tokens(tokenizer)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = 0
        for pre_token, _ in self.split(piece):
            count += 1 if pre_token in self.whole else len(self.model.tokenize(pre_token))
        self[piece] = count
        return count

    def count(self, text: str) -> int:
        if OTHER_SPACE.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.special.split(text)
        total = len(parts) - 1
        for part in parts:
            total += sum(map(self.__getitem__, PIECE.findall(part)))
        return total


def whole_tokens(tokenizer: Tokenizer) -> frozenset[str]:
    """Vocabulary strings that the merges turn into exactly their own token."""
    model = tokenizer.model
    found = []
    for string, number in tokenizer.get_vocab(with_added_tokens=False).items():
        tokens = model.tokenize(string)
        if len(tokens) == 1 and tokens[0].id == number:
            found.append(string)
    return frozenset(found)


@lru_cache(maxsize=2)
def _counts(path: str) -> PieceCounts:
    return PieceCounts(Tokenizer.from_file(path))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document.

    `vocabulary` is a tokenizer file that every executor can open under this path. It must
    hold a byte-level BPE without normaliser.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        for batch in batches:
            tokens = [counts.count(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "text", n_bytes.alias("n_bytes"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
