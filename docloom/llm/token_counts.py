"""Token counts of whole texts with a public tokenizer.

The tokenizer runs inside Arrow functions that return lengths only.  A batch
is as many texts as make up a given number of bytes, whatever their count.

Texts are split where the tokenizer's own pre-tokenizer always splits: before
a single space between two characters that are no white space.  There a match
of its pattern ends and the next one begins with the space, and no special
string holds a space.  So the count of a text is the sum of the counts of its
parts, a long text needs no more memory than a short one, and a part that
occurs again (words do) is encoded once per task.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
BATCH_BYTES = 1 << 20
#: Parts remembered by a task, and the longest part worth remembering.
KEPT_PARTS = 400_000
KEPT_LENGTH = 64

_SAFE = re.compile(r"(?<=\S) (?=\S)")
_UNSAFE = re.compile(r"(?:^|\s) | (?:\s|$)")


def split_long(text: str, limit: int) -> Iterator[str]:
    """Pieces of about ``limit`` characters, cut at safe boundaries only."""
    begin = 0
    while len(text) - begin > limit:
        cut = _SAFE.search(text, begin + limit)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def parts(text: str) -> tuple[str, list[str]]:
    """The text up to its first safe boundary, and the parts behind the
    others without the space each of them begins with."""
    # A piece of a long text begins with a space that is a safe boundary.
    led = text[:1] == " " and not text[1:2].isspace() and len(text) > 1
    body = text[1:] if led else text
    found = body.split(" ") if _UNSAFE.search(body) is None else _SAFE.split(body)
    return ("", found) if led else (found[0], found[1:])


class Counter:
    """Counts tokens; remembers the counts of short parts."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.heads: dict[str, int] = {}
        self.tails: dict[str, int] = {}

    def _learn(self, known: dict[str, int], lead: str, found: Iterable[str]) -> None:
        new = [part for part in found if part not in known]
        encoded = self.tokenizer.encode_batch_fast([lead + part for part in new], add_special_tokens=False)
        known.update(zip(new, map(len, encoded), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        split = [parts(text) for text in texts]
        if len(self.heads) + len(self.tails) > KEPT_PARTS:
            self.heads, self.tails = {}, {}
        self._learn(self.heads, "", {head for head, _ in split})
        self._learn(self.tails, " ", set().union(*(tail for _, tail in split)))
        counts = [self.heads[head] + sum(map(self.tails.__getitem__, tail)) for head, tail in split]
        for known in (self.heads, self.tails):
            for part in [part for head, tail in split for part in (head, *tail) if len(part) > KEPT_LENGTH]:
                known.pop(part, None)
        return counts


def _batches(texts: pa.Array, limit: int) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and pieces of about ``limit`` bytes in all."""
    rows: list[int] = []
    pieces: list[str] = []
    held = 0
    for row, text in enumerate(texts):
        for piece in split_long(text.as_py() or "", limit):
            rows.append(row)
            pieces.append(piece)
            held += len(piece)
            if held >= limit:
                yield rows, pieces
                rows, pieces, held = [], [], 0
    if pieces:
        yield rows, pieces


def _counted(tokenizer: str, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        import public_tokenizers
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(
            tokenizer if os.path.isabs(tokenizer) else public_tokenizers.path(tokenizer)
        )
        loaded.no_truncation()
        loaded.no_padding()
        counter = Counter(loaded)
        for batch in batches:
            texts = batch.column("text")
            tokens = np.zeros(len(texts), np.int64)
            for rows, pieces in _batches(texts, batch_bytes):
                np.add.at(tokens, rows, counter.count(pieces))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens)],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of ``docs(doc_id, text)``.

    A null text is empty and has no tokens.  Every row is returned, also
    repeated ones and those without an id; further columns are ignored.
    ``tokenizer`` is a path or the name of a public tokenizer's file.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    counted = texts.mapInArrow(_counted(tokenizer, batch_bytes), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
