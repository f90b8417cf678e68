"""Removes text that repeats, by sliding spans of consecutive sentences.

A sentence ends behind a word that ends in ``.``, ``!`` or ``?``, and before a
line feed.  One of more than ``LONG`` words is also cut behind every word
whose hash is a multiple of ``CUT_EVERY``, so that copies of a passage fall
into the same sentences wherever they begin.  From every sentence on, the
shortest run of at least ``SENTENCES`` sentences and ``WORDS`` words is a
span; its hash of 128 bits ignores case of A-Z and the kind of white space.

Spans meet by their hash.  The first of equal ones, by ``doc_id`` and place,
stays; every sentence that any other one covers goes.  Equal spans are first
counted per task, so a span that is in most documents costs one row per task
where the first is sought; where all are told, adaptive execution splits it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.arrays import Words, batch_words, mix, power_tables
from docloom.llm.tables import saved

SENTENCES = 2
WORDS = 20
LONG = 16
CUT_EVERY = 8

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


class Spans(NamedTuple):
    """``text`` and ``first`` to ``last`` (sentences counted in the text) of
    every span, and its hash; ``begins`` are the first words of sentences and
    ``sentences[i]:sentences[i + 1]`` those of text ``i``."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hash_a: np.ndarray
    hash_b: np.ndarray
    begins: np.ndarray
    sentences: np.ndarray


def spans(data: np.ndarray, found: Words, sentences: int = SENTENCES, words: int = WORDS) -> Spans:
    count = len(found.hash)
    ends = np.zeros(count, bool)
    if count:
        lines = np.zeros(len(data) + 1, np.int32)
        np.cumsum(data == 10, out=lines[1:])
        ends[:] = _ENDS[data[found.end - 1]]
        ends[:-1] |= lines[found.start[1:]] > lines[found.end[:-1]]
        last_words = found.offsets[1:] - 1
        ends[last_words[found.offsets[1:] > found.offsets[:-1]]] = True
        sentence = np.cumsum(ends) - ends
        long = np.bincount(sentence)[sentence] > LONG
        ends |= long & (found.hash % np.uint64(CUT_EVERY) == 0)
    stops = np.flatnonzero(ends) + 1  # behind the last word of each sentence
    begins = np.concatenate([np.zeros(1, np.int64), stops[:-1]]) if count else stops
    of_text = np.searchsorted(begins, found.offsets)
    text = np.searchsorted(found.offsets[1:], begins, "right")
    enough = np.searchsorted(stops, begins + words, "left") + 1
    until = np.maximum(enough, np.arange(len(begins)) + sentences)  # behind the last sentence
    whole = until <= of_text[1:][text] if count else np.zeros(0, bool)
    start = np.flatnonzero(whole)
    until, text = until[start], text[start]
    power, inverse = power_tables(count + 1)

    def hashed(values: np.ndarray) -> np.ndarray:
        total = np.zeros(count + 1, np.uint64)
        np.cumsum(values * power[:count], out=total[1:])
        return mix((total[stops[until - 1]] - total[begins[start]]) * inverse[begins[start]]).view(np.int64)

    a, b = hashed(found.hash), hashed(mix(found.hash ^ np.uint64(0x632BE59BD9B4E019)))
    return Spans(text, start - of_text[text], until - of_text[text], a, b, begins, of_text)


def _spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for first, _, data, found in batch_words(batch):
            got = spans(data, found)
            yield pa.record_batch(
                [
                    pa.array(got.hash_a),
                    pa.array(got.hash_b),
                    pa.array(ids[first + got.text]),
                    pa.array(got.first.astype(np.int32)),
                ],
                names=["hash_a", "hash_b", "doc_id", "place"],
            )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, place, hash_a, first_doc_id`` of every span that is not the
    first of its kind; ``place`` is the sentence it begins with."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = texts.mapInArrow(_spans_of, "hash_a long, hash_b long, doc_id long, place int")
    firsts = every.groupBy("hash_a", "hash_b").agg(
        F.min(F.struct("doc_id", "place")).alias("kept"), F.count(F.lit(1)).alias("copies")
    )
    firsts = saved(firsts.where("copies > 1").select("hash_a", "hash_b", "kept"), "span-firsts")
    met = every.join(firsts, ["hash_a", "hash_b"])
    others = met.where((F.col("doc_id") != F.col("kept.doc_id")) | (F.col("place") != F.col("kept.place")))
    return others.select("doc_id", "place", "hash_a", F.col("kept.doc_id").alias("first_doc_id"))


def _cleaned(names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removals = batch.column("__spans").to_pylist()
            old = batch.column(batch.schema.get_field_index(text))
            new = old.to_pylist() if any(removals) else None
            total, gone = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for first, last, data, found in batch_words(batch, text):
                got = spans(data, found)
                total[first:last] = np.diff(got.sentences)
                at = np.searchsorted(got.text, np.arange(last - first + 1))
                for i in range(first, last):
                    if not removals[i]:
                        continue
                    mine = slice(at[i - first], at[i - first + 1])
                    begins, hashes = got.first[mine], got.hash_a[mine]
                    drop = np.zeros(total[i], bool)
                    for span in removals[i]:
                        j = int(np.searchsorted(begins, span["place"]))
                        if j < len(begins) and begins[j] == span["place"] and hashes[j] == span["hash_a"]:
                            drop[begins[j] : got.last[mine][j]] = True
                    heads = got.begins[got.sentences[i - first] : got.sentences[i - first + 1]]
                    edges = found.start[heads].tolist()
                    edges[0] = int(found.bounds[i - first])
                    edges.append(int(found.bounds[i - first + 1]))
                    gone[i] = drop.sum()
                    new[i] = b"".join(
                        data[edges[k] : edges[k + 1]].tobytes() for k in np.flatnonzero(~drop).tolist()
                    ).decode()
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            if new is not None:
                columns[text] = pa.array(new, old.type)
            yield pa.record_batch(
                [*[columns[name] for name in names], pa.array(total), pa.array(gone)],
                names=[*names, "n_sentences", "n_removed"],
            )

    return run


def drop_repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated sentences gone from ``text``, and
    ``n_sentences`` (before), ``n_removed`` and ``first_doc_ids`` (the
    documents that hold what was removed, sorted; null if nothing was).

    All columns of ``docs`` stay; one named like an added column is replaced.
    A null text stays null; a text of which everything goes is empty.  Rows
    without a ``doc_id`` take no part and stay as they are.  Rows that repeat
    a ``doc_id`` count as one document, within which a span counts once.
    """
    spans_of = repeated_spans(docs).groupBy(F.col("doc_id").alias("__doc_id")).agg(
        F.collect_set(F.struct("place", "hash_a")).alias("__spans"),
        F.sort_array(F.collect_set("first_doc_id")).alias("first_doc_ids"),
    )
    spans_of = saved(spans_of, "span-removals")
    kept = [c for c in docs.columns if c not in ("n_sentences", "n_removed", "first_doc_ids")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    joined = rows.join(spans_of, rows["doc_id"].cast("long") == spans_of["__doc_id"], "left").drop("__doc_id")
    names = [*kept, "first_doc_ids"]
    fields = [f for f in joined.schema.fields if f.name in names]
    counts = [T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())]
    return joined.mapInArrow(_cleaned(names, "text"), T.StructType([*fields, *counts]))
