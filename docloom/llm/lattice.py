"""Language-model scores by marginal likelihood over subword segmentations.

The pieces are those of an existing vocabulary.  Its scores give every piece a
first weight; one round of expectation and maximisation over all training
words then re-weights them: the expected number of uses of a piece, over all
segmentations of every training word, becomes its probability.

A text is its words, each led by the vocabulary's word mark, and an end.  No
piece reaches over a word mark, so the sum over all segmentations of a text is
the product of those of its words, and each distinct word of the corpus is
scored once: a forward recursion in log space over the lattice of its pieces.
A character without a piece is spelled by the byte pieces.

Words meet their scores in two ways with the same outcome: those of the
``FREQUENT`` most frequent ones are looked up while a text is read, the rest
by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.arrays import Words, batch_words, utf8, words
from docloom.llm.tables import saved

VOCABULARY = "piece_bpe_32k.model"
FOLDS = 7
HELD_OUT = 2
FREQUENT = 1 << 18
#: Uses the vocabulary's own scores count for, per piece, against the corpus.
PRIOR = 1.0
MARK = "▁"
_LN10 = log(10)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def held_out() -> Column:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


# --- distinct words and their counts ---------------------------------------


def _gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words at ``start:end`` as texts, A-Z folded."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)])
    index = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    chars = _LOWER[data[index]]
    return pa.Array.from_buffers(
        pa.large_string(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(chars)]
    ).cast(pa.string())


def _merged(hashes: list[np.ndarray], counts: list[np.ndarray], texts: list[pa.Array]):
    joined = np.concatenate(hashes)
    unique, first, where = np.unique(joined, return_index=True, return_inverse=True)
    total = np.bincount(where, np.concatenate(counts), minlength=len(unique)).astype(np.int64)
    return unique, total, pa.concat_arrays(texts).take(pa.array(first))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, uses`` per task; uses in documents held out count 0."""
    held: list = [[], [], []]
    size = 0

    def flush():
        _, total, texts = _merged(*held)
        for part in held:
            part.clear()
        return pa.record_batch([texts, pa.array(total)], names=["word", "uses"])

    for batch in batches:
        train = batch.column("train").to_numpy(zero_copy_only=False)
        for first, last, data, found in batch_words(batch):
            weight = np.repeat(train[first:last].astype(np.int64), np.diff(found.offsets))
            unique, at, where = np.unique(found.hash, return_index=True, return_inverse=True)
            held[0].append(unique)
            held[1].append(np.bincount(where, weight, minlength=len(unique)).astype(np.int64))
            held[2].append(_gathered(data, found.start[at], found.end[at]))
            size += len(unique)
            if size > 1_000_000:
                merged = _merged(*held)
                for part, value in zip(held, merged, strict=True):
                    part[:] = [value]
                size = len(merged[0])
                if size > 700_000:
                    yield flush()
                    size = 0
    if held[0]:
        yield flush()


# --- pieces ----------------------------------------------------------------


def vocabulary(path: str = VOCABULARY) -> tuple[list[str], np.ndarray]:
    """Pieces and their first probabilities.

    The scores of a unigram vocabulary are log-probabilities.  Those of one
    made by merging are ranks (0, -1, -2, ...), which stand for a Zipf law;
    control pieces are left out, bytes rank last."""
    import os

    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=path if os.path.isabs(path) else public_tokenizers.path(path)
    )
    pieces, scores = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        pieces.append(model.id_to_piece(i))
        scores.append(-float(model.get_piece_size()) if model.is_byte(i) else model.get_score(i))
    values = np.array(scores)
    ranked = np.all(values == np.rint(values))
    weights = 1 / (1 - np.maximum(values, -1e9)) if ranked else np.exp(values)
    return pieces, weights / weights.sum()


class Lattice:
    """Segmentations of words by pieces of given natural log-probabilities."""

    def __init__(self, pieces: list[str], weights: np.ndarray):
        self.weights = weights.tolist()
        self.index = {piece: i for i, piece in enumerate(pieces)}
        self.prefixes = {piece[:k] for piece in pieces for k in range(1, len(piece) + 1)}
        self.bytes = [self.index.get(f"<0x{b:02X}>") for b in range(256)]

    def arcs(self, word: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For every end in the word: where an arc begins, its pieces, weight."""
        out: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(len(word) + 1)]
        index, prefixes, weights = self.index, self.prefixes, self.weights
        for begin in range(len(word)):
            spelled = False
            end = begin + 1
            while end <= len(word):
                part = word[begin:end]
                if part not in prefixes:
                    break
                i = index.get(part)
                if i is not None:
                    out[end].append((begin, (i,), weights[i]))
                    spelled = spelled or end == begin + 1
                end += 1
            if not spelled:
                ids = tuple(self.bytes[b] for b in word[begin].encode())
                out[begin + 1].append((begin, ids, sum(weights[i] for i in ids)))
        return out

    def forward(self, arcs) -> list[float]:
        alpha = [0.0] * len(arcs)
        for end in range(1, len(arcs)):
            total = None
            for begin, _, weight in arcs[end]:
                value = alpha[begin] + weight
                if total is None:
                    total = value
                elif value > total:
                    total = value + log1p(exp(total - value))
                else:
                    total += log1p(exp(value - total))
            alpha[end] = total
        return alpha

    def log_probability(self, word: str) -> float:
        """Sum over all segmentations of ``word``, led by the word mark."""
        return self.forward(self.arcs(MARK + word))[-1]

    def add_uses(self, word: str, times: float, uses: np.ndarray) -> None:
        """Adds the expected uses of every piece in ``times`` words."""
        arcs = self.arcs(MARK + word)
        alpha = self.forward(arcs)
        share = [0.0] * len(arcs)  # how often segmentations pass a place
        share[-1] = times
        for end in range(len(arcs) - 1, 0, -1):
            if share[end] < 1e-12:
                continue
            for begin, ids, weight in arcs[end]:
                part = share[end] * exp(alpha[begin] + weight - alpha[end])
                share[begin] += part
                for i in ids:
                    uses[i] += part


def _expected(pieces: list[str], weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, uses = Lattice(pieces, weights), np.zeros(len(pieces))
        for batch in batches:
            for word, times in zip(batch.column("word").to_pylist(), batch.column("uses").to_pylist(), strict=True):
                lattice.add_uses(word, times, uses)
        used = np.flatnonzero(uses)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(uses[used])], names=["piece", "uses"])

    return run


def _scored(pieces: list[str], weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, weights)
        for batch in batches:
            values = [lattice.log_probability(word) / _LN10 for word in batch.column("word").to_pylist()]
            yield pa.record_batch(
                [batch.column("word"), batch.column("uses"), pa.array(values, pa.float64())],
                names=["word", "uses", "lattice"],
            )

    return run


# --- documents -------------------------------------------------------------

_PARTS = "row long, doc_id long, held_out boolean, tokens long, known long, base double, lattice double, word string, times long"


def _looked_up(shared):
    """For every text what its frequent words add up to, and its other words
    with their number (rows with a ``word``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known, base, lattice = shared.value
        for batch in batches:
            for first, last, data, found in batch_words(batch):
                size = last - first
                text = np.repeat(np.arange(size), np.diff(found.offsets))
                at = np.minimum(np.searchsorted(hashes, found.hash), max(0, len(hashes) - 1))
                hit = hashes[at] == found.hash if len(hashes) else np.zeros(len(at), bool)
                at, of = at[hit], text[hit]
                rows = batch.slice(first, size)
                yield pa.record_batch(
                    [
                        rows.column("row"),
                        rows.column("doc_id"),
                        rows.column("held_out"),
                        pa.array(np.diff(found.offsets)),
                        pa.array(np.bincount(of, known[at], minlength=size).astype(np.int64)),
                        pa.array(np.bincount(of, base[at], minlength=size).astype(np.float64)),
                        pa.array(np.bincount(of, lattice[at], minlength=size).astype(np.float64)),
                        pa.nulls(size, pa.string()),
                        pa.nulls(size, pa.int64()),
                    ],
                    names=_names(),
                )
                yield from _others(found, data, text, np.flatnonzero(~hit), rows)

    return run


def _others(found: Words, data: np.ndarray, text: np.ndarray, misses: np.ndarray, rows: pa.RecordBatch):
    if not len(misses):
        return
    order = misses[np.lexsort((found.hash[misses], text[misses]))]
    new = np.ones(len(order), bool)
    new[1:] = (found.hash[order][1:] != found.hash[order][:-1]) | (text[order][1:] != text[order][:-1])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(order)))
    at = order[heads]
    count = len(at)
    yield pa.record_batch(
        [
            rows.column("row").take(pa.array(text[at])),
            pa.nulls(count, pa.int64()),
            pa.nulls(count, pa.bool_()),
            pa.nulls(count, pa.int64()),
            pa.nulls(count, pa.int64()),
            pa.nulls(count, pa.float64()),
            pa.nulls(count, pa.float64()),
            _gathered(data, found.start[at], found.end[at]),
            pa.array(times.astype(np.int64)),
        ],
        names=_names(),
    )


def _names() -> list[str]:
    return [field.split()[0] for field in _PARTS.split(", ")]


def lattice_scores(docs: DataFrame, path: str = VOCABULARY, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of whole texts, their end included.  A null
    or empty text is its end alone.  Rows without an id are learned from;
    repeated rows are learned from and scored each.  Other columns are
    ignored.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out())
    counted = docs.select("text", (~F.col("held_out")).alias("train"))
    every = saved(
        counted.mapInArrow(_word_counts, "word string, uses long").groupBy("word").agg(F.sum("uses").alias("uses")),
        "lattice-words",
    )
    sizes = every.agg(
        F.coalesce(F.sum("uses"), F.lit(0)).alias("n"), F.count_if(F.col("uses") > 0).alias("v")
    ).first()
    ends = docs.where(~F.col("held_out")).count()
    train_tokens, distinct = sizes["n"] + ends, sizes["v"] + (ends > 0)

    pieces, first = vocabulary(path)
    expected = every.where("uses > 0").mapInArrow(_expected(pieces, np.log(first)), "piece int, uses double")
    uses = np.zeros(len(pieces))
    for row in expected.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
        uses[row["piece"]] = row["uses"]
    strength = PRIOR * len(pieces)
    total = uses.sum() + ends + strength + 1
    weights = np.log((uses + strength * first) / total)
    end_score = log((ends + 1) / total) / _LN10

    scored = saved(every.mapInArrow(_scored(pieces, weights), "word string, uses long, lattice double"), "lattice-scores")
    ground = float(train_tokens + distinct + 1)
    scored = scored.select(
        "word",
        "uses",
        "lattice",
        F.log10((F.col("uses") + 1) / F.lit(ground)).alias("base"),
        (F.col("uses") > 0).cast("long").alias("known"),
    )
    top = scored.where("uses > 0").orderBy(F.col("uses").desc(), "word").limit(frequent)
    shared = spark.sparkContext.broadcast(_table(top))
    lookups = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    parts = saved(lookups.mapInArrow(_looked_up(shared), _PARTS), "lattice-parts")
    others = parts.where("word IS NOT NULL").select("row", "word", "times").join(
        scored.select("word", F.col("known").alias("k"), F.col("base").alias("b"), F.col("lattice").alias("l")), "word"
    )
    others = others.groupBy("row").agg(
        F.sum(F.col("times") * F.col("k")).alias("k"),
        F.sum(F.col("times") * F.col("b")).alias("b"),
        F.sum(F.col("times") * F.col("l")).alias("l"),
    )
    whole = parts.where("word IS NULL").join(others, "row", "left")
    base_end = log((ends + 1) / ground) / _LN10
    return whole.select(
        "doc_id",
        "held_out",
        (F.col("tokens") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("k", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0)) + F.lit(base_end)).alias("base_score"),
        (F.col("lattice") + F.coalesce("l", F.lit(0.0)) + F.lit(end_score)).alias("score"),
    )


def _table(top: DataFrame) -> tuple[np.ndarray, ...]:
    """The frequent words' hashes in order, and what each adds."""
    rows = top.toArrow().combine_chunks()
    if not rows.num_rows:
        return np.zeros(0, np.uint64), *[np.zeros(0)] * 3
    found = words(*utf8(rows.column("word")))
    order = np.argsort(found.hash)
    return found.hash[order], *[
        pc.cast(rows.column(name), pa.float64()).to_numpy()[order] for name in ("known", "base", "lattice")
    ]
