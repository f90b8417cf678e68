"""Finds passages of benchmark items in documents, also in other words.

*Words* are runs of letters, marks and digits of any script without case, so
other punctuation and capitals make no difference.

*Latent space.*  Words are hashed into ``2 ** FEATURE_BITS`` features weighted
by inverse document frequency over all documents.  The items' passages form a
TF-IDF matrix, and a randomised SVD of it (one power step; every step is a sum
over partitions) gives the ``RANK`` directions in which items differ.

*Candidates.*  Windows of each document are projected and compared with the
items' passages by cosine; the window's norm is that of all its words, so a
long stretch of other text lowers it.  A window whose words hold less than a
share of their weight in features of the items cannot reach the cosine and is
left out by running sums alone.

*Checks.*  A candidate counts if the longest common subsequence of words of
the item and the text around the window covers most of the item, in one piece
or, with a higher share, sentence by sentence in any order; and if the item's
answer (its own, or else its rarest words) is in that text as well.  A run of
``RUN`` words of the item, word for word, counts too, unless an answer that the
item brings along is missing.

The items are the stated queries of a search: they come in blocks of bounded
size, each of which every document is read against; texts are not shuffled.
The latent space is that of all items, so an item's hits do not depend on how
items are dealt into blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.arrays import Words, mix, sequence_hashes, slices, utf8
from docloom.llm.arrays import words as text_words
from docloom.llm.id_filter import without_ids
from docloom.llm.tables import saved

FEATURE_BITS = 18
RANK = 128
OVERSAMPLED = 16
#: Words of a window and of an item's passage, and words between windows.
WINDOW = 12
STRIDE = 4
#: The share of squared weight that a window must hold in items' words, the
#: least cosine, and the least share of an item that must be in the text.
SHARED = 0.4
COSINE = 0.5
COMMON = 0.5
APART = 0.7
ANSWER = 0.5
#: Words in a row that count whatever the rest of the item.
RUN = 13
#: Items read against at a time.
ITEMS = 4096

#: Windows and passages compared in one product, and bytes of text read at a time.
WINDOWS = 1024
PASSAGES = 4096
PIECE = 1 << 20

_NO_WORD = r"[^\p{L}\p{M}\p{N}]+"
_SENTENCE = re.compile(r"(?<=[.!?\u3002])\s+|\n+")
_FEATURES = 1 << FEATURE_BITS
_SHIFT = np.uint64(64 - FEATURE_BITS)


def _plain_words(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """``first row, last row, words`` of texts without case and punctuation,
    about ``PIECE`` bytes of them at a time."""
    texts = pc.fill_null(texts, "")
    for first, last in slices(utf8(texts)[1], PIECE):
        plain = pc.replace_substring_regex(pc.utf8_lower(texts.slice(first, last - first)), _NO_WORD, " ")
        yield first, last, text_words(*utf8(plain))
    pa.default_memory_pool().release_unused()


def _feature(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _SHIFT).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per feature, in blocks, and documents in all (block -1)."""
    counts, docs = np.zeros(_FEATURES, np.int64), 0
    for batch in batches:
        docs += len(batch)
        for _, _, found in _plain_words(batch.column("text")):
            text = np.repeat(np.arange(len(found.offsets) - 1), np.diff(found.offsets))
            once = np.unique(text * _FEATURES + _feature(found.hash))
            counts += np.bincount(once % _FEATURES, minlength=_FEATURES)
    blocks = counts.reshape(-1, 1024)
    used = np.flatnonzero(blocks.any(axis=1))
    rows = [blocks[i].tobytes() for i in used] + [np.array([docs], np.int64).tobytes()]
    yield pa.record_batch(
        [pa.array([*used.tolist(), -1], pa.int32()), pa.array(rows, pa.binary())], names=["block", "counts"]
    )


def _summed(dtype):
    def run(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype) for x in group.column("counts").to_pylist())
        return pa.table({"block": group.column("block")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    return run


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weight of every feature over all documents; 1 MB at any size."""
    sums = docs.select("text").mapInArrow(_frequencies, "block int, counts binary")
    counts, total = np.zeros((_FEATURES // 1024, 1024)), 0
    for row in sums.groupBy("block").applyInArrow(_summed(np.int64), "block int, counts binary").collect():
        values = np.frombuffer(row["counts"], np.int64)
        if row["block"] < 0:
            total = int(values[0])
        else:
            counts[row["block"]] = values
    return np.log((total + 1) / (counts.reshape(-1) + 1)).astype(np.float32) + np.float32(1e-3)


def _passages(found: Words, text: int) -> list[tuple[int, int]]:
    """Windows of an item: all its words are in one of them."""
    begin, end = int(found.offsets[text]), int(found.offsets[text + 1])
    if end - begin <= WINDOW:
        return [(begin, end)] if end > begin else []
    starts = list(range(begin, end - WINDOW, WINDOW // 2)) + [end - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _vector(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    features = np.unique(_feature(hashes))  # a word counts once
    values = idf[features]
    return features, values, float(np.sqrt((values**2).sum()))


def _products(shared):
    """A block of rows A of the TF-IDF matrix -> A' (A M) as sparse rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, right = shared.value
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, last, found in _plain_words(batch.column("text")):
                for i in range(last - first):
                    for begin, end in _passages(found, i):
                        features, values, norm = _vector(found.hash[begin:end], idf)
                        values = values / max(norm, 1e-9)
                        row = values @ _rows(right, features)
                        for f, v in zip(features.tolist(), values.tolist(), strict=True):
                            total[f] = total[f] + v * row if f in total else v * row
        if total:
            yield pa.record_batch(
                [
                    pa.array(list(total), pa.int32()),
                    pa.array([v.astype(np.float64).tobytes() for v in total.values()], pa.binary()),
                ],
                names=["block", "counts"],
            )

    return run


def _rows(right, features: np.ndarray) -> np.ndarray:
    """Rows of the right-hand matrix; at first a random one made by hashing."""
    if isinstance(right, int):
        column = np.arange(1, right + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bits = mix(features.astype(np.uint64)[:, None] * np.uint64(0xD1342543DE82EF95) + column[None, :])
        return np.where(bits & np.uint64(1), 1.0, -1.0)
    index, matrix = right
    return matrix[index[features]]


class Space(NamedTuple):
    """``index`` of a feature into the rows of ``basis``, row 0 being zero.

    A word that no item has weighs in a window as an average word of the items
    at most: rare words in place of an item's would hide all the others."""

    idf: np.ndarray
    index: np.ndarray
    basis: np.ndarray


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Y'Y of rows of Y, summed up."""
    total = None
    for batch in batches:
        if batch.num_rows:
            y = np.stack([np.frombuffer(row, np.float64) for row in batch.column("counts").to_pylist()])
            total = y.T @ y if total is None else total + y.T @ y
    if total is not None:
        yield pa.record_batch(
            [pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "counts"]
        )


def _straightened(turn: np.ndarray):
    """Rows of Y -> rows of an orthonormal basis of its columns' space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(row, np.float64) @ turn for row in batch.column("counts").to_pylist()]
            yield pa.record_batch(
                [batch.column("block"), pa.array([row.astype(np.float32).tobytes() for row in rows], pa.binary())],
                names=["block", "counts"],
            )

    return run


def latent_space(items: DataFrame, idf: np.ndarray, rank: int = RANK) -> Space:
    """Randomised SVD of the TF-IDF passages of all items, summed by partition.

    The tall products have a row per feature and stay in the shared folder; to
    make them orthonormal the driver takes their small Gram matrix apart.  It
    gets the basis as single floats, ``rank`` of them for each of at most
    ``2 ** FEATURE_BITS`` features, however many items there are.
    """
    context = items.sparkSession.sparkContext
    schema = "block int, counts binary"
    width = rank + OVERSAMPLED
    right: object = width
    for _ in range(2):
        shared = context.broadcast((idf, right))
        sums = items.select("text").mapInArrow(_products(shared), schema)
        tall = saved(sums.groupBy("block").applyInArrow(_summed(np.float64), schema), "latent")
        gram = tall.mapInArrow(_gram, schema).groupBy("block").applyInArrow(_summed(np.float64), schema).collect()
        if not gram:
            return Space(idf, np.zeros(_FEATURES, np.int32), np.zeros((1, rank), np.float32))
        values, turn = np.linalg.eigh(np.frombuffer(gram[0]["counts"], np.float64).reshape(width, width))
        order = np.argsort(-values)
        values, turn = values[order], turn[:, order]
        # Directions that the passages do not have, if those are fewer.
        scale = np.where(values > 1e-12 * values[0], 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
        index = np.zeros(_FEATURES, np.int32)
        rows = tall.mapInArrow(_straightened(turn * scale), schema).collect()
        matrix = np.zeros((len(rows) + 1, width), np.float32)
        for i, row in enumerate(sorted(rows, key=lambda row: row["block"]), 1):
            index[row["block"]] = i
            matrix[i] = np.frombuffer(row["counts"], np.float32)
        right = (index, matrix)
    average = np.sqrt(np.mean(idf[index > 0] ** 2))
    weights = np.where(index > 0, idf, np.minimum(idf, average)).astype(np.float32)
    return Space(weights, index, np.ascontiguousarray(matrix[:, :rank]))


class Items(NamedTuple):
    """Items of a block, ready for the search."""

    ids: np.ndarray
    words: list[np.ndarray]  # word hashes of each item
    sentences: list[list[tuple[int, int]]]  # words from, to
    answers: list[np.ndarray]
    required: list[bool]  # the answer is the item's own
    owner: np.ndarray  # item of each passage
    latent: np.ndarray  # passages in the latent space, see ``prepare_items``


def _sentences(text: str) -> list[tuple[int, int]]:
    """Which words of an item are one sentence; short ones join the next."""
    parts = pa.array(_SENTENCE.split(text) or [""], pa.string())
    counts = [int(n) for *_, found in _plain_words(parts) for n in np.diff(found.offsets)]
    out, begin, end = [], 0, 0
    for count in counts:
        end += count
        if end - begin >= 4:
            out.append((begin, end))
            begin = end
    if end > begin:
        out = [*out[:-1], (out[-1][0], end)] if out else [(begin, end)]
    return out


def prepare_items(rows: list, space: Space) -> Items:
    words, sentences, answers, owner, latent = [], [], [], [], []
    for _, _, found in _plain_words(pa.array([row["text"] or "" for row in rows], pa.string())):
        for i in range(len(found.offsets) - 1):
            own = found.hash[found.offsets[i] : found.offsets[i + 1]]
            sentences.append(_sentences(rows[len(words)]["text"] or ""))
            words.append(own)
            rare = np.unique(own)
            order = np.lexsort((rare, -space.idf[_feature(rare)]))
            answers.append(rare[order][: max(1, len(rare) // 4)])
            for begin, end in _passages(found, i):
                features, values, length = _vector(found.hash[begin:end], space.idf)
                vector = values @ space.basis[space.index[features]]
                norm = np.linalg.norm(vector)
                if norm > 1e-9:
                    owner.append(len(words) - 1)
                    # A window with the whole passage and nothing else gets 1,
                    # however little of the passage the space has kept.
                    latent.append(vector / norm * (length / norm))
    required = [False] * len(rows)
    for i, row in enumerate(rows):
        if row["answer"]:
            named = [found.hash for *_, found in _plain_words(pa.array([row["answer"]], pa.string()))]
            if named and len(named[0]):
                answers[i], required[i] = named[0], True
    width = space.basis.shape[1]
    return Items(
        np.array([row["item_id"] for row in rows], np.int64),
        words,
        sentences,
        answers,
        required,
        np.array(owner, np.int64),
        np.array(latent, np.float32).reshape(-1, width),
    )


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by rows of bits."""
    where: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        where[word] = where.get(word, 0) | (1 << i)
    every = (1 << len(a)) - 1
    row = every
    for word in b.tolist():
        met = row & where.get(word, 0)
        row = ((row + met) | (row - met)) & every
    return len(a) - row.bit_count()


def _windows(found: Words, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of the windows worth projecting."""
    feature = _feature(found.hash)
    weight = space.idf[feature].astype(np.float64) ** 2
    total = np.concatenate([[0.0], np.cumsum(weight)])
    own = np.concatenate([[0.0], np.cumsum(weight * (space.index[feature] > 0))])
    counts = np.diff(found.offsets)
    per_text = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    step = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = found.offsets[text] + np.minimum(step * STRIDE, np.maximum(0, counts[text] - WINDOW))
    end = np.minimum(begin + WINDOW, found.offsets[text + 1])
    near = own[end] - own[begin] >= SHARED * (total[end] - total[begin])
    return np.stack([begin, end], axis=1)[near], text[near]


def _projected(found: Words, windows: np.ndarray, space: Space) -> np.ndarray:
    """Windows in the latent space, by the length of all their words."""
    begin, end = windows[:, :1], windows[:, 1:]
    place = begin + np.arange(WINDOW)
    feature = _feature(found.hash[np.minimum(place, end - 1)])
    again = np.tril(feature[:, :, None] == feature[:, None, :], -1).any(axis=2)
    weight = np.where((place < end) & ~again, space.idf[feature], np.float32(0))
    latent = np.einsum("kw,kwr->kr", weight, space.basis[space.index[feature]])
    return latent / np.maximum(np.sqrt((weight**2).sum(axis=1, keepdims=True)), 1e-9)


def _found_in(found: Words, items: Items, space: Space) -> Iterator[tuple[int, int, float, float]]:
    """``text, item, cosine, common`` of the best window of every pair."""
    windows, text = _windows(found, space)
    best: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    for at in range(0, len(windows), WINDOWS):
        part = windows[at : at + WINDOWS]
        latent = _projected(found, part, space)
        for passage in range(0, len(items.latent), PASSAGES):
            cosine = latent @ items.latent[passage : passage + PASSAGES].T
            for i, j in zip(*np.nonzero(cosine >= COSINE), strict=True):
                key = (int(text[at + i]), int(items.owner[passage + j]))
                begin, end = part[i].tolist()
                best.setdefault(key, []).append((float(cosine[i, j]), begin, end))
    for (i, j), hits in best.items():
        reach = len(items.words[j])
        checked, top = -1, (0.0, 0.0)
        for cosine, begin, end in sorted(hits, key=lambda hit: hit[1]):
            if begin < checked:  # inside the text that was compared last
                top = (max(top[0], min(cosine, 1.0)), top[1])
                continue
            low = max(int(found.offsets[i]), begin - reach)
            high = min(int(found.offsets[i + 1]), end + reach)
            checked = begin + reach
            top = (max(top[0], min(cosine, 1.0)), max(top[1], _held(items, j, found.hash[low:high])))
        if top[1] > 0:
            yield i, j, *top


def _held(items: Items, j: int, around: np.ndarray) -> float:
    """The share of an item's words that a text holds; 0 if it does not count."""
    words = items.words[j]
    if np.isin(words, around).sum() < min(COMMON * len(words), RUN):
        return 0.0  # the checks below need more of its words, in order
    answered = bool(np.isin(items.answers[j], around).mean() >= ANSWER)
    if items.required[j] and not answered:
        return 0.0
    common = common_subsequence(words, around) / max(1, len(words))
    if answered and common >= COMMON:
        return common
    if len(words) >= RUN and len(around) >= RUN:
        if np.isin(sequence_hashes(words, RUN), sequence_hashes(around, RUN)).any():
            return common
    if answered and len(items.sentences[j]) > 1:
        parts = [common_subsequence(words[a:b], around) for a, b in items.sentences[j]]
        if sum(parts) >= APART * len(words):
            return sum(parts) / len(words)
    return 0.0


def _searched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, space = (kind(*parts) for kind, parts in zip((Items, Space), shared.value, strict=True))
        for batch in batches:
            ids = batch.column("doc_id")
            rows = []
            for first, _, found in _plain_words(batch.column("text")):
                for i, j, cosine, common in _found_in(found, items, space):
                    rows.append((ids[first + i].as_py(), int(items.ids[j]), cosine, common))
            doc, item, cosine, common = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.record_batch(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(item, pa.int64()),
                    pa.array(cosine, pa.float64()),
                    pa.array(common, pa.float64()),
                ],
                names=["doc_id", "item_id", "cosine", "common"],
            )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, common`` of every document that holds an
    item of ``benchmark(item_id, text[, answer])``.

    ``cosine`` is the best latent one, ``common`` the share of the item's
    words found in order, in one piece or sentence by sentence.  Null and empty texts and items match nothing, rows
    without an id take no part, repeated rows are found each (and told once).
    An empty table gives no rows.  A very long text is read window by window;
    of windows that reach the same text the best counts.  Other columns are
    ignored.
    """
    spark = docs.sparkSession
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    usable = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer")
    )
    usable = saved(usable.distinct(), "benchmark")
    idf = inverse_frequencies(docs)
    blocks = -(-usable.count() // ITEMS)
    found = spark.createDataFrame([], "doc_id long, item_id long, cosine double, common double")
    space = latent_space(usable, idf) if blocks else None
    for block in range(blocks):
        mine = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = mine.orderBy("item_id", "text").collect()  # about ITEMS rows
        shared = spark.sparkContext.broadcast((tuple(prepare_items(rows, space)), tuple(space)))
        hits = docs.mapInArrow(_searched(shared), "doc_id long, item_id long, cosine double, common double")
        found = found.unionAll(saved(hits, "leaks"))
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("common").alias("common"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item; rows without an id stay."""
    leaks = contaminated(docs, benchmark).select("doc_id").distinct()
    return without_ids(docs, saved(leaks, "leaking"))
