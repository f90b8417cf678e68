"""Exact n-gram Jaccard self join that skips by the relations of sets.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets
of word n-grams.  Documents with equal sets form a class at once and only
classes are compared.

*Order.*  All sets are read in one order of n-grams, rare ones first: by the
number of documents that hold an n-gram of the same hash bucket (a table of
fixed size, counted over all documents), then by hash.  Any order gives the
same result; this one keeps what many documents share out of the index.

*Index.*  Only the first ``n - ceil(t * n) + 1`` n-grams of a set of ``n`` can
hold the first one that two linked sets have in common.  They are dealt out
by n-gram into lists; a list of one is dropped.

*Skipping by position.*  Two sets that first meet at positions ``p`` and ``q``
share at most ``min(n - p, m - q)``, which must reach the needed overlap.  A
list is cut into blocks of like size and position; a pair of blocks whose
best bound fails is skipped whole.

*Answers from similar sets.*  The hub of a list is the set that has its n-gram
earliest.  Every set is first compared with the hub it meets in most of its
lists, then with those of its other hubs that are in another group by then.
Sets that link to one hub already are in one group, so a second round only looks at pairs whose
groups differ, and skips those where the overlaps with a common hub leave too
little room.  A group of thousands of near copies thus costs a comparison per
member and hub, not per pair, and no link between groups is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.arrays import batch_words, mix, shingle_sets, slices, utf8
from docloom.llm.arrays import words as text_words
from docloom.llm.id_filter import marked
from docloom.llm.links import components
from docloom.llm.tables import saved

WORDS = 5
PERCENT = 75
#: Hash buckets of the n-gram counts: 4 MB, whatever the size of the corpus.
BUCKET_BITS = 20
#: Lists whose bucket is this many times fuller than the mean are dealt out
#: to several tasks.
HEAVY = 64
SALTS = 16

_COUNT_BLOCK = 512
_SET_SCHEMA = "doc_id long, n int, set_a long, set_b long, block int, counts binary"
_ENTRY_SCHEMA = "token long, salt int, cls long, n int, pos int"
_LIST_SCHEMA = "token long, cls long, n int, pos int, hub long, hub_n int, near boolean"


def _digest(values: np.ndarray) -> tuple[int, int]:
    a = mix(values).sum(dtype=np.uint64)
    b = mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def needed(n: Column, m: Column, percent: int) -> Column:
    """The smallest overlap that links sets of sizes ``n`` and ``m``."""
    both = (n.cast("long") + m.cast("long")) * percent
    return F.ceil(both / (100 + percent))


def _sets_and_counts(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        shift = np.uint64(64 - BUCKET_BITS)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, _, found in batch_words(batch):
                rows, buckets = [], []
                for values in shingle_sets(found, words):
                    rows.append((len(values), *_digest(values)))
                    buckets.append(values >> shift)
                counts += np.bincount(np.concatenate(buckets).astype(np.int64), minlength=len(counts))
                n, a, b = zip(*rows, strict=True)
                size = last - first
                yield pa.record_batch(
                    [
                        ids.slice(first, size).cast(pa.int64()),
                        pa.array(n, pa.int32()),
                        pa.array(a, pa.int64()),
                        pa.array(b, pa.int64()),
                        pa.nulls(size, pa.int32()),
                        pa.nulls(size, pa.binary()),
                    ],
                    names=["doc_id", "n", "set_a", "set_b", "block", "counts"],
                )
        blocks = counts.reshape(-1, _COUNT_BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        if len(used):
            nothing = pa.nulls(len(used), pa.int64())
            yield pa.record_batch(
                [
                    nothing,
                    pa.nulls(len(used), pa.int32()),
                    nothing,
                    nothing,
                    pa.array(used, pa.int32()),
                    pa.array([blocks[i].tobytes() for i in used], pa.binary()),
                ],
                names=["doc_id", "n", "set_a", "set_b", "block", "counts"],
            )

    return run


def _added_up(group: pa.Table) -> pa.Table:
    total = np.zeros(_COUNT_BLOCK, np.int64)
    for counts in group.column("counts").to_pylist():
        total += np.frombuffer(counts, np.int64)
    return pa.table({"block": group.column("block")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _bucket_counts(described: DataFrame) -> np.ndarray:
    """Documents per hash bucket; 8 MB by way of the driver at any size."""
    sums = (
        described.where("block IS NOT NULL").select("block", "counts")
        .groupBy("block").applyInArrow(_added_up, "block int, counts binary")
    )
    counts = np.zeros((1 << BUCKET_BITS) // _COUNT_BLOCK * _COUNT_BLOCK, np.int64).reshape(-1, _COUNT_BLOCK)
    for row in sums.collect():
        counts[row["block"]] = np.frombuffer(row["counts"], np.int64)
    counts = counts.reshape(-1)
    # Only the order matters, so the largest counts are brought down to 32 bits.
    scale = max(1, -(-int(counts.max(initial=0)) // ((1 << 24) - 1)))
    return (counts // scale).astype(np.uint32)


def _prefixes(words: int, percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        shift = np.uint64(64 - BUCKET_BITS)
        heavy = max(8, HEAVY * int(counts.mean()))
        seen: set[int] = set()
        for batch in batches:
            for _, _, _, found in batch_words(batch):
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                for values in shingle_sets(found, words):
                    n = len(values)
                    if not n:
                        continue
                    cls = _digest(values)[0]
                    if cls in seen:  # a copy that this task has dealt out
                        continue
                    seen.add(cls)
                    often = counts[(values >> shift).astype(np.int64)]
                    key = (often.astype(np.uint64) << np.uint64(40)) | (values >> np.uint64(24))
                    prefix = n - -(-percent * n // 100) + 1
                    order = np.argsort(key, kind="stable")[:prefix]
                    out[0].append(values[order].view(np.int64))
                    salt = np.where(often[order] > heavy, 1 + (cls & (SALTS - 1)), 0)
                    out[1].append(salt.astype(np.int32))
                    out[2].append(np.full(prefix, cls, np.int64))
                    out[3].append(np.full(prefix, n, np.int32))
                    out[4].append(np.arange(prefix, dtype=np.int32))
                if len(seen) > 200_000:
                    seen.clear()
                if out[0]:
                    columns = [pa.array(np.concatenate(x)) for x in out]
                    yield pa.record_batch(columns, names=["token", "salt", "cls", "n", "pos"])

    return run


def _lists(percent: int):
    """Sorted index entries -> those of lists that are not alone, with the
    hub of their list.  Rows stream by; one is held back per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        hub = (0, 0, 0, 0)  # token, salt, class and size of the last list's first row
        joined = False  # whether the held row belongs to an earlier row's list

        def emit(rows: list[np.ndarray], final: bool):
            nonlocal held, hub, joined
            token, salt, cls, n, pos = rows
            same = np.zeros(len(token), bool)
            same[1:] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
            same[0] = joined
            followed = np.zeros(len(token), bool)
            followed[:-1] = same[1:]
            lead = np.maximum.accumulate(np.where(same, -1, np.arange(len(token))))
            hub_cls = np.where(lead >= 0, cls[lead], hub[2])
            hub_n = np.where(lead >= 0, n[lead], hub[3])
            hub_pos = np.where(lead >= 0, pos[lead], hub[1])
            need = -(-percent * (n.astype(np.int64) + hub_n) // (100 + percent))
            near = (hub_cls != cls) & (np.minimum(n - pos, hub_n - hub_pos) >= need)
            keep = same | followed | (salt > 0)
            if not final:
                keep[-1] = False
                held = [x[-1:] for x in rows]
                joined = bool(same[-1])
                hub = (0, int(hub_pos[-1]), int(hub_cls[-1]), int(hub_n[-1]))
            if keep.any():
                columns = [token, cls, n, pos, hub_cls.astype(np.int64), hub_n.astype(np.int32), near]
                yield pa.record_batch([pa.array(x[keep]) for x in columns], names=_names(_LIST_SCHEMA))

        for batch in batches:
            rows = [batch.column(name).to_numpy(zero_copy_only=False) for name in _names(_ENTRY_SCHEMA)]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            distinct = np.ones(len(rows[0]), bool)
            distinct[1:] = ~np.logical_and.reduce([x[1:] == x[:-1] for x in rows])
            yield from emit([x[distinct] for x in rows], False)
        if held is not None:
            yield from emit(held, True)

    return run


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _sets_of(ids: pa.Array, texts: pa.Array, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The sets of some texts, each text read once, and which one each row has."""
    _, first, which = np.unique(ids.to_numpy(), return_index=True, return_inverse=True)
    return list(shingle_sets(text_words(*utf8(texts.take(pa.array(first)))), size)), which


def _overlaps(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = utf8(batch.column("text_a"))[1] + utf8(batch.column("text_b"))[1]
            for first, last in slices(sizes):
                piece = batch.slice(first, last - first)
                (sets_a, which_a), (sets_b, which_b) = (
                    _sets_of(piece.column(f"rep_{side}"), piece.column(f"text_{side}"), words) for side in "ab"
                )
                out = []
                for i, j in zip(which_a, which_b, strict=True):
                    x, y = sets_a[i], sets_b[j]
                    at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
                    out.append((len(x), len(y), int((y[at] == x).sum()) if len(y) else 0))
                n_a, n_b, overlap = zip(*out, strict=True)
                yield pa.record_batch(
                    [
                        *[piece.column(name) for name in ("a", "b", "rep_a", "rep_b")],
                        *[pa.array(values, pa.int32()) for values in (n_a, n_b, overlap)],
                    ],
                    names=["a", "b", "rep_a", "rep_b", "n_a", "n_b", "overlap"],
                )

    return run


def _compared(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, label: str) -> DataFrame:
    """Exact overlaps of ``pairs(a, b)`` of classes, from the whole texts.

    Texts travel, not their sets: eight bytes per n-gram that do not compress
    are more than the words.
    """
    a = classes.select(F.col("cls").alias("a"), F.col("rep").alias("rep_a"))
    b = classes.select(F.col("cls").alias("b"), F.col("rep").alias("rep_b"))
    named = saved(pairs.join(a, "a").join(b, "b"), f"{label}-named")
    ids = named.select(F.col("rep_a").alias("rep")).unionAll(named.select(F.col("rep_b").alias("rep")))
    wanted = marked(docs, ids).where("__hit")
    a = wanted.select(F.col("doc_id").alias("rep_a"), F.col("text").alias("text_a"))
    b = wanted.select(F.col("doc_id").alias("rep_b"), F.col("text").alias("text_b"))
    return saved(
        named.join(a, "rep_a").join(b, "rep_b").mapInArrow(
            _overlaps(words), "a long, b long, rep_a long, rep_b long, n_a int, n_b int, overlap int"
        ),
        f"{label}-overlaps",
    )


def _links(compared: DataFrame, percent: int) -> DataFrame:
    linked = compared.where(F.col("overlap") >= needed(F.col("n_a"), F.col("n_b"), percent))
    return linked.select(F.col("rep_a").alias("src"), F.col("rep_b").alias("dst"))


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()


def _labels(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """``cls, label``: the group of every class, its own if it has no link."""
    joined = classes.join(groups, classes["rep"] == groups["vertex"], "left")
    labels = joined.groupBy("cls").agg(F.min(F.coalesce("component", "rep")).alias("label"))
    return saved(labels, "ngram-labels")


def _between_groups(lists: DataFrame, labels: DataFrame, compared: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different groups that may link and are not compared."""
    entries = lists.select("token", "cls", "n", "pos").join(labels, "cls")
    entries = entries.withColumn("rest", F.col("n") - F.col("pos"))
    mixed = entries.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    entries = entries.join(mixed.where("low <> high").select("token"), "token")
    # A block holds one group's entries, or those of all groups that have but
    # one entry in the list, cut by size and by the n-grams left.
    alone = entries.groupBy("token", "label").agg(F.count(F.lit(1)).alias("members"))
    entries = entries.join(alone, ["token", "label"]).withColumn(
        "block",
        F.xxhash64(
            F.when(F.col("members") > 1, F.col("label")),
            F.floor(F.log("n") * 16),
            F.floor(F.log("rest") * 32),
        ),
    )
    entries = saved(entries.select("token", "cls", "label", "n", "rest", "block"), "ngram-blocks")
    blocks = entries.groupBy("token", "block").agg(
        F.min("n").alias("least"),
        F.max("rest").alias("most"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    )
    first, second = blocks.alias("x"), blocks.alias("y")
    kept = first.join(
        second,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.block") <= F.col("y.block"))
        & ((F.col("x.low") != F.col("y.high")) | (F.col("x.high") != F.col("y.low")))
        & (
            F.least("x.most", "y.most")
            >= needed(F.col("x.least"), F.col("y.least"), percent)
        ),
    ).select(F.col("x.token").alias("token"), F.col("x.block").alias("block_a"), F.col("y.block").alias("block_b"))

    def side(name: str) -> DataFrame:
        return entries.select(
            "token",
            F.col("block").alias(f"block_{name}"),
            F.col("cls").alias(name),
            F.col("label").alias(f"label_{name}"),
            F.col("n").alias(f"n_{name}"),
            F.col("rest").alias(f"rest_{name}"),
        )

    a = kept.join(side("a"), ["token", "block_a"])
    b = side("b")
    met = a.join(
        b,
        (a["token"] == b["token"])
        & (a["block_b"] == b["block_b"])
        & (a["label_a"] != b["label_b"])
        & ((a["block_a"] != a["block_b"]) | (a["a"] < b["b"]))
        & (F.least(a["rest_a"], b["rest_b"]) >= needed(a["n_a"], b["n_b"], percent)),
    ).select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    ).distinct()
    known = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    met = met.join(known, ["a", "b"], "left_anti")
    # The hub that a set shares most with bounds what it can share with others.
    sides = compared.select(
        F.col("a").alias("cls"), F.struct("overlap", F.col("b").alias("hub")).alias("best")
    ).unionAll(compared.select(F.col("b").alias("cls"), F.struct("overlap", F.col("a").alias("hub")).alias("best")))
    best = sides.groupBy("cls").agg(F.max("best").alias("best"))
    best_a = best.select(F.col("cls").alias("a"), F.col("best.hub").alias("hub_a"), F.col("best.overlap").alias("with_a"))
    best_b = best.select(F.col("cls").alias("b"), F.col("best.hub").alias("hub_b"), F.col("best.overlap").alias("with_b"))
    bounded = met.join(best_a, "a", "left").join(best_b, "b", "left")
    room = F.least("with_a", "with_b") + F.least(F.col("n_a") - F.col("with_a"), F.col("n_b") - F.col("with_b"))
    hopeless = (F.col("hub_a") == F.col("hub_b")) & (room < needed(F.col("n_a"), F.col("n_b"), percent))
    return bounded.where(~F.coalesce(hopeless, F.lit(False))).select("a", "b")


def ngram_jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable by links.  Null or
    blank texts have no n-grams and link with nothing.  Rows without a
    ``doc_id`` are left out; of rows that repeat a ``doc_id`` each is returned.
    Further columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = saved(docs.mapInArrow(_sets_and_counts(words), _SET_SCHEMA), "ngram-sets")
    sets = described.where("block IS NULL").select("doc_id", "n", "set_a", "set_b")
    classes = saved(
        sets.where("n > 0").groupBy(F.col("set_a").alias("cls"), "set_b").agg(F.min("doc_id").alias("rep")),
        "ngram-classes",
    )
    shared = spark.sparkContext.broadcast(_bucket_counts(described))
    entries = docs.select("text").mapInArrow(_prefixes(words, percent, shared), _ENTRY_SCHEMA)
    ordered = entries.repartition("token", "salt").sortWithinPartitions("token", "salt", "pos", "n", "cls")
    lists = saved(ordered.mapInArrow(_lists(percent), _LIST_SCHEMA), "ngram-lists")

    met = saved(
        lists.where("near").groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("met")), "ngram-hubs"
    )
    best = met.groupBy("cls").agg(F.max(F.struct("met", "hub"))["hub"].alias("hub"))
    compared = _compared(_ordered_pairs(best), docs, classes, words, "ngram-hub")
    links = _links(compared, percent)
    labels = _labels(classes, components(links))

    hubs = labels.select(F.col("cls").alias("hub"), F.col("label").alias("hub_label"))
    others = met.join(labels, "cls").join(hubs, "hub").where("label <> hub_label").select("cls", "hub")
    known = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    others = _ordered_pairs(others).join(known, ["a", "b"], "left_anti")
    again = _compared(others, docs, classes, words, "ngram-others")
    compared = compared.unionAll(again)
    links = links.unionAll(_links(again, percent))
    labels = _labels(classes, components(links))
    rest = saved(_between_groups(lists, labels, compared, percent), "ngram-rest")
    more = _compared(rest, docs, classes, words, "ngram-more")
    final = components(links.unionAll(_links(more, percent)))

    reps = classes.join(final, classes["rep"] == final["vertex"], "left").select(
        F.col("cls").alias("set_a"), "set_b", F.coalesce("component", "rep").alias("component")
    )
    return sets.join(reps, ["set_a", "set_b"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
