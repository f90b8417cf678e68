"""Mixing sources to target weights along a time-varying curriculum.

Sizes are words.  Sources get weights by rank of their name and share the
whole by weight; none gets more than ``most`` times what it has, and what is
left over is shared again among the others.  Sorted by the weight at which a
source reaches its bound, the bounded sources are a head of the list, so the
end of the repeated sharing is found from running sums, with integers.

A source's documents follow one another in a fixed shuffled order, again and
again, as a stream of words; the target says how far the stream is read.  Its
share of the training changes over time: the weight schedule of a source is
``target * (1 + a * (1 - 2 * t))`` for ``t`` from 0 to 1, whose integral is
``target * (t + a * t - a * t * t)``.  A document that stands at some part of
its source's stream is trained on when the integral has reached that part:
the inverse gives its position.  Documents sorted by position are the mix.

Only built-in expressions are used.  Running sums are taken by blocks of the
shuffled order, so a source with most of the documents is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, lcm, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.llm.tables import saved
from docloom.operators.ordering import running_totals

WEIGHTS = (5, 2, 1)
MOST = 3
#: Slope of the schedule for each weight: the first sources' share falls over
#: time, the last ones' share rises.
SLOPES = (0.5, 0.0, -0.5)

WORD = r"[^ \t-\r]+"


def _pick(rank: Column, values: Sequence[float]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """``source, rank, source_size, before, target`` of ``sized(source, size)``;
    ``before`` is the size of all sources that sort earlier."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = [F.col("source").asc_nulls_last()]
    ranked = running_totals(sources, by_name, {"rank": F.lit(1), "before": F.col("source_size")})
    ranked = ranked.withColumn("weight", _pick(F.col("rank"), weights).cast("long"))
    bound = F.col("source_size") * most
    fills_at = bound * F.lit(lcm(*weights)) / F.col("weight")
    ordered = running_totals(
        ranked.withColumn("_fills_at", fills_at),
        [F.col("_fills_at"), *by_name],
        {"_bound_before": bound, "_weight_before": F.col("weight")},
    )
    ordered = saved(ordered, "mix-sources")
    wide = "decimal(38,0)"
    totals = ordered.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weight = totals["size"] or 0, totals["weight"] or 0
    bounded = bound.cast(wide) * (F.lit(weight) - F.col("_weight_before")).cast(wide) <= F.col("weight").cast(
        wide
    ) * (F.lit(size) - F.col("_bound_before")).cast(wide)
    ordered = ordered.withColumn("_bounded", bounded)
    kept = ordered.where("_bounded").agg(F.sum(bound).alias("size"), F.sum("weight").alias("weight")).first()
    left, shared = size - (kept["size"] or 0), weight - (kept["weight"] or 0)
    shares = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(max(shared, 1)))
    target = F.when(F.col("_bounded"), bound.cast("double")).otherwise(shares)
    return ordered.select("source", "rank", "source_size", "before", target.alias("target"))


def _position(part: Column, slope: Column) -> Column:
    """The time at which the integral of the schedule reaches ``part``."""
    root = F.sqrt((1 + slope) * (1 + slope) - 4 * slope * part)
    return F.when(slope == 0, part).otherwise((1 + slope - root) / (2 * slope))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    """``more`` and, of every row, ``__id, __source, __size`` and the place in
    its source's stream: ``__hash, __key``, then ``__tie``.

    The hash is of the id as text, for a row without an id of its text, so that
    such rows are spread as well.  Only rows alike in all columns share a place;
    they may stand for each other.
    """
    alike = [
        F.to_json(F.struct(f"`{c}`")) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes if c not in ADDED
    ]
    number = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        *more,
        number.alias("__id"),
        F.col("source").cast("string").alias("__source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("__size"),
        F.md5(F.coalesce(number.cast("string"), F.concat(F.lit("no id "), text))).alias("__hash"),
        F.coalesce(number, F.lit(0)).cast("long").alias("__key"),
        F.xxhash64(*alike).alias("__tie"),
    )


PLACE = ("__hash", "__key", "__size", "__tie")
#: Columns of the mix beside those of the documents.
ADDED = ("copy", "position", "words")


def _block(digits: int) -> Column:
    """Rows by the first hexadecimal digits of their hash: a source of any size
    falls into blocks of about the same number of rows."""
    return F.substring("__hash", 1, digits).alias("__block")


def _streams(sized: DataFrame, digits: int = 3) -> DataFrame:
    """Adds ``occurrence`` among rows of one source and id, from 1; ``__start``,
    the words of all earlier rows of the source; ``__alike``, the number of rows
    that share the place.

    The totals of the blocks of a source, 16 ** ``digits`` at most, are added up
    in one window, rows inside their block in another.
    """
    blocked = sized.select("*", _block(digits))
    totals = blocked.groupBy("__source", "__block").agg(F.sum("__size").alias("__words"))
    earlier = Window.partitionBy("__source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("__source").alias("__of"),
        F.col("__block").alias("__at"),
        F.coalesce(F.sum("__words").over(earlier), F.lit(0)).alias("__offset"),
    )
    inside = Window.partitionBy("__source", "__block").orderBy(*PLACE)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    same_id = Window.partitionBy("__source", "__block", "__hash", "__key").orderBy("__size", "__tie")
    same_place = Window.partitionBy("__source", "__block", *PLACE)
    summed = blocked.withColumn("__inside", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    summed = summed.withColumn("occurrence", F.row_number().over(same_id))
    summed = summed.withColumn("__alike", F.count(F.lit(1)).over(same_place))
    same_block = summed["__source"].eqNullSafe(offsets["__of"]) & (summed["__block"] == offsets["__at"])
    return summed.join(offsets, same_block).select(
        *sized.columns,
        "occurrence",
        "__alike",
        (F.col("__offset") + F.col("__inside")).alias("__start"),
    )


def _copy(begin: Column, size: Column, slopes: Sequence[float]) -> Column:
    """``words, position`` of a copy that begins after ``begin`` words of its
    source's stream; needs the source's ``target`` and ``rank``."""
    words = F.greatest(F.least(F.floor("target") - begin, size), F.lit(0))
    middle = F.try_divide(begin + words / F.lit(2.0), F.col("target"))  # no target, no copy
    return F.struct(words.alias("words"), _position(middle, _pick(F.col("rank"), slopes)).alias("position"))


def _placed(docs: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Every row's place in its stream beside its source's target."""
    sized = saved(_sized(docs), "mix-sizes")
    targets = source_targets(sized.select(F.col("__source").alias("source"), F.col("__size").alias("size")), weights, most)
    targets = targets.drop("before")
    streams = _streams(sized)
    return streams.join(targets, streams["__source"].eqNullSafe(targets["source"]))


def curriculum_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    slopes: Sequence[float] = SLOPES,
) -> DataFrame:
    """``doc_id, occurrence, source, size, source_size, target, taken, copies``.

    ``copies`` holds the ``words`` taken of a document and the training time
    (``position``, from 0 to 1) for each time it is taken: never for one that
    the target leaves out, ``most`` times at most.  Copies are whole but for
    the last one of a source, of which the first ``words`` words fill up the
    target; ``taken`` is their sum, so a source gives its target rounded down.
    A null or empty text has size 0 and takes nothing; a null source sorts
    last; rows of a source that repeat a ``doc_id`` are told apart by
    ``occurrence``.  Other columns, whatever their names, are ignored.
    """
    rounds = F.array(*[F.lit(i) for i in range(most)])
    copies = F.transform(
        rounds, lambda i: _copy(F.col("__start") + i * F.col("source_size"), F.col("__size"), slopes)
    )
    placed = _placed(docs, weights, most).withColumn("copies", F.filter(copies, lambda c: c["words"] > 0))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["words"])
    return placed.select(
        F.col("__id").alias("doc_id"),
        "occurrence",
        "source",
        F.col("__size").alias("size"),
        "source_size",
        "target",
        taken.alias("taken"),
        "copies",
    )


#: Words of a cell of the training time, about 50 MB of text.
CELL_WORDS = 8_000_000
#: Cuts that are broadcast, about 100 bytes each; more are joined by a shuffle.
BROADCAST_CUTS = 500_000


def _celled(placed: DataFrame, cells: int, most: int, slopes: Sequence[float]) -> DataFrame:
    """A row per copy: ``__copy, __begin, __cell``, without a cell if not taken."""
    rounds = F.array(*[F.lit(i) for i in range(most)])
    copies = placed.where("__size > 0").select("*", F.explode(rounds).alias("__copy"))
    copies = copies.withColumn("__begin", F.col("__start") + F.col("__copy") * F.col("source_size"))
    copies = copies.withColumn("__taken", _copy(F.col("__begin"), F.col("__size"), slopes))
    cell = F.least(F.floor(F.col("__taken.position") * cells), F.lit(cells - 1)).cast("int")
    return copies.withColumn("__cell", F.when(F.col("__taken.words") > 0, cell)).drop("__taken")


def _cuts(celled: DataFrame, digits: int) -> DataFrame:
    """Where the streams cross from one cell of the training time to the next.

    A row per source and block of its rows; ``__cuts`` lists, for every copy and
    cell that the block's rows fall into, the first place and the words before
    it.  A cut without a cell starts the rows that are not taken.  So a row
    finds its cells from its place alone.
    """
    of = [F.col("__source").alias("__of"), "rank", "target"]
    first = F.min_by(F.struct(*PLACE), "__begin").alias("__place")
    cuts = celled.groupBy(*of, _block(digits), "__copy", "__cell").agg(first, F.min("__begin").alias("__begin"))
    cut = F.struct("__copy", "__place", "__begin", "__cell")
    return cuts.groupBy("__of", "rank", "target", F.col("__block").alias("__at")).agg(
        F.sort_array(F.collect_list(cut)).alias("__cuts")
    )


def curriculum_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    slopes: Sequence[float] = SLOPES,
    cell_words: int = CELL_WORDS,
) -> DataFrame:
    """The mix: a row per copy, with the columns of ``docs``, the ``copy``
    (from 1), its ``position`` and the number of ``words`` to read of it,
    range-sorted by position.  Columns of ``docs`` so named are replaced.

    Whole texts cross one shuffle.  The training time is divided into cells, a
    partition each, of about ``cell_words`` words whatever the sources' sizes.
    The plan, which has no texts, tells at which rows the streams enter a cell;
    a row then finds its cell from its own place, and inside the cell its
    position by adding up sizes from there.  Rows alike in all columns cannot
    tell their places apart: one of them, found by a grouping of such rows only,
    is given the places of all.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    placed = saved(_placed(docs, weights, most), "mix-plan")
    words = placed.agg(F.sum("__size")).first()[0] or 0
    cells = max(words // cell_words + 1, 4 * docs.sparkSession.sparkContext.defaultParallelism)
    digits = max(2, ceil(log(cells, 16)) - 1)
    celled = _celled(placed, cells, most, slopes)
    cuts = saved(_cuts(celled, digits), "mix-cuts")
    if (cuts.agg(F.sum(F.size("__cuts"))).first()[0] or 0) <= BROADCAST_CUTS:
        cuts = F.broadcast(cuts)

    # A filter on the size would count the words of every text once more.
    rows = _sized(docs.where(F.rlike("text", F.lit(WORD))), F.struct(*kept).alias("__row"))
    repeated = celled.where("__alike > 1")
    places = saved(repeated.select(*PLACE).distinct(), "mix-repeated")
    several = None
    if not places.isEmpty():
        one = rows.join(places, list(PLACE), "left_semi").groupBy(*PLACE).agg(F.first("__row").alias("__row"))
        several = one.join(repeated.where("__cell is not null").withColumn("__exact", F.col("__begin")), list(PLACE))
        rows = rows.join(places, list(PLACE), "left_anti")

    rows = rows.select("*", _block(digits))
    found = rows.join(cuts, rows["__source"].eqNullSafe(cuts["__of"]) & (rows["__block"] == cuts["__at"]))
    place = F.struct(*PLACE)

    def last_cut(copy: int) -> Column:
        return F.element_at(F.filter("__cuts", lambda c: (c["__copy"] == copy) & (c["__place"] <= place)), -1)

    taken = F.array(*[last_cut(i) for i in range(most)]).alias("__taken")
    found = found.select(*rows.columns, "rank", "target", taken)
    found = found.select("*", F.explode_outer("__taken").alias("__cut")).where("__cut.__cell is not null")
    state = ["__row", "__id", "__source", *PLACE, "rank", "target"]
    found = found.select(*state, "__cut.__copy", "__cut.__cell", "__cut.__begin", F.lit(None).cast("long").alias("__exact"))
    if several is not None:
        found = found.unionByName(several.select(*found.columns))

    dealt = found.select("*", _block(digits)).repartitionById(cells, "__cell")
    earlier = Window.partitionBy("__cell", "__source", "__block", "__copy").orderBy(*PLACE)
    earlier = F.sum("__size").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    begin = F.coalesce("__exact", F.col("__begin") + F.coalesce(earlier, F.lit(0)))
    copies = dealt.withColumn("__begin", begin).withColumn("__taken", _copy(F.col("__begin"), F.col("__size"), slopes))
    copies = copies.sortWithinPartitions("__taken.position", "__id")
    return copies.select("__row.*", (F.col("__copy") + 1).alias("copy"), "__taken.position", "__taken.words")
