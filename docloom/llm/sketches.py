"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's words are runs of characters other than space and 0x09-0x0D, with
A-Z folded to a-z; its set are the distinct runs of ``size`` words (of fewer
words the whole sequence as one; of none, nothing).  Every shingle is hashed
to 64 bits, and the fingerprint is the ``k`` smallest hashes, in order, as
lowercase hex digits, 16 for each.  A fingerprint of fewer than ``k`` hashes
is the whole set.

Fingerprints of parts merge into that of the whole: the smallest hashes of
all parts are the smallest of the parts' smallest.  The smallest ``k`` of two
fingerprints taken together are a random sample of the union, so the share of
them that both have estimates the resemblance; how close the ``k``-th of them
is to the end of the hash range tells the number of distinct shingles.

Only built-in expressions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.functions.text import bind
from docloom.llm.tables import saved
from docloom.operators.ordering import running_totals

SIZE = 5
K = 128

_DIGITS = 16
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))


def folded_words(text: Column) -> Column:
    """The words of a text, A-Z folded."""
    nothing = F.array().cast("array<string>")
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    trimmed = F.trim(folded, F.lit(_BLANKS))
    return bind(trimmed, lambda t: F.when(t == "", nothing).otherwise(F.split(t, "[ \t-\r]+")))


def shingle_hashes(words: Column, size: int = SIZE) -> Column:
    """A hash of 16 hex digits for every run of ``size`` words, in order."""

    def digest(run: Column) -> Column:
        return F.substring(F.md5(F.array_join(run, " ")), 1, _DIGITS)

    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(1)))
    runs = F.transform(starts, lambda at: digest(F.slice(words, at, size)))
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(runs)


def fingerprint(text: Column, size: int = SIZE, k: int = K) -> Column:
    """The fingerprint of a text; of a null or blank one it is empty."""
    hashes = bind(folded_words(text), lambda words: shingle_hashes(words, size))
    return F.array_join(F.slice(F.sort_array(F.array_distinct(hashes)), 1, k), "")


def sketch(fingerprint: Column) -> Column:
    """The hashes of a fingerprint, as an array."""
    return F.regexp_extract_all(fingerprint, F.lit(f".{{{_DIGITS}}}"), F.lit(0))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated size of the intersection by that of the union, from 0 to 1,
    of two fingerprints; exact if both are whole sets.  Two empty ones are
    alike (1), an empty one is like no other (0)."""

    def share(pair: Column) -> Column:
        union = F.sort_array(F.array_union(pair["a"], pair["b"]))
        whole = (F.size(pair["a"]) < k) & (F.size(pair["b"]) < k)
        return bind(
            F.struct(
                union.alias("union"),
                F.when(whole, F.size(union)).otherwise(F.least(F.lit(k), F.size(union))).alias("count"),
                F.array_intersect(pair["a"], pair["b"]).alias("both"),
            ),
            lambda s: F.when(s["count"] == 0, F.lit(1.0)).otherwise(
                F.size(F.filter(s["both"], lambda x: x <= F.element_at(s["union"], s["count"]))) / s["count"]
            ),
        )

    pair = F.struct(sketch(a).alias("a"), sketch(b).alias("b"))
    return F.when(a == b, F.lit(1.0)).otherwise(bind(pair, share))


def distinct_shingles(fingerprint: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    count = (F.length(fingerprint) / _DIGITS).cast("int")
    last = F.conv(F.substring(fingerprint, (k - 1) * _DIGITS + 1, 13), 16, 10).cast("double") / float(1 << 52)
    return F.when(count < k, count.cast("double")).otherwise((k - 1) / F.greatest(last, F.lit(2.0**-52)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the set of ``a`` that is in that of ``b``, from 0 to
    1; an empty set is contained in every other."""
    alike, own, other = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    shared = bind(alike, lambda j: j / (1 + j) * (own + other))
    return F.when(own == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / own))


def merged_fingerprints(
    parts: DataFrame, by: Sequence[str], fingerprint: str = "fingerprint", k: int = K
) -> DataFrame:
    """``by..., fingerprint``: one for each group, as if made of all its texts.

    Hashes are made distinct before they meet in a group, and every task sends
    at most ``k`` of a group, so a group of any size is merged in small steps.
    A group of empty fingerprints has an empty one.
    """
    by = list(by)
    hashes = parts.select(*by, F.explode_outer(sketch(F.col(fingerprint))).alias("_hash")).distinct()
    smallest = Window.partitionBy(*by).orderBy(F.col("_hash").asc_nulls_last())
    ranked = hashes.withColumn("_rank", F.row_number().over(smallest)).where(F.col("_rank") <= k)
    merged = ranked.groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias("_hashes"))
    return merged.select(*by, F.array_join("_hashes", "").alias(fingerprint))


def _following(ids: DataFrame) -> DataFrame:
    """``id, before, most``: the id in front of each, and how much of its text
    that one's edit takes at most.  The last id is in front of the first."""
    ranked = saved(running_totals(ids, [F.col("id")], {"place": F.lit(1)}), "sketch-order")
    count = max(ranked.count(), 1)
    place = F.pmod(F.col("place") + 1, F.lit(count))
    before = ranked.select(place.alias("place"), F.col("id").alias("before"), F.col("most"))
    return ranked.select("id", "place").join(before, "place").select("id", "before", "most")


def edited_fingerprints(docs: DataFrame, size: int = SIZE, k: int = K) -> DataFrame:
    """``doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every row of ``docs(doc_id, text)``.

    The ``edited`` text has its last quarter (rounded down, in code points)
    replaced by the beginning of the next document, as long or shorter if
    that is shorter.  ``near_edited`` is the resemblance to the edited text,
    ``near_next`` to the next document, which is the one with the next larger
    id; behind the last comes the first, and a document alone follows itself.

    A null text is empty.  Of rows that repeat an id the one that sorts first
    by text is the next document for the id before; each of them is edited
    with the next id.  Rows without an id have no next document: ``edited``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` are null.  Other
    columns, whatever their names, are ignored.

    Texts are hashed where they are read and cross one shuffle, by id, which
    is read twice: once for the beginnings that go to the id before, once
    for the edits.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"))
    printed = rows.withColumn("print", F.unhex(fingerprint(F.col("text"), size, k)))
    known = rows.where("id IS NOT NULL").groupBy("id").agg((F.max(F.length("text")) / 4).cast("long").alias("most"))
    placed = printed.where("id IS NOT NULL")
    # Not a rank: a limit per group would go below the exchange, which then
    # could not be the one that the join below reads.
    earlier = F.lag(F.lit(1)).over(Window.partitionBy("id").orderBy("text"))
    first = placed.withColumn("earlier", earlier).where("earlier IS NULL")
    heads = first.join(saved(_following(known), "sketch-next"), "id").select(
        F.col("before").alias("id"),
        F.substring(F.col("text"), F.lit(1), F.col("most").cast("int")).alias("head"),
        F.col("print").alias("next_print"),
    )
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - quarter),
        F.substring(F.col("head"), F.lit(1), quarter),
    )
    met = placed.join(heads, "id").withColumn("edited", edited)
    alone = printed.where("id IS NULL").select(
        "id", "text", "print",
        F.lit(None).cast("string").alias("head"),
        F.lit(None).cast("binary").alias("next_print"),
        F.lit(None).cast("string").alias("edited"),
    )
    both = met.unionByName(alone).select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        "edited",
        F.lower(F.hex("print")).alias("fingerprint"),
        F.when(F.col("edited").isNotNull(), fingerprint(F.col("edited"), size, k)).alias("edited_fingerprint"),
        F.lower(F.hex("next_print")).alias("_next"),
    )
    return both.select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
        resemblance(F.col("fingerprint"), F.col("edited_fingerprint"), k).alias("near_edited"),
        resemblance(F.col("fingerprint"), F.col("_next"), k).alias("near_next"),
    )
