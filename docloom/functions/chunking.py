"""Splitting Markdown into pieces of bounded length, inside one expression.

Lengths are counted in code points.  The packing is greedy and sequential by
nature, so it runs as a fold over the sections of one document; documents are
independent of each other, so no shuffle is involved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as fv
from docloom.functions.text import bind, is_blank, line_mode, strip


def sections(markdown: Column) -> Column:
    """Cut in front of every header of level 1 to 3; blank sections go."""
    parts = F.split(markdown, line_mode(f"(?={fv.SECTION_HEADER})"))
    return F.filter(parts, lambda part: ~is_blank(part))


def slices(text: Column, width: int) -> Column:
    """Consecutive pieces of exactly ``width``, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{width}}}"), F.lit(0))


def _starts(parts: Column, max_chars: int, gap: int) -> Column:
    """Indexes of the parts that start a new piece.

    A part joins the open piece while the sum of the lengths, and a gap, stays
    below the limit.  Behind a part that is too long by itself nothing is
    open, nor behind an empty one.

    A fold copies its state at every step, so the state holds numbers, no
    text.  So that a document of very many parts costs little more than its
    length, blocks of parts are folded into their own list first: with blocks
    of the square root of the number of parts, neither the lists nor the
    number of blocks get long.
    """
    nothing = F.array().cast("array<int>")

    def state(open_length: Column, starts: Column) -> Column:
        return F.struct(open_length.cast("int").alias("n"), starts.alias("starts"))

    def add(acc: Column, part: Column) -> Column:
        joined = acc["n"] + part["n"] + gap
        nothing_left = (part["n"] >= max_chars) | (part["n"] == 0)
        return F.when((acc["n"] >= 0) & (joined < max_chars), state(joined, acc["starts"])).otherwise(
            state(F.when(nothing_left, -1).otherwise(part["n"]), F.concat(acc["starts"], F.array(part["i"])))
        )

    def in_blocks(sized: Column) -> Column:
        items, width = sized["items"], sized["width"]

        def one_block(acc: Column, first: Column) -> Column:
            block = F.aggregate(F.slice(items, first, width), state(acc["n"], nothing), add)
            return bind(block, lambda b: state(b["n"], F.concat(acc["starts"], b["starts"])))

        firsts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(items)), width)
        return F.aggregate(firsts, state(F.lit(-1), nothing), one_block, lambda acc: acc["starts"])

    measured = F.transform(parts, lambda part, i: F.struct(F.length(part).alias("n"), i.alias("i")))
    block_width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(parts))).cast("int"))
    return bind(F.struct(measured.alias("items"), block_width.alias("width")), in_blocks)


def _pieces(parts: Column, max_chars: int, separator: str, split_long: Callable[[Column], Column]) -> Column:
    """Parts packed greedily and joined; one that is too long by itself is
    split further instead."""

    def with_starts(items: Column, starts: Column) -> Column:
        def piece(start: Column, j: Column) -> Column:
            count = F.coalesce(F.get(starts, j + 1), F.size(items)) - start
            only = F.get(items, start)
            joined = F.array(F.array_join(F.slice(items, start + 1, count), separator))
            return F.when((count == 1) & (F.length(only) >= max_chars), split_long(only)).otherwise(joined)

        return F.flatten(F.transform(starts, piece))

    return bind(
        parts,
        lambda items: bind(_starts(items, max_chars, len(separator)), lambda starts: with_starts(items, starts)),
    )


def split_oversized(section: Column, max_chars: int) -> Column:
    """Pack the paragraphs of one section with the blank line between them;
    slice those that are too long."""
    paragraphs = F.split(section, fv.PARAGRAPH_BREAK)
    return _pieces(paragraphs, max_chars, "\n\n", lambda paragraph: slices(paragraph, max_chars))


def pack(parts: Column, max_chars: int) -> Column:
    """Pack sections.  What is left of an oversized one is never packed with
    the next section."""
    return _pieces(parts, max_chars, "", lambda section: split_oversized(section, max_chars))


def chunk_array(markdown: Column, max_chars: int = fv.MAX_CHUNK_CHARS) -> Column:
    """Array of trimmed, non-empty chunks of an already cleaned document.

    A document below the limit is one chunk, whatever its sections.
    """
    if max_chars < 1:
        raise ValueError(f"max_chars must be positive, got {max_chars}")
    packed = F.when(F.length(markdown) < max_chars, F.array(markdown)).otherwise(
        pack(sections(markdown), max_chars)
    )
    return F.filter(F.transform(packed, strip), lambda chunk: chunk != "")
