"""Cleaning of Markdown and of generated text: ``Column -> Column``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as fv


def line_mode(pattern: str) -> str:
    """``^`` and ``$`` per line, and only a line feed ends a line."""
    return "(?md)" + pattern


def feed_mode(pattern: str) -> str:
    """``.`` stops at a line feed only."""
    return "(?d)" + pattern


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once where ``use`` needs it more than once.

    An array of one element, transformed, is how an expression names a value.
    """
    return F.transform(F.array(value), use)[0]


def map_lines(text: Column, change: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.split(text, "\n"), change), "\n")


def strip(text: Column) -> Column:
    """Trim white space of any kind, not only blanks, at both ends."""
    return F.trim(text, F.lit(fv.SPACE_CHARS))


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{fv.SPACE}]")


def normalise_newlines(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def drop_figures(text: Column) -> Column:
    return F.regexp_replace(text, fv.FIGURE_BLOCK, "")


def drop_html_data_images(text: Column) -> Column:
    return F.regexp_replace(text, fv.IMG_WITH_DATA_URI, "")


def drop_markdown_data_images(text: Column, strict: bool = False) -> Column:
    """By default a match starts at the first ``![`` of the line, so an
    ordinary image in front of a data image goes too; ``strict`` keeps it."""
    pattern = fv.MD_IMAGE_WITH_DATA_URI_STRICT if strict else fv.MD_IMAGE_WITH_DATA_URI
    return F.regexp_replace(text, feed_mode(pattern), "")


def drop_data_uris(text: Column, strict: bool = False) -> Column:
    """By default words behind the base64 text go too, up to the next
    character that is neither base64 nor white space; ``strict`` stops at the
    first white space."""
    pattern = fv.BARE_DATA_URI_STRICT if strict else fv.BARE_DATA_URI
    return F.regexp_replace(text, pattern, "")


def drop_attribute_references(text: Column) -> Column:
    return F.regexp_replace(text, fv.ATTRIBUTE_REFERENCE, "")


def clean_technical(text: Column, strict: bool = False) -> Column:
    """Remove embedded images and leftover ``{name}`` references.

    Each pattern needs a literal that is cheap to look for, so a pattern runs
    only where its literal is found.  Without ``<figure>`` and
    ``data:image/`` in the input no image pattern can match, and a deletion
    never makes a ``{`` that was not there: most documents are only searched.
    """

    def where_found(literal: str, change: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda t: F.when(F.contains(t, F.lit(literal)), change(t)).otherwise(t)

    without_images = where_found("<figure>", drop_figures)(text)
    for step in (
        where_found("<img", drop_html_data_images),
        where_found("](data:image/", lambda t: drop_markdown_data_images(t, strict)),
        where_found(";base64,", lambda t: drop_data_uris(t, strict)),
    ):
        without_images = bind(without_images, step)
    has_image = F.contains(text, F.lit("<figure>")) | F.contains(text, F.lit("data:image/"))
    has_reference = F.contains(text, F.lit("{"))
    return (
        F.when(has_image & has_reference, drop_attribute_references(without_images))
        .when(has_image, without_images)
        .when(has_reference, drop_attribute_references(text))
        .otherwise(text)
    )


def strip_reasoning(text: Column) -> Column:
    """Remove reasoning blocks with a matching closing tag, then trim.

    The shortest match counts, so a nested tag leaves its tail; unclosed and
    mismatched tags stay.
    """
    tags = "|".join(fv.REASONING_TAGS)
    without = F.regexp_replace(text, rf"(?s)<({tags})>.*?</\1>", "")
    return strip(F.when(F.contains(text, F.lit("</")), without).otherwise(text))


def null_if_missing(text: Column, null_words: tuple[str, ...] = ()) -> Column:
    """Null for an empty value and, if asked for, for words that mean null."""
    return F.when(text.isin("", *null_words), F.lit(None)).otherwise(text)
