"""File names and extensions of paths, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as fv

# The last dot starts the extension if something other than dots is before it.
_STEM_AND_EXTENSION = r"(?s)\A(\.*[^.].*)(\.[^.]*)\z"


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def raw_extension(path: Column) -> Column:
    """Extension with its dot as written, or an empty text."""
    return F.regexp_extract(file_name(path), _STEM_AND_EXTENSION, 2)


def extension(path: Column) -> Column:
    return F.lower(raw_extension(path))


def base_name(path: Column) -> Column:
    """File name without folder and extension."""
    return F.regexp_replace(file_name(path), _STEM_AND_EXTENSION, "$1")


def is_supported(ext: Column) -> Column:
    return ext.isin(*fv.SUPPORTED_EXTENSIONS)
