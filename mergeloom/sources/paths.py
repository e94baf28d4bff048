"""Names held in file paths, as they were given."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _unescaped(text: Column) -> Column:
    """Undo percent escapes; a plus sign is no space in a path."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def plain_path(path: Column) -> Column:
    """`_metadata.file_path` without its URL escapes."""
    return _unescaped(path)


def partition_value(path: Column, key: str) -> Column:
    """The value of a `key=value` folder, whose own escapes lie below the URL's;
    empty if there is none."""
    return _unescaped(F.regexp_extract(plain_path(path), f"(?:^|/){key}=([^/]+)/", 1))
