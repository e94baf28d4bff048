"""Token sequences as code strings: one Unicode character per token.

Token `id` is the character U+id, moved past the surrogate block where needed.
A byte-level text is then its Latin-1 view, a pair is a two-character
substring and a merge is the built-in `replace`, so training and encoding stay
inside the JVM. ASCII text costs one byte per token.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F

_SURROGATES = 0xD800
_SHIFT = 0x800
# Never a token character: ids would have to exceed a million.
CHUNK_BREAK = "\U0010ffff"


def token_char(token: int) -> str:
    return chr(token if token < _SURROGATES else token + _SHIFT)


def char_token(ch: str) -> int:
    point = ord(ch)
    return point if point < _SURROGATES else point - _SHIFT


def byte_codes(text: Column | str) -> Column:
    """UTF-8 bytes of a string as a code string of byte tokens 0..255."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def codes_to_bytes(code: Column) -> Column:
    """Inverse of `byte_codes` for strings made of byte tokens only."""
    return F.encode(code, "ISO-8859-1")


def char_to_id(ch: Column) -> Column:
    point = F.ascii(ch)
    return F.when(point < _SURROGATES, point).otherwise(point - _SHIFT)


def code_ids(code: Column) -> Column:
    """Code string to `array<int>`; the empty string gives an empty array."""
    return F.when(
        F.length(code) == 0, F.array().cast("array<int>")
    ).otherwise(F.transform(F.split(code, ""), char_to_id))


def merge_literal(merges, first_id: int = 256) -> Column:
    """Merges as one foldable array<struct<pair,new>>; Catalyst turns the JSON
    text into a literal once, so the plan holds no per-merge expressions."""
    rows = [
        {"pair": token_char(left) + token_char(right), "new": token_char(first_id + i)}
        for i, (left, right) in enumerate(merges)
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<pair:string,new:string>>")


def apply_merges(code: Column, merges, first_id: int = 256) -> Column:
    """Apply all merges in rank order.

    Equal to repeatedly merging the present pair of lowest rank, because a
    merge can only create pairs of higher rank.
    """
    if not merges:
        return code
    return F.aggregate(
        merge_literal(merges, first_id), code, lambda s, m: F.replace(s, m["pair"], m["new"])
    )


def adjacent_pairs(code: Column) -> Column:
    """Array of overlapping two-character pairs; the last element is NULL."""
    chars = F.split(code, "")
    return F.zip_with(chars, F.slice(chars, 2, 1 << 30), lambda a, b: F.concat(a, b))


def lossy_text(raw: Column) -> Column:
    """Bytes to text with malformed sequences as U+FFFD."""
    return F.make_valid_utf8(raw.cast("string"))


def escape_controls(text: Column) -> Column:
    """Characters of Unicode category C as backslash-u escapes."""
    escaped = F.transform(
        F.split(text, ""),
        lambda c: F.when(
            c.rlike(r"\p{C}"), F.format_string("\\u%04x", F.ascii(c))
        ).otherwise(c),
    )
    return F.when(F.length(text) == 0, text).otherwise(F.array_join(escaped, ""))


def render_token(raw: Column) -> Column:
    return escape_controls(lossy_text(raw))
