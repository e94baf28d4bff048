"""Text measures and regex pre-tokenization, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two published split patterns a trained vocabulary depends on.
GPT2_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GPT4_PATTERN = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
# Fixed value: text between two documents of one joined corpus.
DOC_SEPARATOR = "\n\n"

# Java's \s and \w are ASCII-only without this flag.
_UNICODE = "(?U)"


def byte_length(text: Column | str) -> Column:
    return F.octet_length(text).cast("bigint")


def word_count(text: Column | str) -> Column:
    return F.regexp_count(text, F.lit(_UNICODE + r"\S+")).cast("bigint")


def has_capture_group(pattern: str) -> bool:
    """True if the pattern has a capturing group: its matches would no longer
    be whole chunks."""
    in_class = escaped = False
    for i, ch in enumerate(pattern):
        if escaped:
            escaped = False
        elif ch == "\\":
            escaped = True
        elif in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch == "(":
            ahead = pattern[i + 1 : i + 4]
            if not ahead.startswith("?"):
                return True
            named = ahead.startswith(("?P<", "?<")) and ahead not in ("?<=", "?<!")
            if named:
                return True
    return False


def chunks(text: Column | str, pattern: str = GPT4_PATTERN) -> Column:
    """Array of the pattern's matches in order (`array<string>`)."""
    if has_capture_group(pattern):
        raise ValueError("split pattern must not contain capture groups")
    return F.regexp_extract_all(text, F.lit(_UNICODE + pattern), F.lit(0))


def quote_regex(literal: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else "\\" + c for c in literal)


def special_alternation(tokens) -> str:
    """Alternation over special tokens; registration order decides overlaps."""
    return "|".join(quote_regex(t) for t in tokens)


def split_keeping_specials(text: Column, tokens) -> Column:
    """Alternating ordinary / special parts as `array<struct<part,special>>`.

    Built from the texts between the specials and the specials themselves, so
    no marker character has to be reserved.
    """
    alternation = special_alternation(tokens)
    between = F.split(text, alternation, -1)
    found = F.regexp_extract_all(text, F.lit(alternation), F.lit(0))
    return F.zip_with(
        between, found, lambda part, special: F.struct(part.alias("part"), special.alias("special"))
    )


def chunks_with_specials(text: Column, pattern: str, tokens) -> Column:
    """Chunks of the ordinary parts with each special kept as its own chunk."""
    pieces = F.transform(
        split_keeping_specials(text, tokens),
        lambda p: F.concat(
            chunks(p["part"], pattern),
            F.when(p["special"].isNull(), F.array().cast("array<string>")).otherwise(
                F.array(p["special"])
            ),
        ),
    )
    return F.flatten(pieces)
