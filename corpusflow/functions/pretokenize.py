"""Cutting text into chunks (pre-tokens), inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the published GPT-4-style split pattern with digits in groups of at most two.
SPLIT_PATTERN = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
)


def pretokenize(text: Column | str) -> Column:
    """All chunks of a text, in order; together they are the text.

    ``(?U)`` gives ``\\s`` its Unicode meaning, which the pattern assumes and Java lacks by default.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(text, F.lit("(?U)" + SPLIT_PATTERN), F.lit(0))


def byte_symbols(chunk: Column | str) -> Column:
    """The UTF-8 bytes of a chunk as a string with one character per byte (code point = byte)."""
    chunk = F.col(chunk) if isinstance(chunk, str) else chunk
    return F.decode(F.encode(chunk, "UTF-8"), "ISO-8859-1")


def symbol(token_id: int) -> str:
    """The character that stands for a token id in a symbol string; surrogates are stepped over."""
    return chr(token_id if token_id < 0xD800 else token_id + 0x800)


def token_of(character: str) -> int:
    """Inverse of :func:`symbol`."""
    code = ord(character)
    return code if code < 0xD800 else code - 0x800


def adjacent_pairs(symbols: Column) -> Column:
    """All two-character windows of a symbol string: those at even places, then those at odd places."""
    two = F.lit("(?s)..")
    return F.concat(
        F.regexp_extract_all(symbols, two, F.lit(0)),
        F.regexp_extract_all(F.substr(symbols, F.lit(2)), two, F.lit(0)),
    )
