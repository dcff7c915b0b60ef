"""Text forms of single values, as native column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the longest text, in characters, that a warehouse column takes.
MAX_TEXT = 65535


@cache
def _fold_table() -> tuple[str, str, dict[str, str]]:
    """Every code point whose compatibility decomposition has ASCII characters in it.

    Returns (single sources, their ASCII characters, {source: several ASCII characters}). Decomposing is a
    per-code-point step and ASCII characters are never reordered, so folding character by character is exact.
    """
    singles, targets, several = [], [], {}
    for code in range(0x80, 0x110000):
        char = chr(code)
        folded = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if len(folded) == 1:
            singles.append(char)
            targets.append(folded)
        elif folded:
            several[char] = folded
    return "".join(singles), "".join(targets), several


@cache
def _several_pattern() -> str:
    """A class of ranges behind a guard: ASCII characters, most of any text, are turned down by one comparison."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, _fold_table()[2])):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    spans = "".join(rf"\x{{{first:X}}}-\x{{{last:X}}}" for first, last in ranges)
    return rf"(?![\x00-\x7F])[{spans}]"


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def replace_marks(c: Column, pattern: str, replacement: Callable[[Column], Column]) -> Column:
    """Replace each match of a pattern by an expression of it.

    The text is cut at the matches only, so a long text with few of them has few pieces.
    """
    gaps = F.split(c, pattern, -1)
    marks = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    # There is one gap more than marks: the last mark is NULL.
    pieces = F.zip_with(gaps, marks, lambda gap, mark: F.concat(gap, F.coalesce(replacement(mark), F.lit(""))))
    return F.array_join(pieces, "")


def _spell_out(c: Column) -> Column:
    """Replace ligatures, fractions and the like by their several ASCII characters."""
    several = _fold_table()[2]
    # One text literal, which Catalyst folds into one map literal.
    spelled = "\x02".join(f"{char}\x01{folded}" for char, folded in several.items())
    lookup = F.str_to_map(F.lit(spelled), F.lit("\x02"), F.lit("\x01"))
    return replace_marks(c, _several_pattern(), lambda mark: F.try_element_at(lookup, mark))


def ascii_fold(c: Column) -> Column:
    """NFKD-decompose and drop everything outside ASCII. Text that is ASCII already is passed through."""
    singles, targets, _ = _fold_table()
    spelled = F.when(c.rlike(_several_pattern()), _spell_out(c)).otherwise(c)
    folded = F.regexp_replace(F.translate(spelled, singles, targets), r"[^\x00-\x7F]+", "")
    return F.when(_is_ascii(c), c).otherwise(folded)


def truncate_text(c: Column, size: int = MAX_TEXT) -> Column:
    """The first ``size`` characters (not bytes)."""
    return F.substring(c, 1, size)


def replace_invalid_utf8(c: Column) -> Column:
    """Put U+FFFD in place of byte sequences that are not UTF-8."""
    return F.make_valid_utf8(c.cast("string"))


def fit_to_width(c: Column, width: int) -> Column:
    """Load-time cleanup: valid UTF-8, cut to the column's declared width."""
    return F.substring(replace_invalid_utf8(c), 1, width)


def binary_text(c: Column) -> Column:
    """Bytes as text. Bytes that are not UTF-8 fail the job, so the table is skipped rather than damaged."""
    return F.validate_utf8(c.cast("string"))


def uuid_text(c: Column) -> Column:
    """A UUID in any accepted spelling as lower-case, hyphenated text; NULL when it is not 32 hex digits."""
    digits = F.regexp_replace(F.lower(c.cast("string")), r"urn:|uuid:|[{}-]", "")
    shaped = F.regexp_replace(digits, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"$1-$2-$3-$4-$5")
    return F.when(digits.rlike(r"^[0-9a-f]{32}$"), shaped)


def decimal_text(c: Column, scale: int) -> Column:
    """A decimal with its scale kept.

    Values below 1e-6 in size take the scientific form, which only a scale above 6 can reach.
    """
    plain = c.cast("string")
    if scale <= 6:
        return plain
    digits = F.ltrim(F.translate(plain, "-.", ""), F.lit("0"))
    # Zero has no significant digit: its exponent is the scale itself.
    exponent = F.when(c == 0, F.lit(scale)).otherwise(F.lit(scale + 1) - F.length(digits))
    mantissa = (
        F.when(c == 0, F.lit("0"))
        .when(F.length(digits) == 1, digits)
        .otherwise(F.concat_ws(".", F.substring(digits, 1, 1), digits.substr(F.lit(2), F.length(digits))))
    )
    scientific = F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), mantissa, F.lit("E-"), exponent.cast("string"))
    return F.when(F.abs(c) < F.lit("0.000001").cast("decimal(38,18)"), scientific).otherwise(plain)
