"""Column functions on text.

White space is one explicit class (29 code points) in every function, as Java's
``\\s`` and Spark's ``trim`` know fewer. Patterns are anchored with ``\\A`` and
``\\z``. Every function gives null for null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White-space code points (fixed values).
WS_POINTS = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{WS_POINTS}]"
#: The same without the newline.
WS_INLINE = r"[\x{9}\x{b}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
END_MARKER = "<|endoftext|>"


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"{WS}+\z", "")


def strip(text: Column) -> Column:
    return F.regexp_replace(rstrip(text), rf"\A{WS}+", "")


def clean_text(text: Column) -> Column:
    """Strip; three or more newlines to two; other runs of white space to one space, in this order."""
    return F.regexp_replace(F.regexp_replace(strip(text), r"\n{3,}", "\n\n"), rf"{WS_INLINE}+", " ")


def strip_end_marker(text: Column, marker: str = END_MARKER) -> Column:
    """Remove white space at the end, one end marker there, and the white space before it."""
    bare = rstrip(text)
    n = len(marker)
    return F.when(F.endswith(bare, F.lit(marker)), rstrip(F.substring(bare, F.lit(1), F.length(bare) - n))).otherwise(bare)


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | (strip(text) == "")


def n_chars(text: Column) -> Column:
    """Length in code points."""
    return F.length(text).cast("bigint")


def n_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes."""
    return F.octet_length(text).cast("bigint")


def score_at_least(score: Column, least: float, missing: Column | None = None, unreadable: float | None = None) -> Column:
    """Whether a score, number or numeric string, reaches ``least``; never null.

    NaN never does. ``missing`` says where the field was absent, which counts
    as 0.0; a null or unreadable score is refused, or counts as ``unreadable``
    if that is given.
    """
    number = score.try_cast("double")
    if unreadable is not None:
        number = F.coalesce(number, F.lit(float(unreadable)))
    if missing is not None:
        number = F.when(missing, F.lit(0.0)).otherwise(number)
    return F.coalesce((number >= least) & ~F.isnan(number), F.lit(False))


def gigabytes(gb: float) -> int:
    """Bytes of so many GiB, cut to whole bytes."""
    return int(float(gb) * 1024**3)


def estimated_tokens(gb: float, chars_per_token: float = 4.0) -> int:
    return int(float(gb) * 1024**3 / chars_per_token)


def glob_pattern(pattern: str) -> str:
    """A Java regular expression for a shell pattern over a whole path or base name."""
    import fnmatch

    return fnmatch.translate(pattern).replace(r"\Z", r"\z").replace("(?s:", "(?s:")


def path_matches(path: Column, pattern: str) -> Column:
    """The pattern holds for the relative path or for its last part."""
    rule = glob_pattern(pattern)
    return path.rlike(rf"\A{rule}") | F.element_at(F.split(path, "/"), -1).rlike(rf"\A{rule}")


def chat_turn(role: Column, content: Column) -> Column:
    """One rendered turn; null for a role other than system, user and assistant."""
    return F.when(role.isin("system", "user", "assistant"), F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), content, F.lit("<|im_end|>\n")))
