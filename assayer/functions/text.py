"""String expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.labels import LABELS

# The 29 characters that count as whitespace, as a regular-expression
# class and as a plain string. Java's own \s misses 23 of them. The first half of the
# class turns nearly every letter away with one range test, which halves the time.
WS_CLASS = (
    r"[[^\x21-\x7e\u00a1-\u167f]"
    r"&&[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Length limits, in characters.
DESCRIPTION_CHARS = 900
PARAM_DESCRIPTION_CHARS = 140
EXAMPLE_DESCRIPTION_CHARS = 400

# Stand-ins for blank fields.
NO_NAME = "unknown_tool"
NO_DESCRIPTION = "(no description provided)"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace (all 29 characters, not only U+0020)."""
    return F.trim(c, F.lit(WS_CHARS))


def is_blank(c: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(F.length(strip(c)) == 0, F.lit(True))


def collapse_ws(c: Column) -> Column:
    """Every whitespace run becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, WS_CLASS + "+", " "))


def norm_text(c: Column) -> Column:
    """Collapsed and lower-cased; null becomes empty."""
    return F.lower(collapse_ws(F.coalesce(c, F.lit(""))))


def content_hash(name: Column, description: Column) -> Column:
    """SHA-1 hex over the normalised name and description."""
    return F.sha1(F.concat_ws("||", norm_text(name), norm_text(description)))


def hash_normalised(name: Column, description: Column) -> Column:
    """:func:`content_hash` of texts whose white space is collapsed already."""
    return F.sha1(F.concat_ws("||", F.lower(name), F.lower(description)))


def truncate(c: Column, n: int) -> Column:
    """The first ``n`` code points."""
    return F.substring(c, 1, n)


def name_or_default(name: Column) -> Column:
    stripped = strip(name)
    return F.when(is_blank(name), F.lit(NO_NAME)).otherwise(stripped)


def description_or_default(description: Column) -> Column:
    shown = truncate(collapse_ws(description), DESCRIPTION_CHARS)
    return F.when(is_blank(description), F.lit(NO_DESCRIPTION)).otherwise(shown)


def char_length(c: Column) -> Column:
    return F.length(c).cast("bigint")


def label_words_in(*parts: Column, labels: Sequence[str] = LABELS) -> Column:
    """Lower-cased label words that occur as substrings of the joined parts, in label order."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))
    words = F.array(*[F.lit(label.lower()) for label in labels])
    return F.filter(words, lambda w: F.contains(text, w))


def pair_key(a: Column, b: Column, joiner: str) -> Column:
    """``a_<joiner>_b``, e.g. ``Read_to_Write`` or ``train_vs_test``; a missing label is ``None``."""
    none = F.lit("None")
    return F.concat(F.coalesce(a, none), F.lit(f"_{joiner}_"), F.coalesce(b, none))


def input_text(name: Column, description: Column, params: Column) -> Column:
    """The one text per record that every model sees. The group key is no part of it."""
    return compose_text(name_or_default(name), description_or_default(description), params)


def compose_text(name: Column, description: Column, params: Column) -> Column:
    """:func:`input_text` from parts as they are shown."""
    return F.concat(
        F.lit("Tool name: "), name, F.lit("\nDescription: "), description, F.lit("\nParameters:\n"), params
    )
