"""Text expressions: tokens, duplicate keys, excerpts, clean-up."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blanks of every kind, with invisible and bidirectional fillers.
_BLANKS = r"[\s\p{Z}\x1C-\x1F\x85\u200B-\u200F\u2060\uFEFF]+"

# Typographic characters and their plain spelling.
PLAIN_SPELLING = (
    ("’", "'"),
    ("“", '"'),
    ("”", '"'),
    ("—", "-"),
    ("–", "-"),
    ("−", "-"),
    ("…", "..."),
    ("×", "x"),
    ("⋅", "*"),
    ("β", "beta"),
    ("²", "2"),
    ("³", "3"),
)

ELLIPSIS = "…"


# A run of word characters is a token when it consists of a-z only. The lookarounds keep a match
# from starting or ending inside a longer run; the possessive repeat stops it from backing off.
_TOKEN = r"(?<![\p{L}\p{N}_])[a-z]{2,}+(?![\p{L}\p{N}_])"


def tokens(text: Column) -> Column:
    """Lower-case words: whole runs of word characters made of two or more a-z letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def content_tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """Tokens without stop words; order and repeats are kept."""
    words = tokens(text)
    if not stop_words:
        return words
    return F.filter(words, lambda t: ~t.isin(list(stop_words)))


def bigrams(words: Column) -> Column:
    """Adjacent pairs of a word array, joined by a blank."""
    n = F.size(words)
    return F.when(
        n >= 2,
        F.zip_with(
            F.slice(words, 1, F.greatest(n - 1, F.lit(0))),
            F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
            lambda a, b: F.concat_ws(" ", a, b),
        ),
    ).otherwise(F.array().cast("array<string>"))


# Texts that a worker holds as Python strings at a time; the rest of a batch stays in its Arrow buffers.
_NFKC_ROWS = 128


def _nfkc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), _NFKC_ROWS):
            texts = batch.slice(at, _NFKC_ROWS).to_pylist()
            yield pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts], pa.string())


@cache
def _nfkc_udf():
    return F.arrow_udf(_nfkc, T.StringType())


def text_key(
    text: Column, *, max_chars: int | None = None, compatibility_forms: bool = True
) -> Column:
    """Key under which two texts count as the same; empty text gives an empty key.

    The key covers the whole text. ``max_chars`` cuts it, for callers to whom a prefix decides.
    Compatibility forms (NFKC) have no built-in Spark expression, so texts with characters
    beyond ASCII go through Arrow; the others cross as NULL and stay in the JVM.
    ``compatibility_forms=False`` leaves the step out.
    """
    t = text
    if compatibility_forms:
        t = F.coalesce(_nfkc_udf()(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)
    t = F.lower(F.trim(F.regexp_replace(t, _BLANKS, " ")))
    return F.left(t, F.lit(max_chars)) if max_chars else t


def excerpt(text: Column, max_chars: int = 240) -> Column:
    """Text cut to a display length, with an ellipsis if anything was cut."""
    return F.when(
        F.length(text) > max_chars, F.concat(F.left(text, F.lit(max_chars)), F.lit(ELLIPSIS))
    ).otherwise(text)


def latin_safe(text: Column, max_chars: int | None = None) -> Column:
    """Printable-ASCII text; a single blank if nothing is left. ``max_chars`` cuts it, with dots."""
    t = text
    for odd, plain in PLAIN_SPELLING:
        t = F.replace(t, F.lit(odd), F.lit(plain))
    t = F.regexp_replace(t, r"[^\x20-\x7E\n]+", " ")
    if max_chars is not None:
        t = F.when(
            F.length(t) > max_chars, F.concat(F.left(t, F.lit(max_chars)), F.lit("..."))
        ).otherwise(t)
    cut = F.regexp_replace(t, r"^[ \n]+|[ \n]+$", "")
    return F.when(cut == "", F.lit(" ")).otherwise(cut)


def strip_markdown(text: Column) -> Column:
    """Remove bold marks and heading signs."""
    t = F.regexp_replace(text, r"\*\*([^*]+)\*\*", "$1")
    return F.regexp_replace(t, r"(?m)^#+\s*", "")


def has_substance(text: Column, min_chars: int = 5) -> Column:
    """Longer than ``min_chars`` after trimming."""
    return F.length(F.regexp_replace(text, r"^\s+|\s+$", "")) > min_chars


def dash_words(text: Column) -> Column:
    """Words split at blanks and dashes."""
    return F.filter(F.split(F.replace(F.lower(text), F.lit("-"), F.lit(" ")), r"\s+"), lambda w: w != "")
