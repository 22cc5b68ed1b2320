"""Text cleaning and extraction (survey X1-X11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlens.functions import patterns as P


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_str_array() -> Column:
    return F.array().cast("array<string>")


def strip_urls(c) -> Column:
    """Remove ``http(s)://…`` and ``www.…`` runs."""
    return F.regexp_replace(_c(c), P.URL, "")


def strip_emojis(c) -> Column:
    """Remove runs of the emoji code-point ranges."""
    return F.regexp_replace(_c(c), P.EMOJI, "")


def clean_text(c) -> Column:
    """URLs, then emoji runs, then everything but ASCII letters and
    whitespace are deleted; the rest is lower-cased.  Null stays null.

    Evaluated as one regex pass (``patterns.CLEAN_DELETE``), equivalent to
    the three sequential passes of ``clean_text_stepwise``."""
    return F.lower(F.regexp_replace(_c(c), P.CLEAN_DELETE, ""))


def clean_text_stepwise(c) -> Column:
    """X3 written as the three sequential deletions (reference order)."""
    return F.lower(F.regexp_replace(strip_emojis(strip_urls(c)), P.NON_LETTER, ""))


def extract_emojis(c) -> Column:
    """List of maximal emoji runs; null -> []."""
    return F.coalesce(F.regexp_extract_all(_c(c), F.lit(P.EMOJI), 0), empty_str_array())


def extract_urls(c) -> Column:
    """List of URL matches; null -> []."""
    return F.coalesce(F.regexp_extract_all(_c(c), F.lit(P.URL), 0), empty_str_array())


def word_list(c) -> Column:
    """Split on Unicode whitespace, no empty words; null -> []."""
    parts = F.filter(F.split(_c(c), P.SPLIT), lambda w: w != "")
    return F.coalesce(parts, empty_str_array())


def clean_words(c) -> Column:
    """X8 of X3: the words of the cleaned text; null -> [].  Cleaning leaves
    only letters and white space, so words are runs of letters."""
    return words_of_cleaned(clean_text(c))


def words_of_cleaned(c) -> Column:
    """``clean_words`` of a text that ``clean_text`` has cleaned."""
    runs = F.filter(F.split(_c(c), "[^a-z]+"), lambda w: w != "")
    return F.coalesce(runs, empty_str_array())


def word_count(c) -> Column:
    """Number of whitespace tokens; null -> 0."""
    return F.size(word_list(c))


def char_length(c) -> Column:
    """Code points (null stays null)."""
    return F.length(_c(c))


def join_words(c) -> Column:
    """Join a word list with single spaces; null -> ''."""
    return F.coalesce(F.array_join(_c(c), " "), F.lit(""))


def remove_stopwords(c, stop_words) -> Column:
    """Drop words found in ``stop_words`` (order and repeats kept)."""
    words = sorted(set(stop_words))
    return F.filter(_c(c), lambda w: ~w.isin(words))


def scrub_newlines(c) -> Column:
    """Every LF and every CR becomes one space."""
    return F.translate(_c(c), "\n\r", "  ")


def tokens(c, min_len: int = P.MIN_TOKEN_LEN) -> Column:
    """Vectoriser tokens of a cleaned word list: words of >= ``min_len`` chars."""
    return F.filter(_c(c), lambda w: F.length(w) >= min_len)
