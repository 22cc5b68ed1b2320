"""DuckDB spellings of the text expressions, built from the same pattern
constants as the Spark side (used only to write oracle SQL)."""

from __future__ import annotations

from trendlens.functions import patterns as P
from trendlens.functions.stopwords import stop_words


def strip_urls(x: str) -> str:
    return f"regexp_replace({x}, '{P.URL}', '', 'g')"


def strip_emojis(x: str) -> str:
    return f"regexp_replace({x}, '{P.EMOJI}', '', 'g')"


def clean_text(x: str) -> str:
    return f"lower(regexp_replace({strip_emojis(strip_urls(x))}, '{P.NON_LETTER}', '', 'g'))"


def word_list(x: str) -> str:
    return (f"coalesce(list_filter(regexp_split_to_array({x}, '{P.SPLIT}'), "
            f"lambda w: w <> ''), []::VARCHAR[])")


def extract(x: str, pattern: str) -> str:
    return f"coalesce(regexp_extract_all({x}, '{pattern}'), []::VARCHAR[])"


def join_words(x: str) -> str:
    return f"coalesce(array_to_string({x}, ' '), '')"


#: Stands for the stop-word list in registered SQL until ``resolve`` is called.
STOP_WORDS_MARK = "/*stop words*/"


def stopword_literal() -> str:
    return f"[{STOP_WORDS_MARK}]"


def resolve(sql: str) -> str:
    """Fill in the stop words; done when the SQL is asked for, so that
    registering a query reads no file."""
    if STOP_WORDS_MARK not in sql:
        return sql
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words())
    return sql.replace(STOP_WORDS_MARK, words)


def remove_stopwords(x: str) -> str:
    return f"list_filter({x}, lambda w: NOT list_contains({stopword_literal()}, w))"


def tokens(x: str) -> str:
    return f"list_filter({x}, lambda w: length(w) >= {P.MIN_TOKEN_LEN})"
