"""Multilingual stop-word set (survey U2).

Fixed values: the five lists are the public ones that Spark's
``StopWordsRemover.loadDefaultStopWords`` serves, one word a line, shipped as
data files of this package.  Reading them needs no JVM, no jar and no session.
"""

from __future__ import annotations

import functools
from importlib import resources

DEFAULT_LANGUAGES = ("english", "spanish", "german", "french", "russian")


@functools.lru_cache(maxsize=None)
def load_language(lang: str) -> tuple[str, ...]:
    raw = resources.files("trendlens.data").joinpath("stopwords", f"{lang}.txt").read_text("utf-8")
    return tuple(raw.split())


def stop_words(langs=DEFAULT_LANGUAGES) -> list[str]:
    """Union of the language lists, sorted for a stable literal."""
    out: set[str] = set()
    for lang in langs:
        out.update(load_language(lang))
    return sorted(out)
