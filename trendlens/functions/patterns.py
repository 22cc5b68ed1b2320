"""Regular-expression constants shared by the Spark expressions and the SQL oracle.

Fixed values: these reproduce the reference text rules exactly.
- WS is Python's Unicode whitespace class (what ``str.split()`` and ``\\s``
  match), written out because Java ``\\s`` and RE2 ``\\s`` both differ.
- URL is ``http[s]?://\\S+|www\\.\\S+`` with ``\\S`` spelled as ``[^WS]``.
- EMOJI is the six code-point ranges of the reference emoji class.
- NON_LETTER is ``[^a-zA-Z\\s]`` with ``\\s`` spelled as WS.
The syntax (``\\x{...}`` code points inside classes) is understood by both
Java regex (Spark) and RE2 (DuckDB).
"""

WS = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")

URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"

EMOJI = (r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
         r"\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+")

NON_LETTER = rf"[^a-zA-Z{WS}]"

SPLIT = rf"[{WS}]+"

# Derived: the characters the cleaner deletes after URL removal.  Deleting
# emoji runs and then everything outside [a-zA-Z] + WS deletes exactly the
# characters outside [a-zA-Z] + (WS minus the emoji ranges); the only WS code
# point inside the emoji ranges is U+3000.  URLs start with a letter, so one
# left-to-right pass "URL, else a run of deletable characters" equals the
# sequential passes; the run is possessive, for no match needs it shorter.
# Java tests a class range by range, so the many ranges of the wide white space
# stand behind one test for ASCII (a fifth of the time of one negated class).
WIDE_WS_NOT_EMOJI = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
CLEAN_DELETE = (rf"{URL}|[\x00-\x08\x0e-\x1b!-@\x{{5b}}-\x{{60}}\x{{7b}}-\x{{7f}}"
                rf"[\x{{80}}-\x{{10ffff}}&&[^{WIDE_WS_NOT_EMOJI}]]]++")

# Tokens the TF-IDF vectoriser keeps: runs of two or more word characters.
# After cleaning only ASCII letters remain, so a word is a token iff len >= 2.
MIN_TOKEN_LEN = 2
