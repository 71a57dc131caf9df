"""Text normalisation as built-in Spark expressions (no Python UDF).

The warehouse functions these rules stand in for behave differently from
Spark's own ``trim`` and ``initcap``:

* its TRIM removes every kind of whitespace, Spark's removes only U+0020;
* its INITCAP starts a new word after punctuation as well as after spaces,
  Spark's only after spaces (``initcap('saint-denis') = 'Saint-denis'``).

Both are rebuilt from ``regexp_replace`` / ``regexp_extract_all`` /
``transform`` so they stay JVM-side. The same patterns are valid in Java and
RE2, so the DuckDB oracle reuses them verbatim (see :mod:`revlens.oracle`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Whitespace removed by TRIM: the ASCII controls TAB..CR, every Unicode space
# separator (category Z, which includes NO-BREAK SPACE) and NEXT LINE.
WHITESPACE_CLASS = r"\t-\r\p{Z}\x{85}"
# Characters that end a word for INITCAP (public function documentation):
# whitespace and  [ ] ( ) { } / | \ < > ! ? @ " ^ # $ & ~ _ , . : ; * % + -
WORD_DELIMITERS = r"""[](){}/|\<>!?@"^#$&~_,.:;*%+-"""
# ---------------------------------------------------------------------------


def _class_body(chars: str) -> str:
    """Escape characters that are special inside a regex character class."""
    return "".join("\\" + ch if ch in "[]\\^-" else ch for ch in chars)


DELIMITER_CLASS = WHITESPACE_CLASS + _class_body(WORD_DELIMITERS)
TRIM_PATTERN = rf"^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$"
# A string is a sequence of word runs and delimiter runs.
TITLE_TOKEN_PATTERN = rf"[^{DELIMITER_CLASS}]+|[{DELIMITER_CLASS}]+"


def trim_ws(col: Column | str) -> Column:
    """TRIM that strips tabs, NBSP and other Unicode spaces at both ends."""
    return F.regexp_replace(_c(col), TRIM_PATTERN, "")


def norm_email(col: Column | str) -> Column:
    """LOWER(TRIM(email)): the dedup key of the customer table."""
    return F.lower(trim_ws(col))


def title_case(col: Column | str) -> Column:
    """INITCAP(TRIM(s)): lower-case everything, upper-case each word's first letter.

    Tokenises into alternating word / delimiter runs, upper-cases the first
    character of every token (a no-op for delimiter runs) and joins back.
    """
    tokens = F.regexp_extract_all(F.lower(trim_ws(col)), F.lit(TITLE_TOKEN_PATTERN), 0)
    capped = F.transform(
        tokens, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    )
    return F.array_join(capped, "")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
