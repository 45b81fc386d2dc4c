"""Text expressions (JVM regex, no Python per row).

Python's ``\\w``/``\\s`` are Unicode-aware; Java's and RE2's are ASCII. The
classes below spell the Unicode meaning out, and read the same in Spark
(Java regex) and DuckDB (RE2), so one pattern string serves both engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossa.functions.numeric import col_

# Patterns of the cleaning and extraction rules.
WS = r"\s\p{Z}"                      # whitespace (Unicode separators included)
WORD = r"\p{L}\p{N}_"                # Python's Unicode \w
URL_PATTERN = rf"http[^{WS}]+"       # http\S+
NON_WORD_PATTERN = rf"[^{WORD}{WS}@#]"  # [^\w\s@#]
WS_RUN_PATTERN = rf"[{WS}]+"         # \s+
TOKEN_PATTERN = rf"[^{WS}]+"         # str.split() tokens
HASHTAG_PATTERN = rf"#([{WORD}]+)"   # #(\w+)
MENTION_PATTERN = rf"@([{WORD}]+)"   # @(\w+)


def clean_text(c: str | Column) -> Column:
    """NULL → ''; drop URLs; non-(word/space/@/#) → space; collapse spaces; trim."""
    t = F.coalesce(col_(c).cast("string"), F.lit(""))
    t = F.regexp_replace(t, URL_PATTERN, "")
    t = F.regexp_replace(t, NON_WORD_PATTERN, " ")
    t = F.regexp_replace(t, WS_RUN_PATTERN, " ")
    return F.trim(t)


def char_count(c: str | Column, ch: str) -> Column:
    """Occurrences of a literal character."""
    c = col_(c)
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def word_count(c: str | Column) -> Column:
    """Whitespace-separated tokens (Python ``len(text.split())``)."""
    return F.regexp_count(F.coalesce(col_(c), F.lit("")), F.lit(TOKEN_PATTERN)).cast("long")


def non_space_chars(c: str | Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(col_(c), F.lit("")), rf"[{WS}]", ""))


def contains_any(lower_text: Column, keywords) -> Column:
    cond = None
    for kw in keywords:
        c = lower_text.contains(kw)
        cond = c if cond is None else (cond | c)
    return F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(False)


def first_matching_rule(c: str | Column, rules, default: str) -> Column:
    """Label of the first rule (ordered ``(label, keywords)``) whose keyword is a
    case-insensitive substring of the text; ``default`` if none matches."""
    low = F.lower(F.coalesce(col_(c), F.lit("")))
    expr = None
    for label, kws in rules:
        cond = contains_any(low, kws)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def all_matching_rules(c: str | Column, rules, limit: int | None = None) -> Column:
    """Labels of every matching rule, in rule order, the first ``limit`` kept."""
    low = F.lower(F.coalesce(col_(c), F.lit("")))
    arr = F.array(*[F.when(contains_any(low, kws), F.lit(label)) for label, kws in rules])
    hits = F.filter(arr, lambda x: x.isNotNull())
    return F.slice(hits, 1, limit) if limit else hits


def hashtags(c: str | Column) -> Column:
    """Every ``#word`` without the ``#``; none → empty array."""
    return F.regexp_extract_all(F.coalesce(col_(c), F.lit("")), F.lit(HASHTAG_PATTERN), 1)


def mentions(c: str | Column) -> Column:
    """Every ``@word`` without the ``@``."""
    return F.regexp_extract_all(F.coalesce(col_(c), F.lit("")), F.lit(MENTION_PATTERN), 1)


def normalize_hashtag(c: str | Column) -> Column:
    """Strip ``#`` and lower-case."""
    return F.lower(F.replace(col_(c), F.lit("#"), F.lit("")))


def preview(c: str | Column, n: int = 300) -> Column:
    """First ``n`` characters plus ``...`` when longer."""
    c = col_(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)
