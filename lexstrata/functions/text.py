"""Text functions as column expressions, each with the SQL text of the same rule for the oracle.

Patterns are written for both regular expression engines: explicit classes for white space and letters, no look-around.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode (fixed values).
WS = r"[\t-\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Word characters.
WORD = r"[\p{L}\p{N}\p{M}\p{Pc}]+"
#: Quote characters that matching ignores (fixed values).
QUOTES = "\"«»“”„‟"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, so that nested uses don't multiply in the plan."""
    return F.element_at(F.transform(F.array(value), use), 1)


def lit_sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def source_text(c: Column) -> Column:
    """Normal form of a text: one kind of space and dash, no space before punctuation, no punctuation at the end; null becomes empty."""
    x = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x{2010}-\x{2015}]", "-")
    x = F.trim(F.regexp_replace(x, WS + "+", " "))
    x = F.regexp_replace(x, " +([,.;:])", "$1")
    return F.trim(F.regexp_replace(x, "[.;:,]+$", ""))


def source_text_sql(c: str) -> str:
    x = f"regexp_replace(coalesce({c}, ''), '[\\x{{2010}}-\\x{{2015}}]', '-', 'g')"
    x = f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'), ' ')"
    x = f"regexp_replace({x}, ' +([,.;:])', '\\1', 'g')"
    return f"trim(regexp_replace({x}, '[.;:,]+$', ''), ' ')"


def matching_text(c: Column) -> Column:
    """The normal form without quotes."""
    return F.translate(source_text(c), QUOTES, "")


def matching_text_sql(c: str) -> str:
    return f"translate({source_text_sql(c)}, {lit_sql(QUOTES)}, '')"


def count_words(c: Column) -> Column:
    """Number of runs of word characters; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def count_words_sql(c: str) -> str:
    return f"len(regexp_extract_all(coalesce({c}, ''), '{WORD}'))"


def truncated(c: Column, most: int) -> Column:
    """The text, or its first ``most`` characters and a mark that it goes on."""
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit(" [...]"))).otherwise(c)


def resource_name(c: Column) -> Column:
    """A name for files and resources: letters, digits, point, hyphen and underscore; starts with a letter or underscore."""
    safe = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^0-9A-Za-z_.\-]+", "_"), "^_+|_+$", "")
    return F.when(safe.rlike("^[A-Za-z_]"), safe).otherwise(F.concat(F.lit("doc_"), safe))


def resource_name_sql(c: str) -> str:
    safe = f"regexp_replace(regexp_replace(coalesce({c}, ''), '[^0-9A-Za-z_.\\-]+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"CASE WHEN regexp_matches({safe}, '^[A-Za-z_]') THEN {safe} ELSE 'doc_' || {safe} END"


def uri_token(c: Column) -> Column:
    """A token of a URI: lower case, other characters as underscores; ``documento`` where nothing is left."""
    token = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^0-9a-z]+", "_"), "^_+|_+$", "")
    return F.when(token == "", "documento").otherwise(token)


def uri_token_sql(c: str) -> str:
    token = f"regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^0-9a-z]+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"CASE WHEN {token} = '' THEN 'documento' ELSE {token} END"


def eid_token(c: Column) -> Column:
    """A token of an element id: letters, digits and hyphens; empty where nothing is left."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9A-Za-z]+", "-"), "^-+|-+$", "")


def eid_token_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({c}, ''), '[^0-9A-Za-z]+', '-', 'g'), '^-+|-+$', '', 'g')"
