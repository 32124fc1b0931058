"""Ticker expressions: symbols, candidates, spans and confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlytics.functions.text import WORD, strip

# Words that look like tickers but are not.
STOP_WORDS = ["IT", "ALL", "GO"]
# Symbol shape, one to six letters or dots.
SYMBOL_PATTERN = r"^[\p{L}.]{1,6}$"
# Tag shape, $ and one to five letters or the bare upper-case letters,
# with an optional class suffix as in BRK.B.
# The first character comes before the look-behind, which then runs at few places.
CANDIDATE_PATTERN = (
    r"\$(?<![\p{L}\p{N}_$]\$)[A-Za-z]{1,5}(?:\.[A-Za-z])?(?![\p{L}\p{N}_])"
    r"|[A-Z](?<![\p{L}\p{N}_$][A-Z])[A-Z]{0,4}(?:\.[A-Z])?(?![\p{L}\p{N}_])"
)
# Parts of the extraction confidence.
CONFIDENCE_BASE = 0.8
CONFIDENCE_NAMED = 0.1
CONFIDENCE_SHORT = 0.1
CONFIDENCE_LONG = 0.05
CONFIDENCE_UNSEEN = 0.2
CONFIDENCE_RANGE = (0.3, 1.0)


def normal_symbol(symbol: Column) -> Column:
    """Upper-case symbol without surrounding white space."""
    return F.upper(strip(symbol))


def is_symbol_shape(symbol: Column) -> Column:
    return normal_symbol(symbol).rlike(SYMBOL_PATTERN)


def ticker_candidates(text: Column) -> Column:
    """Distinct tags of a text in order of appearance, stop words left out."""
    found = F.regexp_extract_all(text, F.lit(CANDIDATE_PATTERN), F.lit(0))
    bare = F.transform(found, lambda tag: F.upper(F.ltrim(tag, F.lit("$"))))
    return F.array_except(F.array_distinct(bare), F.array(*[F.lit(w) for w in STOP_WORDS]))


# A word boundary: a word character on exactly one side.
BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
# The ticker stands before the text, set off by a NUL, and is referred back to.  The
# patterns are the same for every row, so they are compiled once.
TAG_PATTERN = rf"(?isu)^([^\x00]*)\x00.*?\$\1{BOUNDARY}"
WORD_PATTERN = rf"(?isu)^([^\x00]*)\x00.*?(?=\1){BOUNDARY}\1{BOUNDARY}"


def _length_before(text: Column, ticker: Column, pattern: str, extra: int) -> Column:
    """Code points before the first match, negative when there is none."""
    joined = F.concat(ticker, F.lit("\x00"), text)
    matched = F.length(F.regexp_extract(joined, pattern, 0))
    return matched - F.length(ticker) * 2 - 1 - extra


def length_before_tag(text: Column, ticker: Column) -> Column:
    """Code points before the ticker written with a ``$``, negative when there is none."""
    return _length_before(text, ticker, TAG_PATTERN, 1)


def length_before_word(text: Column, ticker: Column) -> Column:
    """Code points before the ticker as a word of its own, negative when there is none."""
    return _length_before(text, ticker, WORD_PATTERN, 0)


def loose_position(text: Column, ticker: Column) -> Column:
    """1-based place of the ticker anywhere in the upper-cased text, 0 when it is not there."""
    return F.position(F.upper(ticker), F.upper(text))


def extraction_confidence(ticker: Column, company_name: Column, seen: Column) -> Column:
    """0.8, more with a name and for long tickers, less for short or unseen ones."""
    size = F.length(ticker)
    named = F.coalesce(strip(company_name), F.lit("")) != ""
    low, high = CONFIDENCE_RANGE
    score = (
        F.lit(CONFIDENCE_BASE)
        + F.when(named, CONFIDENCE_NAMED).otherwise(0.0)
        + F.when(size <= 2, -CONFIDENCE_SHORT).when(size >= 4, CONFIDENCE_LONG).otherwise(0.0)
        - F.when(seen, 0.0).otherwise(CONFIDENCE_UNSEEN)
    )
    return F.greatest(F.lit(low), F.least(F.lit(high), score))
