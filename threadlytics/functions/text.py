"""Text, id and time expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Words that mark a post as likely financial.
FINANCIAL_INDICATORS = ["$", "YOLO", "CALL", "PUT", "TSLA", "AAPL", "NVDA", "SPY", "META", "STOCK"]
# Normalisation defaults.
PERMALINK_PREFIX = "https://reddit.com"
DEFAULT_SUBREDDIT = "wallstreetbets"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# The same characters as a class for regular expressions.
SPACE_CLASS = "".join(rf"\x{{{ord(character):x}}}" for character in WHITESPACE)
# Fixed values: [deleted] and [removed] stand for a removed comment.
# Something to read; a removal placeholder; text of at least three characters.  Each is
# settled at the start of a text as a rule, where stripping would walk all of it.
NOT_BLANK_PATTERN = f"[^{SPACE_CLASS}]"
PLACEHOLDER_PATTERN = rf"^[{SPACE_CLASS}]*\[(?:deleted|removed)\][{SPACE_CLASS}]*\z"
THREE_CHARACTERS_PATTERN = f"(?s)[^{SPACE_CLASS}].+?[^{SPACE_CLASS}]"

# A letter, digit or underscore, in any script.
WORD = r"[\p{L}\p{N}_]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def stripped_or_empty(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def base36_id(identifier: Column) -> Column:
    """Number behind a base-36 id of any length; null when it is not base-36 or exceeds a BIGINT.

    More than 13 digits after leading zeros always exceed it.  Up to 13 are converted in two
    parts, whose sum is null on overflow.
    """
    digits = F.regexp_replace(identifier, "^0+(?=.)", "")
    padded = F.lpad(digits, 13, "0")
    high, low = (F.conv(F.substring(padded, *part), 36, 10).cast("bigint") for part in ((1, 7), (8, 6)))
    value = F.try_add(F.try_multiply(high, F.lit(36**6).cast("bigint")), low)
    return F.when(identifier.rlike("^[0-9a-zA-Z]+\\z") & (F.length(digits) <= 13), value)


def epoch_or_zero(seconds: Column) -> Column:
    """Post rule: a missing time is the epoch itself."""
    return F.timestamp_seconds(F.coalesce(seconds, F.lit(0)))


def epoch_or_null(seconds: Column) -> Column:
    """Comment rule: a missing or zero time is unknown."""
    return F.timestamp_seconds(F.nullif(seconds, F.lit(0)))


def iso_utc(moment: Column) -> Column:
    return F.date_format(moment, ISO_UTC)


def parent_id(full_name: Column) -> Column:
    """``t1_abc`` to ``abc``: the text after the first underscore, null without one."""
    at = F.instr(full_name, "_")
    return F.when(at > 0, F.substring(full_name, at + 1, F.length(full_name)))


def parent_kind(full_name: Column) -> Column:
    """Ids of posts and comments may coincide once the prefix is gone; keep what it said."""
    return F.when(full_name.startswith("t3_"), "post").when(
        full_name.startswith("t1_"), "comment"
    )


def post_text(title: Column, body: Column) -> Column:
    return F.concat(
        F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit(""))
    )


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text.rlike(NOT_BLANK_PATTERN), F.lit(False))


def is_analyzable(body: Column) -> Column:
    return ~is_blank(body) & ~body.rlike(PLACEHOLDER_PATTERN)


def has_three_characters(text: Column) -> Column:
    """Whether the stripped text has three characters or more."""
    return F.coalesce(text.rlike(THREE_CHARACTERS_PATTERN), F.lit(False))


def is_likely_financial(title: Column, body: Column) -> Column:
    loud = F.upper(
        F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))
    )
    return loud.rlike("|".join(re.escape(word) for word in FINANCIAL_INDICATORS))


def first_filled_array(first: Column, second: Column) -> Column:
    """First non-empty array of the two, else an empty one."""
    return F.coalesce(
        F.when(F.size(first) > 0, first),
        F.when(F.size(second) > 0, second),
        F.array(),
    )
