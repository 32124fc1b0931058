"""Model responses: find the JSON in the text, and check it strictly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlytics.functions.text import strip

# Code-fence marks, and the layout of an extraction response.
FENCE_PATTERN = r"^```(?:json)?|```\z"
OBJECT_PATTERN = r"(?s)\{.*\}"
RESPONSE_SCHEMA = "tickers array<struct<symbol:string,name:string>>, hype_score string"
HYPE_FIELD = "$.contextual_hype"

STRICT = {"allowSingleQuotes": "false"}


def is_json(text: Column) -> Column:
    """True when the whole text is exactly one JSON value.

    Spark's parsers stop after the first value.  Wrapping the text once as an array and
    once as an object field makes any text around the value break at least one of them.
    """
    as_item = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", STRICT)
    as_field = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")),
        "v string, broken string",
        {**STRICT, "columnNameOfCorruptRecord": "broken"},
    )
    return F.coalesce((F.size(as_item) == 1) & as_field["broken"].isNull(), F.lit(False))


def clean_json(response: Column) -> Column:
    """JSON inside a response, '' when there is none.

    Tries the span from the first opening to the last closing brace, then the whole text.
    """
    raw = F.coalesce(strip(response), F.lit(""))
    body = strip(F.regexp_replace(raw, FENCE_PATTERN, ""))
    inner = F.regexp_extract(body, OBJECT_PATTERN, 0)
    return F.when(is_json(inner), inner).when(is_json(body), body).otherwise("")
