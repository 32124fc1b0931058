"""The symbol list as a file: reading both of its forms, and writing it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlytics.functions.tickers import normal_symbol


def symbols_of(documents: DataFrame, column: str = "value") -> DataFrame:
    """Distinct symbols of JSON documents: ``{"symbols": [...]}`` or a bare ``[...]``.

    Entries that are not strings are skipped; no shape is asked of the others.
    """
    document = F.try_parse_json(column)
    listed = F.coalesce(
        F.try_variant_get(document, "$.symbols", "array<variant>"),
        F.try_variant_get(document, "$", "array<variant>"),
    )
    entries = documents.select(F.explode(listed).alias("entry"))
    texts = entries.filter(F.schema_of_variant("entry") == "STRING").select(
        normal_symbol(F.try_variant_get("entry", "$", "string")).alias("symbol")
    )
    return texts.distinct()


def load_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbols of the JSON files at ``path``, each holding one document."""
    return symbols_of(spark.read.text(path, wholetext=True))


def symbols_document(symbols: DataFrame, updated_at: float) -> DataFrame:
    """One row with the sorted, distinct symbols as a JSON document.

    The format is one document, which a reader holds whole; a list too long for that is written by
    :func:`save_symbol_rows`.
    """
    return (
        symbols.select("symbol")
        .distinct()
        .agg(F.sort_array(F.collect_list("symbol")).alias("symbols"))
        .select(
            F.to_json(F.struct("symbols", F.lit(float(updated_at)).alias("updated_at"))).alias(
                "value"
            )
        )
    )


def save_symbols(symbols: DataFrame, path: str, updated_at: float) -> None:
    symbols_document(symbols, updated_at).write.mode("overwrite").text(path)


def symbol_rows(symbols: DataFrame, updated_at: float) -> DataFrame:
    """The symbol list with a JSON document per symbol, sorted over all tasks: ``{"symbols": [one], ...}``.

    Every line is a document that :func:`symbols_of` reads, and no task holds more than its range.
    """
    document = F.to_json(F.struct(F.array("symbol").alias("symbols"), F.lit(float(updated_at)).alias("updated_at")))
    return symbols.select("symbol").distinct().orderBy("symbol").select(document.alias("value"))


def save_symbol_rows(symbols: DataFrame, path: str, updated_at: float) -> None:
    """Write :func:`symbol_rows`, whose files in the order of their names hold the list in order."""
    symbol_rows(symbols, updated_at).write.mode("overwrite").text(path)
