"""Short texts shown beside results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREVIEW_CHARS = 100


def percent(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def preview(text: Column) -> Column:
    return F.when(
        F.length(text) > PREVIEW_CHARS, F.concat(F.left(text, F.lit(PREVIEW_CHARS)), F.lit("..."))
    ).otherwise(text)


def search_key(name: Column) -> Column:
    return F.concat_ws("_", F.lit("SEARCH"), name.cast("string"))


def local_key(name: Column, threshold: Column) -> Column:
    return F.concat_ws("_", F.lit("LOCAL"), name.cast("string"), threshold.cast("double").cast("string"))


def tamper_key(name: Column, threshold: Column) -> Column:
    return F.concat_ws("_", F.lit("TAMPER"), name.cast("string"), threshold.cast("int").cast("string"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
