"""JSON documents as VARIANT: parsed once, read by path, broken ones apart, one canonical text for hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(documents: DataFrame, text: str, document: str = "document") -> DataFrame:
    """Adds ``document``: the text as a variant, null where it is null or no JSON."""
    return documents.withColumn(document, F.try_parse_json(text))


def broken(text: str, document: str = "document") -> Column:
    """Whether there is a text that is no JSON; such rows go to quarantine and not to the readers of fields."""
    return F.col(text).isNotNull() & F.col(document).isNull()


def fields(paths: dict[str, tuple[str, str]], document: str = "document") -> list[Column]:
    """Columns by name from (path, type); null where the path is missing or its value is of another type."""
    return [F.try_variant_get(document, path, kind).alias(name) for name, (path, kind) in paths.items()]


def canonical(document: str = "document") -> Column:
    """The variant's text: no white space, members of objects in the order of their names, numbers as they are stored; equal documents have equal texts."""
    return F.to_json(document)


def content_hash(document: str = "document") -> Column:
    return F.sha2(canonical(document), 256)
