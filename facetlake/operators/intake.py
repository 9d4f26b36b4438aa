"""Intake: what a file is, and why it is turned away."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions.constants import DEFAULT_CONFIG, LENGTH_UNITS

HEAD_BYTES, FIELD_CHARS = 65536, 200
# How the exchange format begins, and the header fields that are read.
MAGIC = "ISO-10303-21"
FILE_SCHEMA = r"(?is)FILE_SCHEMA\s*\(\s*\(\s*'([^']*)'"
FILE_NAME = r"(?s)FILE_NAME\s*\((.*?)\);"


def intake_code(size: Column, name: Column, head: Column, max_bytes: int = DEFAULT_CONFIG["ingestion"]["max_file_bytes"], extensions: tuple[str, ...] = (".step", ".stp"), magic: str = MAGIC) -> Column:
    """The first failing check of empty, too large, extension, magic; null when all pass. ``head`` is the content's start, as ISO-8859-1 or decoded."""
    extension = F.lower(F.regexp_extract(name, r"(\.[^./\\]*)$", 1))
    body = F.regexp_replace(head, "^[\u00ef\u00bb\u00bf\ufeff \t\r\n]+", "")  # the byte order mark in either form
    return F.when(size == 0, "EMPTY_FILE").when(size > max_bytes, "FILE_TOO_LARGE").when(~extension.isin(*extensions), "UNSUPPORTED_EXTENSION").when(~body.startswith(magic), "NOT_STEP_CONTENT")


def header_fields(head: Column) -> dict[str, Column]:
    """Schema (in any case, trimmed) and originating system from the text of a Part-21 header; of each at most FIELD_CHARS characters, null where empty."""
    quoted = F.regexp_extract_all(F.regexp_extract(head, FILE_NAME, 1), F.lit(r"'([^']*)'"), 1)
    field = lambda c: F.nullif(F.substring(c, 1, FIELD_CHARS), F.lit(""))
    schema = F.regexp_replace(F.regexp_extract(head, FILE_SCHEMA, 1), r"^\s+|\s+$", "")
    return {"step_schema": field(schema), "originating_system": F.when(F.size(quoted) >= 6, field(F.element_at(quoted, -2)))}


def detect_unit(text: Column, units: tuple[tuple[str, str], ...] = LENGTH_UNITS) -> Column:
    """The unit whose pattern matches earliest, in any case; null if none does. Ties go to the earlier pattern."""
    hits = F.array(*[F.struct(F.regexp_instr(text, F.lit(f"(?i){p}")).alias("at"), F.lit(i).alias("rank"), F.lit(u).alias("unit")) for i, (p, u) in enumerate(units)])
    return F.array_min(F.filter(hits, lambda h: h["at"] > 0))["unit"]


def count_entities(text: Column, name: str) -> Column:
    return F.regexp_count(text, F.lit(rf"(?i)=\s*{name}\s*\("))


def structure_code(roots: Column, products: Column, shapes: Column, solids: Column, faces: Column, bare_faces: Column) -> Column:
    """The structural policy over counts, in order."""
    return F.when(roots == 0, "STEP_NO_SHAPES").when(products > 1, "UNSUPPORTED_ASSEMBLY").when(shapes == 0, "STEP_NO_SHAPES").when(solids > 1, "MULTI_BODY").when(faces == 0, "STEP_NO_SHAPES").when(bare_faces > 0, "UNSUPPORTED_TESSELLATED")


def first_code(*codes: Column) -> Column:
    """The first verdict that is not null, of checks in their order."""
    return F.coalesce(*codes)


def degenerate_code(volume: Column, area: Column) -> Column:
    return F.when((volume <= 0) | (area <= 0), "DEGENERATE_GEOMETRY")


def _ascii(name: Column) -> Column:
    """Compatibility decomposition; Spark has no function for it."""

    @F.pandas_udf("string")
    def fold(names: pd.Series) -> pd.Series:
        return names.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode())

    return fold(name)


def sanitize_filename(name: Column, longest: int = 128) -> Column:
    """A safe base name that keeps an extension of at most eight characters."""
    # As in a path, slashes and "." at the end do not count: "a/b/" is named "b".
    base = F.element_at(F.split(F.regexp_replace(F.regexp_replace(name, r"\\", "/"), r"(/\.?)+$", ""), "/"), -1)
    # Plain names stay in the JVM's own functions; the others take the Unicode path.
    folded = F.when(base.rlike(r"^[\x00-\x7f]*$"), base).otherwise(_ascii(base))
    safe = F.regexp_replace(F.regexp_replace(folded, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    safe = F.when(safe == "", "unnamed").otherwise(safe)
    extension = F.regexp_extract(safe, r"(\.[A-Za-z0-9_-]{1,8})$", 1)
    return F.when(F.length(safe) <= longest, safe).otherwise(F.concat(F.substring(safe, F.lit(1), F.lit(longest) - F.length(extension)), extension))


# Names of the public test parts' exports: collection, number and variant.
PART_NAME = r"(?i)^nist_(ctc|ftc|stc)_(\d+)_asme1_(.+)\.stp$"


def part_key(name: Column) -> tuple[Column, Column]:
    """The part that a file shows, and which export of it: the simplified collection shares its parts with the full one; any other name is a part of its own."""
    field = lambda i: F.regexp_extract(name, PART_NAME, i)
    kind, known = F.lower(field(1)), name.rlike(PART_NAME)
    family = F.when(kind == "ctc", "ctc").otherwise("ftc")
    return F.when(known, F.concat_ws("_", family, field(2))).otherwise(name), F.when(known, F.concat_ws(":", kind, field(3))).otherwise("?")


def valid_storage_key(key: Column) -> Column:
    """Slash-separated plain segments, none empty, "." or ".."; no leading slash."""
    segments = F.split(key, "/")
    return key.rlike(r"^[A-Za-z0-9._/-]+$") & ~F.exists(segments, lambda s: s.isin("", ".", ".."))


def probe_files(files: DataFrame) -> DataFrame:
    """Of binaryFile rows (path, length, content): name, sha256, code, header fields, unit."""
    head = F.decode(F.substring("content", 1, HEAD_BYTES), "ISO-8859-1")
    named = files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), head.alias("head"))
    named = named.withColumn("filename", sanitize_filename(F.col("filename"))).withColumn("code", intake_code(F.col("size_bytes"), F.col("filename"), F.col("head")))
    return named.select("path", "filename", "size_bytes", "sha256", "code", *(c.alias(k) for k, c in header_fields(F.col("head")).items()), detect_unit(F.col("head")).alias("original_units"))
