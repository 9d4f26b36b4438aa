"""Content-derived ids, as column expressions that any SQL engine can repeat."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from facetlake.functions.constants import DEFAULT_CONFIG, PIPELINE_VERSION, SCHEMA_VERSION


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def config_hash(config: dict = DEFAULT_CONFIG) -> str:
    return hashlib.sha256(canonical_json(config).encode()).hexdigest()[:16]


def short_hash(*parts: Column | str, size: int = 16) -> Column:
    """Hexadecimal start of the SHA-256 of the parts joined by a bar."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, size)


def sample_id(sha: Column | str, config: str | None = None) -> Column:
    fixed = [F.lit(x) for x in (PIPELINE_VERSION, config or config_hash(), SCHEMA_VERSION)]
    return F.concat(F.lit("s_"), short_hash(sha, *fixed, size=24))


def job_key(sha: Column | str, config: str | None = None) -> Column:
    """Idempotency key of a processing job; the schema version is part of it, as it is of the sample id."""
    return F.concat_ws(":", sha, F.lit(PIPELINE_VERSION), F.lit(config or config_hash()), F.lit(SCHEMA_VERSION))


def quantize(value: Column | str, step: float) -> Column:
    """Steps of ``step``, halves to even, as a whole number."""
    return F.bround(F.col(value) / F.lit(step) if isinstance(value, str) else value / F.lit(step)).cast("long")


def entity_id(prefix: str, index: Column | str) -> Column:
    """F007, F123, F1000: for display alone; order by the number."""
    text = (F.col(index) if isinstance(index, str) else index).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text))
