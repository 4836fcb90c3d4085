"""Point lookups."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_plain_id(raw: str) -> bool:
    """Letters, digits, underscore and hyphen only, at least one."""
    return re.fullmatch("[0-9A-Za-z_-]+", raw) is not None


def lookup_row(df: DataFrame, key: str, raw_id: str) -> DataFrame:
    """The row with this id, or one NOT_FOUND row that carries the id as given. An id with other signs is not looked up.

    The id is a literal of the plan, never part of SQL text, and the filter reaches the scan.
    """
    hit = df.where((F.col(key) == raw_id) & F.lit(is_plain_id(raw_id))).limit(1)
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = df.sparkSession.range(1).where(~hit.select(F.lit(1)).exists()).select(*[
        F.lit(raw_id if c == key else None).cast(types[c]).alias(c) for c in df.columns])
    return hit.withColumn("status", F.lit("FOUND")).unionByName(missing.withColumn("status", F.lit("NOT_FOUND")))
