"""File readers: CSV, JSON, staging text, folder discovery, glossary."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nothing between two commas is null, two quotes are the empty text: the reader's own null mark is a control
# character that no extract holds.
_CSV = {"header": "true", "quote": '"', "escape": '"', "nullValue": "\u0001",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str, partitions: int | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV (plain or gzip) with header and a declared schema; bad values fail the load.

    Plain files are split among tasks. Extracts with newlines inside quotes need ``multi_line``, which reads a file
    in one task, as gzip does anyway: they should come as many files, and ``partitions`` spreads the rows of a few
    large ones before further work.
    """
    df = spark.read.schema(schema).options(**_CSV, multiLine=multi_line, mode="FAILFAST").csv(path)
    return df.repartition(partitions) if partitions else df


def load_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a schema inferred from all rows."""
    return spark.read.options(**_CSV, multiLine=multi_line, inferSchema="true").csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.mode("overwrite").options(header="true", quote='"', escape='"', compression=compression, emptyValue='""',
                                       nullValue="", ignoreLeadingWhiteSpace="false",
                                       ignoreTrailingWhiteSpace="false").csv(path)


def load_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared schema; malformed lines fail the load."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def type_staging(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """All-text staging to typed columns, empty text as null before the cast. Text that is no value of
    the type fails, as a plain cast does; use ``try_type_staging`` to get null."""
    return df.select(*[F.col(c).alias(c) if t == "string" else F.nullif(F.col(c), F.lit("")).cast(t).alias(c)
                       for c, t in casts.items()])


def try_type_staging(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(c) if t == "string" else F.nullif(F.col(c), F.lit("")).try_cast(t).alias(c)
                       for c, t in casts.items()])


def clean_header(names: Sequence[str]) -> list[str]:
    """Identifiers for header cells: letters, digits and ``_`` only, no ``_`` at either end, a letter first; a name that
    is taken, whatever its case, gets the first free number."""
    out: list[str] = []
    taken: set[str] = set()
    for i, n in enumerate(names):
        base = "_".join(re.findall(r"[0-9A-Za-z]+", n)) or f"column_{i + 1}"
        base = f"c_{base}" if base[0].isdigit() else base
        name, number = base, 1
        while name.lower() in taken:
            number += 1
            name = f"{base}_{number}"
        taken.add(name.lower())
        out.append(name)
    return out


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, table, size and time of the files below ``root``; contents are not read. The table is the folder's path
    below ``root``, without partition folders (``name=value``)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .load(root).select("path", F.col("length").alias("size_bytes"), "modificationTime"))
    below = quote(root.rstrip("/").split("://")[-1].removeprefix("file:"), safe="/:=+,;@&$!~*'()")
    folder = F.regexp_extract("path", rf"\Q{below}\E/(?:(.*)/)?[^/]*$", 1)
    return files.withColumn("table_name", F.regexp_replace(folder, r"(^|/)[^/=]+=[^/]*(/[^/=]+=[^/]*)*$", ""))


def discover(spark: SparkSession, root: str, pattern: str = "*.csv", schemas: Mapping[str, T.StructType] | None = None,
             multi_line: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """One table per folder of CSV files, named by its path below ``root``: cleaned header, inferred (or given) schema; and
    the audit, one row per file. Only the names of table folders reach the driver."""
    files = list_files(spark, root, pattern)
    base = root.rstrip("/")
    tables = {}
    for row in files.select("table_name").distinct().collect():
        name = unquote(row["table_name"])
        folder, schema = f"{base}/{name}".rstrip("/"), (schemas or {}).get(name)
        df = load_csv(spark, folder, schema, multi_line=multi_line) if schema is not None else load_csv_inferred(spark, folder, multi_line)
        tables[name] = df.toDF(*clean_header(df.columns))
    return tables, files.select("table_name", F.element_at(F.split("path", "/"), -1).alias("object_name"), "path", "size_bytes",
                                "modificationTime", F.lit("CSV").alias("format"))


def glossary(spark: SparkSession, text: str) -> DataFrame:
    """Flat terms of a YAML glossary: category, synonyms, related terms and linked columns as text, steward."""
    try:
        import yaml
    except ImportError as exc:  # the parser is optional
        raise RuntimeError("reading a glossary needs the yaml package") from exc
    doc = yaml.safe_load(text)
    names = {c["id"]: c["display_name"] for c in doc.get("categories", [])}
    join = lambda term, k: ", ".join(term.get(k, []) or [])
    rows = [(doc["glossary"]["id"], t["category"], names.get(t["category"], t["category"]), t["id"], t["display_name"],
             t["definition"], join(t, "synonyms"), join(t, "related_terms"), join(t, "linked_columns"), t.get("steward", ""))
            for t in doc["terms"]]
    return spark.createDataFrame(rows, "glossary_id string, category_id string, category_name string, term_id string, "
                                       "term_name string, definition string, synonyms string, related_terms string, "
                                       "linked_columns string, steward string")
