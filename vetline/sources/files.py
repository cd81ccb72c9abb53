"""File and catalog readers.

Scale notes: give a schema whenever one is known. Without it, a CSV read
costs one look at the header (all columns strings, no inference pass), but a
JSON read samples the whole input to infer types (``samplingRatio`` bounds it).
Reading a partitioned root (``year=/month=/...``) with partition discovery lets
a filter on the partition columns skip directories; ``recursive=True`` turns
discovery off, so use it only for layouts that are not partitioned.

Malformed records: ``keep_malformed=True`` adds the column ``_corrupt_record``,
the raw text of a record that does not fit the schema (a value of another type,
too few or too many fields, broken JSON) and NULL for all others. ``load`` and
``ingest`` reject such records to the dead-letter queue. Without it a value that
does not fit reads as NULL.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values ---------------------------------------------------------------
# Format rule: an extension of ".json" (any case) means JSON; every other path,
# with or without an extension, is read as CSV. Dots in directory names are
# ignored; only the last path component's extension counts.
JSON_EXTENSION = ".json"
# ------------------------------------------------------------------------------------


#: Options under which CSV text survives a round trip: blanks, padding, quotes
#: and line breaks stay, an unquoted empty field is NULL and a quoted one empty.
#: Columns are positional, so a header that disagrees with the schema fails
#: instead of shifting values. A record is one line, so large files are split
#: over tasks; pass ``multiLine=True`` (one task a file) where values hold line breaks.
CSV_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
               "nullValue": "\0", "emptyValue": "", "multiLine": False, "enforceSchema": False}

#: Holds the raw text of a record that could not be read; NULL for all others.
CORRUPT = "_corrupt_record"


def with_corrupt(schema: StructType | str) -> StructType:
    """``schema`` with the column of malformed records."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


#: What a reader needs to fill that column, whatever columns a query uses.
CORRUPT_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}


def detect_format(path: str) -> str:
    """``"json"`` for a ``.json`` path (any case), ``"csv"`` otherwise."""
    ext = os.path.splitext(path)[1].lower()
    return "json" if ext == JSON_EXTENSION else "csv"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
             header: bool = True, recursive: bool = False, keep_malformed: bool = False, **options) -> DataFrame:
    """Header CSV. Without a schema every column is a string (no inference)."""
    reader = spark.read.options(header=header, **{**CSV_OPTIONS, **options})
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if keep_malformed:
        schema = with_corrupt(schema if schema is not None else reader.csv(path).schema)
        reader = reader.options(**CORRUPT_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
              recursive: bool = False, keep_malformed: bool = False, **options) -> DataFrame:
    """Line-delimited JSON."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if keep_malformed:
        schema = with_corrupt(schema if schema is not None else reader.json(path).schema)
        reader = reader.options(**CORRUPT_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.json(path)


def read_auto(spark: SparkSession, path: str, schema: StructType | str | None = None,
              recursive: bool = False, keep_malformed: bool = False, **options) -> DataFrame:
    """Read ``path`` in the format its extension names (see ``detect_format``)."""
    if detect_format(path) == "json":
        return read_json(spark, path, schema=schema, recursive=recursive, keep_malformed=keep_malformed, **options)
    return read_csv(spark, path, schema=schema, recursive=recursive, keep_malformed=keep_malformed, **options)


def partitioned_schema(data_schema: StructType, partition_columns: list[str]) -> StructType:
    """Data schema plus string partition columns.

    Given to the reader, it keeps zero-padded values such as ``month=03`` as
    text instead of letting discovery turn them into integers.
    """
    fields = list(data_schema.fields) + [StructField(c, StringType(), True) for c in partition_columns]
    return StructType(fields)


def read_partitioned(spark: SparkSession, root: str, fmt: str = "csv",
                     schema: StructType | None = None, partition_columns: list[str] | None = None,
                     keep_malformed: bool = False, **options) -> DataFrame:
    """Read a Hive-style partitioned root with partition discovery.

    With ``schema`` and ``partition_columns`` the partition values stay
    strings; filters on them prune directories before any file is opened.
    ``keep_malformed`` needs the schema.
    """
    if keep_malformed:
        if schema is None:
            raise ValueError("keep_malformed needs a schema")
        schema, options = with_corrupt(schema), {**CORRUPT_OPTIONS, **options}
    reader = spark.read.format(fmt).option("basePath", root)
    if fmt == "csv":
        options = {"header": True, **CSV_OPTIONS, **options}
    if schema is not None:
        full = partitioned_schema(schema, partition_columns or []) if partition_columns else schema
        reader = reader.schema(full)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(root)


def read_catalog(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Catalog table scan (``database.table``)."""
    return spark.table(f"`{database}`.`{table}`")
