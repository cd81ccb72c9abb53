"""Small DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.session import delete_path, scratch_path


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def durable(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors.

    The folder stays until ``clear_scratch``, for results may read it whenever they are computed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    _scratch(spark).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _scratch(spark: SparkSession) -> list[str]:
    """Folders that ``durable`` has written in this application."""
    context = spark.sparkContext
    if not hasattr(context, "_vetline_scratch"):
        context._vetline_scratch = []
    return context._vetline_scratch


def scratch_mark(spark: SparkSession) -> int:
    """How many folders ``durable`` has written, for ``clear_scratch``."""
    return len(_scratch(spark))


def clear_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete what ``durable`` wrote since a mark; returns the number of folders.

    Call it once the results that may read it are stored, and not beside another thread's operators.
    """
    own = _scratch(spark)[since:]
    for path in own:
        delete_path(spark, path)
    del _scratch(spark)[since:]
    return len(own)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per application.

    Functions that run in tasks are pickled by name, so the executors must be
    able to import them also where the library is not installed.
    """
    context = spark.sparkContext
    if getattr(context, "_vetline_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    handle, path = tempfile.mkstemp(prefix="vetline-", suffix=".zip")
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._vetline_shipped = True
