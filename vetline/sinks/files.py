"""Hour-partitioned file layout (``year=YYYY/month=MM/day=DD/hour=HH``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vetline.functions.checks import col_ref

# --- fixed values --------------------------------------------------------------------
# Partition directories, zero padded: year=YYYY / month=MM / day=DD / hour=HH.
HOUR_PARTITIONS = ("year", "month", "day", "hour")
HOUR_FORMATS = ("yyyy", "MM", "dd", "HH")
# ---------------------------------------------------------------------------------------


def with_hour_partitions(df: DataFrame, ts_col: str) -> DataFrame:
    """Add zero-padded string partition columns derived from ``ts_col``
    (UTC hours, whatever the session's time zone)."""
    out = df
    utc = F.to_utc_timestamp(col_ref(ts_col).cast("timestamp"), F.current_timezone())
    for name, fmt in zip(HOUR_PARTITIONS, HOUR_FORMATS):
        out = out.withColumn(name, F.date_format(utc, fmt))
    return out


def _without_line_breaks(df: DataFrame) -> DataFrame:
    """``df``; a row with a line break in a text fails the job."""
    def checked(name: str):
        c = col_ref(name)
        return F.when(c.rlike("[\r\n]"), F.raise_error(F.lit(f"A line break in column '{name}': write it with line_breaks=True"))).otherwise(c).alias(name)

    return df.select(*[checked(f.name) if isinstance(f.dataType, StringType) else col_ref(f.name) for f in df.schema.fields])


def write_hourly(df: DataFrame, ts_col: str, root: str, fmt: str = "csv", header: bool = True,
                 mode: str = "append", max_records_per_file: int | None = None,
                 rebalance: bool = True, line_breaks: bool = False, **options) -> None:
    """Write rows under ``root/year=/month=/day=/hour=/``.

    ``rebalance`` (default) shuffles rows by hour with a REBALANCE hint, so
    each hour is written by few tasks instead of every task writing a small
    file into every hour (tasks x hours files). AQE splits a hot hour over
    several tasks and merges quiet ones, so skew does not serialize the
    write. Without it there is no shuffle, at the cost of many small files.
    ``max_records_per_file`` bounds file size for a hot hour.

    CSV values that hold a line break are refused, for readers split files at
    line ends; ``line_breaks=True`` writes them, to be read with ``multiLine=True``
    (each file then in one task).
    """
    rows = with_hour_partitions(df if fmt != "csv" or line_breaks else _without_line_breaks(df), ts_col)
    if rebalance:
        rows = rows.hint("rebalance", *HOUR_PARTITIONS)
    writer = rows.write.format(fmt).mode(mode)
    if fmt == "csv":
        # The counterpart of CSV_OPTIONS: NULL is an empty field, the empty string a quoted one.
        writer = writer.options(header=header, quote='"', escape='"', nullValue="", emptyValue='""',
                                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.partitionBy(*HOUR_PARTITIONS).save(root)
