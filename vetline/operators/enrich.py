"""Lookup enrichment: right outer equi-join of a lookup table with records.

Every record is kept; unmatched or NULL keys get NULL lookup columns;
duplicate lookup keys fan out. Every lookup column whose name the records
already use (the shared key, typically) is renamed ``lookup_<name>`` so the
output can be written as a table.

Physical strategy, decided by measured size, never by estimates:

* ``broadcast="auto"`` (default) or ``True``: the lookup is broadcast only
  after one pass over it, a partial aggregate in every partition that sends
  one row each, has proved it within ``max_broadcast_rows`` and
  ``max_broadcast_bytes``. Beyond either the join is pinned to a sort-merge
  join (a file-size estimate cannot override the measurement); AQE splits
  skewed partitions of the preserved (records) side. Give ``broadcast=False``
  where the lookup is known to be large, to save the pass.
* A lookup beyond the bound is cut to the records' keys before it is shuffled,
  if these, distinct, are within the bound: a broadcast semi join, so that
  only lookup rows that will match move. What is left is measured again, and
  broadcast if it fits. ``reduce_lookup=False`` saves the pass over the records'
  keys where most of the lookup matches.
* ``salt_buckets=N``: the sort-merge join with hot keys split over N tasks.
  Keys with more than one row in ``4 N`` of either side are found by a partial
  aggregate (at most ``4 N`` of them a side). Records with a key that is hot
  among the records are dealt over N salts, and only the lookup rows of these
  keys are repeated. A key that is hot in the lookup (a fan-out) is dealt on
  both sides, N by N. Salts are hashes of the row, so a task that runs again
  deals its rows alike.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from vetline.functions.checks import col_ref

log = logging.getLogger(__name__)

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 128 << 20
_SALT, _OTHER_SALT = "_vetline_salt", "_vetline_salt_2"
#: What a row costs in a hash relation beside its variable-length values, per column and per row.
_COLUMN_BYTES, _ROW_BYTES = 16, 64


def lookup_size(lookup: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes in memory) of ``lookup``.

    One partial aggregate over all partitions; a row is counted with its fixed
    width and the length of its strings (nested values: as JSON).
    """
    width = F.lit(_ROW_BYTES + _COLUMN_BYTES * len(lookup.columns))
    for f in lookup.schema.fields:
        c = col_ref(f.name)
        if isinstance(f.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            width = width + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    row = lookup.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def lookup_fits(lookup: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``lookup`` has at most ``max_rows`` rows and ``max_bytes``."""
    rows, size = lookup_size(lookup)
    return rows <= max_rows and size <= max_bytes


def _hot_keys(df: DataFrame, key: str, n: int) -> list:
    """Keys of more than one row in ``4 n``: at most ``4 n`` of them, null left out."""
    counts = df.groupBy(col_ref(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [r["k"] for r in counts.where((F.col("n") * 4 * n > total) & F.col("k").isNotNull()).collect()]


def _row_salt(df: DataFrame, n: int):
    return F.pmod(F.xxhash64(*[col_ref(c) for c in df.columns]), F.lit(n)).cast("int")


def _salted_join(lk: DataFrame, records: DataFrame, lkey: str, rkey: str, n: int) -> DataFrame:
    """The right join with hot keys of either side split over ``n`` (or ``n`` by ``n``) tasks."""
    every = F.sequence(F.lit(0), F.lit(n - 1))
    hot_records, hot_lookup = _hot_keys(records, rkey, n), _hot_keys(lk, lkey, n)
    is_hot = lambda c, keys: F.coalesce(c.isin(keys), F.lit(False)) if keys else F.lit(False)

    r1 = records.where(~is_hot(col_ref(rkey), hot_lookup))
    # A null key matches nothing, so null-keyed records may go anywhere.
    dealt = F.when(is_hot(col_ref(rkey), hot_records) | col_ref(rkey).isNull(), _row_salt(records, n)).otherwise(0)
    r1 = r1.withColumn(_SALT, dealt)
    l1 = lk.where(~is_hot(col_ref(lkey), hot_lookup))
    l1 = l1.withColumn(_SALT, F.explode(F.when(is_hot(col_ref(lkey), hot_records), every).otherwise(F.array(F.lit(0)))))
    joined = l1.hint("merge").join(r1, (l1[lkey] == r1[rkey]) & (l1[_SALT] == r1[_SALT]), "right").drop(l1[_SALT]).drop(r1[_SALT])
    if not hot_lookup:
        return joined
    # Every record with such a key has a match, so the inner join of all pairs of salts is exact.
    r2 = records.where(is_hot(col_ref(rkey), hot_lookup))
    r2 = r2.withColumn(_SALT, _row_salt(records, n)).withColumn(_OTHER_SALT, F.explode(every))
    l2 = lk.where(is_hot(col_ref(lkey), hot_lookup))
    l2 = l2.withColumn(_OTHER_SALT, _row_salt(lk, n)).withColumn(_SALT, F.explode(every))
    fanned = l2.hint("merge").join(r2, (l2[lkey] == r2[rkey]) & (l2[_SALT] == r2[_SALT]) & (l2[_OTHER_SALT] == r2[_OTHER_SALT]))
    for side in (l2, r2):
        fanned = fanned.drop(side[_SALT]).drop(side[_OTHER_SALT])
    return joined.unionAll(fanned)


def _renamed_lookup(lookup: DataFrame, records: DataFrame, key: str, prefix: str) -> tuple[DataFrame, str]:
    taken = set(records.columns)
    names = {c: (f"{prefix}{c}" if c in taken else c) for c in lookup.columns}
    return lookup.select(*[col_ref(c).alias(n) for c, n in names.items()]), names[key]


def lookup_right_join(
    lookup: DataFrame,
    records: DataFrame,
    key: str,
    records_key: str | None = None,
    prefix: str = "lookup_",
    broadcast: bool | str = "auto",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    salt_buckets: int = 0,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    reduce_lookup: bool = True,
) -> DataFrame:
    """``lookup RIGHT JOIN records ON lookup.key = records.records_key``."""
    rkey = records_key or key
    lk, lkey = _renamed_lookup(lookup, records, key, prefix)

    if broadcast not in ("auto", True, False):
        raise ValueError("broadcast must be 'auto', True or False")
    if broadcast is not False and lookup_fits(lookup, max_broadcast_rows, max_broadcast_bytes):
        return F.broadcast(lk).join(records, lk[lkey] == records[rkey], "right")
    if broadcast is True:
        log.warning("Lookup exceeds %d rows or %d bytes; using a shuffle join.",
                    max_broadcast_rows, max_broadcast_bytes)
    if broadcast is not False and reduce_lookup:
        keys = records.select(col_ref(rkey).alias("_vetline_key")).where("_vetline_key IS NOT NULL").distinct()
        if lookup_fits(keys, max_broadcast_rows, max_broadcast_bytes):
            lk = lk.join(F.broadcast(keys), lk[lkey] == keys["_vetline_key"], "left_semi")
            if lookup_fits(lk, max_broadcast_rows, max_broadcast_bytes):
                return F.broadcast(lk).join(records, lk[lkey] == records[rkey], "right")
    if salt_buckets and salt_buckets > 1:
        return _salted_join(lk, records, lkey, rkey, int(salt_buckets))
    lk = lk.hint("merge")
    return lk.join(records, lk[lkey] == records[rkey], "right")
