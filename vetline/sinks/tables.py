"""Staging tables and all-or-nothing replacement of a target table.

Parquet tables have no transactions, and ``INSERT OVERWRITE`` deletes the old
files before the new ones are complete: a failure in between leaves an empty
target. Here a new version is always written to a fresh folder first, its
row count is checked, and only then does one catalog call move the target to
it:

* unpartitioned target: an external table whose location is switched
  (``ALTER TABLE ... SET LOCATION``);
* partitioned target: a view over a versioned physical table, replaced with
  ``CREATE OR REPLACE VIEW`` (partition pruning passes through the view).

Readers see either the old or the new version, never a mix or nothing.
Earlier versions are kept (``keep_versions``) for rollback and for readers
still scanning them.

Which version is current is recorded in the target's own folder: one small
numbered file per version under ``_versions``, published complete or not at all
(``vetline.sinks.commits``). That file is the commit; the catalog entry follows
it and is rebuilt from it whenever a session's catalog does not know the
target or points elsewhere, so a target outlives the session and a crash
between the two steps. A load remembers the number it started from and fails
if another load has committed since. Committed versions are pruned by number;
folders that no commit names are swept once they are older than any load runs.
"""

from __future__ import annotations

import logging
import uuid
from urllib.parse import unquote
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, NumericType, StringType, StructField, StructType

from vetline.functions.checks import col_ref
from vetline.session import delete_path, path_exists
from vetline.sinks.catalog import ensure_database, table_exists, table_name, write_table
from vetline.sinks.commits import (
    POINTERS,
    SWEEP_AFTER,
    VERSION_PREFIX,
    commit,
    committed_versions,
    included_batch,
    latest_number,
    new_version_dir,
    newest,
    sweep,
    version_of,
)
from vetline.sinks.widening import widened

log = logging.getLogger(__name__)

_PHYS_SUFFIX = "__v"
_VERSION_PROP = "vetline.version_path"
_DATA_PROP = "vetline.data_path"
_MANIFESTS = "_manifests"
_ADD_BATCH = 500
#: Hidden partition columns of upsert targets, left out of the target's view: a hash
#: bucket of the key, or the group of rows that one task wrote (one file).
BUCKET, GROUP = "_vetline_bucket", "_vetline_group"
_HIDDEN = (BUCKET, GROUP)
#: Partition values, by an estimate, beyond which a load gives them no folders of their own, and values that then share a hidden bucket.
MAX_PARTITIONS, BUCKET_VALUES = 10_000, 4_000
_MAX_BROADCAST_KEYS = 1_000_000
_MAX_BROADCAST_KEY_BYTES = 128 << 20
_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Stands in front of partition values that folders cannot hold, the empty text above all.
_EMPTY = "__vetline_empty__"


def _split(name: str) -> tuple[str, str]:
    db, _, t = name.replace("`", "").rpartition(".")
    if not db:
        raise ValueError(f"Use a qualified name 'database.table', got {name!r}")
    return db, t


def default_root(spark: SparkSession, name: str) -> str:
    db, t = _split(name)
    ensure_database(spark, db)
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{t}"


# --- staging (K4, K5, K9, K14) ----------------------------------------------------

def stage(df: DataFrame, name: str, partition_by: Sequence[str] | str | None = None,
          rebalance: bool = False) -> str:
    """Load all of ``df`` into a managed staging table, replacing it.

    No rebalance by default: staging keys are low-cardinality flags, so each
    task writes at most a few files and a shuffle would buy nothing.
    """
    db, t = _split(name)
    return write_table(df, db, t, partition_by=partition_by, mode="overwrite", evolve_schema=False,
                       rebalance=rebalance)


def recreate_like(spark: SparkSession, staging: str, target: str) -> None:
    """``DROP TABLE IF EXISTS staging; CREATE TABLE staging LIKE target``."""
    db, s = _split(staging)
    tdb, t = _split(target)
    ensure_database(spark, db)
    drop_table(spark, staging)
    spark.sql(f"CREATE TABLE {table_name(db, s)} LIKE {table_name(tdb, t)} USING parquet")


def truncate_table(spark: SparkSession, name: str) -> None:
    db, t = _split(name)
    spark.sql(f"TRUNCATE TABLE {table_name(db, t)}")


def drop_table(spark: SparkSession, name: str) -> None:
    db, t = _split(name)
    if not spark.catalog.databaseExists(db):
        return
    if table_exists(spark, db, t) and spark.catalog.getTable(f"{db}.{t}").tableType == "VIEW":
        spark.sql(f"DROP VIEW IF EXISTS {table_name(db, t)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(db, t)}")


# --- versions ----------------------------------------------------------------------

def ensure_registered(spark: SparkSession, target: str, root: str | None = None) -> None:
    """Make the catalog's entry of ``target`` agree with its newest committed version."""
    db, t = _split(target)
    root = root or default_root(spark, target)
    last = newest(spark, root)
    if not last or table_exists(spark, db, t) and current_version(spark, target) == last["version"]:
        return
    ensure_database(spark, db)
    _point_catalog(spark, db, t, root, last["version"], last["data_path"], StructType.fromJson(last["schema"]), last["keys"],
                   _read_manifest(spark, root, last["version"]), last.get("layout"))


def check_replacement(spark: SparkSession, target: str, schema) -> None:
    """Refuse rows that would leave ``target`` unreadable: a column missing or of another type."""
    db, t = _split(target)
    if not table_exists(spark, db, t):
        return
    new = {f.name: f.dataType.simpleString() for f in schema.fields}
    faults = [f"column '{f.name}' ({f.dataType.simpleString()}) is " + ("missing" if f.name not in new else new[f.name])
              for f in spark.table(table_name(db, t)).schema.fields if new.get(f.name) != f.dataType.simpleString()]
    if faults:
        raise ValueError(f"The rows do not fit {target}: " + "; ".join(faults))


def by_position(df: DataFrame, target: str) -> DataFrame:
    """``df`` with the names and types of ``target``'s columns in their order, as ``INSERT INTO target SELECT *`` takes them.

    The numbers of columns must agree, and types may only widen. A target that does not exist yet takes ``df`` as it is.
    """
    spark = df.sparkSession
    db, t = _split(target)
    if not table_exists(spark, db, t):
        return df
    wanted = spark.table(table_name(db, t)).schema
    if len(wanted) != len(df.columns):
        raise ValueError(f"{target} has {len(wanted)} columns, the rows {len(df.columns)}")
    return widened(df.toDF(*wanted.fieldNames()), wanted, target)


def current_version(spark: SparkSession, name: str) -> str | None:
    db, t = _split(name)
    if not table_exists(spark, db, t):
        return None
    return _props(spark, name).get(_VERSION_PROP)


def _props(spark: SparkSession, name: str) -> dict[str, str]:
    db, t = _split(name)
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table_name(db, t)}").collect()}


def current_data_path(spark: SparkSession, name: str) -> str | None:
    """Folder holding the current version's rows: the version folder itself,
    or a sub-folder of it when a load staged its rows there."""
    props = _props(spark, name) if table_exists(spark, *_split(name)) else {}
    return props.get(_DATA_PROP) or props.get(_VERSION_PROP)


# --- blank partition values ---------------------------------------------------------------
#
# A folder cannot be named by an empty text: Spark writes it as the default
# partition, which reads as NULL. It is written under a name of its own instead,
# which the target's view undoes; texts that begin like that name get it put in front.

def _escapes(df: DataFrame, parts: Sequence[str]) -> list[str]:
    """Partition columns whose values may need another name."""
    return [c for c in parts if c not in _HIDDEN and isinstance(df.schema[c].dataType, StringType)]


def needs_escape(df: DataFrame, parts: Sequence[str]) -> Column:
    """Whether a row has a partition value that is written under another name."""
    out = F.lit(False)
    for c in _escapes(df, parts):
        out = out | F.coalesce((col_ref(c) == "") | col_ref(c).startswith(_EMPTY), F.lit(False))
    return out


def escaped(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``df`` with partition values as folders can hold them."""
    for c in _escapes(df, parts):
        odd = (col_ref(c) == "") | col_ref(c).startswith(_EMPTY)
        df = df.withColumn(c, F.when(odd, F.concat(F.lit(_EMPTY), col_ref(c))).otherwise(col_ref(c)))
    return df


def _unescape_sql(name: str) -> str:
    return f"CASE WHEN startswith(`{name}`, '{_EMPTY}') THEN substring(`{name}`, {len(_EMPTY) + 1}) ELSE `{name}` END"


def _unescaped(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    for c in _escapes(df, parts):
        df = df.withColumn(c, F.expr(_unescape_sql(c)))
    return df


# --- hidden layouts --------------------------------------------------------------------

def layout_for(spark: SparkSession, root: str, partition_by: list[str]) -> tuple[list[str], dict]:
    """Partition columns and layout that a new version of the target is written with: those asked for, else the hidden ones it has."""
    layout = {k: v for k, v in ((newest(spark, root) or {}).get("layout") or {}).items() if k != "escaped"}
    if partition_by or "partitioned" in layout:
        return partition_by, {}
    return [BUCKET] if "buckets" in layout else [GROUP] if "groups" in layout else [], layout


def gathered(df: DataFrame, parts: list[str], limit: int | None = None) -> tuple[list[str], dict]:
    """Partition columns and layout that ``df`` is written with when partitioned by ``parts``.

    A folder and a file for each of very many values cost far more than their rows. Beyond ``limit`` values
    (``MAX_PARTITIONS``) they share hidden buckets, sorted by value, so that a filter skips most row groups.
    """
    limit = MAX_PARTITIONS if limit is None else limit
    hashed = F.xxhash64(*[col_ref(c) for c in parts])
    values = df.agg(F.approx_count_distinct(hashed).alias("n")).first()["n"]
    if values <= limit:
        return parts, {}
    return [BUCKET], {"buckets": min(limit, -(-values // BUCKET_VALUES)), "by": parts, "partitioned": parts}


def _declared(keys: list[str], layout: dict | None) -> list[str]:
    """The columns that a version is partitioned by for its readers."""
    return (layout or {}).get("partitioned") or [k for k in keys if k not in _HIDDEN]


def with_hidden(df: DataFrame, layout: dict) -> DataFrame:
    """``df`` with the hidden partition column of ``layout``."""
    if "buckets" in layout:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[col_ref(k) for k in layout["by"]]), F.lit(int(layout["buckets"]))).cast("int"))
    if "groups" in layout:
        return df.withColumn(GROUP, F.concat(F.lit(f"{uuid.uuid4().hex[:12]}-"), F.spark_partition_id().cast("string")))
    return df


def _write_version(df: DataFrame, path: str, partition_by: list[str], rebalance: bool, layout: dict) -> tuple[int, dict]:
    """Write one version; returns its rows and its layout, which notes escaped partition values.

    Rows of a layout by groups are sorted into ranges of the key, so that each file holds one.
    """
    obs = Observation(f"vetline_version_{uuid.uuid4().hex[:8]}")
    if "groups" in layout:
        # Equal keys, which only rows without one have, may be dealt to several ranges.
        row = F.xxhash64(*[col_ref(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
        df = df.repartitionByRange(*[col_ref(k) for k in layout["by"]], row)
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(needs_escape(df, partition_by)).alias("escaped"))
    rows = escaped(with_hidden(counted, layout), partition_by)
    if "groups" in layout:
        rows = rows.sortWithinPartitions(GROUP, *[col_ref(k) for k in layout["by"]])
    elif partition_by and rebalance:
        rows = rows.hint("rebalance", *partition_by)
    if "partitioned" in layout:
        rows = rows.sortWithinPartitions(BUCKET, *[col_ref(k) for k in layout["by"]])
    writer = rows.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"]), {**layout, "escaped": True} if obs.get["escaped"] else layout


def _hidden_schema(schema: StructType, partition_by: list[str]) -> StructType:
    """``schema`` with the hidden partition column that is to be written."""
    kinds = {BUCKET: IntegerType(), GROUP: StringType()}
    return StructType([*schema.fields, *[StructField(c, kinds[c]) for c in partition_by if c in kinds]])


def _ddl_columns(schema, partition_by: list[str]) -> str:
    data = [f for f in schema.fields if f.name not in partition_by]
    part = [next(f for f in schema.fields if f.name == p) for p in partition_by]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data + part)


def replace_target(df: DataFrame, target: str, partition_by: Sequence[str] | str | None = None,
                   root: str | None = None, expected_count: int | None = None,
                   keep_versions: int = 2, rebalance: bool = True, by_name: bool = True) -> dict:
    """Replace ``target``'s contents with ``df``, all or nothing.

    Columns are matched by name, or with ``by_name=False`` by position (see
    ``by_position``). ``expected_count`` (e.g. the number of valid
    rows counted earlier) is checked against the rows actually written before
    the switch; on a mismatch or any failure the target is left untouched.
    A partitioned version is rebalanced on its keys (few files per folder;
    AQE splits hot keys). A target kept in hidden buckets or file groups by
    upserts keeps them. Returns ``{"version": path, "rows": n}``.
    """
    spark = df.sparkSession
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    root = root or default_root(spark, target)
    ensure_registered(spark, target, root)
    df = df if by_name else by_position(df, target)
    check_replacement(spark, target, df.schema)
    keys, layout = layout_for(spark, root, keys)
    return _replace(df, target, keys, layout, root, expected_count, keep_versions, rebalance)


def _replace(df: DataFrame, target: str, keys: list[str], layout: dict, root: str, expected_count: int | None = None,
             keep_versions: int = 2, rebalance: bool = True, batch: tuple[str, int] | None = None) -> dict:
    spark = df.sparkSession
    base = latest_number(spark, root)
    version = new_version_dir(root)
    try:
        rows, layout = _write_version(df, version, keys, rebalance, layout)
        if expected_count is not None and rows != expected_count:
            raise RuntimeError(f"Wrote {rows} rows to {version}, expected {expected_count}")
    except Exception:
        delete_path(spark, version)
        raise

    register_version(spark, target, version, df.schema, keys, data_path=version, root=root,
                     keep_versions=keep_versions, base=base, layout=layout, batch=batch)
    return {"version": version, "rows": rows}


def register_version(spark: SparkSession, target: str, version: str, schema,
                     partition_by: Sequence[str] | str | None = None, data_path: str | None = None,
                     root: str | None = None, keep_versions: int = 2, base: int | None = None, layout: dict | None = None,
                     batch: tuple[str, int] | None = None) -> None:
    """Switch ``target`` to rows already written under ``version`` (at
    ``data_path``, the version folder itself by default): commit it, point
    the catalog at it, then prune old versions. Columns of ``schema`` are the
    table's; extra columns in the files are ignored. ``base`` is the newest
    version's number when the load began; if it has changed, nothing is
    switched. ``layout`` and ``batch``: see ``commits.commit``."""
    db, t = _split(target)
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    data_path = data_path or version
    root = root or version.rsplit("/", 1)[0]
    last = newest(spark, root)
    visible = _declared(keys, layout)
    if last:
        agrees = _declared(last["keys"], last.get("layout")) == visible
    else:
        agrees = not table_exists(spark, db, t) or (spark.catalog.getTable(f"{db}.{t}").tableType == "VIEW") == bool(visible)
    if not agrees:
        raise ValueError(f"{target} is {'not ' if visible else ''}partitioned so; partition_by must agree")
    schema = _hidden_schema(schema, keys)
    try:
        commit(spark, root, base, version, data_path, schema, keys, layout, batch)
    except Exception:
        delete_path(spark, version)
        raise
    _point_catalog(spark, db, t, root, version, data_path, schema, keys, {}, layout)
    _prune_versions(spark, db, t, root, keep_versions)


def _point_catalog(spark: SparkSession, db: str, t: str, root: str, version: str, data_path: str, schema, keys: list[str],
                   inherited: dict[str, str], layout: dict | None = None) -> None:
    """Make the catalog entry read a committed version."""
    name = table_name(db, t)
    exists = table_exists(spark, db, t)
    if keys and exists and spark.catalog.getTable(f"{db}.{t}").tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # external: the first upsert of a plain target gives it file groups, and a view
    props = f"'{_VERSION_PROP}' = '{version}', '{_DATA_PROP}' = '{data_path}'"
    if keys:
        _publish_partitioned(spark, db, t, root, version, schema, keys, inherited, layout, data_path=data_path)
    elif exists:
        # Additive schema change first: until the switch, old files
        # simply read the new columns as NULL.
        have = set(spark.table(name).columns)
        new = [f for f in schema.fields if f.name not in have]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ("
                      + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{data_path}'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {name} ({_ddl_columns(schema, [])}) USING parquet "
                  f"LOCATION '{data_path}' TBLPROPERTIES ({props})")


def _phys_name(t: str, version: str) -> str:
    return f"{t}{_PHYS_SUFFIX}{version.rsplit('/', 1)[1][len(VERSION_PREFIX):]}"


def _prune_versions(spark: SparkSession, db: str, t: str, root: str, keep: int) -> None:
    """Drop all but the newest ``keep`` committed versions. A dropped version's folder
    stays only as far as a kept version still reads partitions from it
    (inherited by a partition-scoped upsert); its other partitions go."""
    committed = committed_versions(spark, root)
    versions = [v["version"] for v in committed]
    kept = versions[-max(1, keep):]
    # What the catalog still reads is never dropped either.
    current = current_version(spark, f"{db}.{t}")
    if current and current not in kept and current in versions:
        kept.append(current)
    still_read: dict[str, dict[str, set[str]]] = {}  # version -> data folder -> partitions
    for v in kept:
        for part, folder in _read_manifest(spark, root, v).items():
            still_read.setdefault(version_of(folder), {}).setdefault(folder, set()).add(part)
    for old in [v for v in versions if v not in kept]:
        phys_t = _phys_name(t, old)
        phys = table_name(db, phys_t)
        own: set[str] = set()
        if old in still_read:
            manifest = _read_manifest(spark, root, old)
            if table_exists(spark, db, phys_t):
                own = {p for p in _show_partitions(spark, phys) if version_of(manifest.get(p, old)) == old}
        if table_exists(spark, db, phys_t):
            spark.sql(f"DROP TABLE IF EXISTS {phys}")
        delete_path(spark, _manifest_path(root, old))
        for v in committed:
            if v["version"] == old:
                delete_path(spark, f"{root.rstrip('/')}/{POINTERS}/{v['seq']:012d}.json")
        if old not in still_read:
            delete_path(spark, old)
            continue
        for folder, parts in still_read[old].items():
            for part in own - parts:
                delete_path(spark, f"{folder}/{part}")
        if old.rstrip("/") not in still_read[old]:  # rows were staged in a sub-folder
            for sub in _list_subdirs(spark, old):
                if all(not f.startswith(sub) for f in still_read[old]):
                    delete_path(spark, sub)
    sweep(spark, root, set(still_read) | set(kept))


def sweep_uncommitted(spark: SparkSession, target: str, root: str | None = None, older_than=SWEEP_AFTER) -> list[str]:
    """Delete what loads that never committed left in the target's folder, once older than ``older_than``; the names deleted.

    Every load does this with the default age; choose an age that no running load reaches.
    """
    root = root or default_root(spark, target)
    read = {version_of(folder) for v in committed_versions(spark, root) for folder in _read_manifest(spark, root, v["version"]).values()}
    gone = sweep(spark, root, read, older_than)
    db, t = _split(target)
    for name in gone:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(db, _phys_name(t, f'{root}/{name}'))}")
    return gone


def _list_subdirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [f"{path.rstrip('/')}/{st.getPath().getName()}" for st in fs.listStatus(hpath) if st.isDirectory()]


# --- partitioned versions -------------------------------------------------------------
#
# A partitioned target is a view over one physical table per version. Every
# version records in a small manifest which folder holds each of its
# partitions: a full replace holds all of them itself; a partition-scoped
# upsert rewrites only the partitions it touches and registers the others at
# their existing locations, so its cost follows the batch, not the table.

def _manifest_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{_MANIFESTS}/{version.rsplit('/', 1)[1]}"


def _read_manifest(spark: SparkSession, root: str, version: str) -> dict[str, str]:
    """``{partition path: folder}`` of a version (empty when unpartitioned or
    when every partition lives in the version's own folder)."""
    path = _manifest_path(root, version)
    if not path_exists(spark, path):
        return {}
    # One row per partition: catalog-sized metadata, needed on the driver for DDL.
    return {r["part"]: r["dir"] for r in spark.read.schema("part string, dir string").json(path).collect()}


def _write_manifest(spark: SparkSession, root: str, version: str, entries: dict[str, str]) -> None:
    if not entries:
        return
    rows = spark.createDataFrame(sorted(entries.items()), "part string, dir string")
    rows.coalesce(1).write.mode("overwrite").json(_manifest_path(root, version))


def _partition_spec(part_path: str) -> str:
    """``a=1/b=x%2Fy`` (as Spark names folders) to ``PARTITION (`a` = '1', ...)``."""
    out = []
    for seg in part_path.split("/"):
        name, _, raw = seg.partition("=")
        value = unquote(raw)
        lit = "NULL" if value == _DEFAULT_PARTITION else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        out.append(f"`{unquote(name)}` = {lit}")
    return "PARTITION (" + ", ".join(out) + ")"


def _written_partitions(spark: SparkSession, version: str) -> list[str]:
    """Partition paths below a version's folder."""
    found, level = [], [""]
    while level:
        deeper = []
        for part in level:
            names = [p.rsplit("/", 1)[1] for p in _list_subdirs(spark, f"{version}/{part}" if part else version)]
            names = [n for n in names if "=" in n]
            deeper += [f"{part}/{n}" if part else n for n in names]
            if part and not names:
                found.append(part)
        level = deeper
    return found


def _show_partitions(spark: SparkSession, name: str) -> list[str]:
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def _publish_partitioned(spark: SparkSession, db: str, t: str, root: str, version: str, schema,
                         keys: list[str], inherited: dict[str, str], layout: dict | None = None, data_path: str | None = None) -> None:
    """Register ``version`` (rows under ``data_path``, plus ``inherited``
    partitions kept where they are) as a physical table, then move the view
    to it in one catalog call."""
    data_path = data_path or version
    phys = table_name(db, _phys_name(t, version))
    spark.sql(f"DROP TABLE IF EXISTS {phys}")  # external: left by an interrupted switch
    spark.sql(f"CREATE TABLE {phys} ({_ddl_columns(schema, keys)}) USING parquet "
              f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)}) LOCATION '{data_path}'")
    spark.sql(f"ALTER TABLE {phys} RECOVER PARTITIONS")
    own = set(_show_partitions(spark, phys))
    extra = {p: d for p, d in inherited.items() if p not in own}
    items = sorted(extra.items())
    for i in range(0, len(items), _ADD_BATCH):
        clauses = " ".join(f"{_partition_spec(p)} LOCATION '{d}/{p}'" for p, d in items[i:i + _ADD_BATCH])
        spark.sql(f"ALTER TABLE {phys} ADD IF NOT EXISTS {clauses}")
    if extra:
        _write_manifest(spark, root, version, {**extra, **{p: data_path for p in own}})
    ordered = [f for f in schema.fields if f.name not in keys] + [f for f in schema.fields if f.name in keys]
    odd = [f.name for f in schema.fields if f.name in keys and isinstance(f.dataType, StringType)] if (layout or {}).get("escaped") else []
    columns = [f"{_unescape_sql(f.name)} AS `{f.name}`" if f.name in odd else f"`{f.name}`" for f in ordered if f.name not in _HIDDEN]
    spark.sql(f"CREATE OR REPLACE VIEW {table_name(db, t)} "
              f"TBLPROPERTIES ('{_VERSION_PROP}' = '{version}', '{_DATA_PROP}' = '{data_path}') "
              f"AS SELECT {', '.join(columns)} FROM {phys}")


def _rows_in(current: DataFrame, touched: list, parts: list[str], schema: StructType) -> DataFrame:
    """The rows of ``current`` in the partitions ``touched``.

    The partition values are on the driver: they are partition names, which the
    catalog calls that follow need there anyway. Per column, ``IN (values)``
    (plus ``IS NULL``) selects a superset of the touched partitions that the
    file index prunes while planning (a join alone does not prune here); with
    several columns a null-safe semi join with the same values then keeps
    exactly the touched ones.
    """
    cond = F.lit(True)
    for k, c in enumerate(parts):
        present = {r[k] for r in touched} - {None}
        term = current[c].isin(list(present)) if present else F.lit(False)
        if any(r[k] is None for r in touched):
            term = term | current[c].isNull()
        cond = cond & term
    pruned = current.filter(cond)
    if len(parts) == 1:
        return pruned
    named = current.sparkSession.createDataFrame(touched, schema)
    return pruned.join(named, [pruned[c].eqNullSafe(named[c]) for c in parts], "left_semi")


def _in_range(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``current`` cut to the updates' range of ``key``: a filter that the Parquet reader applies to files and row groups."""
    if not isinstance(updates.schema[key].dataType, (NumericType, StringType, DateType)):
        return current
    low, high = updates.agg(F.min(col_ref(key)), F.max(col_ref(key))).first()
    return current.where(col_ref(key).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False))


def _partition_values(part_path: str) -> tuple[str | None, ...]:
    """``a=1/b=x%2Fy`` to its values as text, None for the default partition."""
    raw = [unquote(seg.partition("=")[2]) for seg in part_path.split("/")]
    return tuple(None if v == _DEFAULT_PARTITION else v for v in raw)


def _update_keys(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The update keys for the anti join, broadcast when a bounded check
    proves them small: then the (large) target is streamed through a hash
    join and never shuffled. Otherwise both sides shuffle on the keys."""
    from vetline.operators.enrich import lookup_fits

    key_df = updates.select(*[col_ref(k) for k in keys])
    if lookup_fits(key_df, _MAX_BROADCAST_KEYS, _MAX_BROADCAST_KEY_BYTES):
        return F.broadcast(key_df)
    return key_df


def _upsert_scoped(updates: DataFrame, target: str, keys: list[str], parts: list[str], layout: dict, root: str,
                   keep_versions: int, rebalance: bool, batch: tuple[str, int] | None) -> dict:
    """Upsert that rewrites only the partitions (or hidden buckets, or groups of files) that ``updates`` touch.

    * Partition columns that are part of the key, and buckets of key columns, follow from the updates themselves.
    * Otherwise a key may stand anywhere. Where it stands is found by a semi
      join of the target's key columns, cut to the updates' key range, with
      the update keys; partitions that updates go to are touched as well.

    The anti join on the keys drops replaced rows from the touched partitions,
    the result is written as a new version holding just those, and all other
    partitions are taken over where they are.
    """
    spark = updates.sparkSession
    db, t = _split(target)
    last = newest(spark, root)
    old_phys = table_name(db, _phys_name(t, last["version"]))
    current = spark.table(old_phys)
    plain = _unescaped(current, parts)
    update_keys = _update_keys(updates, keys)
    of_updates = escaped(with_hidden(updates, layout) if parts == [BUCKET] else updates, [c for c in parts if c != GROUP])
    names = [col_ref(c) for c in parts]
    if set(layout["by"] if parts == [BUCKET] else parts) <= set(keys):
        found = of_updates.select(*names).distinct()
    else:
        found = escaped(_in_range(plain, updates, keys[0]).join(update_keys, keys, "left_semi").select(*names), parts)
        found = (found if parts == [GROUP] else found.union(of_updates.select(*names))).distinct()
    touched = found.collect()  # names of partitions
    kept = _unescaped(_rows_in(current, touched, parts, found.schema), parts).drop(*_HIDDEN).join(update_keys, keys, "left_anti")
    merged = kept.unionByName(updates, allowMissingColumns=True)
    version = new_version_dir(root)
    try:
        rows, layout = _write_version(merged, version, parts, rebalance, layout)
    except Exception:
        delete_path(spark, version)
        raise
    old_map = {p: last["data_path"] for p in _show_partitions(spark, old_phys)}
    old_map.update(_read_manifest(spark, root, last["version"]))
    as_text = spark.createDataFrame(touched, found.schema).select(*[c.cast("string") for c in names])
    gone = {tuple(r) for r in as_text.collect()}
    inherited = {p: d for p, d in old_map.items() if _partition_values(p) not in gone}
    own = {p: version for p in _written_partitions(spark, version)}
    schema = _hidden_schema(merged.schema, parts)
    try:
        _write_manifest(spark, root, version, {**inherited, **own})
        commit(spark, root, last["seq"], version, version, schema, parts, layout, batch)
    except Exception:
        delete_path(spark, _manifest_path(root, version))
        delete_path(spark, version)
        raise
    _publish_partitioned(spark, db, t, root, version, schema, parts, inherited, layout)
    _prune_versions(spark, db, t, root, keep_versions)
    return {"version": version, "rows": rows}


def _one_per_key(updates: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """``updates`` with one row per key, the last by ``order_by``; rows with a NULL key are left as they are.

    Map-side partial aggregation keeps one row per key and task, so a key that
    fills the batch is no hot spot.
    """
    no_null = F.lit(True)
    for k in keys:
        no_null = no_null & col_ref(k).isNotNull()
    keyed = updates.where(no_null)
    if not order_by:
        repeated = keyed.groupBy(*[col_ref(k) for k in keys]).count().where("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"Updates repeat the key {tuple(repeated[0])[:-1]}; pass order_by to keep the last row of each key")
        return updates
    last = F.max_by(F.struct(*[col_ref(c) for c in updates.columns]), F.struct(*[col_ref(c) for c in order_by]))
    return keyed.groupBy(*[col_ref(k) for k in keys]).agg(last.alias("_last")).select("_last.*").unionAll(updates.where(~no_null))


# --- keyed upsert (K13) ------------------------------------------------------------

def upsert_target(updates: DataFrame, target: str, keys: Sequence[str],
                  partition_by: Sequence[str] | str | None = None, root: str | None = None,
                  keep_versions: int = 2, partition_scoped: bool = True, rebalance: bool = True,
                  order_by: Sequence[str] | str | None = None, buckets: int | None = None,
                  batch: tuple[str, int] | None = None) -> dict:
    """Insert-or-replace rows of ``target`` by ``keys``, then switch versions.

    A key may occur once in ``updates``; with ``order_by`` it may occur more
    often and the row that is last by these columns stands, otherwise repeated
    keys are refused. ``updates`` must hold the key and partition columns, and
    types that fit the target's (an int a bigint; see ``sinks.widening``). Rows with a NULL key never match, as
    in SQL MERGE. ``updates`` is read several times: hand over stored rows.

    New version = target rows whose key is not in ``updates`` (left anti join)
    plus all of ``updates``. When a bounded check proves the update keys
    small they are broadcast and the target is not shuffled; otherwise both
    sides shuffle on the keys and AQE splits skewed key partitions.

    What is rewritten follows the batch (``partition_scoped``):

    * a partitioned target: the partitions that hold an updated key or that
      updates go to (if all partition columns are among ``keys``, the latter
      alone);
    * ``buckets``: the buckets that the update keys fall in. The number is
      recorded with the target; another one, or other keys, are refused;
    * otherwise: the files that hold an updated key. The target is kept in
      hidden groups of one file each, sorted into ranges of the key, so a
      batch of new or neighbouring keys touches few. A plain target (made by
      ``replace_target``) is rewritten once to get them.

    ``batch`` (stream id, number) is recorded with the version; a batch the
    target includes already is skipped, whatever its rows.
    """
    spark = updates.sparkSession
    db, t = _split(target)
    keys = list(keys)
    if not keys:
        raise ValueError("upsert_target needs at least one key column")
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if buckets and parts:
        raise ValueError("buckets are for targets without partition columns")
    absent = [c for c in [*keys, *parts] if c not in updates.columns]
    if absent:
        raise ValueError(f"Updates for {target} lack {', '.join(absent)}")
    root = root or default_root(spark, target)
    ensure_registered(spark, target, root)
    last = newest(spark, root)
    if batch and included_batch(spark, root, batch[0]) >= batch[1]:
        return {"version": last["version"], "rows": 0}
    if table_exists(spark, db, t):
        updates = widened(updates, spark.table(table_name(db, t)).schema, target)
    layout = _upsert_layout(last, target, keys, parts, buckets)
    parts = [BUCKET] if "buckets" in layout else parts or [GROUP]
    updates = _one_per_key(updates, keys, [order_by] if isinstance(order_by, str) else list(order_by or []))
    if not table_exists(spark, db, t):
        return _replace(updates, target, parts, layout, root, keep_versions=keep_versions, rebalance=rebalance, batch=batch)
    if partition_scoped and last and last["keys"] == parts:
        return _upsert_scoped(updates, target, keys, parts, layout, root, keep_versions, rebalance, batch)
    merged = spark.table(table_name(db, t)).join(_update_keys(updates, keys), keys, "left_anti").unionByName(updates, allowMissingColumns=True)
    if last is None:  # a table that this library did not write keeps its form
        parts, layout = ([] if parts == [GROUP] else parts), ({} if parts == [GROUP] else layout)
    return _replace(merged, target, parts, layout, root, keep_versions=keep_versions, rebalance=rebalance, batch=batch)


def _upsert_layout(last: dict | None, target: str, keys: list[str], parts: list[str], buckets: int | None) -> dict:
    """The layout an upsert writes: the target's own, or what is asked for where it has none."""
    layout = (last or {}).get("layout") or {}
    if parts and layout.get("partitioned") == parts:
        return layout
    if parts:
        return {k: v for k, v in layout.items() if k == "escaped"}
    if "partitioned" in layout:
        raise ValueError(f"{target} is partitioned by {', '.join(layout['partitioned'])}; partition_by must agree")
    if "buckets" in layout:
        if buckets not in (None, layout["buckets"]) or keys != layout["by"]:
            raise ValueError(f"{target} is kept in {layout['buckets']} buckets of {', '.join(layout['by'])}; "
                             f"an upsert in {buckets} of {', '.join(keys)} would not find its rows")
        return layout
    if buckets:
        if last and last["keys"] != [BUCKET]:
            raise ValueError(f"{target} is not kept in buckets")
        return {"buckets": int(buckets), "by": keys}
    return {"groups": True, "by": keys}


# --- run metadata (K15, K17) ---------------------------------------------------------

def append_rows(df: DataFrame, name: str) -> str:
    """Append rows (run metadata, quality results) to a catalog table,
    adding any new columns first."""
    db, t = _split(name)
    return write_table(df.withColumn("recorded_at", F.current_timestamp()), db, t, mode="append")
