"""Enrichment job: lookup right join records, check, write to the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vetline.operators.enrich import lookup_right_join
from vetline.operators.quality import DEFAULT_RULESET, evaluate_dataset_rules, needs_rows, results_from_metrics
from vetline.sinks.catalog import write_table
from vetline.sinks.tables import append_rows


def enrich(
    spark: SparkSession,
    lookup: DataFrame | str,
    records: DataFrame | str,
    key: str,
    database: str,
    table: str,
    path: str | None = None,
    dq_rules=DEFAULT_RULESET,
    dq_results_table: str | None = None,
    gate_on_quality: bool = False,
    **join_options,
) -> DataFrame:
    """Join, evaluate the dataset rules, append the result to the catalog.

    The join runs once: the row count the rules need is observed while the
    joined rows are written. Quality results are published to
    ``dq_results_table`` when given. They gate the write only with
    ``gate_on_quality=True``; rules on the schema alone are then checked
    before any data moves, and only rules on the rows (``RowCount``) cost a
    counting pass first. Returns the results DataFrame (one row per rule).
    """
    lk = spark.table(lookup) if isinstance(lookup, str) else lookup
    rc = spark.table(records) if isinstance(records, str) else records
    joined = lookup_right_join(lk, rc, key, **join_options)
    n_cols = len(joined.columns)
    if gate_on_quality:
        if needs_rows(dq_rules):
            evaluated = evaluate_dataset_rules(joined, dq_rules)  # one row per rule
            pre = spark.createDataFrame(evaluated.collect(), evaluated.schema)
        else:
            pre = results_from_metrics(spark, dq_rules, n_cols, None)
        if pre.filter("outcome != 'Passed'").limit(1).count() > 0:
            if dq_results_table:
                append_rows(pre, dq_results_table)
            raise RuntimeError(f"Data quality rules failed for {database}.{table}")
    obs = Observation(f"enrich_{uuid.uuid4().hex[:8]}")
    write_table(joined.observe(obs, F.count(F.lit(1)).alias("rows")), database, table, path=path,
                mode="append")
    results = results_from_metrics(spark, dq_rules, n_cols, int(obs.get["rows"]))
    if dq_results_table:
        append_rows(results, dq_results_table)
    return results
