"""Run a load where every task of the staging write fails once (run as a
separate process: needs a session that allows task retries)."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.functions import udf  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

from vetline.plans.load import load  # noqa: E402
from vetline.session import build_session  # noqa: E402


def _fail_first_attempt(v):
    # Test-only fault injection: the first attempt of each task dies midway.
    if TaskContext.get().attemptNumber() == 0 and v == "7":
        raise RuntimeError("injected task failure")
    return v


def main() -> None:
    spark = build_session("local[4, 2]", shuffle_partitions=4,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="vetline-retry-")})
    spark.sparkContext.setLogLevel("OFF")
    fail_first_attempt = udf(_fail_first_attempt, StringType())
    src = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("k"),
        fail_first_attempt(F.when(F.col("id") % 3 == 0, F.lit(None))
                           .otherwise((F.col("id") % 10).cast("string"))).alias("vendor_id"))
    rules = [{"rule_type": "not_null", "column": "vendor_id"}]
    m = load(spark, src, "retry.t", rules, dlq_path=spark.conf.get("spark.checkpoint.dir") + "/dlq").first()
    out = {k: m[k] for k in ("status", "total_count", "valid_count", "invalid_count", "dlq_count")}
    out["target_rows"] = spark.table("retry.t").count()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
