"""One incremental run in a process of its own: python restart_job.py <shared folder> <drop number>."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vetline.session import build_session  # noqa: E402
from vetline.streaming.incremental import file_stream, load_incremental  # noqa: E402

shared, drop = sys.argv[1], int(sys.argv[2])
spark = build_session("local[2]", app_name="vetline-restart", shuffle_partitions=2,
                      extra={"spark.checkpoint.dir": f"{shared}/shared", "spark.sql.warehouse.dir": f"{shared}/warehouse"})
rows = spark.createDataFrame([(drop, f"drop {drop}"), (100, f"drop {drop}")], "k int, v string")
rows.coalesce(1).write.mode("append").option("header", True).csv(f"{shared}/in")
load_incremental(spark, file_stream(spark, f"{shared}/in", rows.schema), "vetline_r.target", [], keys=["k"], checkpoint=f"{shared}/checkpoint")
print("ROWS", sorted(tuple(r) for r in spark.table("vetline_r.target").select("k", "v").collect()))
spark.stop()
