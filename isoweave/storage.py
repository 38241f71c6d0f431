"""Tables between steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def shared_dir(spark) -> str:
    """The session's spark.checkpoint.dir; only where it is unset (tests on one machine) a folder is made."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="isoweave-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a step's rows as Parquet and reads them: what many later steps use is worked out once, and a lost executor costs no lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, out: str, *order) -> DataFrame:
    """df with the place of every row in the given order, from 1: sorted in ranges, counted per range, so that no task sees all rows."""
    from pyspark.sql import functions as F

    rows = staged(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    sizes = rows.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()  # one row a range
    before, pairs = 0, []
    for r in sizes:
        pairs += [F.lit(r["p"]), F.lit(before)]
        before += r["n"]
    if not pairs:
        return rows.drop("_at").withColumn(out, F.lit(None).cast("long"))
    place = F.try_element_at(F.create_map(*pairs), F.shiftright("_at", 33)) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.withColumn(out, place.cast("long")).drop("_at")
