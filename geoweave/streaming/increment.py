"""Incremental ingest: daily files of changed and of removed places into a table.

Each run takes the files that are new since the checkpoint and ends.  A batch
rewrites the table under a new version folder and then adds an entry that names
it, so readers see one version or the other and a lost run leaves the old one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.operators.tables import upsert
from geoweave.sources import gazetteer


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The table's present version, or None before the first batch."""
    fs, p = _fs(spark, f"{table}/CURRENT")
    if not fs.exists(p):
        return None
    version = max(str(s.getPath().getName()) for s in fs.listStatus(p))
    return spark.read.parquet(f"{table}/{version.split('-', 1)[1]}")


def publish(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Writes a new version and makes it the present one.

    The version in force is the last entry of the folder CURRENT; entries are
    empty folders, and making one is a single step, so readers always find one.
    """
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{table}/{version}")
    fs, p = _fs(spark, f"{table}/CURRENT")
    n = 1 + max((int(str(s.getPath().getName()).split("-", 1)[0]) for s in fs.listStatus(p)), default=0) if fs.exists(p) else 1
    fs.mkdirs(_fs(spark, f"{table}/CURRENT/{n:012d}-{version}")[1])


def apply_batch(table: str):
    """foreachBatch function: cleansed rows replace those of their id, newest date last."""

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        # A number that the file leaves out is no news: the old one stays.
        new = gazetteer.cleanse(batch, missing_numbers=None)
        old = current(spark, table)
        order = [F.col("modifiedDate")]
        base = old if old is not None else new.limit(0)
        merged = upsert(base, new, "geonameId", order)
        publish(spark, merged.withColumns({c: F.coalesce(c, F.lit(0).cast(t)) for c, t in (("population", "bigint"), ("elevation", "int"))}), table)

    return run


def changes(spark: SparkSession, folder: str, table: str, checkpoint: str) -> None:
    """Applies the modification files that have come since the last run."""
    stream = spark.readStream.schema(gazetteer.SCHEMA).option("sep", "\t").option("quote", "").csv(folder)
    stream.writeStream.foreachBatch(apply_batch(table)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def removals(spark: SparkSession, folder: str, table: str, checkpoint: str) -> None:
    """Applies the delete files (id, name, reason) that have come since the last run."""

    def run(batch: DataFrame, _: int) -> None:
        old = current(spark, table)
        if old is not None:
            publish(spark, old.join(batch.select(F.col("id").try_cast("bigint").alias("geonameId")).distinct(), "geonameId", "left_anti"), table)

    stream = spark.readStream.schema("id string, name string, comment string").option("sep", "\t").option("quote", "").csv(folder)
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
