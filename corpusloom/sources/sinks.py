"""Writers: canonical objects, inventories, bundles, line files and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def write_objects(
    df: DataFrame, path: str, partition: str = "connector", format: str = "parquet", key: str = "id", buckets: int = 64
) -> None:
    """Canonical objects by id: written ones replace their predecessors, all others stay.

    Objects lie in ``buckets`` partitions by hash of their id below each connector; only partitions that hold a
    written id are read and rewritten, the files of all others stay as they are. ``buckets`` must stay the same
    for one folder and should grow with the largest connector.
    """
    spark = df.sparkSession
    df = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        held = spark.read.format(format).load(path)
        touched = df.select(partition, "bucket").distinct()
        held = held.join(touched, [partition, "bucket"], "left_semi").join(df.select(key, partition), [key, partition], "left_anti")
        # Written out first: the partitions that are read are the ones that are replaced.
        df = materialize(df.unionByName(held, allowMissingColumns=True))
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition, "bucket")
    # Objects are long texts: zstd takes two thirds of the room that snappy takes.
    writer.format(format).option("compression", "zstd").save(path)


def write_inventory(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """CSV (header, LF) and JSON copies of a flat inventory.

    Global order is kept by range partitioning; the number of files is Spark's to
    choose, so no single task writes everything.
    """
    rows = df.orderBy(*order) if order else df
    rows.write.mode("overwrite").option("emptyValue", "").csv(f"{path}/csv", header=True, lineSep="\n", escape='"')
    rows.write.mode("overwrite").json(f"{path}/json")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """Sorted distinct lines."""
    df.select(F.col(column).cast("string").alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """JSON lines; absent fields are left out unless nulls are to be kept."""
    df.write.mode("overwrite").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Bundle documents with their relative path, for the upload step to fan out."""
    df.select("id", "path", "sha256", "html").write.mode("overwrite").parquet(path)
