"""Session settings, shared scratch tables and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "waymark", master: str | None = None, partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    else:
        # Shuffles start fine and are merged to the advisory size; merging can't split what began too coarse.
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8192")
    return builder.getOrCreate()


_TEMPORARY: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or in local mode, where one machine does all, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _TEMPORARY:
        _TEMPORARY[application] = tempfile.mkdtemp(prefix="waymark-")
    return _TEMPORARY[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table to the shared folder and read it back.

    The lineage ends at the files, so a lost executor re-reads parquet instead
    of repeating the stages before it, and later plans see real sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Copies of a heavy key's row, and the share of rows from which a key is heavy.
SALTS, HEAVY_SHARE, ONE_TASK_ROWS = 64, 1_000, 100_000


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join a table of one row a key, whatever share of ``rows`` a key or null holds.

    A table of at most 10,000 rows is broadcast. Beyond, null keys are dealt
    evenly, as nothing can match them, and the rows of keys with over a
    thousandth of all rows (fewer than a thousand keys) meet one of 64 copies of
    their row.
    """
    small, few = pinned(table)
    if few:
        return rows.join(small, key, "left")
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    total = rows.count()
    if total > ONE_TASK_ROWS:
        heavy, _ = pinned(rows.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > total // HEAVY_SHARE).select(key, F.lit(True).alias("__heavy")))
        left, right = rows.join(heavy, key, "left"), table.join(heavy, key, "left")
    else:
        left, right = (df.withColumn("__heavy", F.lit(None).cast("boolean")) for df in (rows, table))
    left = left.withColumn("__salt", F.when(F.col(key).isNull() | F.col("__heavy"), salt).otherwise(0)).drop("__heavy")
    copies = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left.join(right.withColumn("__salt", F.explode(copies)).drop("__heavy"), [key, "__salt"], "left").drop("__salt")


def pinned(df: DataFrame, max_rows: int = 10_000) -> tuple[DataFrame, bool]:
    """Fix a table that ought to be small; the flag says whether it was.

    At most ``max_rows + 1`` rows reach the driver. Within the bound the rows
    come back as a local table marked for broadcast; beyond it the table is
    returned as it was and joins shuffle.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df, False
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), True
