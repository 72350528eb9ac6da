"""Session defaults and the shared folder every written intermediate goes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_fallback: str | None = None


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tableloom") -> SparkSession:
    """A session for tests and benches; on a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tableloom-warehouse-"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: its executors live in this very process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_fallback
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="tableloom-")
    return _local_fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tableloom/{label}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, label: str = "work") -> str:
    """A new database whose managed tables live in the shared folder."""
    name = f"tl_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/tableloom/{name}.db'")
    return name


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Write the rows once and read them back.

    Consumers then all see the same batch even if its query is volatile, its source is read only
    once, and a lost executor costs a re-read of files rather than a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
