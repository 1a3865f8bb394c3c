"""Session and checkpoint helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "metaweave", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; it is only
    read here. A machine-local folder is created only for local-mode sessions
    that have none configured (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="metaweave-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at shared storage (HDFS/S3/ABFS) "
        "before using operators that number rows (dense_code, with_row_index)"
    )


def materialize(df):
    """Write ``df`` as a Parquet table under the session's checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the written table, never the
    sources) and lets several jobs reuse one evaluation of an expensive plan. One
    pass over the plan: ``Dataset.checkpoint`` on an un-persisted plan computes it
    twice (once to count, once to write), which at scale doubles e.g. the range
    sort behind global numbering. The folder is the shared one named by
    ``spark.checkpoint.dir``; never a local checkpoint.
    """
    import uuid

    from pyspark.sql import functions as F
    from pyspark.sql.types import NullType

    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/metaweave-{uuid.uuid4().hex}"
    fixes = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if isinstance(f.dataType, NullType)}
    out = df.withColumns(fixes) if fixes else df
    out.write.mode("errorifexists").parquet(path)
    # the schema is known: skip footer-based schema inference on read-back
    return spark.read.schema(out.schema).parquet(path)
