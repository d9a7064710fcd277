"""Session helpers: one place for the configuration the jobs assume."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "gazette") -> SparkSession:
    """Session for tests, the bench and local runs (a cluster passes its own)."""
    master = master or os.environ.get("GAZETTE_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("GAZETTE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on; safe to call repeatedly on any session."""
    # All timestamps are UTC wall-clock values (feed dates are converted to UTC).
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Rows hold whole texts: Spark's default of 10,000 in one Arrow batch is too many to
    # hold in the JVM and the worker of every task at once. Another setting stays.
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable by Python workers (mapInPandas, pandas UDFs, state
    processors) wherever they run: zip it once per application and add it like
    --py-files."""
    import shutil
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext ships code its own way
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="gazette-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "gazette"), "zip", os.path.dirname(pkg), "gazette")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; set one only when unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:  # unset: tests and local runs only
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gazette-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for written intermediate tables."""
    import uuid
    return f"{checkpoint_root(spark)}/gazette/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Estimated bytes below which `spread` deals rows out anew.
SMALL_INPUT = 256 * 1024 * 1024


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy per-row work (text, HTML, XML) on a small input, which would otherwise
    run in one task, one partition per core. Small is the planner's estimate, so nothing
    runs to find out; larger inputs pass unchanged, with the splits of their files."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(target) if estimate < SMALL_INPUT else df


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write a stage once as Parquet under the shared checkpoint folder and read it back:
    later branches read it (with column pruning) instead of recomputing its lineage,
    and a lost executor only re-reads files."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


#: Buckets for each core in materialize_buckets: enough that a task holds few of a large frame's keys.
BUCKETS_PER_CORE = 16


def materialize_buckets(df: DataFrame, key: str, name: str = "stage", compression: str = "snappy") -> DataFrame:
    """materialize, in files by a hash of `key`: a later grouping by it reads each bucket in one
    task and its rows are not shuffled. Each task writes one file for each bucket it has rows of."""
    spark = df.sparkSession
    path, buckets = scratch_path(spark, name), BUCKETS_PER_CORE * spark.sparkContext.defaultParallelism
    table = "gazette_" + path.rsplit("-", 1)[1]
    (df.write.mode("overwrite").format("parquet").option("path", path).option("compression", compression)
     .bucketBy(buckets, key).saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")        # its files stay, and what reads them
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
