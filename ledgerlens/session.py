"""Spark session settings for the audit jobs.

The library itself never builds a session; callers pass one in. These helpers
give tests, the bench and the command-line job one consistent configuration.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the reports rely on. AQE does the runtime work the plans count on:
# it broadcasts a join side only after measuring it (the size check behind every
# small-table join here), splits skewed join partitions and coalesces tiny ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # decimal money: keep ANSI so a malformed partner id fails the run
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


# Target size of one shuffle partition after AQE coalescing, and of one scan split.
ADVISORY_PARTITION_BYTES = 256 * 1024 * 1024
SCAN_SPLIT_BYTES = 512 * 1024 * 1024
# The driver tracks map tasks x reducers: beyond these counts sizes grow instead
# (at 100 TiB: 2.1 GB a split and a reducer, 50,000 x 30,000 blocks at most).
MOST_MAP_TASKS, MOST_REDUCERS = 50_000, 30_000
# Largest shuffle of a report relative to the compressed sales history it reads:
# the settlement lines (9 of 17 columns) meeting the item statistics.
FACT_SHUFFLE_RATIO = 0.6


def cluster_conf(sales_bytes: int) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``sales_bytes`` of sales
    history (compressed parquet).

    AQE can merge small shuffle partitions but never split a large one, so the
    initial partition count is sized for the largest, fact-sized shuffle; the
    small shuffles (taxes, fees, aggregated rows) are coalesced at run time."""
    biggest = max(1, int(sales_bytes * FACT_SHUFFLE_RATIO))
    advisory = max(ADVISORY_PARTITION_BYTES, -(-biggest // MOST_REDUCERS))
    partitions = max(200, -(-biggest // advisory))
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
        "spark.sql.files.maxPartitionBytes": str(
            max(SCAN_SPLIT_BYTES, -(-sales_bytes // MOST_MAP_TASKS))),
    }


# Input of one bucket of a bucketed table: some 200 MB of rows to sort.
BUCKET_BYTES = 8 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Size of the files ``df`` reads; 0 if it reads none."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    conf = spark._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def buckets_for(df: DataFrame, least: int = 16) -> int:
    """How many buckets the rows of ``df`` should have, from the size of its files."""
    return max(least, -(-input_bytes(df) // BUCKET_BYTES))


def apply_unset(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set each runtime SQL option that was not given when the application was
    launched (what the operator configured for the cluster always wins)."""
    launched = spark.sparkContext.getConf()
    for k, v in conf.items():
        if k.startswith("spark.sql.") and not launched.contains(k):
            spark.conf.set(k, v)


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "ledgerlens") -> SparkSession:
    """A local-mode session for tests and the bench (UI off, no server)."""
    cpus = int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local master (tests, the bench)
    gets a folder of its own, recorded in the session conf; any other master
    raises, since its executors would each write to their own disk.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir())
    if not root:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable directory and return
    the shared root it lives under."""
    root = shared_dir(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never a local temp dir
    on a cluster: the checkpoint folder is the one the cluster shares)."""
    import uuid

    root = shared_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: computed once,
    lineage cut, and its size known from its files when a join is planned."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
