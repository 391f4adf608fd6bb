"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; a cluster's own settings win where given.

    AQE does the runtime work: it splits skewed join partitions, coalesces small shuffle
    partitions and turns a join into a broadcast only once the built side's size is known.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.session.timeZone": "UTC",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidemark-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster the lack
    of the setting is an error, because a machine-local folder would lose data with its executor.
    """
    named = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getConf().get(SHARED_DIR_KEY)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder shared by all executors")
    return _local_dir(spark.sparkContext.applicationId)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one run of ``label``."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, partitions: int, keyed: bool = False) -> SparkSession:
    """A sibling session for streaming queries, with its own SQL settings.

    A stream keeps its number of shuffle partitions for the life of its checkpoint, so ``partitions``
    is chosen for the state it will grow to, not for the cores of its first start. Streams whose state is
    kept key by key, with timers, are ``keyed``: their states lie in RocksDB.
    """
    sibling = spark.newSession()
    if keyed:
        sibling.conf.set(STATE_STORE_KEY, STATE_STORE)
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return sibling


def spread(df: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """Rows of a scan that is too small to occupy the cores, dealt out over them.

    A scan of at least a split per core is returned as it is, so big tables are never shuffled
    here. The size is the one the planner knows from the file listing; a stream has none, so a scan ``like``
    it tells.
    """
    known = df if like is None else like
    spark = known.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(known._jdf.queryExecution().sparkSession().sessionState().conf().filesMaxPartitionBytes())
    size = int(str(known._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * split else df
