"""Session settings and the shared folder that jobs may write to."""

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # dates and buckets are computed on UTC wall-clock time
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: broadcast by measured size, split skewed join partitions,
    # merge small shuffle partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key of a join even where a later step then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles a method of more than 8000 bytes of bytecode; above that, separate
    # operators run several times faster than one fused stage that stays interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # ids and other stream state live on disk, checkpointed in the shared folder
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # a sort with a larger limit is done as a distributed sort, not in one heap
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}


def build_session(app_name="rollbook", master=None, shuffle_partitions=None, extra=None):
    """A session with the settings above; on a cluster ``master`` comes from spark-submit.

    ``shuffle_partitions`` is the starting point only, AQE merges small partitions. On a
    large cluster give two to three times the number of executor cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark, name):
    """A new sub-folder of the folder that the cluster shares between its executors.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, an application whose
    executors run inside the driver (master ``local``) gets a temporary folder; on a cluster it
    is an error, since no executor would see the files of another.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="rollbook-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
