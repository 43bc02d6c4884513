"""Session helpers: builder, table access, and tables that cut a lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "8g", conf: dict[str, str] | None = None) -> SparkSession:
    """A session for tests and local runs; clusters bring their own."""
    return (
        SparkSession.builder.master(master)
        .appName("quillspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=conf or {})
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local session (tests) gets a folder of
    its own; on a cluster that is an error, as no executor would find what another one wrote."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        known = _own.setdefault(spark.sparkContext.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="quillspark-")
        _own[spark.sparkContext.applicationId] = known
    return known.rstrip("/")


def own_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted by sweep() or when the process ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def sweep() -> int:
    """Delete all that was written to the shared folder by this process; how many paths. Results that still read from
    them must have been taken before."""
    n = 0
    while _written:
        spark, path = _written.pop()
        try:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
            n += 1
        except Exception:  # the session is gone, and with it the way to the folder
            continue
    return n


atexit.register(sweep)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage, survives lost executors,
    and keeps column pruning for every later reader."""
    spark = df.sparkSession
    path = own_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Repartition only when a scan has fewer partitions than the cluster has cores, as a small table does.
    On large inputs the scan already has more, and nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * per_core) if df.rdd.getNumPartitions() < cores else df
