"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def local_session(cpus: int | str = 8, app: str = "tidegrid") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may run without it; it then gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidegrid-")
    return _local_dirs[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing has been written there yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """``df`` in the place of the table at ``path``, which it may itself be made from.

    Written next to it first, then switched by two renames, so a job that dies in the writing leaves
    the old table, and one that dies in between leaves both beside each other.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{path}-next-{mark}", f"{path}-old-{mark}"
    df.write.parquet(fresh)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(place(path)) and not fs.rename(place(path), place(old)):
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(place(fresh), place(path)):
        raise OSError(f"{fresh} cannot take the place of {path}")
    fs.delete(place(old), True)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage, survives the loss of executors, and gives the planner
    exact sizes for what follows.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
