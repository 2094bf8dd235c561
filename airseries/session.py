"""Session set-up and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "airseries", **extra: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_settings(
    input_bytes: int, task_bytes: int = 1 << 30, expansion: float = 2.0
) -> dict[str, str]:
    """Settings for a given input size, so that a shuffle task holds at most about ``task_bytes``.

    ``expansion`` is the size of the shuffled rows relative to the files read.
    AQE joins partitions that turn out small. Sorted tiles (see ``ordering``) are at
    least as many as the shuffle partitions; their rows are bounded besides.
    """
    partitions = max(200, int(input_bytes * expansion / task_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def stage_root(spark: SparkSession) -> str:
    """The folder staged tables go to.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder; on a cluster a missing
    setting is an error, because executors could not share a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="airseries-"))
    return spark.sparkContext.getCheckpointDir()


def _stage_home(spark: SparkSession) -> str:
    return f"{stage_root(spark)}/airseries/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's stage folder, never used before."""
    return f"{_stage_home(spark)}/{label}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> bool:
    """Delete what this application staged; DataFrames built on it can not be read any more.

    Databases and tables of the session's catalog that lie in the folder go with it, whatever database holds them.
    """
    home = _stage_home(spark)
    for database in spark.catalog.listDatabases():
        if home in database.locationUri:
            spark.sql(f"DROP DATABASE IF EXISTS `{database.name}` CASCADE")
            continue
        for table in spark.catalog.listTables(database.name):
            name = f"`{database.name}`.`{table.name}`"
            if not table.isTemporary and home in _location(spark, name):
                spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0].data_type if rows else ""


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Used where two branches must see the very same rows (for example row
    numbers that depend on the partitioning) or where many jobs read one
    frame. The written table survives the loss of any executor, and later
    reads prune columns, which an RDD checkpoint would not.
    """
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_even(df: DataFrame, label: str) -> DataFrame:
    """Like :func:`stage`, with the rows dealt out evenly, for tables that are read many times over.

    Rows in order of time would leave a split by time with files of training rows only and files without
    any, so some tasks of a fit had all the work. The number of files is a multiple of the cores. Spark packs files
    into scan tasks by their size; if these come to no multiple of the cores, which would leave cores idle in the last
    round of every later pass, the rows are dealt out once more, into as many files as full rounds have tasks.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    staged = stage(df.repartition(_full_rounds(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)), label)
    tasks = scan_tasks(staged)
    return staged if tasks % cores == 0 else stage(staged.repartition(_full_rounds(tasks, cores)), label)


def _full_rounds(tasks: int, cores: int) -> int:
    """The least number of tasks that is not below ``tasks`` and keeps all cores busy."""
    return -(-max(tasks, 1) // cores) * cores


def scan_tasks(df: DataFrame) -> int:
    """Tasks that read a staged table."""
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def stage_buckets(df: DataFrame, label: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Like :func:`stage`, as a table bucketed by ``by``: windows and joins on these columns read it without a shuffle.

    The catalog holds no more buckets than 100,000 a table.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(min(buckets, 100_000), *by).option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)
