"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Page bodies are large, so Python batches are kept short.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def get_spark(app: str = "pageloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local
    session without one gets a folder of its own.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not named:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="pageloom-")
        spark.sparkContext.setCheckpointDir(named)
        current = spark.sparkContext.getCheckpointDir()
    return named or current


#: Narrow rows that are written as one file, if more files than cores are left.
ROWS_PER_FILE = 50_000


def cut_lineage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Materialise ``df`` in the shared folder so that loops keep short plans.

    ``rows`` is how many narrow rows there are at most, where that is known.  Few rows in many
    partitions then become few files: a partition costs a file whatever it holds, and on a local
    file system two commands that set permissions.  Partitions are taken one after another by
    fewer tasks, and no row is moved.
    """
    checkpoint_dir(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_FILE)))
    return df.checkpoint(eager=True)


def release(*tables: DataFrame) -> None:
    """Delete the files of tables that ``cut_lineage`` gave.

    Spark does so only where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, and only once the driver
    happens to collect its garbage.  What is still to be worked out from the tables cannot be read afterwards.
    """
    for table in tables:
        context = table.sparkSession.sparkContext
        name = table._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if name.isDefined():
            folder = context._jvm.org.apache.hadoop.fs.Path(name.get())
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
