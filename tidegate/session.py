"""Session settings and the few file-system calls the jobs need."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on; all can be set on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names, a temporary one only in local mode."""
    context = spark.sparkContext
    folder = (
        spark.conf.get(CHECKPOINT_CONF, None)
        or context.getConf().get(CHECKPOINT_CONF)
        or context.getCheckpointDir()
    )
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="tidegate-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    context.setCheckpointDir(local)
    return context.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """New, not yet existing folder path below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


# Rows of one task ahead of costly per-row work: what it sorts or holds does not grow with the input.
ROWS_PER_TASK = 100_000


def spread(rows: DataFrame) -> DataFrame:
    """Deal the rows of too few input splits over all cores and over tasks of bounded size, ahead of costly per-row work.

    For a plain scan: it asks for the physical plan and counts the rows, by file footers. Input that already has
    a split per core and few rows in each passes through without an exchange.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-rows.count() // ROWS_PER_TASK))
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below ``path``; empty when it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one already; False if there is. At most one caller succeeds."""
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        stream = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception) or "already exists" in str(error.java_exception):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing what is there."""
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    stream = fs.create(hadoop_path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_file(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``; empty when it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isFile())


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Length of all files below the folders."""
    total = 0
    for path in paths:
        fs, hadoop_path = _file_system(spark, path)
        total += fs.getContentSummary(hadoop_path).getLength()
    return total
