"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words, everywhere in this package: runs of what is not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_scratch: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended: the folder's owner clears it
        pass


def scratch(spark: SparkSession) -> str:
    """A folder of this application's own in the shared folder that spark.checkpoint.dir names.

    Where that setting is unset the warehouse serves, which is shared too. It is removed when the driver ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not base:
            base = spark.conf.get("spark.sql.warehouse.dir")
        _scratch[app] = f"{base.rstrip('/')}/codexlake-{app}-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _scratch[app])
    return _scratch[app]


#: With it, Spark removes a command's shuffle files when the command ends: a written table makes them useless at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a few numbers that one task may well write.
ROWS_A_TASK = 200_000


def written(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared scratch folder, which cuts the lineage and survives lost executors.

    at_most: a bound of the number of (narrow) rows, for which few tasks do where few rows can come.
    """
    spark = df.sparkSession
    if at_most is not None:
        df = df.coalesce(max(1, -(-at_most // ROWS_A_TASK)))
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Removes tables that written() made, when nothing reads them any more."""
    for t in tables:
        base = scratch(t.sparkSession)
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            if folder.rsplit("/", 2)[-2] == base.rsplit("/", 1)[-1]:
                _remove(t.sparkSession, folder)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of few rows, so that a Python worker holds little even where texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(column: str, by: int):
    """crc32 of the id as text, modulo: the contract's folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def labelled(labels: DataFrame, label: str, rows: int, held_by: int, held: int) -> DataFrame:
    """(doc_id, y): at most `rows` labelled rows outside the held-out fold, the same ones on every run.

    Rows with a null id or label are left out; of several labels of one id the largest counts.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", held_by) != held))
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
