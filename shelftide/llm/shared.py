"""Tables written once and read again, and small expressions that several operators use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One character that parts words: space, or one of the controls 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which driver and executors share; a temporary folder only on a local master without it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, with no lineage that a lost executor could break.

    All tables of one application lie in one folder, which may go when the application has ended.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once even where ``body`` uses it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def ranked(df: DataFrame, key: str, order: list[Column], drop: list[str] | None = None, finer: list[Column] | None = None) -> DataFrame:
    """``df`` with ``rank`` (from 0) of each row among those of its ``key``, and ``total``, the rows of that key.

    Rows are dealt out by ranges of (key, order), so a key with most rows still fills many tasks, and a row's rank is its
    place in its task plus the rows of its key in earlier tasks. ``key`` holds no null; ``order`` puts nulls first. ``finer``
    orders rows that ``order`` can't tell apart, inside tasks only; for long texts, whose samples the driver should not see.
    Columns in ``drop`` serve the order only. Rows equal in all this take neighbouring ranks.
    """
    along = [F.col(key), *order]
    placed = df.repartitionByRange(*along).sortWithinPartitions(*along, *(finer or [])).withColumn("__at", F.monotonically_increasing_id())
    placed = stored(placed.drop(*(drop or []))).withColumn("__task", F.shiftright("__at", 33))
    parts = placed.groupBy(key, "__task").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    one, along_tasks = Window.partitionBy(key), Window.partitionBy(key).orderBy("__task")
    parts = parts.select(
        key, "__task", "__first", (F.sum("__n").over(along_tasks) - F.col("__n")).alias("__before"), F.sum("__n").over(one).alias("total"))
    return placed.join(parts, [key, "__task"]).withColumn("rank", F.col("__at") - F.col("__first") + F.col("__before")).drop(
        "__at", "__task", "__first", "__before")
