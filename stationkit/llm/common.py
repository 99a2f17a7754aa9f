"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: rows of one Arrow batch handed to Python; documents can be long, so a batch
#: holds far fewer than Spark's default of 10,000
BATCH_ROWS = 1024

#: training rows that a class keeps however many classes share the bound
LEAST_ROWS = 20


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Hand at most ``rows`` rows at a time to Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by later jobs."""
    return cut_lineage(df, f"llm-{name}")


def id_hash_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def text_of(batch, column: int = 1) -> list[str]:
    """Texts of an Arrow batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def rows_each(per_class: int, max_rows: int, classes: int) -> int:
    """Training rows of a class, so that all classes have ``max_rows`` at most
    (or ``LEAST_ROWS`` each)."""
    return max(min(LEAST_ROWS, per_class), min(per_class, max_rows // max(1, classes)))


def stratified(df: DataFrame, column: str, counts: list[tuple], rows: int, seed: str) -> DataFrame:
    """At most ``rows`` rows of each class of ``column``, those of least hash of
    ``doc_id`` and, where there is one, ``text``; ``counts`` are the classes' sizes.
    A hash lets somewhat more than the wanted rows through, so that the window
    sees few."""
    grain = 1 << 30
    wide = rows + 8 * rows ** 0.5 + 16
    shares = df.sparkSession.createDataFrame(
        [(k, int(grain * min(1.0, wide / n)) + 1) for k, n in counts], f"`{column}` string, _share long")
    key = F.xxhash64(F.lit(seed), "doc_id", *(["text"] if "text" in df.columns else []))
    some = (df.withColumn("_hash", key).join(F.broadcast(shares), column)
            .where(F.pmod(F.col("_hash"), F.lit(grain)) < F.col("_share")))
    order = Window.partitionBy(column).orderBy(F.pmod(F.col("_hash"), F.lit(grain)), "_hash")
    return (some.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= rows)
            .drop("_hash", "_share", "_place"))
