"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctmart.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, and its path.

    Later steps then neither repeat the work nor depend on any executor's disk.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table of ``write_table`` that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id's text is a multiple of 5.

    A null id counts as held out.
    """
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about ``limit`` bytes of text each, one row at least."""
    data = batch.column(column)
    start = size = 0
    for i, n in enumerate(pc.binary_length(data).fill_null(0).to_pylist()):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def give_back(cache: dict) -> None:
    """Free what a task has gathered: its worker stays, and shares memory with the executor."""
    cache.clear()
    pa.default_memory_pool().release_unused()


def sample_texts(
    documents: DataFrame, labelled: DataFrame, label: str, per_label: int, longest: int = 50_000
) -> list[tuple[str, object]]:
    """A bounded sample of training texts: at most ``per_label`` rows of each label.

    ``labelled`` has doc_id and the label; rows with a null label or id and held-out rows
    are left out, and of several labels of an id the least counts. Of ids that have a text of
    up to ``longest`` characters those with the smallest hash are taken, so the sample does
    not depend on the partitioning; null and longer texts take no place in it.
    """

    def least(df: DataFrame, *groups: str) -> DataFrame:
        """The ``per_label`` rows of least rank in each group."""
        order = Window.partitionBy(*groups).orderBy("rank", "doc_id")
        return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label)

    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= longest))
    ranked = (
        labelled.select("doc_id", F.col(label).alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
        .select("doc_id", "label", F.xxhash64("doc_id", F.lit(7)).alias("rank"))
        .withColumn("part", F.pmod("rank", F.lit(64)))
    )
    # First in 64 parts of each label, so that no task gathers from all others.
    chosen = least(least(ranked, "label", "part"), "label").select("doc_id", "label")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")  # per_label rows of each label
        .groupBy("doc_id", "label")
        .agg(F.max("text").alias("text"))
        .collect()
    )
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def text_key() -> Column:
    """A hash of the text which, with doc_id, finds a row again; null counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, kept: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` whose doc_id and ``key`` are in ``kept`` (doc_id, key).

    All columns stay. Of rows that agree in both, one stays; null ids count as equal.
    """
    names = [free_name(docs, n) for n in ("_id", "_no_id", "_key")]

    def keyed(df: DataFrame, *columns: str, key: Column) -> DataFrame:
        ids = (F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), key)
        return df.select(*columns, *[c.alias(n) for c, n in zip(ids, names)])

    single = keyed(docs, *docs.columns, key=key).dropDuplicates(names)
    wanted = keyed(kept, key=F.col("key"))
    return single.join(wanted, names, "left_semi").select(*docs.columns)
