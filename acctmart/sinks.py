"""Publishing results: parquet datasets and batched database loads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS_PER_STATEMENT = 10_000


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> int:
    """Replace the gzip parquet dataset at ``path``; returns the rows written.

    The count is observed during the write, so it costs no second pass. ``files`` merges
    the output for a consumer that needs few files; leave it unset for large results.
    """
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if files is not None:
        observed = observed.coalesce(files)
    writer = observed.write.mode("overwrite").option("compression", "gzip")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return counted.get["rows"]


def land(
    tables: Mapping[str, DataFrame], names: Iterable[str], base: str, at_once: int = 4
) -> dict[str, int]:
    """Write each named table as ``<base>/<name>.parquet``; returns rows per table.

    Several writes run at once, so that the last tasks of one leave no cores idle.
    """
    folder = base.rstrip("/")
    frames = {name: tables[name] for name in names}

    def write(name: str) -> int:
        return write_parquet(frames[name], f"{folder}/{name}.parquet")

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(frames, pool.map(write, frames)))


def jdbc_options(
    url: str,
    table: str,
    replace: bool,
    connections: int,
    rows_per_statement: int = ROWS_PER_STATEMENT,
    properties: Mapping[str, str] | None = None,
) -> dict[str, Any]:
    """Writer options of a database load.

    ``connections`` bounds how many tasks write at once, and ``rows_per_statement`` how many
    rows an insert batch has. Each task commits once, at its end. A replacing load truncates,
    so the table keeps its definition and grants.
    """
    options: dict[str, Any] = dict(properties or {})
    options.update(
        url=url, dbtable=table, batchsize=rows_per_statement, numPartitions=connections
    )
    if replace:
        options["truncate"] = True
    return options


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    replace: bool = False,
    connections: int = 16,
    rows_per_statement: int = ROWS_PER_STATEMENT,
    properties: Mapping[str, str] | None = None,
) -> bool:
    """Insert by column name; an empty result loads nothing and returns False.

    A replacing load of an empty result still truncates the table, as a truncate step
    ahead of the insert would. An append that fails may leave the rows of finished tasks in
    the table; ``only_new`` makes repeating it safe.
    """
    if not replace and df.isEmpty():
        return False
    options = jdbc_options(url, table, replace, connections, rows_per_statement, properties)
    mode = "overwrite" if replace else "append"
    df.write.format("jdbc").options(**options).mode(mode).save()
    return True


def only_new(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the target yet, so that a repeated load adds nothing.

    Null keys equal each other. Comparing a hash of the keys as well gives the join a
    partitioning of its own, so that a hot key can be split.
    """
    names = [f"_loaded_{i}" for i in range(len(keys))]
    loaded = target.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    same = F.xxhash64(*keys) == F.xxhash64(*names)
    for key, name in zip(keys, names):
        same = same & F.col(key).eqNullSafe(F.col(name))
    return df.join(loaded, same, "left_anti")


def with_row_count(df: DataFrame, counted: Observation) -> DataFrame:
    """``df`` that also reports its number of rows once it has run."""
    return df.observe(counted, F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, rows: int = 10) -> None:
    """Print the first rows."""
    df.show(rows, truncate=False)


def with_reject_count(df: DataFrame, counted: Observation, rejected: Column) -> DataFrame:
    """``df`` that also reports how many rows meet ``rejected``."""
    return df.observe(
        counted, F.count_if(rejected).alias("rejects"), F.count(F.lit(1)).alias("rows")
    )
