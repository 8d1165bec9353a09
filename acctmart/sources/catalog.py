"""Tables by name: from parquet folders, from the session catalog, from a database."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from acctmart.operators.filters import IdRange, complete, jdbc_predicates, overlapping
from acctmart.schemas import TABLES, conform

_SUFFIX = ".parquet"


class Tables(Mapping[str, DataFrame]):
    """Named tables, each opened when first asked for."""

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(openers)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._openers[name]()
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def create_views(self) -> None:
        """A temporary view per table, for queries written as SQL text."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)


def lower_case(df: DataFrame) -> DataFrame:
    """Every column name in lower case, as the catalog's own headers are."""
    return df.toDF(*[name.lower() for name in df.columns])


def rename_by_position(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Name the columns from a header, first to first."""
    if len(header) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(header)} names")
    return df.toDF(*[name.lower() for name in header])


def _typed(df: DataFrame, name: str) -> DataFrame:
    return conform(df, TABLES[name]) if name in TABLES else lower_case(df)


def read_parquet(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a parquet folder, with the fixed types where the table is known."""
    return _typed(spark.read.parquet(f"{base.rstrip('/')}/{name}{_SUFFIX}"), name)


def load_parquet(
    spark: SparkSession, base: str, names: Iterable[str] | None = None
) -> Tables:
    """The named tables of a folder, or all that lie in it."""
    chosen = list_datasets(spark, base) if names is None else list(names)
    return Tables({n: lambda n=n: read_parquet(spark, base, n) for n in chosen})


def load_catalog(spark: SparkSession, sources: Mapping[str, str]) -> Tables:
    """Tables and views of the session catalog, as {table: catalog name}."""
    return Tables({n: lambda n=n, s=s: _typed(spark.table(s), n) for n, s in sources.items()})


def list_datasets(spark: SparkSession, base: str) -> list[str]:
    """Names of the parquet datasets directly below ``base``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(n.removesuffix(_SUFFIX) for n in found if n.endswith(_SUFFIX))


def query_catalog(spark: SparkSession, sql: str) -> DataFrame:
    """Result of a SQL text over the session catalog."""
    return lower_case(spark.sql(sql))


def query_database(
    spark: SparkSession,
    url: str,
    sql: str,
    properties: Mapping[str, str] | None = None,
    id_name: str | None = None,
    ranges: Sequence[IdRange] | None = None,
) -> DataFrame:
    """Result of a query that a database runs; one task per range of a result column if given."""
    if ranges is not None:
        return read_database_table(spark, url, f"({sql}) ranged", properties, id_name, ranges)
    reader = spark.read.format("jdbc").options(url=url, query=sql, **(properties or {}))
    return lower_case(reader.load())


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    id_name: str | None = None,
    ranges: Sequence[IdRange] | None = None,
) -> DataFrame:
    """A database table, local or behind a database link; one task per id range if given.

    Ranges only divide the work: those that overlap would read rows twice, those that leave
    ids out would lose rows, and both are refused. Without ranges one task reads it all.
    """
    options = dict(properties or {})
    if ranges is None:
        return lower_case(spark.read.jdbc(url, table, properties=options))
    if id_name is None:
        raise ValueError("ranges need the id column's name")
    shared = overlapping(ranges)
    if shared:
        raise ValueError(f"ranges {shared[0].number} and {shared[1].number} overlap")
    if not complete(ranges):
        raise ValueError("ranges leave ids out: open the first below and the last above")
    predicates = jdbc_predicates(id_name, ranges)
    return lower_case(spark.read.jdbc(url, table, predicates=predicates, properties=options))
