from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctmart.schemas import TABLES


def rows(df: DataFrame) -> list[tuple]:
    """All rows as tuples, in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark: SparkSession, name: str, *values: dict) -> DataFrame:
    """A source table from partial rows; columns left out are null."""
    schema = TABLES[name]
    return spark.createDataFrame(
        [tuple(v.get(f.name) for f in schema) for v in values], schema
    )


def final_plan(df: DataFrame) -> str:
    """The physical plan after adaptive execution has finished."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString().split("== Initial Plan ==")[0]


def most_rows_of_a_task(spark: SparkSession, work) -> int:
    """The most rows that any task read from a shuffle while ``work()`` ran."""
    sc = spark.sparkContext
    store, gateway = sc._jsc.sc().statusStore(), sc._gateway

    def stages():
        none = gateway.new_array(gateway.jvm.double, 0)
        found = store.stageList(None, False, False, none, gateway.jvm.java.util.ArrayList())
        return {(found.apply(i).stageId(), found.apply(i).attemptId()) for i in range(found.size())}

    before = stages()
    work()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    most = 0
    for stage, attempt in stages() - before:
        tasks = store.taskList(stage, attempt, 10_000)
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return most


def static_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
