"""Every registered query against its SQL on the same tables, and its plan."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from hireflow.verification.registry import QUERIES, REFERENCE_SQL as SQL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def cell(value):
    return round(value, 6) if isinstance(value, float) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = table(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|CartesianProduct|"
                         r"BroadcastNestedLoopJoin", plan)
    if name not in SQL:
        assert got
        return
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, result.fetchall())


def test_every_sql_has_its_query():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0


def test_events_are_shuffled_once_for_join_numbering_and_outcome(spark, sf):
    """Only the dedupe of each side and one shuffle by application."""
    from hireflow.verification import canonical as c

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = c.facts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\(_event_id", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(application_id", plan)) == 3
    assert plan.count("WindowGroupLimit") == 6


def test_run_day_prunes_raw_partitions(spark, sf):
    from hireflow.operators.impacted import ingested_on
    from hireflow.verification.source_queries import SECOND, loaded_twice

    store, _ = loaded_twice(spark, sf)
    run_day = ingested_on(store.read("workflow_events"), SECOND.date())
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = run_day._jdf.queryExecution().explainString(mode)
    assert re.search(r"PartitionFilters: .*_ingestion_date#\d+ = .*dynamicpruning", plan)
