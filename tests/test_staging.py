import os
import threading

import pytest

from logwarden.session import stage, stage_bucketed, staged_inside, staging_root


def names(spark):
    return set(os.listdir(staging_root(spark)))


def test_scopes_of_two_threads(spark):
    """A job beside a scope keeps its tables, and so does a scope inside another thread's."""
    inside, done, kept = threading.Event(), threading.Event(), []

    def other():
        inside.wait(60)
        kept.append(stage(spark.range(7).toDF("id"), "beside"))
        with staged_inside(spark):
            stage(spark.range(3).toDF("id"), "scoped")
        done.set()

    thread = threading.Thread(target=other)
    thread.start()
    before = names(spark)
    with staged_inside(spark):
        stage(spark.range(5).toDF("id"), "mine")
        inside.set()
        assert done.wait(60)
        outlives = stage(spark.range(2).toDF("id"), "outlives", outlives_scope=True)
    thread.join()
    assert kept[0].count() == 7 and outlives.count() == 2
    assert {n.rsplit("-", 1)[0] for n in names(spark) - before} == {"beside", "outlives"}


def test_nested_scopes_and_errors(spark):
    before = names(spark)
    with pytest.raises(ValueError):
        with staged_inside(spark):
            mine = stage(spark.range(4).toDF("id"), "outer")
            with staged_inside(spark):
                stage(spark.range(4).toDF("id"), "inner")
            assert mine.count() == 4
            raise ValueError
    assert names(spark) == before


def test_bucketed_tables_are_not_shuffled(spark):
    rows = stage_bucketed(spark.range(1000).selectExpr("id % 50 AS key", "id AS value"), "bucketed", "key")
    other = spark.range(50).selectExpr("id AS key", "id * 2 AS twice")

    def both(left, right):
        return left.groupby("key", as_index=False)["value"].sum().merge(right)

    out = rows.groupBy("key").cogroup(other.groupBy("key")).applyInPandas(both, "key long, value long, twice long")
    assert out.count() == 50 and out.filter("value <> 20 * key + 9500").count() == 0
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert spark.sql("SHOW TABLES LIKE 'staged*'").count() == 0
    before = names(spark)
    with staged_inside(spark):
        assert stage_bucketed(spark.range(5).toDF("key"), "gone", "key").count() == 5
    assert names(spark) == before
