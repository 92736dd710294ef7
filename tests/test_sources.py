"""Documents from a database, by ranges of their ids."""

import uuid

import pytest
from pyspark.sql import functions as F

from docmill.sources import documents as d


@pytest.fixture
def table(spark):
    """(url, name): ids in two clusters, some texts null or blank, a row without an id."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    ids = [*range(900), *range(10**12, 10**12 + 100)]
    rows = [(i, None if i % 10 == 1 else " " if i % 10 == 2 else f"<R id='{i}'/>") for i in ids] + [(None, "<R/>")]
    spark.createDataFrame(rows, "app_id long, body string").write.jdbc(url, "docs")
    return url, "docs"


def ids(df):
    return sorted(r.doc_id for r in df.collect())


WANT = [i for i in [*range(900), *range(10**12, 10**12 + 100)] if i % 10 not in (1, 2)]


@pytest.mark.parametrize(("partitions", "even", "bounds"), [(1, False, None), (4, False, None), (4, True, None), (4, False, (100, 200)), (5, True, (0, 900))])
def test_all_documents_come_once(spark, table, partitions, even, bounds):
    """Also those beyond the bounds."""
    got = d.read_jdbc(spark, *table, "app_id", "body", partitions, bounds, even)
    assert ids(got) == WANT and got.columns == ["doc_id", "xml"] and got.rdd.getNumPartitions() == partitions


def test_even_ranges(spark, table):
    """Equally wide ranges leave clusters in one task; even ones don't."""
    sizes = {even: [r["count"] for r in d.read_jdbc(spark, *table, "app_id", "body", 4, even=even).groupBy(F.spark_partition_id()).count().collect()] for even in (False, True)}
    assert max(sizes[False]) == 720 and len(sizes[True]) == 4 and max(sizes[True]) <= 240


def test_filters_go_to_the_database(spark, table):
    got = d.slice_range(d.read_jdbc(spark, *table, "app_id", "body", 4), 100, 200)
    plan = got._jdf.queryExecution().executedPlan().toString().upper()
    assert ids(got) == [i for i in WANT if 100 <= i <= 200]
    assert "PUSHEDFILTERS" in plan and "GREATERTHANOREQUAL(APP_ID,100)" in plan.replace(" ", "").replace("*", "").replace("`", "") and "LESSTHANOREQUAL(APP_ID,200)" in plan.replace(" ", "")


def test_an_empty_database_table(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    spark.createDataFrame([], "app_id long, body string").write.jdbc(url, "docs")
    for even in (False, True):
        assert d.read_jdbc(spark, url, "docs", "app_id", "body", 4, even=even).count() == 0
