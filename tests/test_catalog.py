import os

import duckdb
import pytest

from strandloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in catalog.ORACLE_SQL:
        assert rows
        return
    rel = duck.execute(catalog.ORACLE_SQL[name])
    cols, want = [x[0] for x in rel.description], rel.fetchall()
    order = sorted(df.columns)
    assert sorted(cols) == order
    put = lambda rs, cs: sorted((tuple(r[cs.index(c)] for c in order) for r in rs), key=repr)
    assert put([tuple(r) for r in rows], df.columns) == put(want, cols)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["sample", "insertion", "genotype", "score_genotype"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_overlaps_hold_the_fewer_targets(spark):
    """The right side of the join is held bin by bin, and rows of the left one follow one another in the result."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = catalog.QUERIES["interval_overlap"](spark, SF)._jdf.queryExecution().executedPlan().initialPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.index("l_shipdate") < plan.index("o_orderdate")
