import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double, part long, row long, v string"


def write(spark, folder, rows):
    full = [(i, v, label, 7, 0.5, 3, 1, "x") for i, v, label in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def brute(rows, n_positives=5, n_negatives=10):
    """The contract by plain loops over all rows."""
    kept = []
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((n, i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for n, i, v, label in kept:
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, other) for m, j, w, other in kept if m != n]
        for p, positive, _ in sorted((x for x in scored if x[2] == label), key=order)[:n_positives]:
            inside = sorted((x for x in scored if x[2] != label and 30 * p <= 100 * x[0] <= 90 * p), key=order)[:n_negatives]
            out += [(i, positive, rank, j, p, s) for rank, (s, j, _) in enumerate(inside, 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


def some(r, n, dim, values):
    return [(i, [values() for _ in range(dim)], r.randrange(10)) for i in range(n)]


def test_query_against_brute_force(spark, tmp_path):
    r = random.Random(2)
    rows = some(r, 700, 16, lambda: r.gauss(0, 0.12))
    nan, inf = float("nan"), float("inf")
    rows += [(800, None, 1), (900, [nan] * 16, 1), (901, [0.1] * 15 + [inf], 1), (902, [0.1] * 15 + [None], 1), (1000, [0.1] * 16, None), (1100, [0.0] * 16, 3), (None, [0.2] * 16, 3), (1200, [], 4), (1300, [0.3, 0.1], 4)]
    got = rows_of(hard_negatives.op11(spark, write(spark, tmp_path, rows)))
    assert got == brute(rows) and len(got) > 100


def test_ties_and_repeated_rows(spark, tmp_path):
    r = random.Random(5)
    rows = some(r, 400, 3, lambda: r.choice([-0.5, 0.0, 0.5]))
    rows += [rows[100], rows[100], rows[200], rows[7], rows[7]] + [(i, [0.5, 0.5, 0.0], 2) for i in range(500, 560)]
    got = rows_of(hard_negatives.op11(spark, write(spark, tmp_path, rows)))
    assert got == brute(rows) and len(got) > 50


@pytest.mark.parametrize("block_rows", [1, 37, 10_000])
def test_blocks_do_not_matter(spark, block_rows):
    r = random.Random(8)
    rows = [(i, v, label) for i, v, label in some(r, 150, 8, lambda: r.gauss(0, 0.2))]
    ints = hard_negatives.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    ints = ints.withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    got = hard_negatives.mine(ints, F.col("vec_id") % 100 == 0, block_rows=block_rows)
    assert rows_of(got) == brute(rows)


def test_sql_gives_the_same(spark, tmp_path):
    r = random.Random(11)
    folder = write(spark, tmp_path, some(r, 500, 8, lambda: r.gauss(0, 0.2)) + [(600, None, 1), (700, [float("nan")] * 8, 2), (800, [None] * 8, 2)])
    with duckdb.connect() as con:
        con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
        sql = con.execute(hard_negatives.OP11_SQL)
        columns = [d[0] for d in sql.description]
        want = sorted((tuple(x) for x in sql.fetchall()), key=str)
    out = hard_negatives.op11(spark, folder)
    assert columns == out.columns and rows_of(out) == want


def test_threshold_stops_before_all_are_scored():
    """Where few candidates have large components, the lists end early; what was met suffices."""
    r = np.random.default_rng(1)
    x = r.integers(-3, 4, (5000, 6))
    x[:40] *= 200
    lists = hard_negatives.Lists(x, np.arange(5000), np.arange(5000), np.zeros(5000, np.int64))
    scored = []
    lists.floats = x.astype(float)
    whole = lists.floats

    class Counting:
        def __getitem__(self, new):
            scored.append(len(new))
            return whole[new]

    lists.floats = Counting()
    a = np.array([5, -3, 2, 0, 1, -1])
    _, found, score = next(lists.search(a, 5, [(-(1 << 62), 1 << 62)], np.ones(5000, bool)))
    assert score.tolist() == sorted((x @ a).tolist(), reverse=True)[:5] and sum(scored) < 1500


def test_wide_scores(spark):
    """Scores above 53 bits are counted in whole numbers; above 64 bits they fail."""
    rows = [(0, [1 << 28, 3], 1), (1, [1 << 27, 1], 1), (2, [(1 << 26) + 1, 1], 2)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>, label int")
    (got,) = hard_negatives.mine(df, F.col("vec_id") == 0).collect()
    assert got.positive_score == (1 << 55) + 3 and got.negative_score == (1 << 54) + (1 << 28) + 3
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mine(df.withColumn("vector", F.transform("vector", lambda x: x * (1 << 20))), F.col("vec_id") == 0).collect()


def test_empty_table(spark, tmp_path):
    assert hard_negatives.op11(spark, write(spark, tmp_path, [])).count() == 0
