"""Hard negatives of anchors by the threshold algorithm over sorted lists of components.

A score is the inner product of integer vectors. Candidates are dealt into blocks of bounded size; a block keeps, for
each dimension, the list of its candidates in the order of that component. An anchor reads all lists at once, from the
end at which its own component's sign makes products large, and scores every candidate that it meets for the first time.
No candidate that it has not met can score more than the threshold, the sum of the products at the depth that has been
read. An anchor is done with a block when the threshold is strictly below the k-th score of each of its windows, or
below the window: equal scores go by id, so a candidate that might equal the k-th must be met.

The first search finds each anchor's positives, in blocks of its own label; the second its negatives, for each positive
in a window of scores that depends on the positive's score. Results of the blocks, at most k for each window, are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, shuffle_partitions, stored

BLOCK_ROWS = 8192
#: Depth to which an anchor reads the lists first; it doubles.
FIRST_DEPTH = 32
_NO_ID = np.iinfo(np.int64).max
_FOUND = pa.schema([(c, pa.int64()) for c in ("anchor_row", "place", "row", "id", "score")])


def _matrix(lists: pa.ListArray, dim: int | None = None) -> np.ndarray:
    """Rows of integers; shorter vectors are filled up with zeros, longer ones than dim are cut."""
    ends = np.cumsum(np.concatenate([[0], lists.value_lengths().to_numpy(zero_copy_only=False)]))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    dim = int(sizes.max(initial=0)) if dim is None else dim
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    for row, at, size in zip(out, ends, sizes, strict=False):
        row[: min(size, dim)] = flat[at : at + min(size, dim)]
    return out


class Lists:
    """A block: candidates with rows, ids and labels, and for each dimension the candidates in ascending order of it."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.rows, self.ids, self.labels, self.x = rows, ids, labels, x
        self.largest = int(np.abs(x).max(initial=0))
        self.order = np.argsort(x.T, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(x.T, self.order, axis=1)
        self.floats: np.ndarray | None = None

    def exact(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, sorted components, anchor) in a type that holds every score without rounding."""
        bound = self.largest * int(np.abs(a).max(initial=0)) * max(1, len(a))
        if bound < 1 << 53:
            if self.floats is None:
                self.floats = self.x.astype(np.float64)
            return self.floats, self.values, a.astype(np.float64)
        if bound < 1 << 63:
            return self.x, self.values, a
        raise ValueError("scores do not fit 64 bits")

    def search(self, a: np.ndarray, k: int, windows: list[tuple[int, int]], eligible: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window, places, scores) of the k best eligible candidates in each window (low, high) of scores, ends included; best first."""
        n = len(self.rows)
        x, values, a = self.exact(a)
        up, down = np.flatnonzero(a < 0), np.flatnonzero(a > 0)
        met, score = np.zeros(n, bool), np.zeros(n, a.dtype)
        depth, below = 0, FIRST_DEPTH
        while depth < n:
            below = min(below, n)
            now = met.copy()
            now[self.order[up, depth:below]] = True
            now[self.order[down, n - below : n - depth]] = True
            if not len(up) and not len(down):
                now[:] = True
            new = np.flatnonzero(now != met)
            score[new] = x[new] @ a
            met, depth, below = now, below, 2 * below
            threshold = a[up] @ values[up, depth - 1] + a[down] @ values[down, n - depth]
            if met.all():
                break
            better = score[met & eligible & (score > threshold)]
            if all(threshold < low or np.count_nonzero((better >= low) & (better <= high)) >= k for low, high in windows):
                break
        for w, (low, high) in enumerate(windows):
            found = np.flatnonzero(met & eligible & (score >= low) & (score <= high))
            if len(found) > k:
                found = found[score[found] >= np.partition(score[found], len(found) - k)[len(found) - k]]
            found = found[np.lexsort((self.rows[found], self.ids[found], -score[found]))[:k]]
            yield w, found, score[found]


def _searcher(each: Callable[[Lists, dict], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> Callable:
    """Reads a partition sorted by (part, block, kind): a block's candidates (kind 0), then its anchors (kind 1), a few at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, lists = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "block", "kind")], axis=1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for at, to in zip(starts, starts[1:], strict=False):
                if at == to:
                    continue
                part = batch.slice(at, to - at)
                this, kind = tuple(keys[at, :2]), keys[at, 2]
                if this != key:
                    key, held, lists = this, [], None
                if kind == 0:
                    held.append(part)
                    continue
                if not held and lists is None:
                    continue
                if lists is None:
                    t = pa.Table.from_batches(held).combine_chunks()
                    column = lambda c: t.column(c).combine_chunks()  # noqa: B023, E731
                    lists = Lists(_matrix(column("v")), column("row").to_numpy(), column("id").fill_null(_NO_ID).to_numpy(), column("label").to_numpy())
                    held = []
                yield from _answers(part, lists, each)

    return work


def _answers(part: pa.RecordBatch, lists: Lists, each: Callable) -> Iterator[pa.RecordBatch]:
    vectors = _matrix(part.column("v"), lists.x.shape[1])
    rows, labels, windows = (part.column(c).to_pylist() for c in ("row", "label", "windows"))
    out: list[list[np.ndarray]] = [[] for _ in _FOUND]
    for vector, row, label, asked in zip(vectors, rows, labels, windows, strict=True):
        for place, found, score in each(lists, {"v": vector, "row": row, "label": label, "windows": asked}):
            for column, values in zip(out, (np.full(len(found), row), np.full(len(found), place), lists.rows[found], lists.ids[found], score), strict=True):
                column.append(values)
    columns = [pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64)) for c in out]
    columns[3] = pa.compute.if_else(pa.compute.equal(columns[3], _NO_ID), pa.scalar(None, pa.int64()), columns[3])
    yield pa.RecordBatch.from_arrays(columns, schema=_FOUND)


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for integer vectors.

    Each anchor's positives are its best other rows of the same label; a positive's negatives are the best rows of
    another label whose scores are low to high hundredths of the positive's, ends included. Better is a higher inner
    product, then the smaller id (rows without an id last). Rows with a null label, vector or component take no part.
    Every row counts by itself: rows that repeat an id are anchors, positives and negatives side by side. Of vectors of
    different lengths the missing components are zeros. Anchors without positives, and positives whose score is below 0
    or that have no row in the window, give no rows; an empty table gives none. Scores whose hundredfold takes over 64 bits fail.

    Every anchor meets every block (of its own label, for positives), so the work grows as anchors times rows, less what
    the thresholds save. A task holds one block, whose size is a parameter, and reads the anchors as a stream.
    """
    if low < 0:
        raise ValueError("low is below 0")
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col(vector_col)
    kept = vectors.filter(F.col(label_col).isNotNull() & F.forall(v, lambda x: x.isNotNull()))
    rows = kept.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.cast("array<long>").alias("v"), is_anchor.alias("anchor")
    )
    rows = stored(rows, "vectors")  # a row's number must be the same in every scan
    anchors = rows.filter("anchor").drop("anchor")
    empty = F.lit(None).cast("array<struct<low: long, high: long>>").alias("windows")
    cut = lambda n: F.ceil(n / block_rows).cast("int")
    block_of = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")

    def meet(candidates: DataFrame, asked: DataFrame, each: Callable, n: int) -> DataFrame:
        both = candidates.select("part", block_of.alias("block"), F.lit(0).alias("kind"), "row", "id", "label", "v", empty).union(
            asked.select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "row", "id", "label", "v", "windows")
        )
        dealt = both.repartition(max(n, shuffle_partitions(spark)), "part", "block").sortWithinPartitions("part", "block", "kind")
        return dealt.mapInArrow(_searcher(each), ", ".join(f"{c} long" for c in _FOUND.names))

    total = max(1, -(-rows.count() // block_rows))

    def same_label(lists: Lists, anchor: dict) -> Iterator:
        return lists.search(anchor["v"], positives, [(-_NO_ID, _NO_ID)], lists.rows != anchor["row"])

    sizes = rows.groupBy("label").agg(cut(F.count("*")).alias("blocks"))
    in_label = lambda df: df.join(sizes, "label").withColumn("part", F.col("label"))
    first = _best(meet(in_label(rows), in_label(anchors.withColumn("windows", empty)), same_label, total), positives, "anchor_row")
    first = stored(first.filter("score >= 0").select("anchor_row", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def other_label(lists: Lists, anchor: dict) -> Iterator:
        return lists.search(anchor["v"], negatives, [(w["low"], w["high"]) for w in anchor["windows"]], lists.labels != anchor["label"])

    window = F.struct("rank", F.expr(f"({low} * positive_score + 99) div 100").alias("low"), F.expr(f"({high} * positive_score) div 100").alias("high"))
    asked = first.groupBy(F.col("anchor_row").alias("row")).agg(F.array_sort(F.collect_list(window)).alias("ranked"))
    asked = anchors.join(asked, "row").withColumn("windows", F.transform("ranked", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high")))).withColumn("ranks", F.transform("ranked", lambda w: w["rank"]))
    everyone = lambda df: df.withColumn("blocks", F.lit(total)).withColumn("part", F.lit(0).cast("long"))
    found = _best(meet(everyone(rows), everyone(asked), other_label, total), negatives, "anchor_row", "place")
    # Positives are ranked without gaps from 1, so the place of a window is its positive's rank less 1.
    named = found.select(F.col("anchor_row"), (F.col("place") + 1).cast("int").alias("p"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = named.join(first.withColumnRenamed("rank", "p"), ["anchor_row", "p"]).join(anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def quantised(vectors: DataFrame, vector_col: str = "embedding", scale: int = 256, into: str = "vector") -> DataFrame:
    """vectors + into: floor(scale * x) of each component, null where a component is null or not finite or the vector is null."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.withColumn(into, F.when(fine, F.transform(v, lambda x: F.floor(scale * x))))


def op11(spark, sf_dir) -> DataFrame:
    """Hard negatives of every row whose id is divisible by 100; the label of each seventh id is a wrong one."""
    rows = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(rows.withColumn("label", label).filter("vector is not null"), F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))


OP11_SQL = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM valid a, valid b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
