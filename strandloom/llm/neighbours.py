"""Approximate nearest neighbours by collision counting over single projections (query-aware hashing).

The largest inner product is turned into the least distance on a sphere: vectors are dealt into bands of norms within a
factor of two, each gets one more component, sqrt(M^2 - |x|^2), M the band's largest norm, and a query is stretched to
length M. Every vector is indexed, in blocks of bounded size; a block keeps the sorted array of each random projection
and every vector's rank in it. A query opens a window around its own projection in each array. Windows grow with the
distance that is looked for (virtual rehashing): it doubles until k vectors are found, and the distance of the k-th
best is the last one. Vectors that fall into enough of the windows are verified by inner products, and the best of all
blocks are kept.

A vector no farther than the distance looked for falls into a window with probability 0.68 or more, and into COLLISIONS
of the PROJECTIONS windows with probability 0.97 or more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare

PROJECTIONS = 64
#: Windows that must hold a vector before it is a candidate.
COLLISIONS = 37
#: First distance that is looked for, on a sphere of radius 1.
FIRST = 0.25
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048


def _normals(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim + 1, PROJECTIONS))


class Block:
    """Sorted projections of up to some thousand vectors, in order of their ids."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        norms = np.sqrt((x * x).sum(axis=1))
        self.ids, self.x, self.near = ids, x, x.astype(np.float32)
        self.largest = max(norms.max() * (1 + 1e-9), 1e-300)
        self.a = _normals(x.shape[1])
        at = (x @ self.a[:-1] + np.sqrt(np.maximum(0.0, self.largest**2 - norms**2))[:, None] * self.a[-1]) / self.largest
        order = np.argsort(at.T, axis=1, kind="stable")
        self.values = np.take_along_axis(at.T, order, axis=1)
        self.rank = np.empty(order.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.rank, order, np.arange(len(ids), dtype=self.rank.dtype)[None, :], axis=1)

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[list, list, list]:
        """(query ids, vector ids, inner products) of up to k nearest for each query, itself left out."""
        n, size = len(self.ids), np.maximum(np.sqrt((q * q).sum(axis=1)), 1e-300)
        at = (q / size[:, None]) @ self.a[:-1]
        radius = np.full(len(q), FIRST)
        score = [np.full(n, -np.inf, np.float32) for _ in q]
        open_ = np.arange(len(q))
        while len(open_):
            lo = np.stack([np.searchsorted(v, at[open_, j] - radius[open_], "left") for j, v in enumerate(self.values)], axis=1)
            hi = np.stack([np.searchsorted(v, at[open_, j] + radius[open_], "right") for j, v in enumerate(self.values)], axis=1)
            for i, low, width in zip(open_, lo.astype(self.rank.dtype), hi - lo, strict=True):
                # Ranks below the window wrap around to large numbers.
                inside = (self.rank - low[:, None]) < np.minimum(width, np.iinfo(self.rank.dtype).max).astype(self.rank.dtype)[:, None]
                counts = np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)
                new = np.flatnonzero((counts >= COLLISIONS) & (score[i] == -np.inf) & (self.ids != query_ids[i]))
                score[i][new] = self.near[new] @ q[i].astype(np.float32)
                found = score[i][score[i] > -np.inf]
                far = np.inf
                if len(found) >= k:
                    kth = np.partition(found, len(found) - k)[len(found) - k]
                    # A little farther than the k-th best, for the rounding of single precision.
                    far = np.sqrt(max(0.0, 2 - 2 * float(kth) / (self.largest * size[i]))) + 1e-3
                done = far <= radius[i] or (width == n).all()
                radius[i] = 0 if done else min(far, 2 * radius[i])
            open_ = open_[radius[open_] > 0]
        return self._best(query_ids, q, score, k)

    def _best(self, query_ids: np.ndarray, q: np.ndarray, score: list[np.ndarray], k: int) -> tuple[list, list, list]:
        out: tuple[list, list, list] = ([], [], [])
        for i, qid in enumerate(query_ids):
            found = np.flatnonzero(score[i] > -np.inf)
            if len(found) > k:
                least = np.partition(score[i][found], len(found) - k)[len(found) - k]
                slack = 1e-5 * self.largest * np.sqrt(q[i] @ q[i])
                found = found[score[i][found] >= least - slack]
            exact = (self.x[found] * q[i]).sum(axis=1)
            best = np.lexsort((self.ids[found], -exact))[:k]
            for column, values in zip(out, (np.full(len(best), qid), self.ids[found][best], exact[best]), strict=True):
                column.append(values)
        return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each query, itself left out.

    Vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows with a null id.
    Vectors are compared with those of their own length alone. Equal scores go by the smaller id; repeated rows are
    repeated results. An empty table gives no rows. The blocks of vectors and of queries are dealt by a hash of the id,
    so copies of one vector spread over the blocks. Every block of queries meets every block of vectors.
    """
    spark = vectors.sparkSession
    prepare(spark)
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def valid(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        kept = df.filter(F.col(id_col).isNotNull() & F.forall(v, good) & F.exists(v, lambda x: x != 0))
        return kept.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))

    # A band holds norms within a factor of two.
    band = F.coalesce(F.floor(F.log2(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))), F.lit(-1100)).cast("int")
    data, asked = valid(vectors).withColumn("dim", F.size("v")).withColumn("band", band), valid(queries).withColumn("dim", F.size("v"))
    # A row for each length and band: there are no more bands than exponents.
    blocks = F.broadcast(data.groupBy("dim", "band").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")))
    n_asked = F.broadcast(asked.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("rounds")))
    each = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    dealt = lambda m: F.pmod(F.xxhash64("id"), F.col(m)).cast("int")
    left = data.join(blocks, ["dim", "band"]).join(n_asked, "dim").select("id", "v", "dim", "band", dealt("blocks").alias("b"), each("rounds").alias("r"))
    right = asked.join(n_asked, "dim").join(blocks, "dim").withColumn("r", dealt("rounds")).select("id", "v", F.col("dim").alias("q_dim"), F.col("band").alias("q_band"), each("blocks").alias("q_b"), F.col("r").alias("q_r"))

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t.column("id").to_numpy()
        flat = t.column("v").combine_chunks().flatten().to_numpy()
        by_id = np.argsort(ids, kind="stable")
        return ids[by_id], flat.reshape(len(ids), -1)[by_id]

    kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def work(_key, vs: pa.Table, qs: pa.Table) -> pa.Table:
        if not vs.num_rows or not qs.num_rows:
            return kinds.empty_table()
        (ids, x), (query_ids, q) = matrix(vs), matrix(qs)
        block, parts = Block(ids, x), []
        for at in range(0, len(q), 256):
            cols = block.search(query_ids[at : at + 256], q[at : at + 256], k)
            parts.append(pa.table([pa.array(np.concatenate(c)) for c in cols], schema=kinds))
        return pa.concat_tables(parts)

    found = left.groupBy("dim", "band", "b", "r").cogroup(right.groupBy("q_dim", "q_band", "q_b", "q_r")).applyInArrow(work, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9(spark, sf_dir) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))
