"""Document fingerprints: quartile codes of hashed byte triplets, with the length, compared by a bounded score.

Three triplets of each four-byte window are hashed into 128 buckets. A bucket's code (0 to 3) is the number of the
text's bucket quartiles that its count exceeds. The fingerprint is hex: two digits of logarithmic length, then two bits
a bucket. The difference adds 1, 2 or 6 for codes 1, 2 or 3 apart and one for each step of length up to 24; likeness
is 1 - difference / BOUND, 0 at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, prepare, shuffle_partitions

BUCKETS = 128
BOUND = 200.0
_LENGTH_STEPS = 24
_STEP = np.array([0, 1, 2, 6])


def _byte_table(salt: int) -> np.ndarray:
    return np.random.default_rng(salt).permutation(256).astype(np.uint8)


_A, _B, _C = (_byte_table(s) for s in (101, 102, 103))
#: (places of the three bytes, salt) of each triplet in a window.
TRIPLETS = (((0, 1, 2), 0), ((0, 1, 3), 85), ((0, 2, 3), 170))


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BUCKETS codes, length step of each row)."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    body = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(n), lengths)
    counts = np.zeros(n * BUCKETS, np.int64)
    for (i, j, k), salt in TRIPLETS:
        m = len(body) - k
        if m <= 0:
            continue
        hashed = (_A[body[i : m + i]] ^ _B[body[j : m + j]] ^ _C[body[k:] ^ np.uint8(salt)]) & np.uint8(BUCKETS - 1)
        inside = row[:m] == row[k:]
        counts += np.bincount((row[:m] * BUCKETS + hashed)[inside], minlength=n * BUCKETS)
    counts = counts.reshape(n, BUCKETS)
    ranked = np.sort(counts, axis=1)
    out = sum((counts > ranked[:, [q * BUCKETS // 4 - 1]]).astype(np.uint8) for q in (1, 2, 3))
    return out, np.minimum(255, np.round(np.log(np.maximum(lengths, 1)) / np.log(1.1))).astype(np.int64)


def to_hex(code: np.ndarray, length: np.ndarray) -> list[str]:
    four = code.reshape(len(code), BUCKETS // 4, 4)
    packed = (four[:, :, 0] << 6) | (four[:, :, 1] << 4) | (four[:, :, 2] << 2) | four[:, :, 3]
    return [f"{n:02x}{p.tobytes().hex()}" for n, p in zip(length, packed, strict=True)]


def from_hex(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    packed = np.array([list(bytes.fromhex(p[2:])) for p in prints], np.uint8).reshape(len(prints), BUCKETS // 4)
    return np.stack([(packed >> s) & 3 for s in (6, 4, 2, 0)], axis=2).reshape(len(prints), BUCKETS), np.array([int(p[:2], 16) for p in prints])


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 for each pair of rows; 1 for equal fingerprints."""
    apart = _STEP[np.abs(a[0].astype(np.int8) - b[0].astype(np.int8))].sum(axis=1) + np.minimum(_LENGTH_STEPS, np.abs(a[1] - b[1]))
    return np.maximum(0.0, 1.0 - apart / BOUND)


def fingerprint(df: DataFrame, text_col: str = "text", into: str = "fingerprint") -> DataFrame:
    """df + into: string. Null is taken as empty; equal texts have equal fingerprints; rows are independent."""
    prepare(df.sparkSession)

    @F.pandas_udf("string")
    def printed(texts: pd.Series) -> pd.Series:
        out, raw = [], [(t or "").encode() for t in texts]
        for at in range(0, len(raw), 256):
            out += to_hex(*codes(raw[at : at + 256]))
        return pd.Series(out, dtype=object)

    return df.withColumn(into, printed(text_col))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal rows out by ranges of id_col so that each range is followed by a copy of the next range's first rows.

    Returns id_col, text_col, __range, __guest: a partition holds whole ranges, sorted by range, guest, id (null first)
    and text. A range without rows does not count; the first follows the last. Only one row for each range reaches the
    driver.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(text_col, F.lit("")).alias(text_col))
    cuts = sorted(set(rows.select(id_col).approxQuantile(id_col, [i / (3 * n) for i in range(1, 3 * n)], 0.1 / n)))
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def ranged(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(bounds, ids.fillna(0).astype("int64"), "right")).astype("int32"))

    rows = rows.withColumn("__range", ranged(id_col))
    null_first = F.struct(F.col(id_col).isNotNull().alias("x"), F.col(id_col).alias("i"))
    firsts = sorted((r["__range"], r["i"]["i"]) for r in rows.groupBy("__range").agg(F.min(null_first).alias("i")).collect())
    if not firsts:
        return rows.withColumn("__guest", F.lit(False))
    before = [(i, firsts[k - 1][0]) for k, (_, i) in enumerate(firsts)]
    guests = F.broadcast(spark.createDataFrame(before, f"__first long, __before int"))
    own = F.struct(F.col("__range").alias("r"), F.lit(False).alias("g"))
    also = F.struct(F.col("__before").alias("r"), F.lit(True).alias("g"))
    both = rows.join(guests, rows[id_col].eqNullSafe(guests["__first"]), "left").withColumn("__to", F.explode(F.when(F.col("__before").isNull(), F.array(own)).otherwise(F.array(own, also))))
    dealt = both.select(id_col, text_col, F.col("__to.r").alias("__range"), F.col("__to.g").alias("__guest")).repartition(n, "__range")
    return dealt.sortWithinPartitions("__range", "__guest", F.col(id_col).asc_nulls_first(), text_col)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held = None  # the row whose next one is still to come

    def out(rows, nexts):
        edited = []
        for (_, t), (_, follow) in zip(rows, nexts, strict=True):
            k = len(t) // 4
            edited.append((t[: len(t) - k] + follow[:k]).encode())
        mine, theirs, after = codes([t.encode() for _, t in rows]), codes(edited), codes([t.encode() for _, t in nexts])
        cols = [[i for i, _ in rows], [len(t) for _, t in rows], [hashlib.sha256(e).hexdigest() for e in edited], to_hex(*mine), to_hex(*theirs), likeness(mine, theirs), likeness(mine, after)]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    for batch in pieces(batches, limit=1 << 19):
        rows, nexts = [], []
        for i, t, r, g in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "__range", "__guest")), strict=True):
            if held and held[2] == r:
                rows.append(held[:2])
                nexts.append((i, t))
            held = None if g else (i, t, r)
        if rows:
            yield out(rows, nexts)


def op10(spark, sf_dir) -> DataFrame:
    """Fingerprints of every document and of its text with the last quarter taken from the next document.

    Rows are in order of doc_id, null first, then text; a single row is its own next one.
    """
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_next(docs).mapInArrow(_edited, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
