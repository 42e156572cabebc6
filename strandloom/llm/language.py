"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram is bound by multiplying the vectors of its letters, the first
rotated twice and the second once. A text is the bundle (sum) of its trigrams, a language the bundle of its texts, each
scaled to length one. The mean of the prototypes, which all languages share, is taken off before cosines are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, prepare

DIMENSIONS = 512
SYMBOLS = 64
#: Entries of a table of texts by trigrams that is made at a time.
ENTRIES = 4_000_000
#: Bundles are summed as whole numbers of this part, so that sums do not depend on their order.
PART = 1 << 20
_TABLES: dict[str, np.ndarray] = {}


def _symbols() -> np.ndarray:
    """Code point -> symbol: 0 is no letter, a to z have their own, other letters share the rest."""
    if "symbols" not in _TABLES:
        points = np.arange(0x110000)
        letter = np.array([chr(c).isalpha() for c in range(0x110000)])
        other = 27 + (points * 2654435761 % (1 << 32) >> 12) % (SYMBOLS - 27)
        out = np.where(letter, other, 0).astype(np.uint8)
        out[97:123] = np.arange(1, 27)
        _TABLES["symbols"] = out
    return _TABLES["symbols"]


def _letters() -> np.ndarray:
    if "letters" not in _TABLES:
        _TABLES["letters"] = (np.random.default_rng(64).integers(0, 2, (SYMBOLS, DIMENSIONS)) * 2 - 1).astype(np.float32)
    return _TABLES["letters"]


def _bundle(gram: np.ndarray, row: np.ndarray, first: int, out: np.ndarray) -> None:
    """Add up the bound vectors of the trigrams of each row (ascending, from first on), half of the rows at a time if the table would be large."""
    used, place = np.unique(gram, return_inverse=True)
    if len(out) > 1 and len(out) * len(used) > ENTRIES:
        half = len(out) // 2
        cut = np.searchsorted(row, first + half)
        _bundle(gram[:cut], row[:cut], first, out[:half])
        _bundle(gram[cut:], row[cut:], first + half, out[half:])
        return
    counts = np.bincount((row - first) * max(1, len(used)) + place, minlength=len(out) * len(used)).reshape(len(out), len(used)).astype(np.float32)
    v = _letters()
    for at in range(0, len(used), 4096):
        g = used[at : at + 4096]
        bound = np.roll(v, 2, axis=1)[g // SYMBOLS**2] * np.roll(v, 1, axis=1)[g // SYMBOLS % SYMBOLS] * v[g % SYMBOLS]
        out += counts[:, at : at + 4096] @ bound


def profiles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bundle of length one for each text, whether it has a letter); a text without letters has a zero bundle."""
    cleaned = [f" {(t or '').lower()} " for t in texts]
    lengths = np.array([len(t) for t in cleaned])
    points = np.frombuffer("".join(cleaned).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = _symbols()[points].astype(np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    has = np.bincount(row, symbol > 0, minlength=len(texts)) > 0
    # Runs of other characters count as one space.
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] > 0) | (symbol[:-1] > 0) | (row[1:] != row[:-1])
    symbol, row = symbol[keep], row[keep]
    gram = (symbol[:-2] * SYMBOLS + symbol[1:-1]) * SYMBOLS + symbol[2:]
    inside = row[:-2] == row[2:]
    gram, row = gram[inside], row[:-2][inside]
    bundle = np.zeros((len(texts), DIMENSIONS), np.float32)
    _bundle(gram, row, 0, bundle)
    norm = np.sqrt((bundle * bundle).sum(axis=1, keepdims=True))
    return np.where(has[:, None], bundle / np.maximum(norm, 1e-12), 0.0), has


def _lang_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in pieces(batches):
        bundle, _ = profiles(batch.column("text").to_pylist())
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in set(langs):
            sums[lang] = sums.get(lang, 0) + np.rint(bundle[langs == lang].astype(np.float64) * PART).astype(np.int64).sum(axis=0)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], ["lang", "parts"])


def learn(df: DataFrame) -> dict[str, list[float]]:
    """(text, lang) -> prototype of each non-null lang, from all rows. What returns is DIMENSIONS numbers for each language."""
    prepare(df.sparkSession)
    sums = df.filter("lang is not null and text is not null").select("text", "lang").mapInArrow(_lang_sums, "lang string, parts array<long>")
    rows = sums.select("lang", F.posexplode("parts").alias("at", "part")).groupBy("lang", "at").agg(F.sum("part").alias("part")).collect()
    out = {r.lang: [0.0] * DIMENSIONS for r in rows}
    for r in rows:
        out[r.lang][r.at] = r.part / PART
    return {lang: v for lang, v in sorted(out.items()) if any(v)}


def identify(df: DataFrame, prototypes: dict[str, list[float]], text_col: str = "text") -> DataFrame:
    """df without text_col + lang_pred string, score double (0 to 1). No letter, null or no prototypes: und, 0. Ties: first by name.

    Rows are independent: repeated rows get equal predictions, an empty table gives no rows. Columns of df that are
    named lang_pred or score are replaced.
    """
    prepare(df.sparkSession)
    langs = list(prototypes)
    if langs:
        base = np.array([prototypes[x] for x in langs])
        base /= np.sqrt((base * base).sum(axis=1, keepdims=True))
        shared = base.mean(axis=0) if len(langs) > 1 else np.zeros(DIMENSIONS)
        centred = base - shared
        centred /= np.maximum(np.sqrt((centred * centred).sum(axis=1, keepdims=True)), 1e-12)
    keep = [c for c in df.columns if c not in (text_col, "lang_pred", "score")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            bundle, has = profiles(batch.column(text_col).to_pylist())
            pred, score = np.full(len(has), "und", object), np.zeros(len(has))
            if langs:
                own = bundle - shared * (bundle @ shared)[:, None] / max(shared @ shared, 1e-12)
                cosine = own @ centred.T / np.maximum(np.sqrt((own * own).sum(axis=1, keepdims=True)), 1e-12)
                best = cosine.argmax(axis=1)
                pred[has] = np.array(langs, object)[best][has]
                score[has] = np.clip((1 + cosine.max(axis=1)) / 2, 0, 1)[has]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(pred, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    from pyspark.sql import types as T

    return df.mapInArrow(work, T.StructType([*(df.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op6(spark, sf_dir) -> DataFrame:
    """The language of every document, learnt from those whose crc32(doc_id) mod 3 is not 1. A null doc_id is not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)))
    return identify(docs.drop("lang"), learn(docs.filter("not held_out"))).select("doc_id", "held_out", "lang_pred", "score")
