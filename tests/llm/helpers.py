"""Small tables for the operators' queries."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def tables(spark, folder, texts, labels=(), langs=None, sources=None, extra=False):
    """texts: a list (ids count up) or pairs of id and text. extra: columns whose names clash with inner ones."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, langs[k] if langs else "en", sources[k] if sources else f"src{k % 3}", len(t) if t is not None else None) for k, (i, t) in enumerate(pairs)]
    docs = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in ("size", "key", "ids", "decoded", "sig", "rank", "label", "score", "shard", "slot", "__part", "part", "n", "secret_spans", "copies", "source_size"):
            docs = docs.withColumn(c, docs["n_chars"])
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), LABELS).write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return str(folder)


ODD = [None, "", " ", "\n\t", "x", "same words here", "same words here", "é" * 300, "word " * 5000, "\U0001f600 smile \U0001f600", "a\x00b", "’s it’s DON'T don't    　x", "z" * 20000]
