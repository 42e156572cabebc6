"""From raw documents to a tokenised training mix, in stages that each write a table.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns the rows that the next one gets. All
but the last return the columns of documents. An empty table passes through all stages; null texts are kept as texts
without words; columns beyond those of documents pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import bpe, jaccard_join, mixing, secret_scan, toxicity
from strandloom.llm.common import stored, table, with_places


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on the labelled ones among them, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("row"), "text"), model)
    return scored.filter("predicted = 0").select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the least id, without an id if none has one.

    Rows are told apart by their place in the table, so unlike texts that share an id, or have none, stay both, and of
    repeated rows with words one stays. The place is that in the written file, whatever tasks scan it; docs that are no
    scan of Parquet files are written first.
    """
    rows = with_places(docs, "__row")
    linked = jaccard_join.link_components(rows.select(F.col("__row").alias("doc_id"), "text")).filter("component_id is not null")
    named = rows.select("__row", "doc_id").join(linked.select(F.col("doc_id").alias("__row"), "component_id"), "__row")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    first = named.groupBy("component_id").agg(F.min(order)["__row"].alias("__first"))
    gone = stored(named.join(first, "component_id").filter(F.col("__row") != F.col("__first")).select("__row"), "near-copies")
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret; n_chars follows the text."""
    clean = secret_scan.redact(secret_scan.find_secrets(docs, into="__secrets"), spans_col="__secrets")
    changed = F.size("__secrets") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows that share an id and a source are taken alike."""
    sizes = docs.select("doc_id", "source", mixing.words_in().alias("size"))
    taken = mixing.mix(sizes, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    taken = taken.filter("copies > 0").groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source")).agg(F.max("copies").alias("__copies"))
    both = docs.join(taken, docs["doc_id"].eqNullSafe(F.col("__id")) & docs["source"].eqNullSafe(F.col("__source")))
    return both.select(*docs.columns, F.explode(F.sequence(F.lit(1), "__copies")).alias("__nth")).drop("__nth")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of each row."""
    import public_tokenizers

    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: No SQL can express the trained machine; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
