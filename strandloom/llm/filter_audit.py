"""How filters interact, for every order in which they may run, by wide packed counters.

A document's failed filters are the bits of a mask, and its marks (good, toxic) two bits more. Whatever happens to a
document at any step of any order follows from these bits alone, so each mask stands for one big integer, whose fields
are the outcomes of all steps of all orders: 1 where the outcome applies. The integers are added up for each part, and
the fields of the sum are the counts. A field is as wide as the number of documents in the part needs, so no sum runs
over into the next field. Documents are counted by mask before, so that a part's sum has a term for each mask.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, text_or_empty

FILTERS = "ABCDE"
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
#: Outcomes of a step, in the order of their fields.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def steps(filters: str = FILTERS) -> list[tuple[str, int]]:
    """(order, place of the step from 1) of every step of every order."""
    return [("".join(order), i) for order in permutations(filters) for i in range(1, len(filters) + 1)]


def outcomes(mask: int, order: str, step: int, filters: str = FILTERS) -> tuple[bool, ...]:
    """What happens at a step to a document with this mask, in the order of OUTCOMES."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    fails = mask & ((1 << len(filters)) - 1)
    gone_before = any(fails & bit[f] for f in order[: step - 1])
    here = bool(fails & bit[order[step - 1]])
    removed = here and not gone_before
    good, toxic = mask & (1 << len(filters)), mask & (2 << len(filters))
    return (not gone_before and not here, removed, here and gone_before, fails == bit[order[step - 1]], removed and bool(good), removed and bool(toxic))


def packed(mask: int, width: int, filters: str = FILTERS) -> int:
    """The big integer of a mask: a field of width bits for each outcome of each step, the first one lowest."""
    flags = (flag for order, step in steps(filters) for flag in outcomes(mask, order, step, filters))
    return sum(1 << (i * width) for i, flag in enumerate(flags) if flag)


def unpack(total: int, width: int, n: int) -> list[int]:
    field = (1 << width) - 1
    return [(total >> (i * width)) & field for i in range(n)]


def audit_part(counts: dict[int, int], filters: str = FILTERS) -> Iterator[tuple]:
    """Rows (order, step, outcomes..., shapley) of a part with so many documents of each mask."""
    width = max(1, sum(counts.values()).bit_length())
    total = sum(n * packed(mask, width, filters) for mask, n in counts.items())
    every = steps(filters)
    fields = unpack(total, width, len(every) * len(OUTCOMES))
    rows = [tuple(fields[i * len(OUTCOMES) : (i + 1) * len(OUTCOMES)]) for i in range(len(every))]
    shapley = dict.fromkeys(filters, 0)
    for (order, step), row in zip(every, rows, strict=True):
        shapley[order[step - 1]] += row[OUTCOMES.index("removed")]
    for (order, step), row in zip(every, rows, strict=True):
        yield (order, step, *row, shapley[order[step - 1]])


def audit(masks: DataFrame, part_col: str = "part", mask_col: str = "mask", n_col: str = "n") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from documents' masks.

    masks: rows of part, mask and a number of documents (n_col); rows may repeat. Masks and numbers that are null, and
    numbers below 1, count nothing. Every part with a counted row has all its steps, zeros included; an empty table
    has no rows. A part's group has a row for each mask at most, however many documents it stands for.
    """
    prepare(masks.sparkSession)
    per_part = masks.filter(F.col(mask_col).isNotNull() & (F.col(n_col) > 0)).groupBy(F.col(part_col).alias("part"), F.col(mask_col).cast("int").alias("mask")).agg(F.sum(n_col).alias("n"))

    def work(group: pd.DataFrame) -> pd.DataFrame:
        rows = audit_part(dict(zip(group["mask"].tolist(), group["n"].tolist(), strict=True)))
        out = pd.DataFrame(rows, columns=["filter_order", "step", *OUTCOMES, "shapley"])
        out.insert(0, "part", group["part"].iloc[0])
        return out

    counts = ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    return per_part.groupBy("part").applyInPandas(work, f"part string, filter_order string, step int, {counts}")


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that look at the text alone."""
    trimmed = F.trim(text, F.lit(_SPACE))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    n_words = F.when(trimmed == "", 0).otherwise(F.size(words))
    distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
    n = F.length(text)
    capitals = n - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = (n_words < 200, 100 * distinct < 50 * n_words, F.lit(100).cast("long") * capitals > 3 * n.cast("long"), text.rlike(r"[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def masks_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n) of documents: filters A to E, and the marks of their labels.

    A null text is an empty one, a null lang the part ''. A document fails E if a row with a smaller doc_id, of any
    part, has the same text (compared by length and SHA-256). Rows that share the least doc_id of their text all pass
    E; a row without doc_id passes E and makes no other fail. A doc_id is good or toxic if any of its labels says so.
    Texts stay where they are: what is shuffled is a digest and a mask, added up for each (text, part, doc_id) before,
    so that copies, in whatever number, are few rows by the time that the least doc_id of a text is looked for.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.concat(F.unhex(F.sha2(text, 256)), F.encode(F.octet_length(text).cast("string"), "UTF-8")).alias("content"),
        text_mask(text).alias("mask"),
    )
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg((F.when(F.max(F.col("quality") == 1), GOOD).otherwise(0) + F.when(F.max(F.col("toxic") == 1), TOXIC).otherwise(0)).alias("marks"))
    same = rows.groupBy("doc_id", "part", "content", "mask").agg(F.count("*").alias("n"))
    same = same.join(marks, "doc_id", "left").withColumn("mask", F.col("mask") + F.coalesce("marks", F.lit(0)))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    # Of rows with one doc_id and one text the numbers differ by part and marks alone, which are in the key.
    by_text = same.groupBy("content", "part", "mask").agg(F.sum("n").alias("n"), least.alias("least"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("least.doc_id").over(Window.partitionBy("content"))
    passing = F.col("nameless") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0)
    split = by_text.select("part", "mask", "n", passing.alias("passing"))
    both = F.explode(F.array(F.struct(F.col("mask"), F.col("passing").alias("n")), F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("passing")).alias("n"))))
    return split.select("part", both.alias("x")).select("part", "x.mask", "x.n").filter("n > 0")


def op12(spark, sf_dir) -> DataFrame:
    """The audit of all documents, for each language and each of the 120 orders of five filters."""
    return audit(masks_of(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP12_SQL = r"""
WITH RECURSIVE letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT f AS filter_order FROM letters
  UNION ALL
  SELECT filter_order || f FROM orders, letters WHERE NOT contains(filter_order, f)
),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders WHERE length(filter_order) = 5),
texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
counted AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, min(doc_id) OVER (PARTITION BY text) AS least FROM texts
),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * capitals > 3 * length(text) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM counted LEFT JOIN marks USING (doc_id)
),
kinds AS (SELECT part, good, toxic, fails, count(*) AS n FROM failed GROUP BY ALL),
outcomes AS (
  SELECT part, filter_order, step, good, toxic, n, fails, substr(filter_order, step, 1) AS f, contains(fails, substr(filter_order, step, 1)) AS here,
    step > 1 AND regexp_matches(fails, '[' || substr(filter_order, 1, greatest(step - 1, 1)) || ']') AS before
  FROM kinds CROSS JOIN steps
),
counts AS (
  SELECT part, filter_order, step, f,
    CAST(sum(CASE WHEN NOT here AND NOT before THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN here AND NOT before THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN here AND before THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN here AND NOT before AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN here AND NOT before AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM outcomes GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counts
"""
