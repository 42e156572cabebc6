"""Readers and writers of the steps' text formats, on Spark's text source (gzip included).

Lines of a file are put in order by the place of their split in the file and their place in the split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import insertions, ordered


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_no (rising, with gaps), value."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("k"), "value")
    return raw.select("file", F.struct("at", "k").alias("line_no"), "value")


def _nth(df: DataFrame, into: str) -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy("file").orderBy("line_no")) - 1)


def stem(file: Column) -> Column:
    """File name without folder and .txt.gz, .gz or .txt."""
    return F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"(\.txt)?(\.gz)?$", "")


def read_discoveries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Discovery files -> found insertions as the combine step takes them: file, order, contig, left, right, kind, clips, aligned parts, mates.

    Four lines make a record, consecutive records with one name an insertion; of a field that repeats the last counts,
    mates are listed. A poly-A place is null.
    """
    rows = _nth(lines(spark, path), "n").withColumn("rec", F.floor(F.col("n") / 4)).withColumn("k", F.col("n") % 4)
    recs = rows.groupBy("file", "rec").agg(*(F.max(F.when(F.col("k") == i, F.col("value"))).alias(c) for i, c in ((0, "title"), (1, "seq"), (3, "qual"))))
    part = lambda i: F.regexp_extract("title", r"^@([^:]*):(.*?)-([^:]*):([^:]*):(.*)$", i)
    recs = recs.select("file", "rec", part(1).alias("contig"), part(2).alias("l"), part(3).alias("r"), part(4).alias("side"), part(5).alias("field"), S.quality_seq(F.col("seq"), S.unphred(F.col("qual"))).alias("q"))
    runs = ordered.run_numbers(recs, ["file"], "rec", F.struct("contig", "l", "r"), "order")
    last = lambda side, field: F.max_by("q", F.when((F.col("side") == side) & (F.col("field") == field), F.col("rec")))
    mates = lambda side: F.transform(F.array_sort(F.collect_list(F.when((F.col("side") == side) & F.col("field").startswith("MATE"), F.struct("rec", "q")))), lambda x: x["q"])
    out = runs.groupBy("file", "order", "contig", "l", "r").agg(
        *(last(s, f).alias(n) for n, s, f in (("lc", "LEFT", "CLIPPED"), ("la", "LEFT", "ALIGNED"), ("rc", "RIGHT", "CLIPPED"), ("ra", "RIGHT", "ALIGNED"), ("lp", "LEFT", "CLIPPED_POLYA"), ("rp", "RIGHT", "CLIPPED_POLYA"))),
        *(F.max(F.when(F.col("side") == s, 1)).alias(f"has_{s}") for s in ("LEFT", "RIGHT")),
        mates("LEFT").alias("left_mates"), mates("RIGHT").alias("right_mates"),
    )
    left, right = F.col("l").try_cast("long"), F.col("r").try_cast("long")
    kind = F.when(left.isNull(), insertions.LEFT_POLYA).when(right.isNull(), insertions.RIGHT_POLYA).otherwise(insertions.FULL)
    return out.select(
        "file", "order", "contig", left.alias("left"), right.alias("right"), kind.alias("kind"),
        F.coalesce(S.q_revcomp(F.col("lc")), S.q_revcomp(F.col("lp"))).alias("left_clipped"), F.col("la").alias("left_aligned"),
        F.coalesce("rc", "rp").alias("right_clipped"), S.q_revcomp(F.col("ra")).alias("right_aligned"), "left_mates", "right_mates",
    )


def discovery_records(found: DataFrame, *keep: str | Column) -> DataFrame:
    """Discovered insertions -> what keep names, and value: the records of each, in the written orientation, as one text."""
    name = F.concat(F.col("contig"), F.lit(":"), F.coalesce(F.col("left").cast("string"), F.concat(F.lit("polyA_"), F.col("left_bp"))), F.lit("-"), F.coalesce(F.col("right").cast("string"), F.concat(F.lit("polyA_"), F.col("right_bp"))))
    rec = lambda s, field, q: F.when(q.isNotNull(), S.fastq(F.concat(name, F.lit(f":{s}:{field}")), q)).otherwise("")
    col = F.col
    mates = lambda x, s: F.array_join(F.transform(F.coalesce(x, F.array().cast("array<struct<seq:string,qual:array<int>>>")), lambda m, i: S.fastq(F.concat(name, F.lit(f":{s}:MATE"), i), S.q_revcomp(m))), "")
    left_polya, right_polya = col("left").isNull(), col("right").isNull()
    text = F.concat(
        F.when(left_polya, rec("LEFT", "CLIPPED_POLYA", S.q_revcomp(col("left_clipped")))).otherwise(F.concat(rec("LEFT", "CLIPPED", S.q_revcomp(col("left_clipped"))), rec("LEFT", "ALIGNED", col("left_aligned")), mates(col("left_mates"), "LEFT"))),
        F.when(right_polya, rec("RIGHT", "CLIPPED_POLYA", col("right_clipped"))).otherwise(F.concat(rec("RIGHT", "ALIGNED", S.q_revcomp(col("right_aligned"))), rec("RIGHT", "CLIPPED", col("right_clipped")), mates(col("right_mates"), "RIGHT"))),
    )
    return found.select(*keep, F.rtrim(text, F.lit("\n")).alias("value"))


def consensus_records(found: DataFrame, clipped_only: bool = False) -> DataFrame:
    """value: consensus of each side as name:L and name:R, clips in lower case; poly-A sides are left out."""
    part = lambda s: F.col(f"{'left' if s == 'L' else 'right'}_clipped") if clipped_only else S.consensus_text(F.col(f"{'left' if s == 'L' else 'right'}_clipped"), F.col(f"{'left' if s == 'L' else 'right'}_aligned"), s)
    rec = lambda s, there: F.when(there, S.fastq(F.concat(F.col("name"), F.lit(f":{s}")), part(s))).otherwise("")
    return found.select(F.rtrim(F.concat(rec("L", F.col("kind") != insertions.LEFT_POLYA), rec("R", F.col("kind") != insertions.RIGHT_POLYA)), F.lit("\n")).alias("value"))


def target_records(targets: DataFrame) -> DataFrame:
    """Targets -> value: the genotyping file's record of each."""
    side = lambda s, alt, ref: F.when(F.col(alt).isNotNull(), F.concat(F.lit(f"\n@{s}_INSERTION\n"), alt, F.lit(f"\n@{s}_REFERENCE\n"), ref)).otherwise("")
    return targets.select(F.concat(F.lit(">"), F.col("name"), side("RIGHT", "r_alt", "r_ref"), side("LEFT", "l_alt", "l_ref")).alias("value"))


def write_text(df: DataFrame, path: str) -> None:
    df.write.text(path, compression="gzip")


def read_targets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Genotyping files: name, contig, l, r, r_alt, r_ref, l_alt, l_ref."""
    recs = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^>|\s+$", "").alias("v")).filter("v <> ''")
    field = lambda key: F.nullif(F.regexp_extract("v", f"@{key}\\n([^\\n]*)", 1), F.lit(""))
    name = F.regexp_extract("v", "^([^\n]*)", 1)
    p = S.parse_name(name)
    return recs.select(name.alias("name"), p["contig"].alias("contig"), p["left"].alias("l"), p["right"].alias("r"), field("RIGHT_INSERTION").alias("r_alt"), field("RIGHT_REFERENCE").alias("r_ref"), field("LEFT_INSERTION").alias("l_alt"), field("LEFT_REFERENCE").alias("l_ref"))


def read_calls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Call files -> sample (the file's stem), insertion, genotype, score_genotype, score_alternative; the last of equal names counts."""
    rows = lines(spark, path).withColumn("f", F.split("value", "\t")).filter((F.trim("value") != "") & (F.col("f")[0] != "insertion"))
    last = rows.groupBy(stem(F.col("file")).alias("sample"), F.col("f")[0].alias("insertion")).agg(F.max_by("f", "line_no").alias("f"))
    return last.select("sample", "insertion", F.col("f")[1].alias("genotype"), F.col("f")[2].cast("long").alias("score_genotype"), F.col("f")[3].cast("long").alias("score_alternative"))


#: First line of a call file.
CALL_HEADER = "insertion\tgenotype\tscore_genotype\tscore_alternative"


def call_lines(calls: DataFrame) -> DataFrame:
    """Calls -> sample, insertion, value: the line of each in its sample's file."""
    return calls.select("sample", "insertion", F.concat_ws("\t", "insertion", "genotype", "score_genotype", "score_alternative").alias("value"))


def write_calls(calls: DataFrame, path: str, *order: str) -> None:
    calls.orderBy(*order).select("insertion", "genotype", "score_genotype", "score_alternative").write.csv(path, sep="\t", header=True, compression="gzip")


def write_matrix(matrix: DataFrame, path: str) -> None:
    matrix.write.csv(path, sep=";", header=True, nullValue="")


def read_legacy(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Older combined files: file, name, section, value for each line below an @ marker of a > record."""
    rows = lines(spark, path).filter(F.trim("value") != "")
    v = F.col("value")
    rows = ordered.forward_fill(rows, ["file"], "line_no", F.when(v.startswith(">"), F.substr(v, F.lit(2))), "name")
    # A record's own markers only: the record's start ends the section before.
    rows = ordered.forward_fill(rows, ["file"], "line_no", F.when(v.startswith("@"), F.substr(v, F.lit(2))).when(v.startswith(">"), ""), "section")
    return rows.filter(~v.startswith(">") & ~v.startswith("@") & (F.col("section") != "")).select("file", "line_no", "name", "section", "value")


def patient_counts(legacy: DataFrame) -> DataFrame:
    """name, patient (first seven characters of the listed file), n_found; the last insertion of a file counts too."""
    file = F.element_at(F.split("value", "/"), -1)
    return legacy.filter("section = 'FILES'").groupBy("name", F.substring(file, 1, 7).alias("patient")).agg(F.count("*").alias("n_found"))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Repeat-family hits: model, insertion, side, score, line_no; comments and empty lines are skipped."""
    rows = lines(spark, path).withColumn("v", F.trim("value")).filter("v <> '' and not startswith(v, '#')").withColumn("f", F.split("v", " +"))
    query = F.col("f")[2]
    return rows.select(F.col("f")[0].alias("model"), F.expr("left(f[2], length(f[2]) - 2)").alias("insertion"), F.right(query, F.lit(1)).alias("side"), F.col("f")[3].cast("double").alias("score"), "line_no")


def read_models(spark: SparkSession, path: str, species: str) -> DataFrame:
    """value: records of a model library, each with its end line, that name the species; an unfinished last record is left out."""
    recs = spark.read.text(path, lineSep="//\n").filter(F.col("value").contains(f"TaxName:{species}"))
    return recs.filter(F.col("value").contains("\n")).select(F.concat("value", F.lit("//\n")).alias("value"))


def write_models(models: DataFrame, path: str) -> None:
    models.select(F.regexp_replace("value", r"\n$", "").alias("value")).write.text(path)


def read_loci(spark: SparkSession, path: str) -> DataFrame:
    """Lists of contig:right-left: contig, left, right."""
    part = lambda k: F.regexp_extract("value", r"^([^:]+):(\d+)-(\d+)", k)
    return spark.read.text(path).filter(part(1) != "").select(part(1).alias("contig"), part(3).cast("long").alias("left"), part(2).cast("long").alias("right"))


def read_job_stats(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of key: value lines that start with Job ID -> job, state, cpu, mem."""
    rows = lines(spark, path).select("file", "line_no", F.regexp_extract("value", r"^([^:]+): *(.*)$", 1).alias("k"), F.trim(F.regexp_extract("value", r"^([^:]+): *(.*)$", 2)).alias("v")).filter("k <> ''")
    rows = ordered.forward_fill(rows, ["file"], "line_no", F.when(F.col("k") == "Job ID", F.col("v")), "job").filter("job is not null")
    keep = (("State", "state"), ("CPU Utilized", "cpu"), ("Memory Utilized", "mem"))
    return rows.groupBy("job").agg(*(F.max(F.when(F.col("k") == k, F.col("v"))).alias(c) for k, c in keep))
