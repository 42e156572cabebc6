"""Genotype calls from scored reads, and filters and layout of the genotype matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MOUSE, Config
from ..functions import sequence as S

# Names of the calls.
ARTEFACT, WILD_TYPE, HETEROZYGOUS, HOMOZYGOUS = "artefact", "wild-type", "heterozygous", "homozygous"


def evidence_read(flag: Column, mapq: Column, config: Config = MOUSE) -> Column:
    """Reads that may vote: well mapped, primary and passed. Duplicates do vote."""
    return (mapq >= config.evidence_mapq) & ~S.has_flag(flag, S.SECONDARY) & ~S.has_flag(flag, S.UNMAPPED) & ~S.has_flag(flag, S.QCFAIL)


def side_scores(side: str, seq: Column, qual: Column, cigar: Column, start: Column, end: Column, pos: Column, ref: Column, alt: Column, config: Config = MOUSE) -> Column:
    """allele_scores of the read's part before the left (or after the right) breakpoint; zero if the read does not reach it."""
    q = S.quality_seq(seq, qual)
    zero = F.struct(*(F.lit(0.0).alias(c) for c in ("q_ref", "q_alt", "q_art")))
    if side == "L":
        offset = S.query_offset(cigar, start, pos)
        part, direction = S.q_slice(q, 0, F.coalesce(offset, F.length(seq))), S.RIGHT_TO_LEFT
    else:
        offset = S.query_offset(cigar, start, pos - 1) + 1
        part, direction = S.q_slice(q, F.coalesce(offset, F.lit(0))), S.LEFT_TO_RIGHT
    reached = (start <= pos) & (pos <= end)
    if config.strict_offset:
        reached = reached & offset.isNotNull()
    return F.when(reached, S.allele_scores(part["seq"], part["qual"], ref, alt, direction)).otherwise(zero)


def votes(left: Column, right: Column, config: Config = MOUSE) -> Column:
    """struct<q_ref, q_alt, q_art, q_hom> that one read adds; left and right are its side scores."""
    (lr, la, lx), (rr, ra, rx) = ([s[c] for c in ("q_ref", "q_alt", "q_art")] for s in (left, right))
    zero = F.lit(0.0)

    def add(ref=zero, alt=zero, art=zero, hom=zero):
        return F.struct(ref.alias("q_ref"), alt.alias("q_alt"), art.alias("q_art"), hom.alias("q_hom"))

    left_ref, right_ref = (lr >= la) & (lr > 0), (rr >= ra) & (rr > 0)
    taken = ra if config.double_reference_uses_alt else la
    return (
        F.when(F.greatest(lr, la) <= lx, add(art=lx - F.greatest(lr, la)))
        .when(F.greatest(rr, ra) <= rx, add(art=rx - F.greatest(rr, ra)))
        .when(right_ref & left_ref, add(ref=rr - ra + lr - taken, hom=F.lit(-1.0)))
        .when(right_ref & (la > 0), add(ref=rr - ra, alt=la - lr))
        .when(right_ref, add())
        .when((ra > 0) & left_ref, add(ref=lr - la, alt=ra - rr))
        .when((ra > 0) & (la > 0), add(art=la - lr + ra - rr))
        .otherwise(add())
    )


def call_genotypes(reads: DataFrame, keys: list[str], left: str = "left", right: str = "right", config: Config = MOUSE) -> DataFrame:
    """keys, genotype, score_genotype, score_alternative from scored reads. Sums are combined before the one shuffle."""
    v = reads.select(*keys, votes(F.col(left), F.col(right), config).alias("__v"))
    sums = v.groupBy(*keys).agg(*(F.sum(f"__v.{c}").alias(c) for c in ("q_ref", "q_alt", "q_art", "q_hom")))
    ref, alt, art = F.col("q_ref"), F.col("q_alt"), F.col("q_art")
    top = F.greatest(ref, alt)
    made = lambda name, score, other: F.struct(F.lit(name).alias("g"), score.alias("s"), other.alias("a"))
    call = (
        F.when(art >= top, made(ARTEFACT, art, top))
        .when((alt > art) & (F.col("q_hom") < 0), F.when(ref >= art, made(HETEROZYGOUS, alt, ref)).otherwise(made(ARTEFACT, art, top)))
        .when(alt > art, F.when(alt >= ref, made(HOMOZYGOUS, alt, ref)).otherwise(made(HETEROZYGOUS, alt, ref)))
        .otherwise(made(WILD_TYPE, ref, alt))
    )
    return sums.select(*keys, call.alias("__c")).select(*keys, F.col("__c.g").alias("genotype"), F.col("__c.s").cast("long").alias("score_genotype"), F.col("__c.a").cast("long").alias("score_alternative"))


def complete_calls(targets: DataFrame, calls: DataFrame, crowded: DataFrame, keys: list[str]) -> DataFrame:
    """Calls of all targets: crowded ones are artefacts, those without reads wild types, both with scores of 0."""
    full = targets.select(*keys).join(calls, keys, "left").join(crowded.select(*keys).withColumn("__crowded", F.lit(True)), keys, "left")
    named = F.when(F.col("__crowded"), F.lit(ARTEFACT)).otherwise(F.coalesce("genotype", F.lit(WILD_TYPE)))
    score = lambda c: F.when(F.col("__crowded"), 0).otherwise(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return full.select(*keys, named.alias("genotype"), score("score_genotype"), score("score_alternative"))


def matrix_checks(calls: DataFrame, n_samples: Column | int, config: Config = MOUSE) -> DataFrame:
    """insertion + one boolean for each reason to drop it. calls: sample, insertion, genotype, score_genotype in long form."""
    g, score = F.col("genotype"), F.col("score_genotype")
    ins = g.isin(HETEROZYGOUS, HOMOZYGOUS)
    counts = calls.groupBy("insertion").agg(
        F.count_if(g == WILD_TYPE).alias("n_wt"),
        F.count_if(ins).alias("n_ins"),
        F.count_if(g == ARTEFACT).alias("n_art"),
        F.count_if(g == "insertion?").alias("n_ins_unsure"),
        F.count_if(g == "wild-type?").alias("n_wt_unsure"),
        F.count_if(g.isNotNull()).alias("n_called"),
        F.max(F.when(g == WILD_TYPE, score)).alias("best_wt"),
        F.max(F.when(ins, score)).alias("best_ins"),
    )
    c = {k: F.col(k) for k in counts.columns}
    low = lambda x: F.coalesce(x < config.min_best_score, F.lit(False))
    return counts.select(
        "insertion",
        (c["n_wt"] < config.min_wild_types).alias("few_wild_types"),
        (c["n_ins"] < config.min_insertions).alias("few_insertions"),
        (c["n_art"] > config.max_artefact).alias("many_artefacts"),
        ((F.lit(n_samples) if isinstance(n_samples, int) else n_samples) - c["n_called"] > config.max_na).alias("many_missing"),
        (c["n_ins_unsure"] + c["n_wt_unsure"] > c["n_wt"] + c["n_ins"]).alias("half_unsure"),
        (c["n_ins_unsure"] > c["n_ins"] + 1).alias("insertions_unsure"),
        low(c["best_wt"]).alias("low_wild_type"),
        low(c["best_ins"]).alias("low_insertion"),
    )


def kept_insertions(checks: DataFrame) -> DataFrame:
    bad = F.lit(False)
    for c in checks.columns[1:]:
        bad = bad | F.col(c)
    return checks.filter(~bad).select("insertion")


def filter_matrix(calls: DataFrame, n_samples: int | None = None, config: Config = MOUSE) -> DataFrame:
    """The calls of insertions that pass all checks. n_samples: counted if not given (one number, not data)."""
    if n_samples is None:
        n_samples = calls.select("sample").distinct().count()
    return calls.join(kept_insertions(matrix_checks(calls, n_samples, config)), "insertion", "left_semi")


def to_matrix(calls: DataFrame, samples: list[str]) -> DataFrame:
    """One row for each insertion, one column for each sample named."""
    return calls.groupBy("insertion").pivot("sample", samples).agg(F.first("genotype"))
