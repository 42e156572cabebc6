"""The four batch steps: discover, combine, genotype, collect; each is one chain of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import MOUSE, Config
from ..functions import sequence as S
from ..operators import breakpoints, genotypes, insertions, intervals, ordered, reports, seeds
from ..sources import genomes
from ..staging import staged


def discover(reads: DataFrame, config: Config = MOUSE) -> DataFrame:
    """The discovered insertions alone; see discover_with_outcomes."""
    return discover_with_outcomes(reads, config)[0]


def discover_with_outcomes(reads: DataFrame, config: Config = MOUSE) -> tuple[DataFrame, DataFrame]:
    """Discovered insertions of all samples: sample, contig, left, right, kind, left_/right_ clipped, aligned and mates; and counters.

    The counters are sample, side, outcome, n_clusters, from the one clustering that the insertions come from.

    reads: sample, ordinal, qname, flag, contig, pos, end, mapq, cigar, seq, qual, sa. Breakpoints and mates, far fewer
    than reads, are staged because several joins read them. A breakpoint's number is its first read's place among the
    reads of its sample, with its side: no two clusters of one side share a read.
    """
    found, wanted, ends = breakpoints.merge_clusters(breakpoints.clipped_reads(reads, config), config)
    counts = reports.outcome_counts(ends, ["sample", "side"])
    found = staged(found.withColumn("id", 4 * F.col("first") + F.when(F.col("side") == "L", 0).otherwise(1)), "breakpoints")
    polya = staged(breakpoints.polya_reads(reads, config).withColumn("id", 4 * F.col("ordinal") + 2), "polya-reads")
    claims = wanted.join(found.select(*breakpoints.CLUSTER, "id", "first"), breakpoints.CLUSTER)
    claims = claims.select("sample", F.col("qname").alias("name"), "side", F.col("first").alias("ordinal"), "want_read1", "id")
    claims = claims.unionByName(polya.select("sample", F.col("qname").alias("name"), F.lit("P").alias("side"), "ordinal", (~F.col("is_read1")).alias("want_read1"), "id"))
    claims = claims.select(F.struct("sample", "name").alias("qname"), "side", "ordinal", "want_read1", F.struct("sample", "id").alias("bp"))
    flag = F.col("flag")
    usable = reads.filter(~S.has_flag(flag, S.SECONDARY) & ~S.has_flag(flag, S.QCFAIL) & ~S.has_flag(flag, S.DUPLICATE))
    usable = usable.select(F.struct("sample", F.col("qname").alias("name")).alias("qname"), S.has_flag(flag, S.READ1).alias("is_read1"), "ordinal", "flag", "contig", "pos", "end", "mapq", "seq", "qual")
    mates = insertions.find_mates(claims, usable, ["ordinal", "flag", "contig", "pos", "end", "mapq", "seq", "qual"])
    mates = staged(mates.select("bp.sample", "bp.id", "ordinal", "flag", "contig", "pos", "end", "mapq", S.clean_clip(S.quality_seq(F.col("seq"), F.col("qual")), config).alias("clean")), "mates")
    turned = F.when(S.has_flag(flag, S.REVERSE), S.q_revcomp(F.col("clean"))).otherwise(F.col("clean"))
    by_bp = mates.withColumn("m", turned).groupBy("sample", "id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "m"))).alias("l")).select("sample", "id", F.transform("l", lambda x: x["m"]).alias("mates"))
    last = mates.groupBy("sample", "id").agg(F.max_by(F.struct("flag", "contig", "pos", "end", "mapq"), "ordinal").alias("mate"))
    found = staged(found.join(by_bp, ["sample", "id"], "left"), "with-mates")
    placed = polya.join(last, ["sample", "id"]).withColumn("bp", S.polya_breakpoint(F.col("flag"), F.col("kind"), F.col("mate.flag"), F.col("mate.pos"), F.col("mate.end"), F.col("mate.mapq"), config))
    placed = placed.select("sample", F.col("mate.contig").alias("contig"), "id", "bp", "side", "clipped")
    placed = staged(placed.filter((F.length("contig") <= config.max_contig_name) & F.col("bp").isNotNull()), "placed-tails")
    side = lambda s: found.filter((F.col("side") == s) & (F.length("contig") <= config.max_contig_name))
    cols = ["sample", "contig", "bp", "id"]
    pairs = ordered.pairs_with_rescue(side("L").select(*cols), side("R").select(*cols), placed.select(*cols, "side"), ["sample", "contig"], config)

    def ends(x, s):
        real = side(s).select("sample", "id", F.col("bp").alias(x), "bp", "clipped", "aligned", "mates")
        kinds = {f.name: f.dataType for f in real.schema}
        tails = placed.select("sample", "id", F.lit(None).cast(kinds["bp"]).alias(x), "bp", "clipped", *(F.lit(None).cast(kinds[c]).alias(c) for c in ("aligned", "mates")))
        return real.unionByName(tails).select("sample", F.col("id").alias(f"{x}_id"), x, *(F.col(c).alias(f"{x}_{c}") for c in ("bp", "clipped", "aligned", "mates")))

    kind = F.when(F.col("kind") == "pair", insertions.FULL).when(F.col("kind") == "polya_right", insertions.RIGHT_POLYA).otherwise(insertions.LEFT_POLYA)
    both = pairs.withColumn("kind", kind).join(ends("left", "L"), ["sample", "left_id"]).join(ends("right", "R"), ["sample", "right_id"])
    return staged(both.drop("left_id", "right_id"), "discoveries"), counts


def combine(found: DataFrame, genome: DataFrame, whole_hits: DataFrame | None = None, clip_hits: DataFrame | None = None, chain: DataFrame | None = None, chunk: int = 10_000, config: Config = MOUSE) -> DataFrame:
    """The targets alone; see combine_with_reasons."""
    return combine_with_reasons(found, genome, whole_hits, clip_hits, chain, chunk, config)[0]


def combine_with_reasons(found: DataFrame, genome: DataFrame, whole_hits: DataFrame | None = None, clip_hits: DataFrame | None = None, chain: DataFrame | None = None, chunk: int = 10_000, config: Config = MOUSE, index: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Targets for genotyping from the discoveries of many files: name, contig, l, r, l_alt, l_ref, r_alt, r_ref; and (name, reason) of what was dropped.

    found: discover's columns with file (or sample) and order. whole_hits, clip_hits: query (name:side), contig, start,
    end, is_forward of an external aligner; index: the genome's minimisers, by which both are looked for here (see
    seeds.find_places). Without either the alignment filters are skipped. clip_hits are lifted over by chain where
    given. The genome's contigs are found under the names of genomes.resolve_contigs. Reasons are the
    first that applies: hot_bin, mapped_whole, mapped_near and those of insertions.reference_problem; rows that were
    merged into others, too unlike to be merged, or in files with too many insertions have none. The rows with their
    reasons are staged, so that targets, reasons and their counts come from one pass.
    """
    full = found.filter((F.col("kind") == insertions.FULL) & S.usable_contig(F.col("contig"), config))
    full = insertions.cap_by_file(full, "file", config.max_insertions_per_file)
    seqs = ["right_clipped", "left_clipped", "left_aligned", "right_aligned"]
    rows = staged(insertions.merge_insertions(full.withColumn("files", F.array("file")), ["contig", "left", "right"], seqs, "order", config, ("files",)), "merged")
    rows = rows.withColumn("name", S.insertion_name(F.col("contig"), F.col("left"), F.col("right")))
    if index is not None:
        side = lambda s, q: F.struct(F.concat("name", F.lit(f":{s}")).alias("query"), q["seq"].alias("seq"))
        of = lambda *sides: seeds.find_places(rows.select(F.explode(F.array(*sides)).alias("q")).select("q.*"), genome, index, chunk)
        lc, la, rc, ra = (F.col(c) for c in ("left_clipped", "left_aligned", "right_clipped", "right_aligned"))
        whole_hits = of(side("L", S.consensus_text(lc, la, "L")), side("R", S.consensus_text(rc, ra, "R"))) if whole_hits is None else whole_hits
        clip_hits = of(side("L", lc), side("R", rc)) if clip_hits is None else clip_hits
    cool = intervals.without_hot_bins(rows, "contig", "right", config.bin_width, config.bin_hot, config.bin_margin)
    rows = _marked(rows, cool.select("name"), "__cool")
    if whole_hits is not None:
        rows = _marked(rows, whole_hits.select(F.regexp_replace("query", ":[LR]$", "").alias("name")), "__whole")
    if clip_hits is not None:
        hits = clip_hits.withColumn("at", F.when(F.col("is_forward"), F.col("start")).otherwise(F.col("end")))
        hits = intervals.lift_over(hits.withColumnRenamed("contig", "hit_contig"), chain, "hit_contig", "at") if chain is not None else hits.withColumn("lifted_contig", F.col("contig")).withColumn("lifted_pos", F.col("at"))
        hits = hits.withColumn("n", S.parse_name(F.col("query")))
        near = (S.with_chr(F.col("n.contig")) == S.with_chr(F.col("lifted_contig"))) & (F.abs(F.when(F.col("n.side") == "R", F.col("n.right")).otherwise(F.col("n.left")) - F.col("lifted_pos")) < config.remap_distance)
        rows = _marked(rows, hits.filter(near).select(F.regexp_replace("query", ":[LR]$", "").alias("name")), "__near")
    k = config.kmer
    has = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in rows.columns else F.lit(False)
    before = F.when(~has("__cool"), "hot_bin").when(has("__whole"), "mapped_whole").when(has("__near"), "mapped_near")
    rows = rows.withColumn("reason", before).drop("__cool", "__whole", "__near")
    rows = rows.withColumn("r_alt", F.substring(F.upper("right_clipped.seq"), 1, k)).withColumn("l_alt", S.revcomp(F.upper(F.substring("left_clipped.seq", 1, k))))
    rows = staged(rows.select("name", "contig", "left", "right", "l_alt", "r_alt", "files", "reason"), "marked-insertions")
    names = genomes.resolve_contigs(rows, genome)
    kept = rows.filter("reason is null").select("name", "contig", "left", "right").join(names, "contig", "left")
    places = kept.select("name", "genome_contig", "left", "right").withColumns({"l0": F.col("left") - k, "r1": F.col("right") + k})
    left = intervals.genome_slices(places, genome, ["name"], "genome_contig", "l0", "left", chunk, "l_ref")
    right = intervals.genome_slices(places, genome, ["name"], "genome_contig", "right", "r1", chunk, "r_ref")
    rows = rows.join(left.withColumn("l_ref", F.upper("l_ref")), "name", "left").join(right.withColumn("r_ref", F.upper("r_ref")), "name", "left")
    problem = insertions.reference_problem(F.lit(insertions.FULL), F.col("l_ref"), F.col("l_alt"), F.col("r_ref"), F.col("r_alt"))
    rows = staged(rows.withColumn("reason", F.coalesce("reason", problem)), "targets")
    targets = rows.filter("reason is null").select("name", "contig", F.col("left").alias("l"), F.col("right").alias("r"), "l_alt", "l_ref", "r_alt", "r_ref", "files")
    return targets, rows.filter("reason is not null").select("name", "reason")


def _marked(rows: DataFrame, names: DataFrame, into: str) -> DataFrame:
    """rows + into: true where names has the row's name, else null."""
    return rows.join(names.distinct().withColumn(into, F.lit(True)), "name", "left")


def genotype(reads: DataFrame, targets: DataFrame, samples: list[str], config: Config = MOUSE) -> DataFrame:
    """Calls of every target in every sample named: sample, insertion, genotype, score_genotype, score_alternative."""
    ids = ["sample", "insertion"]
    wanted = targets.select(F.col("name").alias("insertion"), "contig", "l", "r", "l_alt", "l_ref", "r_alt", "r_ref")
    wanted = wanted.withColumns({"lo": F.least("l", "r"), "hi": F.greatest("l", "r") + 1})
    # Every read counts for the coverage, voting reads alone are scored; crowded targets are dropped before.
    at = reads.withColumnRenamed("pos", "start")
    every = wanted.select(F.explode(F.array(*map(F.lit, samples))).alias("sample"), "insertion", "contig", "lo", "hi")
    covered = intervals.count_overlaps(every, at.select("sample", "contig", "start", "end"), ["sample", "contig"], ("lo", "hi"), ("start", "end"), ids)
    crowded = staged(covered.filter(F.col("n") > config.max_coverage), "crowded")
    voting = at.filter(genotypes.evidence_read(F.col("flag"), F.col("mapq"), config)).select("sample", "contig", "start", "end", "cigar", "seq", "qual")
    pairs = intervals.overlap_join(wanted.withColumn("lo", F.col("lo") - 1), voting, ["contig"], ("lo", "hi"), ("start", "end")).join(crowded.select(*ids), ids, "left_anti")
    args = [F.col(c) for c in ("seq", "qual", "cigar", "start", "end")]
    scored = pairs.select(*ids, genotypes.side_scores("L", *args, F.col("l"), F.col("l_ref"), F.col("l_alt"), config).alias("left"), genotypes.side_scores("R", *args, F.col("r"), F.col("r_ref"), F.col("r_alt"), config).alias("right"))
    scored = staged(scored, "side-scores")
    calls = genotypes.call_genotypes(scored, ids, config=config)
    return genotypes.complete_calls(every.select(*ids), calls, crowded, ids)


def collect(calls: DataFrame, samples: list[str], config: Config = MOUSE) -> DataFrame:
    """The matrix of the insertions that pass all checks, a column for each sample."""
    return genotypes.to_matrix(genotypes.filter_matrix(calls, len(samples), config), samples)


def with_order(df: DataFrame, *by: str) -> DataFrame:
    """df + order: the place of each row within its file."""
    return df.withColumn("order", F.row_number().over(Window.partitionBy("file").orderBy(*by)))
