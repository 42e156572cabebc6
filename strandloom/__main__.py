"""The four steps from the command line: python -m strandloom discover|combine|genotype|collect ... (see --help)."""

from __future__ import annotations

import argparse
import glob
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import config
from .operators import seeds
from .plans import steps
from .sources import alignments, genomes, records, sample_files
from .staging import staged

PRESETS = {"mouse": config.MOUSE, "human": config.HUMAN, "mouse-colonies": config.MOUSE_COLONIES}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandloom", description="Discovery and genotyping of insertions.")
    p.add_argument("--preset", choices=sorted(PRESETS), default="mouse")
    sub = p.add_subparsers(dest="step", required=True)
    d = sub.add_parser("discover", help="BAM files -> a discovery file for each sample")
    d.add_argument("--bam", required=True, help="a file, folder or pattern")
    d.add_argument("--out", required=True)
    c = sub.add_parser("combine", help="discovery files and a genome -> the genotyping file")
    c.add_argument("--discoveries", required=True)
    c.add_argument("--genome", required=True, help="a 2bit file")
    c.add_argument("--search", action="store_true", help="drop insertions whose sequences lie elsewhere in the genome")
    c.add_argument("--chain", help="a liftover chain for the places found")
    c.add_argument("--out", required=True)
    g = sub.add_parser("genotype", help="BAM files and the genotyping file -> a call file for each sample")
    g.add_argument("--bam", required=True)
    g.add_argument("--insertions", required=True)
    g.add_argument("--out", required=True)
    m = sub.add_parser("collect", help="call files -> the matrix of the insertions that pass all checks")
    m.add_argument("--calls", required=True)
    m.add_argument("--out", required=True)
    return p


def listed(path: str, suffix: str) -> list[str]:
    """The files at a path, in a folder (those in folders with 'old' in their names left out) or of a pattern."""
    if os.path.isdir(path):
        return sorted(f for f in glob.glob(os.path.join(path, "**", f"*{suffix}"), recursive=True) if "old" not in os.path.relpath(os.path.dirname(f), path))
    return sorted(glob.glob(path))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a step; 2 if an input is missing or the output is there already."""
    args = _parser().parse_args(argv)
    for name in ("bam", "discoveries", "genome", "chain", "insertions", "calls"):
        path = getattr(args, name, None)
        if path and not listed(path, ""):
            print(f"not found: {path}", file=sys.stderr)
            return 2
    if os.path.exists(args.out):
        print(f"there already: {args.out}", file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName(f"strandloom {args.step}").getOrCreate()
    globals()[args.step](spark, args, PRESETS[args.preset])
    return 0


def discover(spark: SparkSession, args: argparse.Namespace, rules: config.Config) -> None:
    found = steps.discover(alignments.read_bam(spark, args.bam), rules)
    named = records.discovery_records(found, "sample", "contig", F.coalesce("left", "left_bp").alias("at"), F.coalesce("right", "right_bp").alias("to"))
    sample_files.write_samples(named, args.out, "sample", "value", ["contig", "at", "to"])


def combine(spark: SparkSession, args: argparse.Namespace, rules: config.Config) -> None:
    spark.dataSource.register(genomes.TwoBitSource)
    genome = spark.read.format("twobit").load(args.genome)
    found = records.read_discoveries(spark, listed(args.discoveries, ".txt.gz"))
    index = staged(seeds.genome_minimisers(genome), "minimisers") if args.search else None
    chain = genomes.read_chain(spark, args.chain) if args.chain else None
    targets, reasons = steps.combine_with_reasons(found, genome, chain=chain, config=rules, index=index)
    records.write_text(records.target_records(targets), args.out)
    reasons.groupBy("reason").count().orderBy("reason").show(truncate=False)


def genotype(spark: SparkSession, args: argparse.Namespace, rules: config.Config) -> None:
    samples = [os.path.basename(f).removesuffix(".bam") for f in listed(args.bam, ".bam")]
    calls = steps.genotype(alignments.read_bam(spark, args.bam), records.read_targets(spark, args.insertions), samples, rules)
    sample_files.write_samples(records.call_lines(calls), args.out, "sample", "value", ["insertion"], header=records.CALL_HEADER)


def collect(spark: SparkSession, args: argparse.Namespace, rules: config.Config) -> None:
    files = listed(args.calls, ".txt.gz")
    calls = records.read_calls(spark, files)
    records.write_matrix(steps.collect(calls, [r[0] for r in calls.select("sample").distinct().orderBy("sample").collect()], rules), args.out)


if __name__ == "__main__":
    sys.exit(main())
