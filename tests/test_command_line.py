import gzip
import os
import random

from test_sources_steps import bam, insertion_reads, two_bit

from strandloom.__main__ import main


def test_steps_from_the_command_line(spark, tmp_path, capsys):
    """All four steps over files: a sample with the insertion on both haplotypes, and one without it."""
    r = random.Random(5)
    genome = "".join(r.choice("ACGT") for _ in range(5000))
    inserted = "".join(r.choice("ACGT") for _ in range(400))
    os.makedirs(tmp_path / "bams")
    for k, (sample, alleles) in enumerate({"hom": (1, 1), "wt": (0, 0)}.items()):
        rows = insertion_reads(genome, inserted, 2000, 2008, sample, alleles, k)
        bam(tmp_path / "bams" / f"{sample}.bam", ["1"], [(q, flag, contig, pos, mapq, ops, seq, qual, sa) for _, _, q, flag, contig, pos, _, mapq, ops, seq, qual, sa in rows])
    two_bit(tmp_path / "g.2bit", {"chr1": genome})
    at = lambda name: str(tmp_path / name)
    run = lambda *args: main(list(args), spark)
    assert run("discover", "--bam", at("bams"), "--out", at("found")) == 0
    assert os.listdir(at("found")) == ["hom.txt.gz"]
    with gzip.open(at("found/hom.txt.gz"), "rt") as f:
        assert f.readline().startswith("@1:2000-2008:LEFT:")
    assert run("combine", "--discoveries", at("found"), "--genome", at("g.2bit"), "--search", "--out", at("targets")) == 0
    assert run("genotype", "--bam", at("bams"), "--insertions", at("targets"), "--out", at("calls")) == 0
    assert sorted(os.listdir(at("calls"))) == ["hom.txt.gz", "wt.txt.gz"]
    with gzip.open(at("calls/hom.txt.gz"), "rt") as f:
        lines = f.read().splitlines()
    assert lines[0].split("\t") == ["insertion", "genotype", "score_genotype", "score_alternative"] and lines[1].startswith("1:2000-2008\thomozygous\t") and len(lines) == 2
    with gzip.open(at("calls/wt.txt.gz"), "rt") as f:
        assert f.read().splitlines()[1].startswith("1:2000-2008\twild-type\t")
    assert run("--preset", "human", "collect", "--calls", at("calls"), "--out", at("matrix")) == 0
    assert spark.read.csv(at("matrix"), sep=";", header=True).collect() == [("1:2000-2008", "homozygous", "wild-type")]
    # What is missing or there already is told before anything runs.
    assert run("collect", "--calls", at("nowhere"), "--out", at("x")) == 2 and run("collect", "--calls", at("calls"), "--out", at("matrix")) == 2
    assert "not found" in capsys.readouterr().err
