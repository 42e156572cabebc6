import gzip
import os
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

from strandloom.config import MOUSE
from strandloom.functions import sequence as S
from strandloom.operators import breakpoints, intervals
from strandloom.plans import steps
from strandloom.sources import alignments, bgzf, genomes, records

READ = alignments.SCHEMA


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def block(data):
    c = zlib.compressobj(wbits=-15)
    body = c.compress(data) + c.flush()
    return struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def bam(path, contigs, reads, size=10_000):
    data = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(contigs))
    for c in contigs:
        data += struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", size)
    for name, flag, contig, pos, mapq, ops, seq, qual, sa in reads:
        codes = ["=ACMGRSVTWYHKDBN".index(b) for b in seq] + [0] * (len(seq) % 2)
        rec = struct.pack("<iiBBHHHiiii", contigs.index(contig) if contig else -1, pos, len(name) + 1, mapq, 0, len(ops), flag, len(seq), -1, -1, 0)
        rec += name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | op) for op, n in ops) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True)) + bytes(qual or [255] * len(seq))
        rec += b"NMi" + struct.pack("<i", 3) + b"XBBc" + struct.pack("<i", 2) + b"ab" + (b"SAZ" + sa.encode() + b"\0" if sa else b"")
        data += struct.pack("<i", len(rec)) + rec
    with open(path, "wb") as f:
        for at in range(0, len(data), 700):
            f.write(block(data[at : at + 700]))
        f.write(block(b""))


def test_bam_and_sam(spark, tmp_path):
    reads = [("a", 99, "1", 100, 60, [(4, 3), (0, 5)], "ACGTNACG", list(range(8)), "1,5,+,3M,1,0;"), ("b", 4, None, -1, 0, [], "ACG", None, None), ("c", 16, "X", 7, 20, [(0, 2), (2, 4), (8, 1)], "TTT", [1, 2, 3], None)] * 40
    bam(tmp_path / "s1.bam", ["1", "X"], reads)
    spark.dataSource.register(alignments.BamSource)
    got = [tuple(r) for r in spark.read.format("bam").load(str(tmp_path)).orderBy("ordinal").collect()]
    # A record's number is its place: it follows the header, and the later one is greater.
    places = [x[1] for x in got]
    assert len(got) == 120 == len(set(places)) and places[1] > places[0] == 4 + 4 + 4 + 2 * (4 + 2 + 4)
    got = [(x[0], i, *x[2:]) for i, x in enumerate(got)]
    assert got[0] == ("s1", 0, "a", 99, "1", 100, 105, 60, [(4, 3), (0, 5)], "ACGTNACG", list(range(8)), "1,5,+,3M,1,0;")
    assert got[1] == ("s1", 1, "b", 4, None, -1, None, 0, None, "ACG", None, None) and got[2][6] == 14
    assert spark.read.format("bam").option("min_mapq", 40).option("contig", "1").load(str(tmp_path / "s1.bam")).count() == 40
    (tmp_path / "x.sam").write_text("@HD\tVN:1\na\t99\t1\t101\t60\t3S5M\t=\t1\t0\tACGTNACG\t" + "".join(chr(33 + i) for i in range(8)) + "\tNM:i:1\tSA:Z:1,5,+,3M,1,0;\nb\t4\t*\t0\t0\t*\t*\t0\t0\tACG\t*\n")
    sam = [tuple(r) for r in alignments.read_sam(spark, str(tmp_path / "x.sam"), "s1").orderBy("ordinal").collect()]
    assert sam[0][2:] == got[0][2:] and sam[1][2:] == got[1][2:]


def many_reads(n, seed=4):
    """Reads of two contigs in the order of their places, of very unlike sizes, and some without a place."""
    r = random.Random(seed)
    out = []
    for contig in ("1", "X"):
        for pos in sorted(r.randrange(9_000_000) for _ in range(n)):
            size = r.choice([1, 5, 30, 100, 100, 400])
            ops = r.choice([[(0, size)], [(4, 1), (0, size - 1)] if size > 1 else [(0, 1)], [(0, size), (3, r.randrange(1, 60_000))], []])
            seq = "".join(r.choice("ACGTN") for _ in range(size))
            out.append((f"read{len(out)}", r.choice([0, 16, 99]), contig, pos, r.randrange(61), ops, seq, r.choice([None, [r.randrange(41) for _ in range(size)]]), r.choice([None, "1,5,+,3M,1,0;"])))
    return out + [(f"none{i}", 4, None, -1, 0, [], "ACGT", None, None) for i in range(20)]


def test_bam_in_ranges(spark, tmp_path):
    """However a file is cut, its tasks give the same rows with the same numbers."""
    path = str(tmp_path / "s.bam")
    bam(path, ["1", "X"], many_reads(600), size=10_000_000)
    spark.dataSource.register(alignments.BamSource)
    load = lambda split: spark.read.format("bam").option("split", split).load(path)
    whole = load(1 << 30)
    assert whole.rdd.getNumPartitions() == 1
    want = [tuple(r) for r in whole.collect()]
    assert [x[2] for x in want] == [f"read{i}" for i in range(1200)] + [f"none{i}" for i in range(20)]
    for split in (97, 5_000, 60_000):
        parts = alignments.ranges(path, alignments.Region(), split)
        rows = [x for p in parts for x in alignments.records(p, "s", alignments.Region())]
        assert len(parts) > 2 and [x[:8] for x in rows] == [x[:8] for x in want]
    cut = load(40_000)
    assert cut.rdd.getNumPartitions() > 3 and [tuple(r) for r in cut.orderBy("ordinal").collect()] == want
    # A block's first bytes inside other data do not make a block.
    with open(tmp_path / "odd", "wb") as f:
        f.write(b"x" * 10 + bgzf.MAGIC + b"y" * 50 + block(b"data") + block(b""))
    with open(tmp_path / "odd", "rb") as f:
        assert bgzf.next_block(f, 0) == 64 and bgzf.next_block(f, 65) == 64 + len(block(b"data")) and bgzf.next_block(f, 500) is None


def test_bam_regions_by_index(spark, tmp_path):
    path = str(tmp_path / "s.bam")
    reads = many_reads(900)
    bam(path, ["1", "X"], reads, size=10_000_000)
    with pytest.raises(Exception, match="sorted"):
        bam(tmp_path / "bad.bam", ["1"], [reads[5], reads[0]], size=10_000_000)
        alignments.write_index(str(tmp_path / "bad.bam"))
    (index,) = alignments.index_files(spark, [path])
    with open(index, "rb") as f:
        known = bgzf.Index.read(f)
    whole = [Range for Range in alignments.ranges(path, alignments.Region(), 1 << 30)]
    rows = [x for p in whole for x in alignments.records(p, "s", alignments.Region())]
    size = os.path.getsize(path)
    r = random.Random(2)
    for _ in range(60):
        contig, start = r.choice(["1", "X", "nowhere"]), r.randrange(9_000_000)
        region = alignments.Region(frozenset([contig]), start, start + r.choice([1, 1000, 300_000]))
        parts = alignments.ranges(path, region, 20_000)
        got = [x for p in parts for x in alignments.records(p, "s", region)]
        touch = lambda x: x[4] == contig and x[5] < region.end and (x[6] or x[5] + 1) > region.start  # noqa: B023, E731
        assert [x for x in got if touch(x)] == [x for x in rows if touch(x)] and len({x[1] for x in got}) == len(got)
        assert sum(p.end - p.start >> 16 for p in parts) < size / 2
    assert known.chunks(0, 0, 1 << 29)[0][0] == rows[0][1]
    try:
        df = alignments.read_bam(spark, path).filter("contig = 'X' and pos < 2000000 and end > 1500000 and mapq >= 20")
        want = [x for x in rows if x[4] == "X" and x[5] < 2_000_000 and x[6] and x[6] > 1_500_000 and x[7] >= 20]
        assert [tuple(x) for x in df.orderBy("ordinal").collect()] == want and want
        reader = alignments.PushedReader({"path": path})
        assert list(reader.pushFilters([EqualTo(("contig",), "X"), LessThan(("pos",), 2_000_000), GreaterThan(("end",), 1_500_000)]))
        assert sum(p.end - p.start >> 16 for p in reader.partitions()) < size / 4
        none = alignments.read_bam(spark, path).filter("contig = 'nowhere'")
        assert none.count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def two_bit(path, contigs):
    index, body, at = b"", b"", 16 + sum(len(n) + 5 for n in contigs)
    for name, seq in contigs.items():
        index += bytes([len(name)]) + name.encode() + struct.pack("<I", at + len(body))
        spans = lambda keep: [(i, 1) for i, c in enumerate(seq) if keep(c)]
        body += struct.pack("<I", len(seq))
        for s in (spans(lambda c: c.upper() == "N"), spans(str.islower)):
            body += struct.pack(f"<I{2 * len(s)}I", len(s), *(x for x, _ in s), *(n for _, n in s))
        codes = ["TCAG".index(c.upper()) if c.upper() in "TCAG" else 0 for c in seq] + [0] * (-len(seq) % 4)
        body += struct.pack("<I", 0) + bytes(codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3] for i in range(0, len(codes), 4))
    path.write_bytes(struct.pack("<4I", 0x1A412743, 0, len(contigs), 0) + index + body)


def test_two_bit_and_names(spark, tmp_path):
    r = random.Random(1)
    contigs = {"chr1": "".join(r.choice("ACGTacgtN") for _ in range(103)), "chrM": "ACGTA", "GL1": "TT"}
    two_bit(tmp_path / "g.2bit", contigs)
    spark.dataSource.register(genomes.TwoBitSource)
    df = spark.read.format("twobit").option("chunk", 10).load(str(tmp_path / "g.2bit"))
    got = df.groupBy("contig").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_start", "seq"))), lambda x: x["seq"]), "").alias("s")).collect()
    assert {x.contig: x.s for x in got} == contigs
    names = genomes.resolve_contigs(spark.createDataFrame([("1",), ("chr1",), ("MT",), ("L1.1",), ("zz",), ("nope",)], "contig string"), df.select("contig").distinct())
    assert {x.contig: x.genome_contig for x in names.collect()} == {"1": "chr1", "chr1": "chr1", "MT": "chrM", "L1.1": "GL1", "zz": None, "nope": None}


def test_chain(spark, tmp_path):
    (tmp_path / "c.chain").write_text("chain 10 chr1 1000 + 100 160 chrA 500 + 40 95 1\n20 5 0\n35\n\nchain 5 chr1 1000 + 300 310 chrB 200 - 10 20 2\n10\n\n")
    blocks = genomes.read_chain(spark, str(tmp_path / "c.chain"))
    points = spark.createDataFrame([("chr1", p) for p in (99, 100, 119, 122, 125, 159, 160, 305)], "contig string, pos long")
    got = {r.pos: (r.lifted_contig, r.lifted_pos, r.lifted_strand) for r in intervals.lift_over(points, blocks).collect()}
    assert got == {100: ("chrA", 40, "+"), 119: ("chrA", 59, "+"), 125: ("chrA", 60, "+"), 159: ("chrA", 94, "+"), 305: ("chrB", 200 - 1 - 15, "-")}


def test_text_formats(spark, tmp_path):
    put = lambda name, text: (gzip.open(tmp_path / name, "wt").write(text), str(tmp_path / name))[1]
    calls = records.read_calls(spark, [put("a.txt.gz", "insertion\tgenotype\tscore_genotype\tscore_alternative\nx\twild-type\t5\t1\n\nx\tartefact\t7\t0\n"), put("b.txt.gz", "insertion\tgenotype\ts\ts\ny\thomozygous\t9\t2\n")])
    assert sorted(tuple(r) for r in calls.collect()) == [("a", "x", "artefact", 7, 0), ("b", "y", "homozygous", 9, 2)]
    legacy = put("l.txt.gz", ">i1\n@RIGHT_CONSENSUS\nAAcc\n@FILES\nd/P000001_x\nd/P000001_y\n>i2\n@FILES\nd/P000002_x\n")
    rows = records.read_legacy(spark, legacy)
    assert sorted(tuple(r) for r in records.patient_counts(rows).collect()) == [("i1", "P000001", 2), ("i2", "P000002", 1)]
    assert [r[0] for r in rows.filter("section = 'RIGHT_CONSENSUS'").select(S.clipped_part(F.col("value"), "RIGHT_CONSENSUS")).collect()] == ["cc"]
    (tmp_path / "h.txt").write_text("# c\n\nL1  x  i:1-2:L  12.5\n")
    hits = records.read_hits(spark, str(tmp_path / "h.txt")).drop("line_no").collect()
    assert hits == [("L1", "i:1-2", "L", 12.5)]
    (tmp_path / "m.hmm").write_text("NAME a\nTH TaxName:mouse;\n//\nNAME b\nTH TaxName:man;\n//\nNAME c\nTH TaxName:mouse;\n")
    assert [r.value for r in records.read_models(spark, str(tmp_path / "m.hmm"), "mouse").collect()][0].startswith("NAME a")
    (tmp_path / "loci.txt").write_text("1:20-12\njunk\n")
    assert records.read_loci(spark, str(tmp_path / "loci.txt")).collect() == [("1", 12, 20)]
    (tmp_path / "seff.txt").write_text("Job ID: 7\nState: COMPLETED\nCPU Utilized: 00:01\nMemory Utilized: 3 GB\nJob ID: 8\nState: FAILED\n")
    assert sorted(map(tuple, records.read_job_stats(spark, str(tmp_path / "seff.txt")).collect())) == [("7", "COMPLETED", "00:01", "3 GB"), ("8", "FAILED", None, None)]


def insertion_reads(genome, inserted, left, right, sample, alleles, seed):
    """Reads of two haplotypes around one insertion with a duplicated target site; returns rows as an aligner would give them."""
    r = random.Random(seed)
    rows = []
    mutated = genome[:right] + inserted + genome[left:]
    for k in range(60):
        hap = alleles[k % 2]
        if not hap:
            start = r.randrange(left - 120, left - 20)
            rows.append((f"w{k}", 0, start, [(0, 150)], genome[start : start + 150]))
        elif k % 4 < 2:  # across the first junction: the right end is clipped
            clip = r.randrange(20, 90)
            start = right - (150 - clip)
            rows.append((f"r{k}", 0, start, [(0, 150 - clip), (4, clip)], mutated[start : start + 150]))
        else:  # across the second one: the left end is clipped
            clip = r.randrange(20, 90)
            at = right + len(inserted) - clip
            rows.append((f"l{k}", 0, left, [(4, clip), (0, 150 - clip)], mutated[at : at + 150]))
    rows.sort(key=lambda x: x[2])
    return [(sample, i, f"{sample}_{q}", f, "1", p, p + sum(n for op, n in ops if op == 0), 60, ops, s, [30] * len(s), None) for i, (q, f, p, ops, s) in enumerate(rows)]


def test_steps_end_to_end(spark, tmp_path):
    r = random.Random(5)
    genome = "".join(r.choice("ACGT") for _ in range(5000))
    inserted = "".join(r.choice("ACGT") for _ in range(400))
    left, right = 2000, 2008
    kinds = {"hom": (1, 1), "het": (0, 1), "wt": (0, 0)}
    rows = [x for k, (s, a) in enumerate(kinds.items()) for x in insertion_reads(genome, inserted, left, right, s, a, k)]
    reads = spark.createDataFrame(rows, READ).cache()
    found, ends = steps.discover_with_outcomes(reads)
    found = found.withColumn("file", F.col("sample")).cache()
    assert {(x.file, x.left, x.right, x.kind) for x in found.collect()} == {(s, left, right, "full") for s in ("hom", "het")}
    assert all(inserted.startswith(x.right_clipped.seq[:15]) and rc(inserted).startswith(x.left_clipped.seq[:15]) for x in found.collect())
    counts = {(x.sample, x.side, x.outcome): x.n_clusters for x in ends.collect()}
    assert all(counts[s, side, "passed"] == 1 for s in ("hom", "het") for side in "LR") and not any(s == "wt" for s, _, _ in counts)
    # The written form reads back as the same insertions.
    records.write_text(records.discovery_records(found.filter("file = 'hom'")), str(tmp_path / "hom"))
    back = records.read_discoveries(spark, str(tmp_path / "hom")).collect()
    one = found.filter("file = 'hom'").collect()[0]
    assert len(back) == 1 and (back[0].left, back[0].right, back[0].kind) == (left, right, "full")
    for c in ("right_clipped", "left_clipped", "left_aligned", "right_aligned"):
        assert back[0][c].seq == one[c].seq and back[0][c].qual == [min(q, 93) for q in one[c].qual]
    chunks = spark.createDataFrame([("1", s, genome[s : s + 100]) for s in range(0, 5000, 100)], genomes.SCHEMA)
    targets = steps.combine(steps.with_order(found, "contig", "left", "right"), chunks, chunk=100).cache()
    rows = targets.collect()
    assert [(x.name, x.l_ref, x.r_ref, x.r_alt, x.l_alt) for x in rows] == [(f"1:{left}-{right}", genome[left - 12 : left], genome[right : right + 12], inserted[:12], inserted[-12:])]
    records.write_text(records.target_records(targets), str(tmp_path / "targets"))
    again = records.read_targets(spark, str(tmp_path / "targets"))
    assert [tuple(x) for x in again.select("name", "contig", "l", "r", "l_alt", "l_ref", "r_alt", "r_ref").collect()] == [tuple(x)[:8] for x in rows]
    from dataclasses import replace

    again = spark.createDataFrame(again.collect(), again.schema)
    calls = {x.sample: x for x in steps.genotype(reads, again, [*kinds, "none"], replace(MOUSE, max_coverage=100)).collect()}
    assert {k: x.genotype for k, x in calls.items()} == {"hom": "homozygous", "het": "heterozygous", "wt": "wild-type", "none": "wild-type"}
    assert calls["none"].score_genotype == 0 < calls["hom"].score_genotype
    # Where too many reads overlap, nothing is called.
    deep = {x.sample: (x.genotype, x.score_genotype) for x in steps.genotype(reads, again, list(kinds), replace(MOUSE, max_coverage=50)).collect()}
    assert all(deep[k] == ("artefact", 0) for k, n in reads.filter(f"pos < {right + 1} and end > {left}").groupBy("sample").count().collect() if n > 50) and deep["hom"] == ("artefact", 0)
    matrix = steps.collect(spark.createDataFrame(list(calls.values())), list(kinds), replace(MOUSE, min_wild_types=1, min_best_score=100))
    assert matrix.collect() == [(f"1:{left}-{right}", "homozygous", "heterozygous", "wild-type")]
    records.write_matrix(matrix, str(tmp_path / "matrix"))
    assert spark.read.csv(str(tmp_path / "matrix"), sep=";", header=True).collect() == matrix.collect()
    ordered = steps.with_order(found, "left")
    why = lambda **hits: {x.name: x.reason for x in steps.combine_with_reasons(ordered, chunks, chunk=100, **hits)[1].collect()}
    name = f"1:{left}-{right}"
    hits = spark.createDataFrame([(f"{name}:L", "1", left - 500, 20, True), (f"{name}:L", "7", 10, 20, True)], "query string, contig string, start long, end long, is_forward boolean")
    assert why(clip_hits=hits) == {name: "mapped_near"} and why(clip_hits=hits.filter("contig = '7'")) == {}
    # A chain that leads the far hit next to the insertion, and away from it.
    blocks = lambda at: spark.createDataFrame([("7", 0, 100, "1", at, 5000, "+")], "t_contig string, t_start long, t_end long, q_contig string, q_start long, q_size long, q_strand string")
    assert why(clip_hits=hits.filter("contig = '7'"), chain=blocks(left)) == {name: "mapped_near"} and why(clip_hits=hits.filter("contig = '7'"), chain=blocks(left + 2000)) == {}
    assert why(whole_hits=hits) == {name: "mapped_whole"}
    # The genome may call the contig otherwise.
    other = chunks.withColumn("contig", F.lit("chr1"))
    assert steps.combine(ordered, other, chunk=100).count() == 1 and {x.reason for x in steps.combine_with_reasons(ordered, chunks.withColumn("contig", F.lit("chrX")), chunk=100)[1].collect()} == {"missing"}


def test_tails_and_mates(spark):
    """Breakpoints far apart, a badly mapped read with a poly-A tail whose mate lies beside the right one, and a lone clipped read with a tail."""
    r = random.Random(8)
    genome = "".join(r.choice("ACGT") for _ in range(3000))
    inserted = "".join(r.choice("CGT") for _ in range(200))
    left = 1000
    row = lambda i, q, flag, pos, ops, seq, mapq: ("s", i, q, flag, "1", pos, pos + sum(n for op, n in ops if op == 0), mapq, ops, seq, [30] * len(seq), None)
    rows = []
    for k, clip in enumerate((30, 45, 60, 75)):  # the left side of the insertion: the reads' left ends are clipped
        rows.append((f"l{k}", 16, left, [(4, clip), (0, 150 - clip)], inserted[-clip:] + genome[left : left + 150 - clip], 60))
    for k, clip in enumerate((30, 45)):
        rows.append((f"r{k}", 0, 1500 - (150 - clip), [(0, 150 - clip), (4, clip)], genome[1500 - (150 - clip) : 1500] + inserted[:clip], 60))
    tail = inserted[60:100] + "A" * 30
    rows.append(("tail", 1 + 64, 2500, [(0, 70)], tail, 0))
    rows.append(("tail", 1 + 128, 1450, [(0, 100)], genome[1450:1550], 60))
    # A forward read at the right breakpoint asks for its mate.
    rows.append(("r0", 1 + 64, 700, [(0, 100)], genome[700:800], 60))
    lone = genome[2000:2060] + "T" * 12 + inserted[:20]
    rows.append(("lone", 0, 2000, [(0, 60), (4, 32)], lone, 60))
    reads = spark.createDataFrame([row(i, *x) for i, x in enumerate(sorted(rows, key=lambda x: x[2]))], READ)
    polya = breakpoints.polya_reads(reads).collect()
    assert [(x.qname, x.kind, x.side, x.clipped.seq) for x in polya] == [("tail", "A", "L", rc(inserted[60:100]))]
    found, wanted, ends = breakpoints.merge_clusters(breakpoints.clipped_reads(reads))
    got = {(x.side, x.bp): x for x in found.collect()}
    assert set(got) == {("L", left), ("R", 1500), ("R", 2060)}
    assert got["R", 2060].n_reads == 1 and got["R", 2060].clipped.seq == "T" * 12 + inserted[:20]
    assert {(x.side, x.outcome) for x in ends.collect()} == {("L", "passed"), ("R", "passed"), ("R", "rescued_polya")}
    assert {x.qname for x in wanted.filter("side = 'L'").collect()} == {f"l{k}" for k in range(4)}
    _, counts = steps.discover_with_outcomes(reads)
    assert {(x.side, x.outcome): x.n_clusters for x in counts.collect()} == {("L", "passed"): 1, ("R", "passed"): 1, ("R", "rescued_polya"): 1}
    out = steps.discover(reads).collect()
    assert [(x.kind, x.left, x.left_bp, x.right, x.left_clipped.seq) for x in out] == [("left_polya", None, 1450, 1500, rc(inserted[60:100]))]
    assert [m.seq for m in out[0].right_mates] == [genome[700:800]] and out[0].right_clipped.seq[:20] == inserted[:20]
