import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import seeds
from strandloom.sources import records, sample_files


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_places_against_all_offsets(spark):
    r = random.Random(7)
    genome = {c: "".join(r.choice("ACGT") for _ in range(n)) for c, n in (("a", 900), ("b", 501), ("c", 30))}
    genome["a"] = genome["a"][:300] + genome["b"][100:260] + genome["a"][460:]  # a repeat
    genome["b"] = genome["b"][:400] + "N" + genome["b"][401:450].lower() + genome["b"][450:]
    cut = spark.createDataFrame([(c, s, g[s : s + 40]) for c, g in genome.items() for s in range(0, len(g), 40)], "contig string, chunk_start long, seq string")
    queries = []
    for i in range(120):
        g = genome[r.choice("ab")].upper()
        at, n = r.randrange(len(g) - 60), r.choice([33, 34, 40, 60])
        q = list(g[at : at + n])
        for _ in range(r.randrange(4)):
            q[r.randrange(n)] = r.choice("ACGTN")
        q = "".join(q)
        queries.append((i, q if r.random() < 0.5 else rc(q)))
    queries += [(200, genome["b"][:50].upper()), (201, genome["a"][-40:]), (202, "ACGT" * 10), (203, "ACG"), (204, None), queries[0]]
    for most, k, w in ((1, 11, 6), (2, 8, 3), (0, 15, 10)):
        want = set()
        for i, q in queries:
            if q is None or len(q) < (most + 1) * (k + w - 1) + most:
                continue
            for c, g in genome.items():
                for at in range(len(g) - len(q) + 1):
                    for forward, s in ((True, q), (False, rc(q))):
                        unlike = sum(x != y or y == "N" for x, y in zip(s, g[at : at + len(q)].upper(), strict=True))
                        if unlike <= most:
                            want.add((i, c, at, at + len(q), forward, unlike))
        found = seeds.find_places(spark.createDataFrame(queries, "query int, seq string"), cut, seeds.genome_minimisers(cut, k, w), 40, most=most, k=k, w=w).collect()
        assert {tuple(x) for x in found} == want and len(found) == len(want) > 40


def test_places_of_odd_sequences_and_of_common_seeds(spark):
    """Other letters, chunks that do not begin at 0, palindromes, one k-mer over and over; no pair of a seed and a place is passed on that the bases beside them rule out."""
    r = random.Random(3)
    text = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    motif = text(13)
    genome = {"odd": (0, text(90) + "RYN-" + text(60) + "R" + text(80)), "late": (500, text(400)), "crowd": (0, "".join(motif + text(21) for _ in range(200))), "twin": (0, text(50) + "ACGT" * 20 + "A" * 60 + text(30))}
    cut = spark.createDataFrame([(c, o + s, g[s : s + 37]) for c, (o, g) in genome.items() for s in range(0, len(g), 37)], "contig string, chunk_start long, seq string")
    queries = [(1, genome["odd"][1][120:160]), (2, genome["odd"][1][70:110]), (3, rc(genome["odd"][1][140:180])), (4, "ACGT" * 10), (5, "A" * 40), (6, genome["late"][1][:35]), (7, genome["late"][1][350:]), (8, genome["late"][1][201:600])]
    queries += [(100 + i, genome["crowd"][1][34 * i : 34 * i + 34]) for i in range(200)]
    queries += [(9, genome["odd"][1][140:180] + "é"), (10, None), (11, "")]
    queries = queries + queries[:5]
    want = set()
    for i, q in queries:
        for c, (o, g) in genome.items():
            for at in range(len(g) - len(q or "") + 1 if len(q or "") >= 33 else 0):
                for forward, s in ((True, q), (False, rc(q))):
                    unlike = sum(x != y or y == "N" for x, y in zip(s, g[at : at + len(q)], strict=True))
                    if unlike <= 1:
                        want.add((i, c, o + at, o + at + len(q), forward, unlike))
    index = seeds.genome_minimisers(cut)
    asked = spark.createDataFrame(queries, "query int, seq string")
    found = seeds.find_places(asked, cut, index, 37)
    rows = [tuple(x) for x in found.collect()]
    assert set(rows) == want and len(rows) == len(want) and {i for i, *_ in rows} >= {1, 3, 4, 5, 6, 7, 8, *range(100, 300)}
    # What goes to the genome grows with the places found, not with sequences times places that share a k-mer.
    crowd = asked.filter("query >= 100").select("query", F.col("seq").alias("s"))
    met = seeds._met(seeds._seeds(crowd, 1, seeds.K, seeds.W, 34), index, seeds.K).count()
    assert met < 200 * 200 / 20
    with pytest.raises(Exception, match="longer than 34"):
        seeds.find_places(asked, cut, index, 37, longest=34).collect()


def test_sample_files(spark, tmp_path):
    r = random.Random(1)
    rows = [(f"s{i % 3}", i, r.choice([f"line {i}", None, "two\nlines"])) for i in range(300)]
    df = spark.createDataFrame(r.sample(rows, 300), "who string, n int, text string").repartition(5)
    out = str(tmp_path / "out")
    sample_files.write_samples(df, out, "who", "text", ["n"], header="top")
    assert sorted(os.listdir(out)) == ["s0.txt.gz", "s1.txt.gz", "s2.txt.gz"]
    for s in range(3):
        with gzip.open(f"{out}/s{s}.txt.gz", "rt") as f:
            assert f.read() == "top\n" + "".join((t or "") + "\n" for w, _, t in rows if w == f"s{s}")
    # Written again only if that is asked for; what is there stays.
    with pytest.raises(Exception, match="there before"):
        sample_files.write_samples(df.filter("n < 9"), out, "who", "text", ["n"])
    with gzip.open(f"{out}/s0.txt.gz", "rt") as f:
        assert f.readline() == "top\n"
    sample_files.write_samples(df.filter("n < 9"), out, "who", "text", ["n"], overwrite=True)
    with gzip.open(f"{out}/s0.txt.gz", "rt") as f:
        assert f.readline() != "top\n"
    assert len(os.listdir(out)) == 3


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    df = spark.range(200).select((F.col("id") % 4).cast("string").alias("s"), F.col("id").alias("n"), F.when(F.col("id") == 190, F.raise_error(F.lit("broken"))).otherwise("x").alias("v"))
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="broken"):
        sample_files.write_samples(df, out, "s", "v", ["n"])
    assert not os.path.exists(out) or os.listdir(out) == []
    with pytest.raises(Exception, match="makes no file"):
        sample_files.write_samples(spark.createDataFrame([("a/b", 1, "x"), ("ok", 1, "x")], "s string, n int, v string"), out, "s", "v", ["n"])
    assert not os.path.exists(out) or os.listdir(out) == []


def test_calls_and_consensus_and_models_are_read_back(spark, tmp_path):
    calls = spark.createDataFrame([("a", "1:5-9", "wild-type", 12, 3), ("b", "1:5-9", "artefact", 0, 0), ("a", "1:1-2", "homozygous", 7, -2)], "sample string, insertion string, genotype string, score_genotype long, score_alternative long")
    sample_files.write_samples(records.call_lines(calls), str(tmp_path / "calls"), "sample", "value", ["insertion"], header=records.CALL_HEADER)
    assert sorted(records.read_calls(spark, str(tmp_path / "calls")).collect()) == sorted(calls.collect())
    records.write_calls(calls.filter("sample = 'a'"), str(tmp_path / "one"), "insertion")
    back = records.read_calls(spark, str(tmp_path / "one")).drop("sample")
    assert sorted(back.collect()) == sorted(calls.filter("sample = 'a'").drop("sample").collect())
    q = lambda s: (s, [30] * len(s))
    found = spark.createDataFrame([("n", "full", q("AACC"), q("GG"), q("TTT"), q("CA"))], "name string, kind string, left_clipped struct<seq:string,qual:array<int>>, left_aligned struct<seq:string,qual:array<int>>, right_clipped struct<seq:string,qual:array<int>>, right_aligned struct<seq:string,qual:array<int>>")
    records.write_text(records.consensus_records(found), str(tmp_path / "consensus"))
    lines = [x.value for x in spark.read.text(str(tmp_path / "consensus")).collect()]
    assert lines[0] == "@n:L" and lines[1] == "ggttGG" and lines[4] == "@n:R" and lines[5] == "TGttt"
    (tmp_path / "m.hmm").write_text("NAME a\nTH TaxName:mouse;\n//\nNAME b\nTH TaxName:man;\n//\n")
    records.write_models(records.read_models(spark, str(tmp_path / "m.hmm"), "mouse"), str(tmp_path / "models"))
    assert [x.value for x in records.read_models(spark, str(tmp_path / "models"), "mouse").collect()] == [x.value for x in records.read_models(spark, str(tmp_path / "m.hmm"), "mouse").collect()]
