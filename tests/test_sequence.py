import random

from pyspark.sql import functions as F

from strandloom.config import MOUSE
from strandloom.functions import sequence as S

QS = "struct<seq:string,qual:array<int>>"


def rows(spark, data, schema):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(data)], f"i int, {schema}")


def values(df, column):
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def rc(s):
    return s[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca"))


def clean(s):
    if len(s) < 2:
        return ""
    tail = len(s) - len(s.rstrip("G"))
    if tail >= 5:
        s = s[: max(1, len(s) - tail)]
    a, j = MOUSE.adapters[0], 0
    for i, c in enumerate(s):
        j = j + 1 if c == a[j] else int(c == a[0])
        if j == 10:
            return s[: i + 1 - 10]
    return s[: len(s) - j] if j >= 4 else s


def test_strings_against_plain_python(spark):
    r = random.Random(0)
    a = MOUSE.adapters[0]
    seqs = ["", "A", "GG", "GGGGG", "GGGGGG", "a", "ANna"] + ["".join(r.choice("ACGTNG") for _ in range(r.randrange(30))) + a[: r.randrange(14)] + "A" * r.randrange(3) + "G" * r.randrange(8) for _ in range(400)]
    df = rows(spark, [(s,) for s in seqs], "s string")
    assert values(df, S.revcomp(F.col("s"))) == [rc(s) for s in seqs]
    assert values(df, S.clean_length(F.col("s"))) == [len(clean(s)) for s in seqs]
    assert values(df, S.is_short_repeat(F.col("s"))) == [any((s[:n] * (24 // n)) == s[:24] and len(s) >= 24 or (s[:n] * (24 // n)) == s[:24] for n in range(1, 5)) for s in seqs]
    assert values(df, S.is_low_complexity(F.col("s"))) == [sum(b in s for b in "ACGT") <= 2 for s in seqs]
    got = values(df, S.longest_run(F.col("s"), "A"))
    for s, x in zip(seqs, got, strict=True):
        n = max((len(p) for p in "".join(c if c == "A" else " " for c in s).split()), default=0)
        assert x.size == n and x.start == (s.index("A" * n) if n else None)


def test_adapters(spark):
    a = MOUSE.adapters
    seqs = ["A", "T" * 12, "G" * 12, "CACACACACACA", "TT", a[0][3:9], rc(a[1][:7]), a[2][5:17].lower(), "ACGTTGCAACGT", None]
    df = rows(spark, [(s,) for s in seqs], "s string")
    assert values(df, S.is_adapter(F.col("s"))) == [False, False, True, True, True, True, True, True, False, None]


def test_quality_sequences(spark):
    df = rows(spark, [(("ACGTN", [1, 2, 3, 4, 100]),)], f"q {QS}")
    q = F.col("q")
    cut = lambda a, b=None: tuple(values(df, S.q_slice(q, a, b))[0])
    s, w = "ACGTN", [1, 2, 3, 4, 100]
    for a in range(-7, 8):
        for b in (None, -6, -2, 0, 3, 9):
            assert cut(a, b) == (s[a:b], w[a:b])
    assert tuple(values(df, S.q_revcomp(q))[0]) == ("NACGT", w[::-1])
    assert values(df, S.fastq(F.lit("t"), q)) == ['@t\nACGTN\n+\n"#$%~\n']
    assert values(df, S.unphred(S.phred(q["qual"]))) == [[1, 2, 3, 4, 93]]


def test_allele_scores_by_hand(spark):
    # The last four bases A, C, C, A of qualities 12, 13, 14, 15: against ACGA they score 12 + 13 - 14 + 15, against ACCA their sum.
    df = rows(spark, [("GGACCA", [10, 11, 12, 13, 14, 15], "ACGA", "ACCA")], "s string, q array<int>, r string, a string")
    assert tuple(values(df, S.allele_scores(F.col("s"), F.col("q"), F.col("r"), F.col("a"), S.RIGHT_TO_LEFT))[0]) == (26.0, 54.0, 13.5)


def test_offsets(spark):
    cigar = [(4, 10), (0, 20), (2, 5), (0, 30)]
    df = rows(spark, [(cigar,)], "c array<struct<op:int,len:int>>")
    at = lambda p: values(df, S.query_offset(F.col("c"), F.lit(100), F.lit(p)))[0]
    assert [at(99), at(100), at(119), at(120), at(124), at(125), at(154), at(155)] == [None, 10, 29, None, None, 30, 59, None]
    assert values(df, S.reference_end(F.col("c"), F.lit(100))) == [155]
    assert values(df, S.clip_side(F.col("c")))[0].side == "L"


def test_names_and_tags(spark):
    df = rows(spark, [("1:10-18:L", "1,200,+,5M,60,0;2,100,+,5M,60,0;"), ("chrX:polyA_5-9", None)], "n string, sa string")
    assert [tuple(x) for x in values(df, S.parse_name(F.col("n")))] == [("1", 10, 18, "L"), ("chrX", None, 9, None)]
    assert values(df, S.near_supplementary(F.col("sa"), F.lit("1"), F.lit(1100))) == [True, False]
    assert values(df, S.near_supplementary(F.col("sa"), F.lit("1"), F.lit(1200))) == [False, False]


def test_match_score(spark):
    data = [([("ACGT", [30] * 4), ("ACGA", [10] * 4)],), ([("ACGT", None), ("ACGA", None)],), ([("", []), ("A", [1])],), ([("NN", None), ("NN", None)],), ([("AC", [5, 5]), ("AG", [5, 5]), ("AG", [5, 5])],)]
    df = rows(spark, data, f"q array<{QS}>")
    assert values(df, S.match_score(F.col("q"))) == [1.0, 0.25, None, 1.0, 1.0]


def test_allele_scores_of_short_ends(spark):
    """Ends shorter than the alleles, unknown bases, and null sequences."""
    r = random.Random(3)
    rows = [("".join(r.choice("ACGTN") for _ in range(r.randrange(0, 9))), "".join(r.choice("ACGT") for _ in range(r.randrange(0, 7))), "".join(r.choice("ACGTN") for _ in range(r.randrange(0, 7)))) for _ in range(200)]
    rows = [(i, s, [r.randrange(40) for _ in s], a, b) for i, (s, a, b) in enumerate(rows)]
    rows += [(900, None, [1], "A", "A"), (902, "A", [1], None, "A"), (905, "", [], "", "")]
    df = spark.createDataFrame(rows, "i int, s string, q array<int>, a string, b string")
    cols = [F.col(c) for c in "sqab"]
    got = {x.i: (x.l, x.r) for x in df.select("i", S.allele_scores(*cols, S.LEFT_TO_RIGHT).alias("l"), S.allele_scores(*cols, S.RIGHT_TO_LEFT).alias("r")).collect()}
    for i, s, q, a, b in rows[:200]:
        n = min(len(s), len(a), len(b))
        for at, ends in enumerate(((0, 0, 0), (len(s) - n, len(a) - n, len(b) - n))):
            places = [(s[ends[0] + k], q[ends[0] + k], a[ends[1] + k], b[ends[2] + k]) for k in range(n)]
            want = [sum(w if x == y[j] else -w for x, w, *y in places if x != "N") for j in range(2)] + [sum(w for x, w, *_ in places if x != "N") / 4]
            assert list(got[i][at]) == want
    assert [got[i][0] for i in (900, 902)] == [None] * 2 and list(got[905][0]) == [0, 0, 0]
