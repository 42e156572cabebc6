import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandloom.config import MOUSE
from strandloom.operators import axis, consensus, genotypes, insertions, intervals, ordered


def test_gap_clusters_and_mode(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 6, 6, 12, 18, 18, 19)] + [("b", 5)], "k string, p long")
    out = {(r.k, r.p): r.cluster for r in ordered.gap_clusters(df, ["k"], "p").collect()}
    assert out == {("a", 1): 1, ("a", 6): 1, ("a", 12): 2, ("a", 18): 3, ("a", 19): 3, ("b", 5): 1}
    tie = spark.createDataFrame([(1, 9), (1, 4), (1, 9), (1, 4), (1, 7)], "k int, p long")
    assert ordered.mode(tie, ["k"], "p").collect() == [(1, 4, 2)]


@pytest.mark.parametrize(("width", "levels"), [(1 << 16, 2), (10, 2), (7, 3), (3, 4), (50, 1)])
def test_clusters_do_not_depend_on_bins(spark, width, levels):
    r = random.Random(width)
    rows = [(r.choice(["a", "b", None]), r.choice([None, r.randrange(-200, 300), r.randrange(100_000)])) for _ in range(700)]
    want, before = {}, {}
    for k, p in sorted(set(rows), key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0)):
        last, number = before.get(k, (None, 0))
        number += last is None or p - last >= 6
        want[k, p], before[k] = number, (p, number)
    out = ordered.gap_clusters(spark.createDataFrame(rows, "k string, p long"), ["k"], "p", width=width, levels=levels).collect()
    assert len(out) == 700 and {(x.k, x.p): x.cluster for x in out} == want


@pytest.mark.parametrize(("width", "levels"), [(1 << 16, 2), (5, 3)])
def test_running_sums(spark, width, levels):
    r = random.Random(4)
    rows = [(k, p, r.randrange(-5, 50)) for k in ("a", None) for p in r.sample(range(-300, 300), 150)]
    out = axis.running_sums(spark.createDataFrame(rows, "k string, p long, v long"), ["k"], "p", ["v"], width, levels).collect()
    assert sorted((str(x.k), x.p, x.v_to) for x in out) == sorted((str(k), p, sum(v for k2, q, v in rows if k2 == k and q <= p)) for k, p, _ in rows)


def test_overlap_counts_by_sweep(spark):
    r = random.Random(6)
    key = lambda: (r.choice([1, 2, None]), r.choice(["s", "t"]))
    targets = [(i % 90, *key(), s := r.choice([None, r.randrange(400)]), None if s is None else s + r.randrange(-2, 40)) for i in range(120)]
    reads = [(*key(), s := r.choice([None, r.randrange(400)]), None if s is None else s + r.randrange(-2, 60)) for _ in range(900)] + [(1, "s", 100, 200)] * 500
    want = dict.fromkeys((t[0] for t in targets), 0)
    for i, c, k, lo, hi in targets:
        for c2, k2, a, b in reads:
            want[i] += None not in (c, c2, lo, a) and (c, k) == (c2, k2) and lo < hi and a < b and lo < b and a < hi
    dt = spark.createDataFrame(targets, "i int, c int, k string, s long, e long")
    dr = spark.createDataFrame(reads, "c int, k string, a long, b long")
    for width in (16, 1 << 16):
        got = intervals.count_overlaps(dt, dr, ["c", "k"], ("s", "e"), ("a", "b"), ["i"], width)
        assert {x.i: x.n for x in got.collect()} == want
    plan = intervals.count_overlaps(dt, dr, ["c", "k"], ("s", "e"), ("a", "b"), ["i"])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_forward_pairs_edges(spark):
    left = spark.createDataFrame([("c", 100), ("c", 200), ("c", 203)], "k string, bp long")
    right = spark.createDataFrame([("c", x) for x in (101, 102, 140, 241, 243)] + [("d", 205)], "k string, bp long")
    got = sorted((r.bp, r.right_bp) for r in ordered.forward_pairs(left, right, ["k"], "bp").collect())
    assert got == [(100, 102), (203, 241)]


def by_rule(lefts, rights, polys, asked=-1):
    """What the first left and right breakpoint decide, and then the rest: the rule as a recursion over sorted tuples (place, id, side)."""
    if not lefts or not rights:
        return []
    (left, left_id, _), (right, right_id, _) = lefts[0], rights[0]
    if right - left in range(2, 41):
        return [(left_id, right_id, "pair"), *by_rule(lefts[1:], rights, polys, asked)]
    behind = right - left < 2
    asked = max(asked, left + 12 if behind else right - 120)
    place, found, side = min((p for p in polys if p[0] >= asked), default=(10**9, None, None))
    if behind:
        if side == "R" and place - left < 120:
            return [(left_id, found, "polya_right"), *by_rule(lefts[1:], rights, polys, asked)]
        return by_rule(lefts, rights[1:], polys, asked)
    if side == "L" and right - place > 12:
        return [(found, right_id, "polya_left"), *by_rule(lefts, rights[1:], polys, asked)]
    return by_rule(lefts[1:], rights, polys, asked)


def test_rescued_pairs_against_the_rule(spark):
    r = random.Random(1)
    make = lambda n, base: sorted((r.randrange(3000), base + i, r.choice("LR")) for i in range(n))
    want, tables = set(), [[], [], []]
    for s in range(6):
        groups = [make(40, 1000 * s), make(40, 1000 * s + 300), make(25, 1000 * s + 600)]
        want |= set(by_rule(*groups))
        for t, g in zip(tables, groups, strict=True):
            t += [(f"s{s}", bp, i, side) for bp, i, side in g]
    frames = [spark.createDataFrame(t, "k string, bp long, id long, side string") for t in tables]
    got = {(x.left_id, x.right_id, x.kind) for x in ordered.pairs_with_rescue(frames[0].drop("side"), frames[1].drop("side"), frames[2], ["k"]).collect()}
    assert got == want and {k for _, _, k in got} == {"pair", "polya_right", "polya_left"}


@pytest.mark.parametrize("stretches", [1, 2, 7])
def test_rescued_pairs_in_runs(spark, monkeypatch, stretches):
    """Runs of few stretches, composed a few at a time: what waits at a gap goes on over runs that hold one side only."""
    monkeypatch.setattr(ordered, "FAN", 3)
    monkeypatch.setattr(ordered, "LEVELS", 3)
    r = random.Random(stretches)
    tables, want = [[], [], []], set()
    for s in range(4):
        spread = (1500, 6000, 20000, 60000)[s]
        groups = [sorted((r.randrange(spread), 1000 * s + 300 * t + i, r.choice("LR")) for i in range(r.randrange(15, 60))) for t in range(3)]
        # A place with all three kinds near each other, now and then.
        for n in range(0, spread, 700):
            if r.random() < 0.7:
                for t, d in enumerate((0, r.choice([10, 39, 41]), r.choice([15, 30, 100]))):
                    groups[t].append((n + d, 1000 * s + 300 * t + 100 + n // 700, r.choice("LR")))
        groups = [sorted(g) for g in groups]
        want |= {(f"s{s}", *x) for x in by_rule(*groups)}
        for t, g in zip(tables, groups, strict=True):
            t += [(f"s{s}", bp, i, side) for bp, i, side in g] + [(f"s{s}", None, -1, "L")]
    frames = [spark.createDataFrame(t, "k string, bp long, id long, side string") for t in tables]
    out = ordered.pairs_with_rescue(frames[0].drop("side"), frames[1].drop("side"), frames[2], ["k"], stretches=stretches).collect()
    got = {(x.k, x.left_id, x.right_id, x.kind) for x in out}
    assert got == want and len(out) == len(got) and {x.kind for x in out} == {"pair", "polya_right", "polya_left"}


@pytest.mark.parametrize(("parts", "batch", "stretches"), [(1, 1000, 256), (1, 3, 2), (5, 7, 1), (40, 2, 3), (300, 1, 2)])
def test_rescued_pairs_in_ranges(spark, monkeypatch, parts, batch, stretches):
    """Ranges and batches that end within keys and stretches, and equal rows."""
    monkeypatch.setattr(ordered, "FAN", 3)
    r = random.Random(parts)
    tables, want = [[], [], []], Counter()
    keys = [(None, 1), (None, 2), ("a", None), ("b", 1), ("b", 2), ("c", 7)]
    for s, spread in zip(keys, (40, 4000, 9000, 900, 20_000, 60_000), strict=True):
        groups = [[(r.randrange(spread), 10_000 + 100 * t + r.randrange(60), r.choice("LRx")) for _ in range(r.choice([1, 60]))] for t in range(3)]
        for t in range(3):
            groups[t] += groups[t][:2]
        groups = [sorted(g, key=lambda x: x[:2]) for g in groups]
        # Rows that differ in nothing but the side have no order.
        groups[2] = list({x[:2]: x for x in groups[2]}.values())
        want.update((*s, *x) for x in by_rule(*groups))
        for t, g in zip(tables, groups, strict=True):
            t += [(*s, bp, i, side) for bp, i, side in g]
    tables[0] += [("d", n, n, n, "L") for n in range(30)]  # keys with nothing on the other side
    frames = [spark.createDataFrame(t, "k string, `the key` int, bp long, id long, side string") for t in tables]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = ordered.pairs_with_rescue(frames[0].drop("side"), frames[1].drop("side"), frames[2], ["k", "the key"], stretches=stretches, parts=parts)
        assert Counter(map(tuple, out.collect())) == want and "pair" in {x[-1] for x in want}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rescued_pairs_have_no_group_for_each_key(spark):
    """Many small keys are gone through in order by a few tasks."""
    left = spark.range(40_000).selectExpr("id div 2 as k", "(id % 2) * 1000 as bp", "id")
    plans = []
    keep = ordered.staged
    ordered.staged = lambda df, name: plans.append(df._jdf.queryExecution().toString()) or keep(df, name)
    try:
        out = ordered.pairs_with_rescue(left, left.selectExpr("k", "bp + 5 as bp", "id"), left.selectExpr("k", "bp", "id", "'L' as side"), ["k"])
        assert out.filter("left_id = right_id and kind = 'pair'").count() == out.count() == 40_000
    finally:
        ordered.staged = keep
    assert "MapInArrow" in plans[0] and "FlatMapGroups" not in plans[0] and plans[0].count("Exchange") <= 2 * plans[0].count("Exchange rangepartitioning")


def test_overlaps(spark):
    r = random.Random(2)
    a = [(i, r.randrange(3), s := r.randrange(500), s + r.randrange(0, 60)) for i in range(120)]
    b = [(i, r.randrange(3), s := r.randrange(500), s + r.randrange(0, 90)) for i in range(150)]
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3] and x[2] < x[3] and y[2] < y[3])
    da, db = spark.createDataFrame(a, "i int, c int, s long, e long"), spark.createDataFrame(b, "j int, c int, s2 long, e2 long")
    got = intervals.overlap_join(da, db, ["c"], ("s", "e"), ("s2", "e2"), width=17)
    assert sorted((x.i, x.j) for x in got.collect()) == want


def test_hot_bins_edges(spark):
    hot = [("c", 100 + i) for i in range(4)] + [("c", x) for x in (50, 51, 249, 250)] + [("d", 100 + i) for i in range(3)]
    left = {(x.c, x.p) for x in intervals.without_hot_bins(spark.createDataFrame(hot, "c string, p long"), "c", "p").collect()}
    assert left == {("c", 50), ("c", 250), ("d", 100), ("d", 101), ("d", 102)}


def test_genome_slices(spark):
    text = "ACGTTGCAAC" * 5
    genome = spark.createDataFrame([("1", s, text[s : s + 8]) for s in range(0, 50, 8)], "contig string, chunk_start long, seq string")
    wanted = spark.createDataFrame([(0, "1", 3, 21), (1, "1", 5, 5), (2, "2", 0, 4), (3, "1", 45, 80)], "i int, c string, s long, e long")
    assert {r.i: r.bases for r in intervals.genome_slices(wanted, genome, ["i"], "c", "s", "e", 8).collect()} == {0: text[3:21], 1: "", 2: "", 3: text[45:]}


def brute_consensus(seqs):
    if len(seqs) == 1:
        return seqs[0]
    out, qual = "", []
    for p in range(max(len(s) for s, _ in seqs)):
        w = {b: sum(q[p] for s, q in seqs if p < len(s) and s[p] == b) for b in "ATGC"}
        top = max(w, key=w.get)
        if 2 * w[top] <= sum(w.values()):
            break
        out, qual = out + top, [*qual, 2 * w[top] - sum(w.values())]
    return out, qual


def test_consensus(spark):
    r = random.Random(3)
    groups = {}
    for k in range(40):
        base = "".join(r.choice("ACGT") for _ in range(20))
        groups[k] = [("".join(c if r.random() > 0.15 else r.choice("ACGTN") for c in base[: r.randrange(5, 21)]), None) for _ in range(r.randrange(1, 6))]
        groups[k] = [(s, [r.randrange(1, 40) for _ in s]) for s, _ in groups[k]]
    df = spark.createDataFrame([(k, s, q) for k, g in groups.items() for s, q in g], "k int, s string, q array<int>")
    got = {x.k: (x.s, list(x.q)) for x in consensus.weighted_consensus(df, ["k"], "s", "q").collect()}
    assert got == {k: brute_consensus(g) for k, g in groups.items()}


def test_consensus_over_several_tasks_and_odd_sequences(spark, monkeypatch):
    monkeypatch.setattr(consensus, "HELD", 50)
    r = random.Random(5)
    groups = {(k, None if k % 3 else "x"): [("".join(r.choice("ACGTNé") for _ in range(r.randrange(0, 9)))) for _ in range(r.randrange(1, 30))] for k in range(25)}
    groups = {k: [(s, [r.randrange(1, 40) for _ in s]) for s in g] for k, g in groups.items()}
    rows = [(*k, s, q) for k, g in groups.items() for s, q in g]
    df = spark.createDataFrame(rows, "k int, j string, s string, q array<int>").repartition(7)
    got = {(x.k, x.j): (x.s, list(x.q)) for x in consensus.weighted_consensus(df, ["k", "j"], "s", "q").collect()}
    assert got == {k: brute_consensus(g) for k, g in groups.items()}
    odd = spark.createDataFrame([(1, "ACG", [5, None, 7, 9]), (1, "AC", [5]), (1, None, [3]), (1, "ACG", None), (2, None, None)], "k int, s string, q array<int>")
    assert sorted(consensus.weighted_consensus(odd, ["k"], "s", "q").collect()) == [(1, "A", [10]), (2, None, None)]
    assert consensus.weighted_consensus(odd.filter("k > 5"), ["k"], "s", "q").count() == 0


@pytest.mark.parametrize(("held", "batch", "most"), [(1 << 22, 10_000, 40), (30, 3, 40), (300, 1, 300), (200, 7, 1 << 40)])
def test_consensus_is_dealt_once(spark, monkeypatch, held, batch, most):
    """Keys of few and of many sequences, in any order, with odd letters and qualities: the same, and each key's parts are dealt out once and not by place."""
    monkeypatch.setattr(consensus, "HELD", held)
    r = random.Random(held)
    groups = {(None if k == 3 else k, r.choice([None, "x"])): [] for k in range(40)}
    for n, g in enumerate(groups.values()):
        for _ in range(r.choice([1, 2, 3, 60])):
            s = "".join(r.choice("ACGTN") if r.random() < 0.2 else "ACGT"[(i + n) % 4] for i in range(r.randrange(0, 12)))
            g.append((s, [r.randrange(1, min(most, 1 << 24)) for _ in s]))
    if most > 40:
        groups[40, "x"] = [("ACé", [most >> 12, 1, 2])]
        groups[41, "x"] = [("AC", [-5, 9])] * 4 + [("AA", [30, 9])]
    rows = [(*k, s, q) for k, g in groups.items() for s, q in g]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, j string, s string, q array<int>").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        made = consensus.weighted_consensus(df, ["k", "j"], "s", "q")
        out = made.collect()
        plan = made._jdf.queryExecution().executedPlan().initialPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == len(groups) and {(x.k, x.j): (x.s, list(x.q)) for x in out} == {k: brute_consensus(g) for k, g in groups.items()}
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan


@pytest.mark.parametrize(
    ("reads", "call"),
    [
        ([((40, -40, 10), (40, -40, 10))], ("wild-type", 160, 0)),
        ([((-40, 40, 10), (-40, 40, 10))], ("artefact", 160, 0)),
        ([((40, -40, 10), (-40, 40, 10)), ((-40, 40, 10), (40, -40, 10))], ("heterozygous", 160, 160)),
        ([((0, 0, 0), (40, -40, 10))], ("artefact", 0, 0)),
        ([((5, 5, 9), (1, 1, 1))], ("artefact", 4, 0)),
    ],
)
def test_calls(spark, reads, call):
    kind = "struct<q_ref:double,q_alt:double,q_art:double>"
    df = spark.createDataFrame([("x", tuple(map(float, a)), tuple(map(float, b))) for a, b in reads], f"k string, left {kind}, right {kind}")
    got = genotypes.call_genotypes(df, ["k"]).collect()[0]
    if call[0] == "heterozygous":
        assert got.genotype in ("heterozygous", "homozygous")
    else:
        assert tuple(got)[1:] == call


def test_matrix_filter_missing_and_scores(spark):
    from dataclasses import replace

    config = replace(MOUSE, min_wild_types=1, max_na=1)
    calls = spark.createDataFrame([("a", "ok", "wild-type", 2000), ("b", "ok", "heterozygous", 1000), ("a", "low", "wild-type", 999), ("b", "low", "homozygous", 5000), ("a", "gone", "wild-type", 5000)], "sample string, insertion string, genotype string, score_genotype long")
    assert {r.insertion for r in genotypes.filter_matrix(calls, 3, config).collect()} == {"ok"}
    assert genotypes.to_matrix(calls.filter("insertion = 'gone'"), ["a", "b"]).collect() == [("gone", "wild-type", None)]


def test_claims(spark):
    rows = [("q1", "L", 5, True, 1), ("q1", "R", 2, True, 2), ("q1", "R", 9, True, 3), ("q2", "L", 1, True, 4), ("q2", "L", 2, False, 5), ("q3", "P", 4, True, 6), ("q3", "P", 3, False, 7), ("q4", "P", 1, True, 8), ("q4", "L", 7, False, 9)]
    got = insertions.resolve_claims(spark.createDataFrame(rows, "qname string, side string, ordinal long, want_read1 boolean, bp long")).collect()
    assert sorted(tuple(r) for r in got) == [("q1", True, 3), ("q3", False, 7), ("q4", False, 9)]


def test_labels_and_merge(spark):
    df = spark.createDataFrame([(None, "L", "ttttttgg"), (None, "R", "ggaaaaaa"), (None, "L", "aaaaaa"), ("m", "L", "tttttt")], "m string, s string, c string")
    assert [r[0] for r in df.select(insertions.polya_label(F.col("m"), F.col("s"), F.col("c"))).collect()] == ["polyA", "polyA", None, "m"]
    q = lambda s: (s, [30] * len(s))
    rows = [(1, 1, q("ACGTACGT"), ["f1"]), (1, 2, q("ACGTACGTAA"), ["f2"]), (2, 1, q("ACGT"), ["f1"]), (3, 1, q("AAAA"), ["f1"]), (3, 2, q("CCCC"), ["f2"])]
    merged = insertions.merge_insertions(spark.createDataFrame(rows, "k int, o int, q struct<seq:string,qual:array<int>>, files array<string>"), ["k"], ["q"], "o", lists=("files",)).collect()
    assert sorted((r.k, r.q.seq, r.files) for r in merged) == [(1, "ACGTACGTAA", ["f1", "f2"]), (2, "ACGT", ["f1"])]
