import random

import numpy as np
import pytest

from strandloom.llm import jaccard_join as J

from .helpers import ODD, tables


def brute(texts):
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in w.translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if x]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


def made(seed, n=160):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [r.choice(vocabulary) for _ in range(40)]
    bases = [[r.choice(vocabulary) for _ in range(r.choice([3, 5, 6, 8, 9, 12, 30, 80, 200]))] for _ in range(18)]
    out = []
    for _ in range(n):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4])):
            i = r.randrange(len(w))
            how = r.random()
            if how < 0.4:
                w[i] = r.choice(vocabulary)
            elif how < 0.7:
                w = w[: max(1, len(w) - r.randrange(1, 4))]
            else:
                w += [r.choice(vocabulary)]
        if r.random() < 0.2:
            w = w[:20] + shared
        out.append((" " if r.random() < 0.5 else "\n").join(w).replace("w1", "W1"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, tmp_path, seed):
    texts = ODD + made(seed)
    rows = J.op7(spark, tables(spark, tmp_path, texts, extra=True)).collect()
    want = brute(texts)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == want
    assert 5 < len({c for _, _, c in want}) < len(texts) - 40


def test_every_similar_pair_shares_signatures():
    r = np.random.default_rng(3)
    for _ in range(3000):
        n = int(r.integers(1, 120))
        x = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        y = np.concatenate([x[int(r.integers(0, n // 5 + 1)) :], r.integers(0, 1 << 63, int(r.integers(0, n // 5 + 1)), dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 80 * (len(x) + len(y) - both) or np.array_equal(x, y):
            continue
        got = {}
        for name, s in (("x", x), ("y", y)):
            b, own, above = J.band_of(len(s))
            got[name] = {k: J.signatures(s, k, m) for k, m in ((b, own), (b + 1, above))}
        found = False
        for band in got["x"].keys() & got["y"].keys():
            found |= len(np.intersect1d(got["x"][band], got["y"][band])) >= 1
        assert found


def test_repeated_rows_null_ids_and_nothing(spark, tmp_path):
    text = "one two three four five six"
    rows = J.op7(spark, tables(spark, tmp_path, [(5, text), (5, text), (3, text), (None, "a b"), (9, None)])).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == sorted([(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 1, None), (9, 0, 9)], key=repr)
    assert J.op7(spark, tables(spark, tmp_path, [])).count() == 0


def test_texts_without_a_similar_one_do_not_move(spark, tmp_path):
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=40)) for _ in range(300)) for _ in range(240)]
    folder = tables(spark, tmp_path, [*texts, texts[7] + " end"])
    sc = spark.sparkContext

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before, broadcast = max(stages(), default=-1), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = J.op7(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert {x.doc_id: x.component_id for x in rows} == {i: 7 if i == 240 else i for i in range(241)}
    assert 0 < sum(v for k, v in stages().items() if k > before) < sum(map(len, texts)) / 2


def test_map_of_bits_loses_no_document(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("if(id = 5, null, id * 1000003 - 7000000) AS doc_id", "'x' AS text")
    hopeful = docs.filter("doc_id % 3 = 0").selectExpr("doc_id AS node", "1 AS w")
    want = {x.node for x in hopeful.collect()}
    got = [x.doc_id for x in J._possible(docs, hopeful, 4000).collect()]
    assert want <= set(got) and len(got) == len(set(got)) < 1800
    monkeypatch.setattr(J, "BITS", 0)
    monkeypatch.setattr(J, "MOST_BITS", 64)
    assert want <= {x.doc_id for x in J._possible(docs, hopeful, 4000).collect()}


@pytest.mark.parametrize("often", [2, J.CROWDED + 1])
def test_sets_of_one_id_meet_apart(spark, often):
    r = np.random.default_rng(8)
    x = [np.sort(r.integers(0, 1 << 62, 60, dtype=np.uint64)) for _ in range(4)]
    x[3] = np.sort(np.concatenate([x[1][3:], x[3][:3]]))
    sets = spark.createDataFrame([(i // 2, 60, J._parity(s, np.array([0, 60]))[0].tolist(), s.view(np.int64).tolist()) for i, s in enumerate(x)], "node long, n long, parity array<long>, elements array<long>")
    rows = spark.createDataFrame([(sig, node, node, often) for sig in (7, 9) for node in (0, 1)], "sig long, node long, g long, often long")
    pairs = J._pairs_apart(rows, sets)
    assert [tuple(p) for p in J._verified(pairs, sets).distinct().collect()] == [(0, 1)]
