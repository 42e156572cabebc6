import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from strandloom.llm import digest, language, neighbours

from .helpers import ODD, tables


@pytest.mark.parametrize("n", [0, 1, 2, 60])
def test_fingerprints(spark, tmp_path, n):
    r = random.Random(n)
    texts = (ODD * 5)[:n] if n < 5 else ODD + ["".join(r.choice("abcdeé fgh") for _ in range(r.randrange(400))) for _ in range(n)]
    ids = r.sample(range(10_000), len(texts))
    rows = {x.doc_id: x for x in digest.op10(spark, tables(spark, tmp_path, list(zip(ids, texts, strict=True)), extra=True)).collect()}
    assert len(rows) == len(texts)
    order = sorted(zip(ids, [t or "" for t in texts], strict=True))
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        m = len(t) // 4
        edited = t[: len(t) - m] + after[:m]
        assert rows[i].n_chars == len(t)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints = digest.to_hex(*digest.codes([t.encode(), edited.encode(), after.encode()]))
        assert [rows[i].fingerprint, rows[i].edited_fingerprint] == prints[:2]
        a, b, c = (digest.from_hex([p]) for p in prints)
        assert abs(rows[i].near_edited - digest.likeness(a, b)[0]) < 1e-9 and abs(rows[i].near_next - digest.likeness(a, c)[0]) < 1e-9


def test_fingerprint_by_hand():
    text = "the quick brown fox jumps over the lazy dog".encode() * 3
    counts = [0] * digest.BUCKETS
    for i in range(len(text)):
        for (a, b, c), salt in digest.TRIPLETS:
            if i + c < len(text):
                counts[(digest._A[text[i + a]] ^ digest._B[text[i + b]] ^ digest._C[text[i + c] ^ salt]) % digest.BUCKETS] += 1
    cuts = [sorted(counts)[q * 32 - 1] for q in (1, 2, 3)]
    assert [sum(c > x for x in cuts) for c in counts] == digest.codes([b"zz", text])[0][1].tolist()


def test_repeated_and_null_ids(spark, tmp_path):
    rows = digest.op10(spark, tables(spark, tmp_path, [(3, "same text here"), (3, "same text here"), (None, "abcd" * 3), (1, "x" * 8)])).collect()
    assert sorted(r.edited_sha256 for r in rows) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in ["abcd" * 2 + "a" + "xxx", "x" * 6 + "sa", "same text hsam"[:11] + "sam", "same text h" + "abc"])
    docs = spark.createDataFrame([("aaaa bbbb", 1), ("aaaa bbbb", 2), (None, 3)], "text string, fingerprint_id int")
    out = [r.fingerprint for r in digest.fingerprint(docs).collect()]
    assert out[0] == out[1] != out[2]


def test_language(spark, tmp_path):
    r = random.Random(1)
    parts = {"aa": ["ka", "to", "mi", "ru"], "bb": ["ent", "sch", "ung", "ver"], "cc": ["ción", "ado", "ñe", "llo"]}
    texts, langs = [], []
    for i in range(300):
        lang = list(parts)[i % 3]
        texts.append(" ".join("".join(r.choice(parts[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(2, 40))))
        langs.append(None if i % 10 == 0 else lang)
    texts += ODD + ["1234 !!"]
    langs += ["aa"] * len(ODD) + [None]
    rows = {x.doc_id: x for x in language.op6(spark, tables(spark, tmp_path, texts, langs=langs, extra=True)).collect()}
    assert len(rows) == len(texts)
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= x.score <= 1 for i, x in rows.items())
    assert np.mean([rows[i].lang_pred == list(parts)[i % 3] for i in range(300)]) > 0.98
    for i, t in enumerate(texts):
        assert (rows[i].lang_pred == "und") == (t is None or not any(c.isalpha() for c in t))


def test_language_against_bind_and_bundle(spark, tmp_path):
    """Prototypes, predictions and scores from trigrams that are bound and bundled one by one."""
    r = random.Random(8)
    texts = ["".join(r.choice("abcdé fgh-1") for _ in range(r.randrange(0, 60))) for _ in range(60)] + [None, "", "7 7", "Ab cd", "Ab cd"]
    langs = [r.choice(["xx", "yy", "zz", None]) for _ in texts]
    letters, symbols = language._letters().astype(int), language._symbols()

    def bundle(text):
        clean = []
        for c in f" {(text or '').lower()} ":
            s = int(symbols[ord(c)])
            if s or not clean or clean[-1]:
                clean.append(s)
        total = np.zeros(language.DIMENSIONS)
        for a, b, c in zip(clean, clean[1:], clean[2:]):
            for d in range(language.DIMENSIONS):
                total[d] += letters[a][d - 2] * letters[b][d - 1] * letters[c][d]
        return total / np.sqrt((total**2).sum()) if any(clean) else total

    bundles = [bundle(t) for t in texts]
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(len(texts))]
    sums = {x: sum(b for b, k, h, t in zip(bundles, langs, held, texts) if k == x and not h and t is not None) for x in ("xx", "yy", "zz")}
    base = np.array([v / np.sqrt((v**2).sum()) for v in sums.values()])
    shared = base.mean(axis=0)
    centred = [(b - shared) / np.sqrt(((b - shared) ** 2).sum()) for b in base]
    rows = {x.doc_id: x for x in language.op6(spark, tables(spark, tmp_path, texts, langs=langs)).collect()}
    for i, b in enumerate(bundles):
        if not b.any():
            assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
            continue
        own = b - shared * (b @ shared) / (shared @ shared)
        cosines = [float(own @ c / np.sqrt(own @ own)) for c in centred]
        assert rows[i].lang_pred == list(sums)[int(np.argmax(cosines))] and abs(rows[i].score - (1 + max(cosines)) / 2) < 1e-4


def test_many_short_texts_in_small_tables(monkeypatch):
    r = random.Random(9)
    texts = ["".join(chr(r.randrange(97, 123)) for _ in range(30)) for _ in range(200)]
    whole, _ = language.profiles(texts)
    monkeypatch.setattr(language, "ENTRIES", 1000)
    assert (language.profiles(texts)[0] == whole).all()


def test_language_with_nothing_to_learn(spark, tmp_path):
    assert [x.lang_pred for x in language.op6(spark, tables(spark, tmp_path, ["some text"], langs=[None])).collect()] == ["und"]
    assert language.op6(spark, tables(spark, tmp_path, [])).count() == 0


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, k=20):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = defaultdict(list)
    for i, q in good:
        if i % 20 == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def vectors(spark, folder, rows):
    spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_neighbours_recall_and_exact_scores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 1500)
    r = np.random.default_rng(7)
    x = r.standard_normal((4000, 32)).astype(np.float32) * r.uniform(0.5, 1.5, (4000, 1)).astype(np.float32)
    x[100:130] = x[50]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(4000, None), (4020, [0.0] * 32), (4040, [float("nan")] + [1.0] * 31), (4060, [None] + [1.0] * 31), (4080, [float("inf")] + [1.0] * 31), (None, [1.0] * 32)]
    got = defaultdict(list)
    for q in neighbours.op9(spark, vectors(spark, tmp_path, rows)).orderBy("query_id", "rank").collect():
        got[q.query_id].append((q.vec_id, q.score, q.rank))
    want = brute(rows)
    assert set(got) == set(want)
    hits = 0
    for i, found in got.items():
        assert [k for _, _, k in found] == list(range(1, 21)) and i not in [j for j, _, _ in found]
        assert [(-s, j) for j, s, _ in found] == sorted((-s, j) for j, s, _ in found)
        assert all(abs(s - float((x[i].astype(float) * x[j].astype(float)).sum())) < 1e-12 for j, s, _ in found)
        hits += len({j for j, _, _ in found} & {j for j, _ in want[i]})
    assert hits >= 0.93 * 20 * len(want)


def test_few_vectors(spark, tmp_path):
    got = neighbours.op9(spark, vectors(spark, tmp_path, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [1.0, 1.0, 1.0])])).collect()
    assert sorted((g.query_id, g.rank, g.vec_id, g.score) for g in got) == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert neighbours.op9(spark, vectors(spark, tmp_path, [])).count() == 0
