import hashlib
import random

import numpy as np
import pytest

from strandloom.llm import repeats
from strandloom.llm.suffixes import suffix_order

from .helpers import ODD, tables


def brute(pairs):
    seen, first = {}, {}
    docs = sorted(pairs)
    for i, t in docs:
        raw = (t or "").encode()
        for p in range(len(raw) - 99):
            seen.setdefault(raw[p : p + 100], (i, p))
    out = {}
    for i, t in docs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 99):
            if seen[raw[p : p + 100]] < (i, p):
                gone[p : p + 100] = True
        gone = gone[: len(raw)]
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def made(seed):
    r = random.Random(seed)
    words = [f"{r.randrange(10**6)}é"[: r.randrange(2, 8)] for _ in range(3000)]
    passage = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [passage(n) for n in (18, 20, 22, 25, 40, 80)]
    texts = []
    for _ in range(70):
        parts = [passage(r.randrange(1, 60))]
        for _ in range(r.randrange(0, 4)):
            parts += [r.choice(shared), passage(r.randrange(0, 20))]
        texts.append(" ".join(parts))
    for t in r.sample(texts, 25):
        w = t.split(" ")
        w[r.randrange(len(w))] = "edit"
        texts.append(" ".join(w))
    return texts + texts[:5] + ["ab" * 300, "abc" * 200, "x" * 500, "x" * 99, "x" * 100, "x" * 101] + ODD


@pytest.mark.parametrize("many", [20_000, 3])
def test_against_brute_force(spark, tmp_path, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)
    texts = made(many)
    ids = random.Random(9).sample(range(10**6), len(texts))
    pairs = list(zip(ids, texts, strict=True))
    rows = repeats.op2(spark, tables(spark, tmp_path, pairs, extra=True)).collect()
    want = brute(pairs)
    assert len(rows) == len(pairs)
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], (r.doc_id, dict(pairs)[r.doc_id][:80])
    assert sum(r.n_removed > 0 for r in rows) > 60


def test_repeated_rows_and_nothing(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = repeats.op2(spark, tables(spark, tmp_path, [(4, text), (4, text), (6, text), (None, text[:50])])).collect()
    assert sorted(((r.doc_id or 0, r.n_removed) for r in rows)) == [(0, 0), (4, 0), (4, 0), (6, len(text))]
    assert repeats.op2(spark, tables(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("many", [20_000, 1])
def test_texts_that_share_an_id(spark, tmp_path, monkeypatch, many):
    """Unlike texts without an id, or of one id, are cut each by its own marks."""
    monkeypatch.setattr(repeats, "MANY", many)
    line = lambda w, n: " ".join(f"{w}{i}" for i in range(n))
    once, twice = line("only", 60), line("again", 60)
    pairs = [(None, once + " " + twice), (None, twice + " " + line("more", 40)), (None, line("alone", 90))]
    pairs += [(7, line("seven", 80)), (7, twice + " " + line("other", 30)), (7, line("third", 20)), (9, line("nine", 9) + twice + line("x", 5)), (9, line("seven", 60))]
    rows = repeats.op2(spark, tables(spark, tmp_path, pairs)).collect()
    # Documents in order: null first, texts of one id by the hash.
    number = spark.createDataFrame(pairs, "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) h").collect()
    order = sorted(number, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    want = brute([(k, r.text) for k, r in enumerate(order)])
    assert sorted(tuple(r[1:]) for r in rows) == sorted(want.values())
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows) == sorted((r.doc_id or 0, *want[k][:2]) for k, r in enumerate(order))
    assert sum(r.n_removed > 0 for r in rows) == 4


def test_suffix_order():
    r = np.random.default_rng(0)
    for _ in range(800):
        t = r.integers(0, int(r.integers(1, 4)), int(r.integers(0, 60))).astype(np.uint8)
        b = t.tobytes()
        assert suffix_order(t, 10**9).tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        for depth in (5, 20):
            got = [b[i : i + depth] for i in suffix_order(t, depth)]
            assert got == sorted(got)


def test_long_texts_are_looked_at_in_parts(monkeypatch):
    monkeypatch.setattr(repeats, "PART", 450)
    r = np.random.default_rng(4)
    body = r.integers(97, 100, 5000).astype(np.uint8)
    off = np.array([0, 1700, 1750, 1849, 1949, 1949, 5000])
    row, first, n, piece, _ = repeats._by_parts(body, off)
    starts = sorted((a, f + k) for a, f, m in zip(row.tolist(), first.tolist(), n.tolist(), strict=True) for k in range(m))
    assert starts == [(a, p) for a in range(6) for p in range(off[a], off[a + 1] - 99)]
    whole = repeats.stretches(body, off)
    of = lambda rows: {f + k: p for f, m, p in zip(*rows, strict=True) for k in range(m)}
    assert of((first.tolist(), n.tolist(), piece.tolist())) == of((whole[1].tolist(), whole[2].tolist(), whole[3].tolist()))


def test_a_passage_over_the_end_of_a_part(spark, tmp_path):
    r = random.Random(12)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(repeats.PART + 300_000))
    passage = text[1000:1700]
    long = text[: repeats.PART - 350] + passage + text[repeats.PART - 350 :]
    rows = repeats.op2(spark, tables(spark, tmp_path, [(1, long), (2, "other words " + passage[100:400])])).collect()
    assert sorted((x.doc_id, x.n_removed, x.n_spans, x.kept_sha256) for x in rows) == [(1, 700, 1, hashlib.sha256(text.encode()).hexdigest()), (2, 300, 1, hashlib.sha256(b"other words ").hexdigest())]
