import random
import zlib

import pyarrow as pa

from strandloom.llm import toxicity as X

from .helpers import ODD, tables

INSULTS = ["blockhead", "nitwit", "scoundrel"]


def corpus(n=600, seed=4):
    r = random.Random(seed)
    words = ["".join(r.choice(["ta", "no", "ri", "shem", "lor", "ban", "eth", "ov"]) for _ in range(r.randrange(1, 5))) for _ in range(500)]
    texts, toxic = [], []
    for i in range(n):
        w = [r.choice(words) for _ in range(r.randrange(10, 120))]
        if i % 4 == 0:
            for _ in range(r.randrange(2, 5)):
                w[r.randrange(len(w))] = r.choice(INSULTS)
        texts.append(" ".join(w))
        toxic.append(int(i % 4 == 0))
    return texts, toxic


def test_held_out_accuracy(spark, tmp_path):
    texts, toxic = corpus()
    folder = tables(spark, tmp_path, texts, [(i, 0, t) for i, t in enumerate(toxic)] + [(1, 0, None), (None, 1, 1), (10_000, 0, 1)], extra=True)
    rows = X.op8(spark, folder).collect()
    assert len(rows) == len(texts)
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == toxic[r.doc_id] for r in out) >= 0.97 * len(out)


def test_gapped_insults():
    texts, toxic = corpus()
    model = X.train(X.bags(pa.array(texts)), toxic)
    clean = texts[1]
    same = lambda t: X.text_scores(pa.array([t]), model)[0]
    for w in ("block.head blockhxead", "nit.wit nitwxit", "SCOUNDREL scounxdrel", "nitxwit scou.ndrel"):
        assert same(clean + " " + w) > 0.5 > same(clean)


def test_one_changed_insult():
    """One insult alone in a clean text, its letters apart or a mark in it."""
    texts, toxic = corpus()
    model = X.train(X.bags(pa.array(texts)), toxic)
    spelt = ["n i t w i t", "n-i-t-w-i-t", "n.i.t.w.i.t", "N * I * T * W * I * T", "n\u00b7i\u00b7t\u00b7w\u00b7i\u00b7t", "s\u2022c\u2022o\u2022u\u2022n\u2022d\u2022r\u2022e\u2022l"]
    spelt += ["b_l_o_c_k_h_e_a_d", "block-head", "block.head", "SCOUNDREL", "scoun-drel", "nitxwit", "scou*ndrel"]
    for clean in (texts[1], texts[2], texts[3]):
        scores = X.text_scores(pa.array([clean, clean + " a b c d", *(f"{clean} {w} ta" for w in spelt)]), model)
        assert (scores[:2] < 0.5).all()
        assert (scores[2:] > 0.5).all(), [w for w, s in zip(spelt, scores[2:]) if s <= 0.5]


def test_letters_put_together():
    rows = ["n i t", "a", "b c", "d", "I'm U.S. x", "n1i1t no-i-t", "\u00e9-\u00e0-b", "a - b .. c,d", "word.Word (e)", "a .. . b ... c"]
    body, off = X._pack([t.encode() for t in rows])
    raw = body.tobytes()
    got = [raw[i + 1 : j].decode() for i, j in zip(off[:-1], off[1:], strict=True)]
    assert got == ["nit", "a", "b c", "d", "ImUSx", "n1i1t noit", "\u00e9\u00e0b", "a - b .. cd", "wordWord (e)", "a .. . b ... c"]


def test_odd_texts(spark, tmp_path):
    texts, toxic = corpus(80)
    model = X.train(X.bags(pa.array(texts)), toxic)
    scores = X.text_scores(pa.array(ODD), model)
    assert len(scores) == len(ODD) and (scores < 0.5).all()
    assert scores[5] == scores[6]
    rows = X.op8(spark, tables(spark, tmp_path, ODD)).collect()
    assert len(rows) == len(ODD) and not any(r.predicted for r in rows)
    assert X.op8(spark, tables(spark, tmp_path, [], [(1, 0, 1)])).count() == 0


def test_folded_table_equals_kernel_machine():
    """The folded table's value is that of the kernels with the landmarks."""
    phi = X._features([b"blockhead", b"nitwit"])
    body, off = X._pack([b"a blockhead is no nitwit"])
    _, both, _ = X.unit_values(body, off, phi.T)
    w = X.np.array([0.7, -0.2])
    _, folded, _ = X.unit_values(body, off, phi.T @ w)
    assert X.np.allclose(folded[:, 0], both @ w)


def test_long_texts_in_slices(monkeypatch):
    """A text taken apart in slices has the score and the bag that it has as a whole."""
    texts, toxic = corpus(200)
    model = X.train(X.bags(pa.array(texts)), toxic)
    long = " ".join(texts[:40]) + " n i t w i t " + "block-head " * 30 + "x" * 500
    rows = pa.array([long, None, "short nitwit", "a b c d " * 100, ""])
    whole, bag = X.text_scores(rows, model), X.bags(rows)
    monkeypatch.setattr(X, "SLICE", 200)
    assert len(list(X._slices(*X.raw_bytes(rows)))) > 20
    assert X.bags(rows) == bag and abs(X.text_scores(rows, model) - whole).max() < 1e-9


def test_one_very_long_labelled_text(spark, tmp_path):
    texts, toxic = corpus(60)
    texts[0] = " ".join(texts[::4]) + " nitwit " + "word and other " * 200_000
    folder = tables(spark, tmp_path, texts, [(i, 0, t) for i, t in enumerate(toxic)])
    assert X.op8(spark, folder).count() == 60
