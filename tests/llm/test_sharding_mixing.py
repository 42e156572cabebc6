import zlib
from collections import defaultdict

from strandloom.llm import mixing, sharding

from .helpers import ODD, tables


def test_shards(spark, tmp_path):
    texts = ODD + ["t" * (i % 97) for i in range(500)]
    rows = sorted(sharding.op3(spark, tables(spark, tmp_path, texts, extra=True)).collect(), key=lambda r: r.doc_id)
    sizes = [len((t or "").encode()) + 1 for t in texts]
    assert [r.size for r in rows] == sizes
    assert [r.text_crc32 for r in rows] == [None if t is None else zlib.crc32(t.encode()) for t in texts]
    total, at = sum(sizes), 0
    slots = defaultdict(int)
    for r in rows:
        assert r.shard == min(7, (2 * at + r.size) * 8 // (2 * total)) and r.slot == slots[r.shard]
        slots[r.shard] += 1
        at += r.size


def test_shards_of_repeated_ids_and_nothing(spark, tmp_path):
    folder = tables(spark, tmp_path, [(7, "same")] * 40 + [(None, "x"), (7, "other")])
    rows = sharding.op3(spark, folder).collect()
    assert len(rows) == 42 and {r.law for r in rows} == {"bytes"}
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.op3(spark, tables(spark, tmp_path, [])).count() == 0


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def test_mix(spark, tmp_path):
    texts = ODD + ["w " * (1 + i * i % 53) for i in range(400)]
    sources = [None if i % 11 == 0 else f"s{min(i % 7, 3)}" for i in range(len(texts))]
    labels = [(i, i % 2, 0) for i in range(0, len(texts), 3)] + [(3, None, 1), (3, 1, 0), (None, 1, 1)]
    folder = tables(spark, tmp_path, texts, labels, sources=sources, extra=True)
    rows = mixing.op5(spark, folder).collect()
    assert len(rows) == len(texts) and sorted(rows) == sorted(mixing.op5(spark, folder).collect())
    sizes = defaultdict(int)
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").split()) or not (texts[r.doc_id] or "").isascii()
        sizes[r.source] += r.size
    want, taken = brute_targets(sizes), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= max(r.size for r in rows if r.source == s) for s in want)


def test_mix_of_nothing(spark, tmp_path):
    assert mixing.op5(spark, tables(spark, tmp_path, [])).count() == 0
    rows = mixing.op5(spark, tables(spark, tmp_path, [None, ""])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
