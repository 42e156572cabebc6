import random
from collections import Counter

import public_tokenizers as P
import pytest

from strandloom.llm import bpe

from .helpers import DOCS, tables

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def fixture(spark, folder):
    from .test_toxicity import corpus

    texts, toxic = corpus(300)
    r = random.Random(3)
    docs = []
    for t in texts:
        if r.random() < 0.2:
            t += " token=abcdefghijklmnop done"
        docs.append(t)
    clean = [i for i, x in enumerate(toxic) if not x and len(docs[i].split()) > 60]
    near = {len(docs) + k: i for k, i in enumerate(clean[:20])}
    for i in list(near.values()):
        docs.append(docs[i] + " end")
    toxic += [0] * len(near)
    docs += [None, ""]
    toxic += [0, 0]
    return tables(spark, folder, docs, [(i, i % 2, x) for i, x in enumerate(toxic)], extra=True), docs, toxic, near


def test_stages(spark, tmp_path):
    folder, texts, toxic, near = fixture(spark, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows, before = docs, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, folder)
        path = f"{folder}/stage{k}"
        out.write.parquet(path)
        before, rows = rows, spark.read.parquet(path)
        if name != "bpe":
            assert rows.columns == columns
        got = [x.asDict() for x in rows.collect()]
        ids = [x["doc_id"] for x in got]
        if name == "toxicity":
            wrong = sum((i in set(ids)) == bool(toxic[i]) for i in range(len(texts)))
            assert wrong <= 3 and not any(toxic[i] and i in set(ids) for i in list(range(0, 300, 4))[:5])
        if name == "jaccard_join":
            assert not set(ids) & set(near) and set(near.values()) & set(ids)
            assert set(x.doc_id for x in before.collect()) - set(ids) <= set(near)
        if name == "secret_scan":
            assert not any("abcdefghijklmnop" in (x["text"] or "") for x in got) and any("[SECRET]" in (x["text"] or "") for x in got)
            assert all(x["n_chars"] == (len(x["text"]) if x["text"] is not None else None) for x in got)
            assert sorted(ids) == sorted(x.doc_id for x in before.collect())
        if name == "mixing":
            words = lambda xs: sum(len((x["text"] or "").split()) for x in xs)
            assert set(Counter(ids).values()) <= {1, 2}
            assert abs(words(got) / words([x.asDict() for x in before.collect()]) - 1.5) < 0.05
        if name == "bpe":
            ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
            back = {i: p for p, i in ranks.items()}
            text = {x.doc_id: x.text or "" for x in before.collect()}
            assert Counter(ids) == Counter(x.doc_id for x in before.select("doc_id").collect())
            assert all(b"".join(back[i] for i in x["ids"]).decode() == text[x["doc_id"]] and x["n_tokens"] == len(x["ids"]) for x in got)


def test_run_on_nothing(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [])).count() == 0


def test_unlike_texts_of_one_id_stay(spark, tmp_path):
    text = "one two three four five six seven eight"
    folder = tables(spark, tmp_path, [(5, text), (5, text), (5, "quite another text that is not like it"), (7, text), (None, "some words without an id at all"), (None, "other words without an id at all"), (None, text), (8, ""), (9, "")])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.keep_one_of_near_copies(spark, docs, folder).collect()
    want = [(5, text), (5, "quite another text that is not like it"), (None, "some words without an id at all"), (None, "other words without an id at all"), (8, ""), (9, "")]
    assert sorted(((r.doc_id, r.text) for r in out), key=repr) == sorted(want, key=repr)


def test_places_do_not_depend_on_how_a_table_is_scanned(spark, tmp_path):
    """The rows that go are copies, also where the number of tasks changes between the scans of one table."""
    from strandloom.llm.common import with_places

    words = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(i, words(i % 60), "en", "s", 1) for i in range(240)]
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{tmp_path}/docs")
    seen = []
    for split in ("1", "64"):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", split)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k" if split == "64" else "128m")
        try:
            docs = spark.read.parquet(f"{tmp_path}/docs")
            seen.append({(r.doc_id, r.text): r.at for r in with_places(docs, "at").collect()})
            kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, str(tmp_path)).collect()
            assert sorted(r.doc_id for r in kept) == list(range(60))
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] and len(set(seen[0].values())) == 240
    made = with_places(docs.filter("doc_id < 100").union(docs.filter("doc_id < 10")), "at").collect()
    assert len(made) == 110 == len({r.at for r in made})
