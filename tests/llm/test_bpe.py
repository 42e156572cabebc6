import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from strandloom.llm import bpe

from .helpers import ODD, tables

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    r = random.Random(5)
    chars = "abcdeinorst  \n\t'’0123456789.,!?éäßñ  　\u001c\u001f\u0085你好\U0001f600ىक़"
    return ODD + ["".join(r.choice(chars) for _ in range(r.randrange(1, 200))) for _ in range(300)]


def test_same_as_library(spark, tmp_path, library):
    texts = odd_texts()
    got = {r.doc_id: r for r in bpe.op1(spark, tables(spark, tmp_path, texts, extra=True)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids), t
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), t
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_operator_gives_ids_and_bytes(spark, library):
    docs = spark.createDataFrame([(1, "Hello world"), (2, None)], "k int, body string")
    out = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN, "body", "toks"), RANKS, "toks", "back").orderBy("k").collect()
    assert out[0].toks == library.encode_ordinary("Hello world") and bytes(out[0].back) == b"Hello world"
    assert out[1].toks == [] and bytes(out[1].back) == b""


def test_long_words_fold_alike(library):
    ranks = bpe.load_ranks(RANKS)
    r = random.Random(1)
    for n in (101, 300, 2000):
        w = "".join(r.choice("abehilnorst") for _ in range(n))
        assert bpe.fold_word(w.encode(), ranks) == library.encode_ordinary(w)


def test_empty_table(spark, tmp_path):
    assert bpe.op1(spark, tables(spark, tmp_path, [])).filter(F.lit(True)).count() == 0


def test_decoding_is_by_parts_of_long_lists_and_replaces_a_column(spark, library):
    rows = [(0, [262] * 700_000, b"old"), (1, None, b"old"), (2, [1, 2, 3] * 100, None), (2, [1, 2, 3] * 100, None), (3, [], None)]
    out = bpe.decode(spark.createDataFrame(rows, "k int, ids array<int>, decoded binary"), RANKS).collect()
    assert [bytes(r.decoded) for r in out] == [library.decode_bytes(x or []) for _, x, _ in rows]
    assert out[0].__fields__.count("decoded") == 1
