import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import sentencepiece

from strandloom.llm import sentence_pieces

from .helpers import tables
from .test_bpe import odd_texts

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return sentence_pieces.Encoder(sentence_pieces.load(MODEL))


def ids_of(coder, text):
    packed = coder.encode(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_query_same_as_library(spark, tmp_path, library):
    texts = [*odd_texts(), "▁ ▁▁x▁y", "<s> </s> <unk> <0x41>", "   lead and trail   ", " " * 300 + "the", "same", "same"]
    texts += [(0, "a repeated id"), (0, "a repeated id")]
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, 1)]
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentence_pieces.op13(spark, tables(spark, tmp_path, pairs, extra=True)).collect())
    want = []
    for i, t in pairs:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)


def test_runs_without_breaks(coder, library):
    r = random.Random(3)
    for alphabet, n in (("abehilnorst", 3000), ("ab", 500), (" ", 777), (" a", 2000), ("0123456789abcdef", 2000), ("你好\U0001f600\x01é", 300)):
        for _ in range(5):
            text = "".join(r.choice(alphabet) for _ in range(n))
            assert ids_of(coder, text) == library.encode(text)


def small_model(pieces, prefix=False):
    """A model file with control pieces and the given (piece, score) pairs, without bytes."""

    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3 & 127 | 128 if number > 15 else number << 3, *([number >> 4] if number > 15 else []), value])
        return bytes([number << 3 | 2, len(value)]) + value

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + field(3, kind))

    head = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    return head + b"".join(piece(t, s, 1) for t, s in pieces) + field(2, field(3, 2)) + field(3, field(1, b"identity") + field(3, int(prefix)) + field(4, 0))


@pytest.mark.parametrize("seed", range(12))
def test_any_vocabulary_against_the_merges_themselves(seed):
    """Random vocabularies, with equal scores, pieces that no merge arrives at and characters that are no piece."""
    r = random.Random(seed)
    words = {"".join(r.choice("abc") for _ in range(r.randrange(1, 7))) for _ in range(40)}
    vocabulary = [(w, float(-r.randrange(12))) for w in sorted(words)]
    model = sentence_pieces.Model(small_model(vocabulary))
    coder = sentence_pieces.Encoder(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=small_model(vocabulary))
    by_text = {t: i for i, t in enumerate(model.text)}
    for _ in range(200):
        text = "".join(r.choice("aaabbbcd") for _ in range(r.randrange(1, 30)))
        parts, _, _ = sentence_pieces.merges(text, model.rank)
        assert ids_of(coder, text) == [by_text.get(p, 0) for p in parts]
        if not set(model.left) - words:
            assert [i for i in ids_of(coder, text) if i] == [i for i in library.encode(text) if i]


def test_operators_keep_columns_and_decode_any_ids(spark, library):
    docs = spark.createDataFrame([(1, "Hello world", "kept"), (2, None, None)], "k int, body string, decoded string")
    out = sentence_pieces.decode(sentence_pieces.encode(docs, MODEL, "body", "toks", begin=False), MODEL, "toks").orderBy("k").collect()
    assert out[0].toks == library.encode("Hello world", add_eos=True) and out[0].decoded == "Hello world"
    assert out[1].toks == [2] and out[1].decoded == ""
    r = random.Random(2)
    rows = [[r.choice([0, 1, 2, *range(3, 259), 259, 28705, *range(259, 400)]) for _ in range(r.randrange(9))] for _ in range(400)]
    # The bytes of é and of a lone surrogate; a byte of nothing before a piece with a space.
    rows += [[198, 172], [240, 163, 131], [198, 28705, 415], [28705, 415], [28705, 28705, 415], [259], []]
    decoded = sentence_pieces.decode(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, ids array<int>"), MODEL)
    for row in decoded.collect():
        assert row.decoded == library.decode(row.ids), row.ids


def test_long_lists_are_decoded_in_bounded_slices(spark):
    import pyarrow as pa

    from strandloom.llm.common import list_slices

    batch = pa.RecordBatch.from_pydict({"ids": [[1] * 10, None, [2] * 25, [], [3] * 3, [4] * 3]})
    parts = list(list_slices([batch], "ids", 10))
    assert [p.num_rows for p in parts] == [2, 1, 3] and pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()


def test_empty_table(spark, tmp_path):
    assert sentence_pieces.op13(spark, tables(spark, tmp_path, [])).count() == 0


def test_other_kinds_of_model_are_refused():
    with pytest.raises(ValueError):
        sentence_pieces.Model(small_model([("a", 0.0)]).replace(bytes([3 << 3, 2]), bytes([3 << 3, 1])))
