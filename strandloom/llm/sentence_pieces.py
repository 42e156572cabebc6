"""SentencePiece encoding and decoding for vocabularies of merge type, by a table of prefixes.

A text is encoded from left to right: for each of its prefixes the table keeps the last token of that prefix's own
encoding. The pieces that end at a place come from an automaton over the vocabulary; of these exactly one is the last
token, the one that may stand behind the last token of the prefix before it. Two tokens may stand side by side if the
merges of their joined text would never cross the seam, which a walk over both tokens' edges decides. The ids are read
backwards from the end of the table. The time is in proportion to the text, however long a run without a break is.

Merges cannot cross a place whose neighbours meet in no piece. Where the vocabulary has no piece with a space mark
behind another character, a text is therefore cut in front of its runs of spaces, and a worker remembers the ids of a
bounded number of such words.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import list_slices, pieces, prepare

#: The mark that stands for a space inside pieces.
SPACE = "▁"
#: Kinds of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Characters of words that a worker remembers, in each of two generations, and the longest word that it remembers.
REMEMBERED, LONGEST = 1_500_000, 200
#: Verdicts on pairs that a worker remembers.
PAIRS = 300_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message in the wire format of protocol buffers."""

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    at = 0
    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"wire type {kind} in a model file")
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """A vocabulary: pieces, their scores and kinds, by id; and the edges of each mergeable piece."""

    def __init__(self, data: bytes):
        self.uid = uuid.uuid4().hex
        self.text: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        trainer: dict = {}
        rules: dict = {}
        for number, value in _fields(data):
            if number == 1:
                p = dict(_fields(value))
                self.text.append(p.get(1, b"").decode())
                self.score.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kind.append(p.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only models of merge type are supported")
        if rules.get(2, b"") or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models that keep texts as they are, with spaces as marks before words, are supported")
        if USER_DEFINED in self.kind or UNUSED in self.kind:
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = bool(rules.get(3, 1))
        self.begin, self.end = (self._control(trainer.get(n, d).decode()) for n, d in ((46, b"<s>"), (47, b"</s>")))
        self.unknown = self.kind.index(UNKNOWN)
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.bytes_of = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k == BYTE} if trainer.get(35, 0) else {}
        self._edges()

    def _control(self, name: str) -> int:
        return next(i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if t == name and k == CONTROL)

    def _edges(self) -> None:
        """Tokens are the vocabulary's mergeable pieces and the characters in them.

        left[t] and right[t] list what stands at the token's edge while it is merged from its characters: (edge, the
        worst rank of the merges up to the next edge). A piece that its own merges do not arrive at is no token.
        """
        self.rank = {t: -s for t, s, k in zip(self.text, self.score, self.kind, strict=True) if k == NORMAL and t}
        ids = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k == NORMAL}
        self.left: dict[str, list[tuple[str, float]]] = {}
        self.right: dict[str, list[tuple[str, float]]] = {}
        for c in {c for t in self.rank for c in t}:
            self.left[c] = self.right[c] = [(c, float("inf"))]
        for t in self.rank:
            if len(t) > 1:
                parts, left, right = merges(t, self.rank)
                if parts == [t]:
                    self.left[t], self.right[t] = left, right
        self.ids = {t: (ids[t],) if t in ids else self.spelt(t) for t in self.left}
        self.cut = not any(SPACE in t.lstrip(SPACE) for t in self.left)

    def spelt(self, text: str) -> tuple[int, ...]:
        """Ids of a character that is no piece."""
        return tuple(self.bytes_of[b] for b in text.encode()) if self.bytes_of else (self.unknown,)


def merges(text: str, rank: dict[str, float]) -> tuple[list[str], list, list]:
    """Best-first merges of text, leftmost first among equals: its parts, and the edges on the left and right on the way."""
    n = len(text)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    live = bytearray(b"\x01") * n
    heap = [(rank[text[i : i + 2]], i, i + 2) for i in range(n - 1) if text[i : i + 2] in rank]
    heapq.heapify(heap)
    left, right = [[text[:1], float("-inf")]], [[text[-1:], float("-inf")]]
    while heap:
        r, i, to = heapq.heappop(heap)
        if not live[i] or end[i] >= n or end[end[i]] != to:
            continue
        live[end[i]] = 0
        end[i] = to
        for edges in (left, right):
            edges[-1][1] = max(edges[-1][1], r)
        if i == 0:
            left.append([text[:to], float("-inf")])
        if to == n:
            right.append([text[i:], float("-inf")])
        else:
            before[to] = i
            if (near := text[i : end[to]]) in rank:
                heapq.heappush(heap, (rank[near], i, end[to]))
        if (p := before[i]) >= 0 and (near := text[p:to]) in rank:
            heapq.heappush(heap, (rank[near], p, to))
    left[-1][1] = right[-1][1] = float("inf")
    parts, i = [], 0
    while i < n:
        parts.append(text[i : end[i]])
        i = end[i]
    return parts, [tuple(x) for x in left], [tuple(x) for x in right]


class Encoder:
    """A worker's automaton and what it remembers."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.tokens = ["", *model.left]  # a token is its place here; 0 is none
        self.ids = [b"", *(np.array(model.ids[t], "<i4").tobytes() for t in model.left)]
        self.sizes = list(map(len, self.tokens))
        self.automaton = ahocorasick.Automaton()
        for n, t in enumerate(self.tokens[1:], 1):
            self.automaton.add_word(t, n)
        self.automaton.make_automaton()
        self.verdicts: dict[int, bool] = {}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.find = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall if model.cut else lambda t: [t]

    def fits(self, a: int, b: int) -> bool:
        """Whether token b may follow token a: no merge crosses the seam while both are merged from their characters.

        Of the next edges of both sides the one with the lower rank comes first, the left one if they are equal. A merge
        over the seam comes before it if its rank is lower, or equal to that of the right side, which stands behind it.
        """
        rank = self.model.rank
        xs, ys = self.model.right[self.tokens[a]], self.model.left[self.tokens[b]]
        i = j = 0
        while True:
            (x, x_next), (y, y_next) = xs[i], ys[j]
            over = rank.get(x + y)
            if over is not None and (over < x_next if x_next <= y_next else over <= y_next):
                out = False
                break
            if i == len(xs) - 1 and j == len(ys) - 1:
                out = True
                break
            if x_next <= y_next:
                i += 1
            else:
                j += 1
        if len(self.verdicts) >= PAIRS:
            self.verdicts.clear()
        self.verdicts[a * len(self.tokens) + b] = out
        return out

    def encode_word(self, word: str) -> bytes:
        """Ids of a word as little-endian 32-bit integers."""
        sizes, fits, known, width = self.sizes, self.fits, self.verdicts.get, len(self.tokens)
        last = [0] * (len(word) + 1)  # by length of prefix; 0 where a character that no piece has ends
        for to, token in self.automaton.iter(word):
            to += 1
            if last[to]:
                continue
            before = last[to - sizes[token]]
            if before:
                fit = known(before * width + token)
                if not (fits(before, token) if fit is None else fit):
                    continue
            last[to] = token
        ids, out, to = self.ids, [], len(word)
        while to:
            if token := last[to]:
                out.append(ids[token])
                to -= sizes[token]
            else:
                to -= 1
                out.append(np.array(self.model.spelt(word[to]), "<i4").tobytes())
        out.reverse()
        return b"".join(out)

    def word(self, word: str) -> bytes:
        ids = self.new.get(word)
        if ids is None:
            ids = self.old.get(word) or self.encode_word(word)
            if len(word) <= LONGEST:
                if self.held >= REMEMBERED:
                    self.old, self.new, self.held = self.new, {}, 0
                self.new[word] = ids
                self.held += len(word)
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.word, self.find(((SPACE if self.model.prefix else "") + text).replace(" ", SPACE))))


_WORKER: list[Encoder] = []


def _encoder(model: Model) -> Encoder:
    """The worker's encoder; one of another vocabulary is dropped."""
    if not _WORKER or _WORKER[0].model.uid != model.uid:
        _WORKER[:] = [Encoder(model)]
    return _WORKER[0]


def load(path: str) -> Model:
    with open(path, "rb") as f:
        return Model(f.read())


def encode(df: DataFrame, model_path: str, text_col: str = "text", into: str = "ids", packed: str | None = None, begin: bool = True, end: bool = True) -> DataFrame:
    """df without text_col + into: array<int>, and packed (if named): the same ids as little-endian 32-bit integers.

    A null text is as an empty one: its ids are the begin and end ids alone. Texts are encoded whole. Rows are
    independent: repeated rows get equal ids, an empty table gives no rows. Columns of df named as into or packed are
    replaced. The model is read by the driver and broadcast; its size does not depend on the data.
    """
    spark = df.sparkSession
    prepare(spark)
    model = load(model_path)
    shared = spark.sparkContext.broadcast(model)
    first, final = np.array([model.begin] if begin else [], "<i4").tobytes(), np.array([model.end] if end else [], "<i4").tobytes()
    keep = [c for c in df.columns if c not in (text_col, into, packed)]
    names = [*keep, into, *([packed] if packed else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared.value)
        for batch in pieces(batches, text_col):
            rows = [first + coder.encode(t) + final for t in batch.column(text_col).to_pylist()]
            ends = np.fromiter(accumulate((len(r) // 4 for r in rows), initial=0), np.int32, len(rows) + 1)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))
            extra = [pa.array(rows, pa.binary())] if packed else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids, *extra], names)

    fields = [*(df.schema[c] for c in keep), T.StructField(into, T.ArrayType(T.IntegerType()))]
    return df.mapInArrow(work, T.StructType(fields + ([T.StructField(packed, T.BinaryType())] if packed else [])))


def _one_for_each_byte(e: UnicodeError) -> tuple[str, int]:
    return "�", e.start + 1


def text_of(ids: list[int], shown: list[bytes], silent: frozenset[int], spaced: frozenset[int]) -> str:
    """Text of one row of ids. A piece loses the space before it if it is the first to show; each byte that is part of no character becomes U+FFFD."""
    out = b"".join(map(shown.__getitem__, ids))
    if next((i for i in ids if i not in silent), None) in spaced:
        out = out[1:]
    try:
        return out.decode()
    except UnicodeDecodeError:
        codecs.register_error("strandloom-bytes", _one_for_each_byte)
        return out.decode(errors="strandloom-bytes")


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """df + into: string. Control ids show nothing; null or no ids give an empty text; an id outside the vocabulary fails. A column named as into is replaced."""
    df = df.drop(into)
    prepare(df.sparkSession)
    model = load(model_path)
    shown = []
    for i, (t, k) in enumerate(zip(model.text, model.kind, strict=True)):
        shown.append(b"" if k == CONTROL else model.unknown_text.encode() if k == UNKNOWN else bytes([int(t[3:5], 16)]) if k == BYTE else t.replace(SPACE, " ").encode())
    silent = frozenset(i for i, k in enumerate(model.kind) if k == CONTROL)
    spaced = frozenset(i for i, t in enumerate(model.text) if model.prefix and model.kind[i] == NORMAL and t.startswith(SPACE))
    shared = df.sparkSession.sparkContext.broadcast((shown, silent, spaced))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in list_slices(batches, ids_col):
            texts = []
            for row in batch.column(ids_col):
                ids = [] if not row.is_valid else row.values.to_numpy(zero_copy_only=False).tolist()
                if ids and min(ids) < 0:
                    raise IndexError("an id below 0")
                texts.append(text_of(ids, *tables))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return df.mapInArrow(work, T.StructType([*df.schema.fields, T.StructField(into, T.StringType())]))


def op13(spark, sf_dir, model: str | None = None) -> DataFrame:
    """Ids and round trip of every document, as digests. The vocabulary's path is a parameter."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = decode(encode(docs, model, packed="packed"), model)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
