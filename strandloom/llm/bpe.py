"""Byte-level BPE: encoding by ranked merges over the bytes of distinct words, decoding by joining pieces.

The text is cut by the tokenizer's pattern, and each distinct word that a task meets is folded once: of all adjacent
pairs the one with the lowest rank is merged, until no pair has a rank. The rank map (a few MB whatever the data) is
read once from a path and broadcast. A worker remembers a bounded number of words; words beyond it are folded again.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import list_slices, pieces, prepare

#: Words that a worker remembers, in each of two generations.
REMEMBERED = 150_000
#: Ids whose pieces are put together at once.
PLACES = 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file (base64 piece, space, rank in each line) as piece -> rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def portable(pattern: str) -> str:
    """The pattern with Unicode's White_Space for \\s and \\S, as the tokenizer libraries read it."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def fold_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: ranked merges, leftmost first among equal ranks."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 100:
        return _fold_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    get, none = ranks.get, 1 << 60
    pair = [get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pair:
        low = min(pair)
        if low == none:
            break
        i = pair.index(low)
        parts[i] += parts.pop(i + 1)
        del pair[i]
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long words, with a heap of pairs and links to the neighbours: n log n steps."""
    n = len(word)
    end = list(range(1, n + 1))  # part at i is word[i:end[i]]
    before = list(range(-1, n - 1))
    live = bytearray(b"\x01") * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        if not live[i] or end[i] >= n or end[end[i]] != to:
            continue  # one of the two has changed since
        live[end[i]] = 0
        end[i] = to
        if to < n:
            before[to] = i
            if (r := ranks.get(word[i : end[to]])) is not None:
                heapq.heappush(heap, (r, i, end[to]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:to])) is not None:
            heapq.heappush(heap, (r, p, to))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class _Words(dict):
    """word -> its ids as int32 bytes, folded on demand; the older of two generations goes when the newer is full."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.old = ranks, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = np.array(fold_word(word.encode(), self.ranks), np.int32).tobytes()
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


_WORKER: list[_Words] = []


def _words(ranks: dict[bytes, int]) -> _Words:
    """The worker's words; those of another vocabulary are dropped."""
    if not _WORKER or _WORKER[0].ranks is not ranks:
        _WORKER[:] = [_Words(ranks)]
    return _WORKER[0]


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", into: str = "ids") -> DataFrame:
    """df without text_col + into: array<int>. A null or empty text has an empty array; special tokens are ordinary text.

    Every text is encoded whole; a word of any length is folded. Rows are independent: repeated rows get equal ids, an
    empty table gives no rows. A column of df that is named as into is replaced.
    """
    spark = df.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(load_ranks(ranks_path))
    pattern = portable(pattern)
    keep = [c for c in df.columns if c not in (text_col, into)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        get = _words(shared.value).__getitem__
        for batch in pieces(batches, text_col):
            rows = [b"".join(map(get, find(t))) if t else b"" for t in batch.column(text_col).to_pylist()]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int64).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, into])

    fields = [df.schema[c] for c in keep]
    return df.mapInArrow(work, T.StructType([*fields, T.StructField(into, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """df + into: binary, the pieces of the ids one after another. Null or no ids give no bytes; an unknown id fails. A column named as into is replaced."""
    spark = df.sparkSession
    df = df.drop(into)
    prepare(spark)
    by_id = {i: p for p, i in load_ranks(ranks_path).items()}
    table = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    lengths = np.array([len(p) for p in table], np.int64)
    shared = spark.sparkContext.broadcast((np.frombuffer(b"".join(table), np.uint8), np.cumsum(lengths) - lengths, lengths))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, starts, sizes = shared.value
        for batch in list_slices(batches, ids_col):
            lists = batch.column(ids_col)
            if lists.null_count:
                lists = pa.array(lists.to_pylist(), lists.type).fill_null([])
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            rows = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            size = sizes[ids]
            ends = np.concatenate([[0], np.cumsum(size)])
            # The pieces of a long list are put together a part at a time.
            parts = [slice(at, at + PLACES) for at in range(0, len(ids), PLACES)]
            data = b"".join(body[np.repeat(starts[ids[p]] - (ends[:-1][p] - ends[p.start]), size[p]) + np.arange(size[p].sum())].tobytes() for p in parts)
            out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(ends[rows].tobytes()), pa.py_buffer(data)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, into])

    return df.mapInArrow(work, T.StructType([*df.schema.fields, T.StructField(into, T.BinaryType())]))


def op1(spark, sf_dir, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Ids and round trip of every document, as digests. The vocabulary's path and pattern are parameters."""
    if ranks is None or pattern is None:
        import public_tokenizers

        ranks, pattern = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = decode(encode(docs, ranks, pattern), ranks)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
