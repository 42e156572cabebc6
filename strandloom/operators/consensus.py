"""Quality-weighted consensus of sequences."""

from __future__ import annotations

from collections.abc import Iterator
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequence import BASES
from ..staging import importable


#: Letters that a task holds before it passes them on.
HELD = 1 << 22
#: Sequences of a key from which on their weights are added up before they are passed on; fewer are smaller as they are.
MANY = 3


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of sizes."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


CODE = np.full(256, 4, np.uint8)
CODE[[ord(b) for b in BASES]] = range(len(BASES))
LETTER = np.frombuffer("".join(BASES).encode(), np.uint8)
#: What a part of a key has: a sequence and its qualities, as a list or as bytes, or weights as numbers of so many bytes.
PARTS = [("__n", pa.int64()), ("__s", pa.string()), ("__q", pa.list_(pa.int32())), ("__b", pa.binary()), ("__w", pa.binary()), ("__size", pa.int32())]


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _letters(seqs: pa.Array, quals: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of letters and their weights, one sequence behind the other, and lengths; what a sequence or its qualities have more is left out."""
    plain = pa.compute.replace_substring_regex(seqs.fill_null(""), r"[^\x00-\x7F]", "N")
    lengths = pa.compute.binary_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = CODE[np.frombuffer("".join(plain.to_pylist()).encode(), np.uint8)]
    weights = pa.compute.fill_null(quals.flatten(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = _lengths(quals)
    if not (sizes == lengths).all():
        both = np.minimum(sizes, lengths)
        cut = lambda x, of: x[np.repeat(np.cumsum(of) - of, both) + _within(both)]
        codes, weights, lengths = cut(codes, lengths), cut(weights, sizes), both
    return codes, weights, lengths


class _Sums:
    """Weights of the four bases by group and place."""

    def __init__(self, groups: int):
        self.sizes = np.zeros(groups, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]] = []

    def add(self, group: np.ndarray, lengths: np.ndarray, weights: np.ndarray, codes: np.ndarray | None = None) -> None:
        """lengths of the parts of groups; weights of each place, of the base that codes tells or of all four."""
        np.maximum.at(self.sizes, group, lengths)
        self.parts.append((group, lengths, weights, codes))

    def table(self) -> np.ndarray:
        heads = np.cumsum(self.sizes) - self.sizes
        out = np.zeros((int(self.sizes.sum()), len(BASES)), np.int64)
        for group, lengths, weights, codes in self.parts:
            place = np.repeat(heads[group], lengths) + _within(lengths)
            if codes is None:
                np.add.at(out, place, weights)
            else:
                some = codes < len(BASES)
                np.add.at(out.reshape(-1), (place * len(BASES) + codes)[some], weights[some])
        return out


def _passed_on(rows: pa.Table, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The parts of keys: sequences as they are where a key has few, else their weights."""
    rows = rows.combine_chunks()
    column = lambda c: rows[c].chunk(0)
    columns = [rows[k].to_pylist() for k in keys]
    number: dict = {}
    group = np.fromiter((number.setdefault(k, len(number)) for k in (zip(*columns, strict=True) if columns else [()] * rows.num_rows)), np.int64, rows.num_rows)
    count = np.bincount(group, minlength=len(number))
    quals = column("__q")
    values = quals.flatten()
    short = not values.null_count and (not len(values) or (pa.compute.min(values).as_py() >= 0 and pa.compute.max(values).as_py() < 256))

    def batch(at: np.ndarray, **parts: pa.Array) -> pa.RecordBatch:
        at = pa.array(at)
        return pa.RecordBatch.from_arrays([*(column(k).take(at) for k in keys), *(parts.get(c, pa.nulls(len(at), kind)) for c, kind in PARTS)], [*keys, *(c for c, _ in PARTS)])

    few = np.flatnonzero(count[group] < MANY)
    if len(few):
        some = quals.take(pa.array(few))
        if short:
            sizes = np.concatenate([[0], np.cumsum(_lengths(some))]).astype(np.int32)
            bits = pa.compute.is_valid(some)
            as_bytes = pa.Array.from_buffers(pa.binary(), len(few), [None, pa.py_buffer(sizes), pa.py_buffer(some.flatten().to_numpy(zero_copy_only=False).astype(np.uint8))])
            parts = {"__b": pa.compute.if_else(bits, as_bytes, pa.nulls(len(few), pa.binary()))}
        else:
            parts = {"__q": some}
        yield batch(few, __n=pa.array(np.ones(len(few), np.int64)), __s=column("__s").take(pa.array(few)), **parts)
    many = np.flatnonzero(count[group] >= MANY)
    if len(many):
        which, first, of = np.unique(group[many], return_index=True, return_inverse=True)
        codes, weights, lengths = _letters(column("__s").take(pa.array(many)), quals.take(pa.array(many)))
        sums = _Sums(len(which))
        sums.add(of, lengths, weights, codes)
        table = sums.table()
        size = next(n for n in (2, 4, 8) if n == 8 or not table.size or max(table.max(), -table.min()) < 1 << 8 * n - 1)
        offsets = np.concatenate([[0], np.cumsum(sums.sizes)]) * len(BASES) * size
        as_bytes = pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(table.astype(f"<i{size}"))])
        yield batch(many[first], __n=pa.array(count[which]), __w=as_bytes, __size=pa.array(np.full(len(which), size, np.int32)))


def _consensus(rows: pa.Table, keys: list[str], starts: np.ndarray) -> pa.RecordBatch:
    """A row for each group of the parts that begin at starts."""
    rows = rows.combine_chunks()
    column = lambda c: rows[c].chunk(0)
    group = np.zeros(rows.num_rows, np.int64)
    group[starts[1:]] = 1
    group = np.cumsum(group)
    n = np.bincount(group, rows["__n"].to_numpy(), len(starts)).astype(np.int64)
    sums = _Sums(len(starts))
    b, q, w = column("__b"), column("__q"), column("__w")
    as_lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pa.compute.binary_length(b).fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int32)), pa.array(np.frombuffer(b"".join(b.drop_null().to_pylist()), np.uint8).astype(np.int32)))
    for quals, there in ((as_lists, b), (q, q)):
        at = np.flatnonzero(there.is_valid().to_numpy(zero_copy_only=False))
        if len(at):
            codes, weights, lengths = _letters(column("__s").take(pa.array(at)), quals.take(pa.array(at)))
            sums.add(group[at], lengths, weights, codes)
    for size in (2, 4, 8):
        at = np.flatnonzero(pa.compute.equal(column("__size"), size).fill_null(False).to_numpy(zero_copy_only=False))
        if len(at):
            weights = np.frombuffer(b"".join(w.take(pa.array(at)).to_pylist()), f"<i{size}").reshape(-1, len(BASES)).astype(np.int64)
            sums.add(group[at], pa.compute.binary_length(w.take(pa.array(at))).to_numpy().astype(np.int64) // (len(BASES) * size), weights)
    table = sums.table()
    owner, place = np.repeat(np.arange(len(starts)), sums.sizes), _within(sums.sizes)
    lead = 2 * table.max(axis=1, initial=np.iinfo(np.int64).min // 4) - table.sum(axis=1)
    cut = sums.sizes.copy()
    np.minimum.at(cut, owner[lead <= 0], place[lead <= 0])
    kept = place < cut[owner]
    offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(cut)]).astype(np.int32))
    seqs = pa.Array.from_buffers(pa.string(), len(starts), [None, offsets, pa.py_buffer(LETTER[table[kept].argmax(axis=1)])])
    quals = pa.Array.from_buffers(pa.list_(pa.int32()), len(starts), [None, offsets], children=[pa.array(lead[kept].astype(np.int32))])
    # A single sequence stands as it is.
    one, first = pa.array(n == 1), pa.array(starts)
    single = pa.compute.if_else(b.is_valid().take(first), as_lists.take(first), q.take(first))
    return pa.RecordBatch.from_arrays([*(column(k).take(first) for k in keys), pa.compute.if_else(one, column("__s").take(first), seqs), pa.compute.if_else(one, single, quals)], [*keys, "__s", "__q"])


def weighted_consensus(df: DataFrame, keys: list[str], seq: str, qual: str) -> DataFrame:
    """keys, seq, qual: at each place the base with more weight than the other three, weight being the quality's sum.

    The consensus ends at the first place without such a base; its quality is the winner's lead. A single sequence is
    its own consensus; an empty group does not exist, and one whose first place has no winner gives '' and no
    qualities. Other letters have no weight, nor have a null sequence, a null quality and what either is longer.

    A task adds up the weights of its sequences by key and place, a bounded number of letters at a time, and passes on
    a row for each key: few sequences as they are, many as their weights. These are dealt out once, by key, and a task
    goes through its keys in order and holds a batch of rows and the rows of one key, which are no more than there were
    such bounded numbers, times MANY. The input is scanned once.
    """
    importable(df.sparkSession)
    rows = df.select(*keys, F.col(seq).alias("__s"), F.col(qual).cast("array<int>").alias("__q"))
    kinds = [T.StructField(f"__k{n}", rows.schema[k].dataType) for n, k in enumerate(keys)]
    names = [f.name for f in kinds]
    rows = rows.select(*(F.col(k).alias(x) for k, x in zip(keys, names, strict=True)), "__s", "__q")
    of = {"__n": T.LongType(), "__s": T.StringType(), "__q": T.ArrayType(T.IntegerType()), "__b": T.BinaryType(), "__w": T.BinaryType(), "__size": T.IntegerType()}

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                letters += batch.num_rows + max(len(batch["__q"].flatten()), pa.compute.sum(pa.compute.binary_length(batch["__s"])).as_py() or 0)
            if letters > HELD:
                yield from _passed_on(pa.Table.from_batches(held), names)
                held, letters = [], 0
        if held:
            yield from _passed_on(pa.Table.from_batches(held), names)

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last key
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(_changes(held[-1] if held else batch.slice(0, 1), batch, names))
            if len(starts):
                closed = pa.Table.from_batches([*held, batch.slice(0, starts[-1])])
                before = closed.num_rows - int(starts[-1])
                yield _consensus(closed, names, np.concatenate([[0], before + starts[:-1]]))
                held = []
            held.append(batch.slice(starts[-1]) if len(starts) else batch)
        if held:
            yield _consensus(pa.Table.from_batches(held), names, np.array([0]))

    parts = rows.mapInArrow(added, T.StructType([*kinds, *(T.StructField(c, t) for c, t in of.items())]))
    dealt = parts.repartition(*names).sortWithinPartitions(*names) if names else parts.coalesce(1)
    out = dealt.mapInArrow(ended, T.StructType([*kinds, T.StructField("__s", of["__s"]), T.StructField("__q", of["__q"])]))
    return out.select(*(F.col(x).alias(k) for k, x in zip(keys, names, strict=True)), F.col("__s").alias(seq), F.col("__q").alias(qual))


def _changes(before: pa.RecordBatch, batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Whether a row has other keys than the one before it, the first one's being the last of before."""
    out = np.zeros(batch.num_rows, bool)
    for k in keys:
        values = [before[k][-1].as_py(), *batch[k].to_pylist()]
        out |= np.fromiter(map(ne, values[1:], values), bool, len(out))
    return out
