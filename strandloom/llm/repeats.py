"""Suffix-array dedup: every byte covered by a 100-byte string that also starts earlier is removed.

Suffixes are dealt out so that equal 100-byte strings meet: each string goes by the least hash of its 32-byte pieces
(leftmost among equals), and strings that follow each other with the same piece travel as one stretch of text. A
stretch whose text has been seen before under its piece is removed without a look at its suffixes; a piece with a single
text needs none either. Only stretches that share a piece but differ are sorted: each task orders the suffixes of its
share of the pieces by the difference cover of 3 (sampled triples, names, recursion, merge of the rest) and compares
adjacent prefixes. A piece with very many different stretches is not sorted in one task: its strings are dealt out by
their own hash. So the sorted text is a small part of the input, and no result is lost.

What is marked refers to the input, not to what is left; marks of a document are merged and cut out at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, prepare, raw_bytes, shuffle_partitions, stored
from .shingles import mix64
from .suffixes import suffix_order

LENGTH = 100
PIECE = 32
#: Different stretches of one piece beyond which its strings are dealt out by their own hash.
MANY = 20_000
#: Text that a task sorts at a time, if no single piece has more.
SORTED_BYTES = 4 << 20
_NULL = -(1 << 63)
_TABLE = mix64(np.arange(1, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BACK)):
            p = np.full(max(n, 1 << 21), base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def _grams(body: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of the size bytes from each place on, by doubling; size is a power of two."""
    h, k = _TABLE[body.astype(np.int64) + 256 * salt], 1
    while k < size:
        h = mix64(h[:-k] * _BASE + h[k:] + np.uint64(k)) if len(h) > k else h[:0]
        k *= 2
    return h


def stretches(body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first string, number of strings, piece, content) of the stretches of rows laid end to end; places count in body."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if len(body) < LENGTH:
        return none
    piece = _grams(body, PIECE)
    # The upper bits order, the lower ones say where: the least is the leftmost among equals.
    key = (piece & np.uint64(((1 << 64) - 1) ^ ((1 << 28) - 1))) | np.arange(len(piece), dtype=np.uint64)
    window, k = LENGTH - PIECE + 1, 1
    least = key
    while 2 * k <= window:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    least = np.minimum(least[: len(body) - LENGTH + 1], least[window - k : window - k + len(body) - LENGTH + 1])
    at = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    valid = np.flatnonzero(row[: len(at)] == row[LENGTH - 1 :])
    if not len(valid):
        return none
    at = at[valid]
    cut = np.ones(len(valid), bool)
    cut[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
    begin = np.flatnonzero(cut)
    first, n = valid[begin], np.diff(begin, append=len(valid))
    up, down = _powers(len(body) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[body.astype(np.int64) + 256] * up[: len(body)])])
    size = n + LENGTH - 1
    content = mix64((sums[first + size] - sums[first]) * down[first] + size.astype(np.uint64))
    return row[first], first, n, piece[at[begin]], content


#: Bytes of a longer text that are looked at together; neighbouring parts overlap by all but one byte of a string.
PART = 2 << 20


def _by_parts(body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """stretches() of rows of any length: a stretch that a part ends in is two, which are compared like others that differ."""
    out = []
    step = PART - LENGTH + 1
    for row in range(len(off) - 1) if len(body) > PART else ():
        for at in range(off[row], max(off[row] + 1, off[row + 1] - LENGTH + 1), step):
            part = body[at : min(off[row + 1], at + PART)]
            _, first, n, piece, content = stretches(part, np.array([0, len(part)]))
            out.append((np.full(len(first), row), first + at, n, piece, content))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else stretches(body, off)


_FOUND = ["piece", "content", "doc", "twin", "at", "n", "again"]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of all texts. again: the same stretch starts earlier in this batch, so nothing else need see it."""
    for batch in pieces(batches, limit=2 << 20):
        body, off = raw_bytes(batch.column("text"))
        row, first, n, piece, content = _by_parts(body, off)
        doc, twin = (batch.column(c).to_numpy()[row] for c in ("doc", "twin"))
        at = first - off[row]
        order = np.lexsort((at, twin, doc, content, piece))
        doc, twin, at, n, piece, content = doc[order], twin[order], at[order], n[order], piece[order], content[order]
        same = np.zeros(len(doc), bool)
        same[1:] = (piece[1:] == piece[:-1]) & (content[1:] == content[:-1])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(doc)))) if len(doc) else np.zeros(0, int)
        again = same & ((doc != doc[head]) | (twin != twin[head]) | (at != at[head]))
        cols = [piece.view(np.int64), content.view(np.int64), doc, twin, at.astype(np.int32), n.astype(np.int32), again]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], _FOUND)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each stretch asked for: rows (text, doc, twin, wanted) -> a row for each stretch."""
    for whole in batches:
        for k in range(0, whole.num_rows, 64):
            batch = whole.slice(k, 64)
            out: dict[str, list] = {"piece": [], "many": [], "doc": [], "twin": [], "at": [], "n": [], "body": []}
            for text, doc, twin, wanted in zip(*(batch.column(c).to_pylist() for c in ("text", "doc", "twin", "wanted")), strict=True):
                raw = text.encode()
                for w in wanted:
                    out["piece"].append(w["piece"])
                    out["many"].append(w["many"])
                    out["doc"].append(doc)
                    out["twin"].append(twin)
                    out["at"].append(w["at"])
                    out["n"].append(w["n"])
                    out["body"].append(raw[w["at"] : w["at"] + w["n"] + LENGTH - 1])
            yield pa.RecordBatch.from_arrays([pa.array(out["piece"], pa.int64()), pa.array(out["many"], pa.bool_()), pa.array(out["doc"], pa.int64()), pa.array(out["twin"], pa.int64()), pa.array(out["at"], pa.int32()), pa.array(out["n"], pa.int32()), pa.array(out["body"], pa.binary())], list(out))


def _equal_prefixes(body: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the LENGTH bytes from a on equal those from b on."""
    eight = np.zeros(len(body), np.uint64)
    padded = np.concatenate([body, np.zeros(8, np.uint8)])
    for k in range(8):
        eight |= padded[k : k + len(body)].astype(np.uint64) << np.uint64(8 * k)
    same = np.ones(len(a), bool)
    for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        left = np.flatnonzero(same)
        same[left] = eight[a[left] + k] == eight[b[left] + k]
    return same


def repeated_starts(bodies: list[bytes], doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of the LENGTH-byte strings within bodies that start earlier too, in order; bodies begin at (doc, at)."""
    body = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.array([len(x) for x in bodies])
    begin = np.cumsum(size) - size
    order = suffix_order(body, LENGTH)
    owner = np.repeat(np.arange(len(bodies)), size)
    order = order[order + LENGTH <= (begin + size)[owner[order]]]  # whole strings only
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group = np.cumsum(np.concatenate([[0], ~_equal_prefixes(body, order[1:], order[:-1])]))
    d, p = doc[owner[order]], at[owner[order]] + order - begin[owner[order]]
    by = np.lexsort((p, d, group))
    d, p, group = d[by], p[by], group[by]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), np.arange(len(group)), 0))
    late = (d != d[head]) | (p != p[head])
    d, p = d[late], p[late]
    by = np.lexsort((p, d))
    return d[by], p[by]


def _runs(d: np.ndarray, p: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    """Covered bytes (doc, twin, from, to) of starts in order; d are places in owner."""
    cut = np.ones(len(d), bool)
    cut[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + LENGTH)
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(d)) - 1
    return pa.RecordBatch.from_arrays([pa.array(owner["doc"][d[first]], pa.int64()), pa.array(owner["twin"][d[first]], pa.int64()), pa.array(p[first], pa.int64()), pa.array((p[last] if len(d) else p) + LENGTH, pa.int64())], ["doc", "twin", "lo", "hi"])


def _sort_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of piece: whole pieces together, SORTED_BYTES at a time."""
    held: list[tuple] = []
    size, last = 0, None

    def done():
        owner, number = np.unique(np.array([h[:2] for h in held], [("doc", np.int64), ("twin", np.int64)]), return_inverse=True)
        d, p = repeated_starts([h[3] for h in held], number.astype(np.int64), np.array([h[2] for h in held], np.int64))
        return _runs(d, p, owner)

    for batch in batches:
        for piece, doc, twin, at, body in zip(*(batch.column(c).to_pylist() for c in ("piece", "doc", "twin", "at", "body")), strict=True):
            if size > SORTED_BYTES and piece != last:
                yield done()
                held, size = [], 0
            held.append((doc, twin, at, body))
            size, last = size + len(body), piece
    if held:
        yield done()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of each stretch with two hashes of its own."""
    for whole in batches:
        for k in range(0, whole.num_rows, 2000):
            batch = whole.slice(k, 2000)
            doc, twin, at, n = (batch.column(c).to_numpy() for c in ("doc", "twin", "at", "n"))
            bodies = batch.column("body").to_pylist()
            body = np.frombuffer(b"".join(bodies), np.uint8)
            size = n.astype(np.int64) + LENGTH - 1
            begin = np.cumsum(size) - size
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(begin, n) + step
            hashes = []
            for salt in (0, 1):
                g = _grams(body, 64, salt)
                hashes.append(mix64(g[place] * _BASE + g[place + LENGTH - 64]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[0]), pa.array(hashes[1]), pa.array(np.repeat(doc, n)), pa.array(np.repeat(twin, n)), pa.array((np.repeat(at, n) + step).astype(np.int32))], ["w1", "w2", "doc", "twin", "at"])


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc long; twin long; text; none null) -> (doc, twin, lo, hi): bytes to remove, half open; rows may overlap and touch.

    doc and twin name one text, and order the documents. Rows that share both are one document.
    """
    spark = docs.sparkSession
    prepare(spark)
    found = docs.mapInArrow(_find, "piece long, content long, doc long, twin long, at int, n int, again boolean")
    dealt = F.when(F.col("again"), F.xxhash64("doc", "twin", "at")).otherwise(F.col("piece"))
    found = found.withColumn("key", dealt)
    text = Window.partitionBy("key", "content", "again").orderBy("doc", "twin", "at")
    here = F.struct("doc", "twin", "at")
    found = found.repartition(shuffle_partitions(spark), "key").withColumn("first", F.first(here).over(text))
    every = Window.partitionBy("key")
    found = found.withColumn("late", F.col("again") | (F.col("first") < here))
    # Of a piece: the numbers of its different texts, and whether there are two at all.
    found = found.withColumn("texts", F.sum(F.when(F.col("late") | F.col("again"), 0).otherwise(1)).over(every)).filter("late or texts > 1")
    marks = stored(found.select("piece", "doc", "twin", "at", "n", "late", F.col("texts").alias("texts")), "stretches")
    sure = marks.filter("late").select("doc", "twin", F.col("at").cast("long").alias("lo"), (F.col("at") + F.col("n") + LENGTH - 1).cast("long").alias("hi"))
    wanted = marks.filter("not late").groupBy("doc", "twin").agg(F.collect_list(F.struct("piece", (F.col("texts") > MANY).alias("many"), "at", "n")).alias("wanted"))
    texts = docs.join(wanted, ["doc", "twin"]).dropDuplicates(["doc", "twin"]).select("text", "doc", "twin", "wanted")
    texts = stored(texts.mapInArrow(_texts, "piece long, many boolean, doc long, twin long, at int, n int, body binary"), "stretch-texts")
    shares = texts.filter("not many").select("piece", "doc", "twin", "at", "body").repartition(shuffle_partitions(spark), "piece").sortWithinPartitions("piece")
    seen = shares.mapInArrow(_sort_shares, "doc long, twin long, lo long, hi long")
    alone = texts.filter("many").mapInArrow(_strings, "w1 long, w2 long, doc long, twin long, at int")
    least = alone.groupBy("w1", "w2").agg(F.min(here).alias("first"))
    late = alone.join(least, ["w1", "w2"]).filter(F.col("first") < here)
    rare = late.select("doc", "twin", F.col("at").cast("long").alias("lo"), (F.col("at") + LENGTH).cast("long").alias("hi"))
    return sure.unionAll(seen).unionAll(rare)


def cut_out(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs) of raw without spans."""
    kept, at, removed, runs = [], 0, 0, 0
    end = -1
    for lo, hi in sorted(spans):
        hi = min(hi, len(raw))
        if hi <= lo:
            continue
        if lo > end:
            kept.append(raw[max(at, 0) : lo])
            runs += 1
            removed += hi - lo
            at = end = hi
        elif hi > end:
            removed += hi - end
            at = end = hi
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def _named(rows: DataFrame) -> DataFrame:
    """rows + twin: 0, or a hash of the text where the id is null or has several texts; so that most rows travel small."""
    text = F.xxhash64("text")
    shared = rows.filter("doc_id is not null").groupBy("doc").agg(F.min(text).alias("lo"), F.max(text).alias("hi")).filter("lo < hi")
    shared = stored(shared.select("doc", F.lit(True).alias("shared")), "shared-ids")
    return rows.join(shared, "doc", "left").withColumn("twin", F.when(F.col("doc_id").isNull() | F.col("shared"), text).otherwise(F.lit(0).cast("long"))).drop("shared")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept binary). Null text is empty; a null doc_id comes before all others.

    Equal rows are one document, not copies of each other. Unlike texts that share an id, or have none, are documents of
    their own, in the order of a hash of the text. Texts under 100 bytes lose nothing. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _named(rows.withColumn("doc", F.coalesce("doc_id", F.lit(_NULL))))
    spans = repeated_bytes(rows.select("doc", "twin", "text")).groupBy("doc", "twin").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    both = rows.join(spans, ["doc", "twin"], "left").select("doc_id", "text", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            raws = [t.encode() for t in batch.column("text").to_pylist()]
            out = []
            for raw, spans in zip(raws, batch.column("spans"), strict=True):
                if not spans.is_valid:
                    out.append((raw, 0, 0))
                    continue
                v = spans.values
                out.append(cut_out(raw, list(zip(v.field("lo").to_pylist(), v.field("hi").to_pylist(), strict=True))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(r) for r in raws], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), pa.array([o[0] for o in out], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return both.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op2(spark, sf_dir) -> DataFrame:
    """What is left of every document without the bytes that a 100-byte string with an earlier start covers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
