"""Aligned reads: a Spark data source for BAM files, and a reader for SAM text.

    read_bam(spark, "/shared/sample.bam", min_mapq=40).filter("contig = '7' and pos < 2000 and end > 1000")

A file is cut into ranges of bytes, each a task, which finds the first record that begins in its range and decodes its
records as a stream; so neither memory nor a task's time grows with the file. Conditions on contig, pos, end and mapq reach
the source: where a file has an index (.bai), only the blocks of that region are
read. ordinal is a record's virtual place in its file (see bgzf): it rises with the order of records, is another for
each record, and does not depend on how the file is cut.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..staging import importable
from .bgzf import POSITIONS, Index, Stream, first_record

SCHEMA = (
    "sample string, ordinal long, qname string, flag int, contig string, pos long, end long, mapq int, cigar array<struct<op:int,len:int>>, "
    "seq string, qual array<int>, sa string"
)
# Fixed values of the format: base codes, letters of operations, sizes of tag values, operations that use the reference.
_BASES = "=ACMGRSVTWYHKDBN"
_OPERATIONS = "MIDNSHP=X"
_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_ON_REFERENCE, _ON_READ = (0, 2, 3, 7, 8), (0, 1, 4, 7, 8)
_PAIRS = [a + b for a in _BASES for b in _BASES]
#: Bytes of a file that a task reads, and records of a batch.
SPLIT, BATCH = 32 << 20, 4096
_ARROW = pa.schema(
    [("sample", pa.string()), ("ordinal", pa.int64()), ("qname", pa.string()), ("flag", pa.int32()), ("contig", pa.string()), ("pos", pa.int64()), ("end", pa.int64()), ("mapq", pa.int32()),
     ("cigar", pa.list_(pa.struct([("op", pa.int32()), ("len", pa.int32())]))), ("seq", pa.string()), ("qual", pa.list_(pa.int32())), ("sa", pa.string())]
)


def _supplementary(tags: bytes) -> str | None:
    at = 0
    while at + 3 <= len(tags):
        name, kind = tags[at : at + 2], chr(tags[at + 2])
        at += 3
        if kind in "ZH":
            end = tags.index(b"\0", at)
            if name == b"SA":
                return tags[at:end].decode()
            at = end + 1
        elif kind == "B":
            at += 5 + _SIZES[chr(tags[at])] * struct.unpack("<i", tags[at + 1 : at + 5])[0]
        else:
            at += _SIZES[kind]
    return None


def _tags_end(tags: bytes) -> bool:
    """Whether tags follow one another up to the end."""
    at = 0
    while at + 3 <= len(tags):
        kind = chr(tags[at + 2])
        at += 3
        if kind in "ZH":
            if (at := tags.find(b"\0", at) + 1) == 0:
                return False
        elif kind == "B":
            if at + 5 > len(tags) or chr(tags[at]) not in _SIZES:
                return False
            at += 5 + _SIZES[chr(tags[at])] * struct.unpack("<I", tags[at + 1 : at + 5])[0]
        elif kind in _SIZES:
            at += _SIZES[kind]
        else:
            return False
    return at == len(tags)


@dataclass
class Header:
    names: list[str]
    sizes: list[int]
    body: int  # virtual place of the first record

    @classmethod
    def read(cls, f, path: str) -> Header:
        s = Stream(f, 0)
        number = lambda: struct.unpack("<i", s.take(4))[0]
        if s.take(4) != b"BAM\1":
            raise ValueError(f"{path} is no BAM file")
        s.take(number())
        names, sizes = [], []
        for _ in range(number()):
            names.append(s.take(number())[:-1].decode())
            sizes.append(number())
        return cls(names, sizes, s.tell())

    def plausible(self, rec: bytes) -> bool:
        """Whether bytes are a whole record of this file: its parts must fit its size, and its values their ranges."""
        ref, pos, n_name, _, _, n_ops, _, n_seq, other, other_pos, _ = struct.unpack("<iiBBHHHiiii", rec[:32])
        n = len(self.names)
        if not (-1 <= ref < n and -1 <= other < n and -1 <= pos < (self.sizes[ref] if ref >= 0 else 1 << 31) and -1 <= other_pos < (self.sizes[other] if other >= 0 else 1 << 31)):
            return False
        ops, packed = 32 + n_name, 32 + n_name + 4 * n_ops
        tags = packed + (n_seq + 1) // 2 + n_seq
        if n_name < 2 or tags > len(rec) or rec[ops - 1] or not all(33 <= c <= 126 for c in rec[32 : ops - 1]):
            return False
        cigar = struct.unpack(f"<{n_ops}I", rec[ops:packed])
        if any(v & 15 > 8 for v in cigar) or (n_ops and n_seq and sum(v >> 4 for v in cigar if v & 15 in _ON_READ) != n_seq):
            return False
        return _tags_end(rec[tags:])


def _decoded(rec: bytes, names: list[str], sample: str, ordinal: int) -> tuple:
    ref, pos, n_name, mapq, _, n_ops, flag, n_seq, *_ = struct.unpack("<iiBBHHHiiii", rec[:32])
    at = 32 + n_name
    ops = [(v & 15, v >> 4) for v in struct.unpack(f"<{n_ops}I", rec[at : at + 4 * n_ops])]
    at += 4 * n_ops
    half = (n_seq + 1) // 2
    seq = "".join(map(_PAIRS.__getitem__, rec[at : at + half]))[:n_seq]
    at += half
    raw = rec[at : at + n_seq]
    qual = None if not n_seq or raw[0] == 255 else list(raw)
    end = pos + sum(n for op, n in ops if op in _ON_REFERENCE) if ops else None
    tags = rec[at + n_seq :]
    return (sample, ordinal, rec[32 : 31 + n_name].decode(), flag, names[ref] if ref >= 0 else None, pos, end, mapq, ops or None, seq or None, qual, _supplementary(tags))


@dataclass
class Range(InputPartition):
    """Records of a file that begin in [start, end) of virtual places; exact tells that a record begins at start."""

    path: str
    start: int
    end: int
    exact: bool = False


@dataclass
class Region:
    """What conditions leave: contigs (None: all), and positions that a record must touch."""

    contigs: frozenset[str] | None = None
    start: int = 0
    end: int = 1 << POSITIONS
    min_mapq: int = 0

    def narrow(self, f: Filter) -> None:
        """Take in a condition that is understood. Spark checks every condition again, so others are passed over."""
        column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        contigs = frozenset([f.value]) if isinstance(f, EqualTo) else frozenset(f.value) if isinstance(f, In) else None
        if column == "contig" and contigs is not None:
            self.contigs = contigs if self.contigs is None else self.contigs & contigs
        elif column == "pos" and isinstance(f, LessThan | LessThanOrEqual):
            self.end = min(self.end, f.value + isinstance(f, LessThanOrEqual))
        elif column in ("pos", "end") and isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.start = max(self.start, f.value - (column == "end"))
        elif column == "pos" and isinstance(f, EqualTo):
            self.start, self.end = max(self.start, f.value), min(self.end, f.value + 1)
        elif column == "mapq" and isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.min_mapq = max(self.min_mapq, f.value + isinstance(f, GreaterThan))


def ranges(path: str, region: Region, split: int = SPLIT) -> list[Range]:
    """A file's ranges: of its bytes, or, with an index and contigs, of the chunks of the region."""
    index = next((p for p in (path + ".bai", path.removesuffix(".bam") + ".bai") if os.path.exists(p)), None)
    if region.contigs is not None and index:
        with open(path, "rb") as f, open(index, "rb") as i:
            names, known = Header.read(f, path).names, Index.read(i)
        chunks = sorted(c for n, name in enumerate(names) if name in region.contigs for c in known.chunks(n, region.start, region.end))
        apart: list[tuple[int, int]] = []
        for a, b in chunks:  # no record is read twice
            if apart and a <= apart[-1][1]:
                apart[-1] = (apart[-1][0], max(b, apart[-1][1]))
            else:
                apart.append((a, b))
        return [r for a, b in apart for r in _cut(path, a, b, split)]
    size = os.path.getsize(path)
    return [Range(path, at << 16, min(size, at + split) << 16) for at in range(0, size, split)]


def _cut(path: str, start: int, end: int, split: int) -> Iterator[Range]:
    """A chunk of the index in pieces of about split bytes; only the first begins with a record for sure."""
    exact = True
    while start < end:
        to = min(end, ((start >> 16) + split) << 16)
        yield Range(path, start, to, exact)
        start, exact = to, False


def records(part: Range, sample: str, region: Region) -> Iterator[tuple]:
    """The records that begin in a range and may be of the region, in the order of the file."""
    with open(part.path, "rb") as f:
        header = Header.read(f, part.path)
        start = max(part.start, header.body)
        if start > header.body and not part.exact:
            start = first_record(f, part.start >> 16, (part.end + 0xFFFF) >> 16, header.plausible)
        if start is None:
            return
        s = Stream(f, start)
        while (at := s.tell()) < part.end and (size := s.take(4)):
            rec = s.take(struct.unpack("<i", size)[0])
            ref, mapq = struct.unpack("<i", rec[:4])[0], rec[9]
            if mapq < region.min_mapq or (region.contigs is not None and (ref < 0 or header.names[ref] not in region.contigs)):
                continue
            yield _decoded(rec, header.names, sample, at)


def write_index(path: str) -> str:
    """Write the index of a file that is sorted by position beside it (.bai): its bins, chunks and windows. Returns its path."""
    with open(path, "rb") as f:
        header = Header.read(f, path)
        index, s, last = Index(len(header.names)), Stream(f, header.body), (0, 0)
        at = s.tell()
        while size := s.take(4):
            rec, to = s.take(struct.unpack("<i", size)[0]), s.tell()
            ref, pos = struct.unpack("<ii", rec[:8])
            if ref >= 0:
                if (ref, pos) < last:
                    raise ValueError(f"{path} is not sorted by position")
                last = (ref, pos)
                _, _, _, _, _, _, end, *_ = _decoded(rec, header.names, "", 0)
                index.add(ref, max(0, pos), max(1, pos + 1 if end is None else end), at, to)
            at = to
    temporary = f"{path}.bai.{os.getpid()}"
    with open(temporary, "wb") as f:
        index.write(f)
    os.replace(temporary, path + ".bai")
    return path + ".bai"


def index_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Write the indexes of files in shared storage, a task for each."""
    importable(spark)
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return [r.written for r in rows.mapInPandas(lambda frames: (f.assign(written=[write_index(p) for p in f["path"]])[["written"]] for f in frames), "written string").collect()]


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        contig = options.get("contig")
        self.region = Region(None if contig is None else frozenset([contig]), min_mapq=int(options.get("min_mapq", 0)))

    def partitions(self):
        path = self.options["path"].removeprefix("file:")
        paths = sorted(glob.glob(os.path.join(path, "*.bam"))) if os.path.isdir(path) else sorted(glob.glob(path))
        return [r for p in paths for r in ranges(p, self.region, int(self.options.get("split", SPLIT)))] or [Range("", 0, 0)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        sample = self.options.get("sample") or os.path.basename(partition.path).removesuffix(".bam")
        held: list[tuple] = []
        for row in records(partition, sample, self.region):
            held.append(row)
            if len(held) == BATCH:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)


class PushedReader(BamReader):
    """A reader that Spark tells the conditions on its rows; it needs the setting for that, or Spark refuses it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            self.region.narrow(f)
            yield f


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    columns[8] = [None if ops is None else [{"op": o, "len": n} for o, n in ops] for ops in columns[8]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types, strict=True)], schema=_ARROW)


class BamSource(DataSource):
    """Options: path (file, folder or pattern), sample (default: the file's name), min_mapq, contig, split (bytes of a task), pushdown (true: conditions reach the source)."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (PushedReader if self.options.get("pushdown") == "true" else BamReader)(self.options)


def read_bam(spark: SparkSession, path: str, **options) -> DataFrame:
    """BAM files, with conditions that reach the source: the setting for that is switched on in the session."""
    importable(spark)
    spark.dataSource.register(BamSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("bam").options(pushdown="true", **options).load(path)


def read_sam(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """SAM text with the columns of BAM files, by built-in functions; pos counts from 0. Lines with too few fields are left out."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("@")).withColumn("f", F.split("value", "\t")).filter(F.size("f") >= 11)
    f = lambda i: F.col("f")[i]
    codes = F.create_map(*(F.lit(x) for i, op in enumerate(_OPERATIONS) for x in (op, i)))
    ops = F.transform(F.regexp_extract_all(f(5), F.lit("[0-9]+[MIDNSHP=X]"), F.lit(0)), lambda x: F.struct(F.element_at(codes, F.right(x, F.lit(1))).alias("op"), x.alias("x")))
    ops = F.transform(ops, lambda o: F.struct(o["op"].alias("op"), F.regexp_extract(o["x"], "[0-9]+", 0).cast("int").alias("len")))
    pos = f(3).cast("long") - 1
    tags = F.filter(F.slice(F.col("f"), 12, F.size("f")), lambda x: x.startswith("SA:Z:"))
    along = F.aggregate("cigar", F.lit(0).cast("long"), lambda acc, c: acc + F.when(c["op"].isin(*_ON_REFERENCE), c["len"]).otherwise(0))
    known = lambda c, none: F.when(c != none, c)
    rows = lines.select(
        F.lit(sample).alias("sample"), F.monotonically_increasing_id().alias("ordinal"), f(0).alias("qname"), f(1).cast("int").alias("flag"), known(f(2), "*").alias("contig"), pos.alias("pos"),
        f(4).cast("int").alias("mapq"), F.when(F.size(ops) > 0, ops).alias("cigar"), known(f(9), "*").alias("seq"),
        F.when(f(10) != "*", F.transform(F.filter(F.split(f(10), ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)).alias("qual"), F.substr(F.get(tags, F.lit(0)), F.lit(6)).alias("sa"),
    )
    return rows.withColumn("end", F.when(F.col("cigar").isNotNull(), F.col("pos") + along)).select("sample", "ordinal", "qname", "flag", "contig", "pos", "end", "mapq", "cigar", "seq", "qual", "sa")
