"""Genomes and liftover chains: a Spark data source for 2bit files, and a reader for chain files.

    spark.dataSource.register(TwoBitSource)
    spark.read.format("twobit").option("chunk", 10000).load("/shared/genome.2bit")   # contig, chunk_start, seq
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "contig string, chunk_start long, seq string"
_FOUR = ["".join("TCAG"[b >> s & 3] for s in (6, 4, 2, 0)) for b in range(256)]
#: Bases that one partition reads.
SPAN = 5_000_000


def _index(f) -> tuple[str, dict[str, int]]:
    head = f.read(16)
    order = "<" if head[:4] == b"\x43\x27\x41\x1a" else ">"
    magic, version, count, _ = struct.unpack(order + "4I", head)
    if magic != 0x1A412743 or version != 0:
        raise ValueError("no 2bit file")
    out = {}
    for _ in range(count):
        name = f.read(f.read(1)[0]).decode()
        out[name] = struct.unpack(order + "I", f.read(4))[0]
    return order, out


def _layout(f, order: str, at: int) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]], int]:
    """(size, unknown stretches, lower-case stretches, place of the packed bases) of the contig at a place of the file."""
    f.seek(at)
    number = lambda n=1: struct.unpack(f"{order}{n}I", f.read(4 * n))
    size, stretches = number()[0], []
    for _ in range(2):
        n = number()[0]
        starts, sizes = number(n), number(n)
        stretches.append(list(zip(starts, sizes, strict=True)))
    f.read(4)
    return size, stretches[0], stretches[1], f.tell()


def _bases(f, packed: int, size: int, unknown, lower, start: int, end: int) -> str:
    end = min(end, size)
    f.seek(packed + start // 4)
    raw = "".join(_FOUR[b] for b in f.read((end + 3) // 4 - start // 4))
    seq = list(raw[start % 4 : start % 4 + end - start])
    for stretches, change in ((unknown, lambda _: "N"), (lower, str.lower)):
        for s, n in stretches:
            for i in range(max(s, start), min(s + n, end)):
                seq[i - start] = change(seq[i - start])
    return "".join(seq)


class _Span(InputPartition):
    def __init__(self, contig: str, at: int, start: int, end: int):
        self.contig, self.at, self.start, self.end = contig, at, start, end


class TwoBitReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.chunk = options["path"].removeprefix("file:"), int(options.get("chunk", 10_000))

    def partitions(self):
        span, out = max(self.chunk, SPAN // self.chunk * self.chunk), []
        with open(self.path, "rb") as f:
            order, index = _index(f)
            for name, at in index.items():
                f.seek(at)
                size = struct.unpack(order + "I", f.read(4))[0]
                out += [_Span(name, at, s, min(size, s + span)) for s in range(0, size, span)]
        return out

    def read(self, partition) -> Iterator[tuple]:
        with open(self.path, "rb") as f:
            order, _ = _index(f)
            size, unknown, lower, packed = _layout(f, order, partition.at)
            for start in range(partition.start, partition.end, self.chunk):
                yield partition.contig, start, _bases(f, packed, size, unknown, lower, start, min(start + self.chunk, partition.end))


class TwoBitSource(DataSource):
    """Options: path, chunk (bases in a row). A contig is read in spans, each a partition."""

    @classmethod
    def name(cls) -> str:
        return "twobit"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return TwoBitReader(self.options)


def resolve_contigs(wanted: DataFrame, contigs: DataFrame) -> DataFrame:
    """(contig) x (contig) -> (contig, genome_contig): itself, chrM for MT, with chr, or the first that holds it without .1; null if none.

    The rules give ranked candidates, which are looked up by equality; the best one known is taken. For the last rule
    every known name is listed under each of its parts, as names are short. Both tables have a row for each contig name,
    not for each base.
    """
    names = wanted.select("contig").filter("contig is not null").distinct()
    known = contigs.select(F.col("contig").alias("genome_contig")).filter("genome_contig is not null").distinct()
    c = F.col("contig")
    exact = F.array(F.struct(F.lit(0).alias("rule"), c.alias("key")), F.struct(F.lit(1).alias("rule"), F.when(c == "MT", F.lit("chrM")).alias("key")), F.struct(F.lit(2).alias("rule"), F.concat(F.lit("chr"), c).alias("key")))
    asked = names.select("contig", F.explode(exact).alias("x")).select("contig", "x.rule", "x.key").filter("key is not null")
    found = asked.join(known, asked["key"] == known["genome_contig"]).select("contig", "rule", "genome_contig")
    bare = names.filter(F.length(c) > 2).select("contig", F.regexp_replace(c, r"\.1$", "").alias("part"))
    n = F.length("genome_contig")
    places = F.explode(F.sequence(F.lit(1), n)).alias("from")
    parts = known.filter(n > 0).select("genome_contig", places).select("genome_contig", "from", F.explode(F.sequence(F.lit(1), n - F.col("from") + 1)).alias("size"))
    parts = parts.select("genome_contig", F.expr("substring(genome_contig, from, size)").alias("part")).distinct()
    partly = bare.join(parts, "part").select("contig", F.lit(3).alias("rule"), "genome_contig")
    best = found.unionByName(partly).groupBy("contig").agg(F.min(F.struct("rule", "genome_contig"))["genome_contig"].alias("genome_contig"))
    return names.join(best, "contig", "left")


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of a chain file: t_contig, t_start, t_end, q_contig, q_start, q_size, q_strand, score, chain.

    score is the chain's, chain its place among the chains of the file, which breaks ties of the score. Chains are
    separated by empty lines; a head without all its fields, and lines that are no numbers, fail.
    """
    texts = spark.read.text(path, lineSep="\n\n").select("value", F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("k"))
    chains = texts.withColumn("l", F.filter(F.split("value", "\n"), lambda x: (x != "") & ~x.startswith("#"))).filter(F.size("l") > 1)
    chains = chains.withColumn("chain", F.struct("at", "k"))
    head = F.split(F.col("l")[0], r"\s+")
    zero = F.lit(0).cast("long")
    state = F.struct(zero.alias("t"), zero.alias("q"), F.array().cast("array<struct<t:bigint,q:bigint,n:bigint>>").alias("out"))

    def step(st, line):
        f = F.split(line, r"\s+")
        n, dt, dq = f[0].cast("long"), F.coalesce(F.get(f, F.lit(1)).cast("long"), zero), F.coalesce(F.get(f, F.lit(2)).cast("long"), zero)
        block = F.struct(st["t"].alias("t"), st["q"].alias("q"), n.alias("n"))
        return F.struct((st["t"] + n + dt).alias("t"), (st["q"] + n + dq).alias("q"), F.concat(st["out"], F.array(block)).alias("out"))

    rows = chains.select(head.alias("h"), "chain", F.explode(F.aggregate(F.slice("l", 2, 100_000_000), state, step, lambda st: st["out"])).alias("b"))
    t, q = F.col("h")[5].cast("long") + F.col("b.t"), F.col("h")[10].cast("long") + F.col("b.q")
    return rows.select(F.col("h")[2].alias("t_contig"), t.alias("t_start"), (t + F.col("b.n")).alias("t_end"), F.col("h")[7].alias("q_contig"), q.alias("q_start"), F.col("h")[8].cast("long").alias("q_size"), F.col("h")[9].alias("q_strand"), F.col("h")[1].cast("double").alias("score"), "chain")
