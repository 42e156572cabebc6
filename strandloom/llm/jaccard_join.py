"""Set-similarity join of texts on word shingles by PartEnum signatures, and its connected components.

Sets with a Jaccard similarity of 0.8 or more differ in at most (|a| + |b|) / 9 elements. Sizes are cut into bands such
that two such sets are in the same or in neighbouring bands; each set takes part in its own band and the next. In a
band whose largest set has R elements the bound is k = 2R / 9. The feature domain is cut into n1 first-level parts, so
many that some of them holds at most one of the k differences; each is cut into three second-level parts, and every two
of the three sign together. So two similar sets share a signature, of about six elements each. More parts than that
least number leave room to drop each set's thinnest signatures, which unlike sets share most often.

Steps: equal sets are one node; sets that cannot share enough of the low end of their elements with any other set are
put aside (no link is lost); of the others, signatures that two sets have are kept. Each set is verified first against
one pivot, the most ordinary set among those that share most of its signatures, and then, while still apart, against
others; so a large group of near copies costs a few checks for each member. Signatures whose sets are still in different
components are then joined, of those that the same sets have one. A pair comes out of that join only if the parities of
both sets in 1,024 cells, a lower bound of their difference, allow a link, and only where no signature among the last
few before this one is common too; it is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, pieces, prepare, stored, stored_by
from .components import components
from .shingles import long_lists, mix64, shingle_sets

#: Similarity in hundredths.
SIMILAR = 80
#: Second-level parts of a first-level part; any two of them sign together.
SECOND = ((0, 1), (0, 2), (1, 2))
#: Pivots that a set is verified against after the first one, while a signature of it has sets of other components.
MORE_PIVOTS = 2
#: Bytes of texts that a task makes sets of at a time; its arrays take about fifty times as much.
TEXT = 1 << 18
#: Words of 64 parity bits.
PARITY = 16
#: Signatures before one, in order, that are looked at for an earlier meeting of the same pair.
BEFORE = 8
#: Sets that share a signature from which on it is crowded: its sets are asked first how much they have in common at most.
CROWDED = 16
#: Bits for each document, and in all, of the map that tells most documents without a similar one before texts move.
BITS, MOST_BITS = 8, 1 << 26


def _low_sizes(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(elements taken from the low end, how many of them a similar set must have) for sets of n elements."""
    need = np.minimum(np.maximum(1, (5 * n + 99) // 100), n)
    return np.minimum(n, n - (SIMILAR * n + 99) // 100 + need), need


def _hashed(x: np.ndarray, off: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(x + np.uint64(salt)))])
    return np.diff(sums[off]).view(np.int64)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, limit=TEXT):
        x, off = shingle_sets(batch.column("text"))
        n = np.diff(off)
        low, need = _low_sizes(n)
        cols = [pa.array(v) for v in (n, low, need, _hashed(x, off, 1), _hashed(x, off, 2))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", "n", "low", "need", "h1", "h2"])


def _low_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, limit=TEXT):
        x, off = shingle_sets(batch.column("text"))
        low, _ = _low_sizes(np.diff(off))
        ends = np.cumsum(low)
        take = np.repeat(off[:-1] - (ends - low), low) + np.arange(ends[-1] if len(ends) else 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(_hashed(x, off, 1), low)), pa.array(x[take].view(np.int64))], ["h1", "x"])


def _parity(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Of each set, in each of PARITY * 64 cells of the hashes, whether it has an odd number of elements there."""
    cells, n = 64 * PARITY, len(off) - 1
    cell = (mix64(x + np.uint64(9)) % np.uint64(cells)).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(n), np.diff(off)) * cells + cell, minlength=n * cells).reshape(n, cells) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, limit=TEXT):
        x, off = shingle_sets(batch.column("text"))
        parity = _parity(x, off)
        bits = long_lists(parity.reshape(-1), np.arange(len(parity) + 1) * PARITY)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(off)), bits, long_lists(x, off)], ["node", "n", "parity", "elements"])


def band_of(n: int) -> tuple[int, int, int]:
    """(number of the band, its largest size, the next band's largest size) of a set of n >= 1 elements."""
    b, hi = 0, 1
    while hi < n:
        b, hi = b + 1, (hi + 1) * 100 // SIMILAR
    return b, hi, (hi + 1) * 100 // SIMILAR


def parts_for(largest: int) -> tuple[int, int, int]:
    """(k, s, n1): elements in which similar sets up to this size may differ; signatures that each may drop; first-level parts.

    k differences leave at least 2 * n1 - k > s signatures untouched: the first in a part spoils two of its three, the
    second one the last.
    """
    k = 2 * largest * (100 - SIMILAR) // (100 + SIMILAR)
    s = (k + 1) // 8
    return k, s, (k + 2 + s) // 2


def signatures(x: np.ndarray, band: int, largest: int, salt: int = 0) -> np.ndarray:
    """Signatures of one set (ascending hashes) in a band. Similar sets share at least one of them.

    The s thinnest in a common order may go: of more than s shared ones, the last in that order is dropped by neither
    set. A signature of empty parts, common to sets without likeness, is signed again on other parts of the domain:
    similar sets that share it share one of those as well. Where no two different sets can be similar there is none.
    """
    k, s, n1 = parts_for(largest)
    if not k:
        return np.zeros(0, np.uint64)
    y = np.sort(mix64(x + np.uint64(salt))) if salt else x
    cells = 3 * n1
    edges = np.searchsorted(((y >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32), np.arange(cells + 1, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(y + np.uint64(3)))])
    content = mix64(sums[edges[1:]] - sums[edges[:-1]]).reshape(n1, 3)
    size = np.diff(edges).reshape(n1, 3)
    one, two = (np.array(p) for p in zip(*SECOND, strict=True))
    thick = (size[:, one] + size[:, two]).ravel()
    place = np.arange(cells, dtype=np.uint64) + (np.uint64(band + 1) << np.uint64(40)) + (np.uint64(salt) << np.uint64(56))
    sigs = mix64(mix64(content[:, one] * np.uint64(0xD6E8FEB86659FD93) + content[:, two]).ravel() + place)
    kept = np.sort(np.argsort(thick, kind="stable")[s:])
    sigs, empty = sigs[kept], thick[kept] == 0
    if salt >= 3 or not empty.any():
        return sigs
    again = signatures(x, band, largest, salt + 1)
    return np.concatenate([sigs[~empty], *(mix64(again + e) for e in sigs[empty])])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            out = []
            for n, elements in zip(batch.column("n").to_pylist(), batch.column("elements"), strict=True):
                x = elements.values.to_numpy().view(np.uint64)
                b, own, above = band_of(n)
                out.append(np.concatenate([signatures(x, band, most) for band, most in ((b, own), (b + 1, above))]))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("w"), long_lists(np.concatenate(out), np.cumsum([0, *map(len, out)]))], ["node", "w", "sigs"])


def _similar(both: Column, n: Column, m: Column) -> Column:
    return 100 * both >= SIMILAR * (n + m - both)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("elements").alias("xa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("elements").alias("xb"))
    near = pairs.join(one, "a").join(two, "b").withColumn("both", F.size(F.array_intersect("xa", "xb")))
    return near.filter(_similar(F.col("both"), F.col("na"), F.col("nb"))).select("a", "b")


def _hopeful(docs: DataFrame, profile: DataFrame) -> DataFrame:
    """(node, w): the sets that may have a similar one, by their least doc_id; w, how ordinary a set is: how many of its low elements others have too.

    A similar set has at least need of the low elements. Elements that one set alone has are counted, with a row for
    each task and element at most, so an element that is everywhere does not weigh.
    """
    spread = docs.mapInArrow(_low_ends, "h1 long, x long").groupBy("x").agg(F.min("h1").alias("h1"), F.max("h1").alias("last"))
    alone = spread.filter("h1 = last").groupBy("h1").agg(F.count("*").alias("alone"))
    nodes = profile.filter("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.max("low").alias("low"), F.max("need").alias("need"))
    shared = F.col("low") - F.coalesce("alone", F.lit(0))
    kept = nodes.filter("node is not null").join(alone, "h1", "left").filter(shared >= F.col("need"))
    return kept.groupBy("node").agg(F.max(shared).cast("int").alias("w"))


def _possible(docs: DataFrame, hopeful: DataFrame, rows: int) -> DataFrame:
    """Of docs (rows of them) those in hopeful, and few others: their ids are marked in a map of bits, by a hash.

    The map is a table of up to MOST_BITS bits (8 MB), whatever docs has; when it is crowded, more of the others pass.
    """
    bits = min(max(1 << 15, rows * BITS), MOST_BITS)

    def bit(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(bits)) + 1

    marks = hopeful.groupBy(F.bitmap_bucket_number(bit("node")).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit("node"))).alias("__bits"))
    place = F.bitmap_bit_position(bit("doc_id")).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = docs.join(F.broadcast(marks), F.bitmap_bucket_number(bit("doc_id")) == F.col("__bucket"))
    return marked.filter(F.getbit(byte, place.bitwiseAND(7)) == 1).select(*docs.columns)


def _most_shared(pairs: DataFrame) -> DataFrame:
    """(sig, pivot, node) -> (a, b): each node b with its pivot a of most signatures."""
    counted = pairs.groupBy("pivot", "node").agg(F.count("*").alias("c"))
    return counted.groupBy("node").agg(F.max(F.struct("c", -F.col("pivot"))).alias("top")).select((-F.col("top")["col2"]).alias("a"), F.col("node").alias("b"))


def _with_pivots(rows: DataFrame, salt: int) -> DataFrame:
    """(a, b): each set b of (sig, node, g) with the pivot a, picked by a hash, of most of its signatures, if that is of another component."""
    pivots = rows.groupBy("sig").agg(F.max_by(F.struct("node", "g"), F.xxhash64("node", F.lit(salt))).alias("p"))
    return _most_shared(rows.join(pivots, "sig").filter(F.col("p.g") != F.col("g")).select("sig", F.col("p.node").alias("pivot"), "node"))


def _apart(kept: DataFrame, group: DataFrame) -> DataFrame:
    """Of (sig, node) those whose signature has sets of different components, with g, the component of the set."""
    placed = kept.join(group, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("g"))
    apart = placed.groupBy("sig").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo < hi").select("sig")
    return placed.join(apart, "sig")


def _one_of_alike(rows: DataFrame) -> DataFrame:
    """(sig, node, g, often) of one signature for each set of nodes: signatures that the same nodes have give the same pairs.

    Two long texts share thousands of signatures. Sets of nodes are told apart by their number and two hashes.
    """
    hashes = [F.bit_xor(F.xxhash64("node", F.lit(s))).alias(f"h{s}") for s in (0, 1)]
    nodes = rows.groupBy("sig").agg(F.count("*").alias("often"), *hashes)
    return rows.join(nodes.groupBy("often", "h0", "h1").agg(F.min("sig").alias("sig")).select("sig", "often"), "sig")


def _left_over(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, n, common) of the sets in rows that may have a link to one in rows of another component.

    Elements that no set of another component has cannot be shared: common, the number of the others, bounds what a
    pair has in common, so sets that all differ a little too much from one text are not compared with each other.
    """
    elements = sets.join(rows.select("node", "g").distinct(), "node").select("node", "g", "n", F.explode("elements").alias("x"))
    both = elements.groupBy("x").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo < hi").select("x")
    common = elements.join(both, "x").groupBy("node", "n").agg(F.count("*").alias("common"))
    return common.filter(100 * F.col("common") >= SIMILAR * F.col("n"))


def _pairs_apart(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share a signature of rows (sig, node, g, often) and whose parities allow a link.

    At a crowded signature sets meet only if what they have in common with sets at crowded ones allows a link; two that
    have a link and meet there both count what they share. A pair meets at its least shared signature, before which
    nothing is shared, so none is lost; at most later ones it is passed over, as long texts would meet thousands of times.
    """
    bits = [f"p{i}" for i in range(PARITY)]
    crowded = F.col("often") > CROWDED
    common = _left_over(rows.filter(crowded), sets)
    about = sets.select("node", "n", *(F.col("parity")[i].alias(c) for i, c in enumerate(bits))).join(common, ["node", "n"], "left")
    rows = rows.join(about, "node").filter(~crowded | F.col("common").isNotNull())
    rows = rows.select("sig", "node", "g", "n", F.when(crowded, F.col("common")).otherwise(F.col("n")).alias("common"), *bits)
    # Unlike texts under one id are different sets of a node, each with its own order.
    last = Window.partitionBy("node", "n", *bits).orderBy("sig").rowsBetween(-BEFORE, -1)
    rows = rows.withColumn("before", F.collect_list("sig").over(last))
    other = rows.select("sig", *(F.col(c).alias(f"{c}_b") for c in ("node", "g", "n", "common", "before", *bits)))
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))) for c in bits), F.lit(0))
    total = F.col("n") + F.col("n_b")
    can = (F.col("node") < F.col("node_b")) & (F.col("g") != F.col("g_b")) & ((100 + SIMILAR) * F.least("common", "common_b") >= SIMILAR * total) & ((100 + SIMILAR) * apart <= (100 - SIMILAR) * total)
    return rows.join(other, (rows["sig"] == other["sig"]) & can & ~F.arrays_overlap("before", "before_b")).select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()


def link_components(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, component_id), a row for each row of docs.

    component_id is the least doc_id that links reach, its own included; rows without words are linked with nothing.
    Rows that share a doc_id and a set are one node; unlike texts that share a doc_id are linked with what either is
    similar to. A null doc_id has a null component_id unless an equal text has an id. Documents with an equal set are
    linked. Ties do not matter: components do not depend on order. An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = stored(docs.mapInArrow(_profiles, "doc_id long, n long, low long, need long, h1 long, h2 long"), "profiles")
    hopeful = stored(_hopeful(docs, profile), "hopeful")
    texts = _possible(docs, hopeful, profile.count())
    sets = stored_by(texts.mapInArrow(_whole_sets, "node long, n long, parity array<long>, elements array<long>").filter("n > 0"), "sets", "node")
    signing = sets.join(hopeful, "node").select("node", "w", "n", "elements")
    written = stored(signing.mapInArrow(_signed, "node long, w int, sigs array<long>"), "signatures")
    signed = written.select("node", "w", F.explode("sigs").alias("sig"))
    # A set has a signature once. The most ordinary set comes first, equal ones in the order of a hash.
    place = F.least("w", F.lit(1 << 22)) * F.lit(1 << 40) + F.shiftrightunsigned(F.xxhash64("node"), 24)
    shared = signed.groupBy("sig").agg(F.count("*").alias("often"), F.max_by("node", place).alias("pivot")).filter("often > 1")
    kept = stored(signed.select("sig", "node").join(shared.select("sig", "pivot"), "sig"), "kept")
    discard(written)
    links = stored(_verified(_most_shared(kept.filter("pivot <> node")), sets), "links-first")
    group = stored(components(links), "groups")
    rows = stored(_apart(kept.select("sig", "node"), group), "apart")
    discard(kept, group)
    # Most sets are settled; the rest are all that later rounds move.
    sets, before = stored_by(sets.join(rows.select("node").distinct(), "node", "left_semi"), "sets-apart", "node"), sets
    discard(before)
    # Those still apart meet pivots that hashes pick.
    for salt in range(MORE_PIVOTS):
        links = links.union(stored(_verified(_with_pivots(rows, salt), sets), "links-more"))
        group, before = stored(components(links), "groups"), rows
        rows = stored(_apart(before.select("sig", "node"), group), "apart")
        discard(before, group)
    rows, before = stored(_one_of_alike(rows), "alike"), rows
    discard(before)
    second = stored(_verified(_pairs_apart(rows, sets), sets), "links-second")
    links = components(links.union(second))
    nodes = profile.filter("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    by_set = nodes.join(links, "node", "left").select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.coalesce("component", "node").alias("component"))
    joined = profile.select("doc_id", "n", "h1", "h2").join(by_set, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")) & (F.col("n") > 0), "left")
    discard(sets, rows, hopeful)
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def op7(spark, sf_dir) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.8 or more."""
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP7_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM w
), x AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = s.doc_id) AS component_id FROM s
"""
