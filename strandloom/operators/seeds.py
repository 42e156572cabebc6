"""Places of sequences in a genome by minimiser seeds, without an outside aligner.

A k-mer and its reverse complement have one code, and the minimiser of a window of w neighbouring k-mers is the one
whose code's hash is least, in whichever direction it is read. A sequence that differs from the genome in at most m
bases agrees with it in one of m + 1 windows of w + k - 1 bases that do not overlap, so it is looked up by the
minimisers of these windows, one each. The genome's minimisers are a table, with the bases beside them; a join with
those of the sequences, checked by the bases of the window that stand beside the k-mer, gives places where a sequence
would begin, each of which is verified once, base by base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import importable

#: Bases of a k-mer, k-mers of a window.
K, W = 13, 4
#: Bases on each side of a k-mer that are compared at most, and the bits that they take.
BESIDE, BITS = 3, 12
#: Bases of a page of the genome, at least.
PAGE = 256

COMPLEMENT = np.arange(256, dtype=np.uint8)
COMPLEMENT[[ord(b) for b in "ACGTacgt"]] = [ord(b) for b in "TGCAtgca"]
#: Two bits of a letter; A, C, G and T are told apart.
TWO = (np.arange(256) >> 1 & 3).astype(np.uint64)
LETTERS = np.frombuffer(b"ACTG", np.uint8)
#: First byte of a packed sequence that has other letters than A, C, G and T, and stands as it is.
PLAIN = 255


def _text(seqs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of sequences one behind the other, a byte each, and their lengths."""
    if isinstance(seqs, pa.ChunkedArray):
        seqs = seqs.combine_chunks()
    plain = pa.compute.replace_substring_regex(seqs, r"[^\x00-\x7F]", "?")
    return np.frombuffer("".join(plain.to_pylist()).encode(), np.uint8), pa.compute.binary_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)


def _packed(seqs: pa.Array, text: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Sequences with four letters in a byte, behind a byte with the number of letters in the last one, or none if it is full."""
    sizes = 1 + -(-lengths // 4)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(text)) - (np.cumsum(lengths) - lengths)[owner]
    data = np.bincount(offsets[owner] + 1 + at // 4, TWO[text].astype(np.int64) << 2 * (at % 4), offsets[-1]).astype(np.uint8)
    data[offsets[:-1]] = lengths % 4
    out = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    other = np.bincount(owner[LETTERS[TWO[text].astype(np.int64)] != text], minlength=len(lengths)) > 0
    if other.any():
        out = pa.array([bytes([PLAIN]) + x.encode() if o else y for x, y, o in zip(seqs.to_pylist(), out.to_pylist(), other.tolist(), strict=True)], pa.binary())
    return out


def _unpacked(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters as code points, one sequence behind the other, and lengths."""
    rows = packed.to_pylist()
    data = np.frombuffer(b"".join(rows), np.uint8)
    sizes = pa.compute.binary_length(packed).to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    lengths = 4 * (sizes - 1) - -data[starts].astype(np.int64) % 4
    if (plain := data[starts] == PLAIN).any():
        one = lambda row: row[1:].decode() if row[0] == PLAIN else "".join("ACTG"[b >> 2 * i & 3] for b in row[1:] for i in range(4))[: 4 * (len(row) - 1) - -row[0] % 4]
        texts = [one(row) for row in rows]
        return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.where(plain, list(map(len, texts)), lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(owner)) - (np.cumsum(lengths) - lengths)[owner]
    return LETTERS[data[starts[owner] + 1 + at // 4] >> (2 * (at % 4)).astype(np.uint8) & 3].astype(np.uint32), lengths


def _mixed(code: np.ndarray) -> np.ndarray:
    x = code * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def _codes(text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each k-mer along the last axis: its code, whether that is read backwards, and whether both directions are alike."""
    n = text.shape[-1] - k + 1
    ahead, back = np.zeros((*text.shape[:-1], n), np.uint64), np.zeros((*text.shape[:-1], n), np.uint64)
    letters, others = TWO[text], TWO[COMPLEMENT[text]]
    for j in range(k):
        ahead = ahead << np.uint64(2) | letters[..., j : j + n]
        back = back << np.uint64(2) | others[..., k - 1 - j : k - 1 - j + n]
    return np.minimum(ahead, back), back < ahead, ahead == back


def _beside(text: np.ndarray, at: np.ndarray, backwards: np.ndarray, k: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits for each of the bases beside the k-mers at places of text, in the direction that the k-mer is read in, and which bits count: those of the places from low to before high."""
    values, counts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    left, right = np.arange(-BESIDE, 0), np.arange(k, k + BESIDE)
    for i in range(2 * BESIDE):
        place = at + np.where(backwards, np.concatenate([left, right])[2 * BESIDE - 1 - i], np.concatenate([left, right])[i])
        inside = (place >= low) & (place < high)
        letter = text[np.where(inside, place, 0)]
        values = values << 2 | np.where(inside, TWO[np.where(backwards, COMPLEMENT[letter], letter)].astype(np.int64), 0)
        counts = counts << 2 | np.where(inside, 3, 0)
    return values, counts


def genome_minimisers(genome: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """(h, contig, at, tag) of a genome in chunks (contig, chunk_start, seq) that touch one another: the minimisers' codes and places.

    tag has the bases beside them and the direction. A chunk is read together with the first bases of the next one,
    which an equality join brings, so no window is lost between two chunks; a minimiser there stands twice, with what
    each chunk knows beside it. Chunks must have w + k - 2 bases or more, but for a contig's last. Of equal k-mers of a
    window all are there. Made once, kept as a table.
    """
    importable(genome.sparkSession)
    upper = genome.select("contig", "chunk_start", F.upper("seq").alias("seq"))
    heads = upper.select(F.col("contig").alias("__c"), F.col("chunk_start").alias("__next"), F.substring("seq", 1, w + k - 2).alias("__head"))
    ahead = (upper["contig"] == heads["__c"]) & (upper["chunk_start"] + F.length(upper["seq"]) == heads["__next"])
    whole = upper.join(heads, ahead, "left").select("contig", F.col("chunk_start").cast("long").alias("start"), F.concat("seq", F.coalesce("__head", F.lit(""))).alias("seq"))
    span = w + k - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.compute.greater_equal(pa.compute.utf8_length(batch["seq"]), span))
            if not batch.num_rows:
                continue
            text, lengths = _text(batch["seq"])
            ends = np.cumsum(lengths)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            codes, backwards, _ = _codes(text, k)
            hashes = _mixed(codes)
            n = len(text) - span + 1
            whole_window = np.arange(n) + span <= ends[owner[:n]]
            least = hashes[:n].copy()
            for t in range(1, w):
                np.minimum(least, hashes[t : t + n], out=least)
            chosen = np.zeros(len(hashes), bool)
            for t in range(w):
                chosen[t : t + n] |= whole_window & (hashes[t : t + n] == least)
            at = np.flatnonzero(chosen)
            of = owner[at]
            values, _ = _beside(text, at, backwards[at], k, (ends - lengths)[of], ends[of])
            places = at - (ends - lengths)[of] + batch["start"].to_numpy()[of]
            columns = [pa.array(codes[at].view(np.int64)), batch["contig"].take(pa.array(of)), pa.array(places), pa.array((values << 1 | backwards[at]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["h", "contig", "at", "tag"])

    return whole.mapInArrow(work, f"h long, contig {whole.schema['contig'].dataType.simpleString()}, at long, tag int")


def _seeds(known: DataFrame, most: int, k: int, w: int, longest: int) -> DataFrame:
    """query, s (packed), h, within, behind, tag: the minimiser of each of most + 1 windows of a sequence, and the bases before and behind it; twice if its directions are alike. tag also has which bits of the bases beside it count."""
    span = w + k - 1
    least = (most + 1) * span + most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Here and not by a condition, for which Spark would make the sequences once more.
            batch = batch.filter(pa.compute.greater_equal(pa.compute.utf8_length(batch["s"]), least))
            if not batch.num_rows:
                continue
            text, lengths = _text(batch["s"])
            if lengths.max() > longest:
                raise ValueError(f"a sequence of {lengths.max()} bases, longer than {longest}")
            starts = ((np.cumsum(lengths) - lengths)[:, None] + np.arange(most + 1) * span).ravel()
            codes, backwards, alike = _codes(text[starts[:, None] + np.arange(span)], k)
            offset = np.argmin(_mixed(codes), axis=1)
            pick = lambda x: x[np.arange(len(x)), offset]
            codes, backwards, alike = pick(codes), pick(backwards), pick(alike)
            both = np.concatenate([np.arange(len(codes)), np.flatnonzero(alike)])
            backwards = np.concatenate([backwards[: len(codes)], np.ones(len(both) - len(codes), bool)])
            values, counts = _beside(text, (starts + offset)[both], backwards, k, starts[both], starts[both] + span)
            of = both // (most + 1)
            within = both % (most + 1) * span + offset[both]
            tag = (counts << BITS | values) << 1 | backwards
            columns = [batch["query"].take(pa.array(of)), _packed(batch["s"], text, lengths).take(pa.array(of)), pa.array(codes[both].view(np.int64))]
            columns += [pa.array(x.astype(np.int32)) for x in (within, lengths[of] - k - within, tag)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "s", "h", "within", "behind", "tag"])

    return known.mapInArrow(work, f"query {known.schema['query'].dataType.simpleString()}, s binary, h long, within int, behind int, tag int")


def _met(seeds: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """query, s, contig, start, is_forward, size: where sequences would begin by seeds whose window is in the index, as far as it stands beside the k-mer."""
    seeds = seeds.withColumnRenamed("tag", "__q")
    alike = F.expr(f"((shiftright(__q, 1) ^ shiftright(tag, 1)) & shiftrightunsigned(__q, {BITS + 1}) & {(1 << BITS) - 1}) = 0")
    forward = F.expr("((__q ^ tag) & 1) = 0")
    start = F.col("at") - F.when(forward, F.col("within")).otherwise(F.col("behind"))
    size = F.col("within") + F.col("behind") + k
    return seeds.join(index, "h").filter(alike).select("query", "s", "contig", start.alias("start"), forward.alias("is_forward"), size.alias("size")).filter("start >= 0")


def _verified(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (query, s, contig, start, is_forward, g) whose sequence, in its direction, differs from the bases g in at most most places; g is shorter, or has \0, where the genome ends."""
    for batch in batches:
        if not batch.num_rows:
            continue
        asked, lengths = _unpacked(batch["s"])
        there = np.frombuffer("".join(pa.compute.utf8_rpad(batch["g"], int(lengths.max()), "\0").to_pylist()).encode("utf-32-le"), np.uint32).reshape(len(lengths), -1)
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        forward = batch["is_forward"].to_numpy(zero_copy_only=False).astype(bool)
        at = np.arange(len(asked))
        turned = ~forward[owner]
        read = asked[np.where(turned, (2 * ends - lengths - 1)[owner] - at, at)]
        read = np.where(turned & (read < 256), COMPLEMENT[read & 255], read)
        there = there[owner, at - (ends - lengths)[owner]]
        unlike = np.bincount(owner[(read != there) | (there == ord("N"))], minlength=len(lengths))
        outside = np.bincount(owner[there == 0], minlength=len(lengths))
        good = np.flatnonzero((unlike <= most) & (outside == 0))
        rows = batch.take(pa.array(good))
        end = pa.array(rows["start"].to_numpy() + lengths[good])
        yield pa.RecordBatch.from_arrays([rows["query"], rows["contig"], rows["start"], end, rows["is_forward"], pa.array(unlike[good].astype(np.int32))], ["query", "contig", "start", "end", "is_forward", "mismatches"])


def _pages(genome: DataFrame, page: int) -> DataFrame:
    """(contig, page, bases): page number page of a contig and the one behind it; what no chunk has in front of a chunk is filled with \\0."""
    end = F.col("chunk_start") + F.length("seq")
    cut = genome.filter(F.length("seq") > 0).select("contig", F.col("chunk_start").cast("long").alias("chunk_start"), F.upper("seq").alias("seq"))
    cut = cut.withColumn("page", F.explode(F.sequence(F.greatest(F.floor(F.col("chunk_start") / page) - 1, F.lit(0).cast("long")), F.floor((end - 1) / page))))
    begin = F.col("page") * page
    low = F.greatest(F.col("chunk_start"), begin)
    piece = F.substring(F.col("seq"), (low - F.col("chunk_start") + 1).cast("int"), (F.least(end, begin + 2 * page) - low).cast("int"))
    pieces = cut.groupBy("contig", "page").agg(F.array_sort(F.collect_list(F.struct((low - begin).cast("int").alias("at"), piece.alias("bases")))).alias("p"))
    filled = F.aggregate("p", F.lit(""), lambda text, x: F.concat(F.rpad(text, x["at"], "\0"), x["bases"]))
    joined = F.array_join(F.transform("p", lambda x: x["bases"]), "")
    last = F.element_at("p", -1)
    return pieces.select("contig", "page", F.when(F.length(joined) == last["at"] + F.length(last["bases"]), joined).otherwise(filled).alias("bases"))


def find_places(queries: DataFrame, genome: DataFrame, index: DataFrame, chunk: int, id_col: str = "query", seq_col: str = "seq", most: int = 1, k: int = K, w: int = W, longest: int | None = None) -> DataFrame:
    """(query, contig, start, end, is_forward, mismatches): every place where a whole sequence, or its reverse complement, differs in at most most bases.

    index: genome_minimisers of genome with the same k and w. Sequences shorter than (most + 1) * (k + w - 1) + most bases
    could be missed and are left out, as are null ones; N is unlike every base. Rows that repeat an id and a sequence
    are looked up once. A sequence that is its own reverse complement is told in both directions. Insertions and
    deletions are not looked for. longest: bases of the longest sequence; if it is not given, a job asks for it, and a
    longer one fails.

    Sequences go to the seeds' codes and from there, with their place, to the pages of the genome; what repeats is in
    one page and goes there.
    """
    importable(queries.sparkSession)
    known = queries.select(F.col(id_col).alias("query"), F.upper(seq_col).alias("s"))
    if longest is None:
        longest = known.agg(F.max(F.length("s"))).first()[0] or 0
    page = max(PAGE, -(-longest // chunk) * chunk)
    met = _met(_seeds(known, most, k, w, longest), index, k)
    met = met.withColumn("page", F.floor(F.col("start") / page))
    seen = met.join(_pages(genome, page), ["contig", "page"])
    there = F.substring(F.col("bases"), (F.col("start") - F.col("page") * page + 1).cast("int"), F.col("size"))
    seen = seen.select("query", "s", "contig", "page", "start", "is_forward", there.alias("g")).distinct()
    kinds = {f.name: f.dataType.simpleString() for f in seen.schema}
    return seen.select("query", "s", "contig", "start", "is_forward", "g").mapInArrow(lambda batches: _verified(batches, most), f"query {kinds['query']}, contig {kinds['contig']}, start long, end long, is_forward boolean, mismatches int")
