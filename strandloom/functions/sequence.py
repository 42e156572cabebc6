"""Column functions over bases, base qualities and alignments. All are built-in expressions: null in, null out.

A quality sequence is struct<seq: string, qual: array<int>> with as many qualities as bases.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MOUSE, Config

# The codes of alignment operations.
MATCH, INSERT, DELETE, SKIP, SOFT, HARD, PAD, EQUAL, DIFFER = range(9)
LEFT_TO_RIGHT, RIGHT_TO_LEFT = "ltr", "rtl"
BASES = "ATGC"


def revcomp(seq: Column) -> Column:
    """Reverse complement; case stays, other letters stay."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def let(value: Column, use) -> Column:
    """use(value) with value evaluated once: an expression in which it stands many times stays small."""
    return F.transform(F.array(value), use)[0]


def quality_seq(seq: Column, qual: Column) -> Column:
    return F.struct(seq.alias("seq"), qual.alias("qual"))


def q_revcomp(q: Column) -> Column:
    return let(q, lambda v: quality_seq(revcomp(v["seq"]), F.reverse(v["qual"])))


def q_upper(q: Column) -> Column:
    return quality_seq(F.upper(q["seq"]), q["qual"])


def q_lower(q: Column) -> Column:
    return quality_seq(F.lower(q["seq"]), q["qual"])


def q_concat(*parts: Column) -> Column:
    return let(F.array(*parts), lambda ps: quality_seq(F.concat(*(ps[i]["seq"] for i in range(len(parts)))), F.concat(*(ps[i]["qual"] for i in range(len(parts))))))


def q_repeat(q: Column, times: int) -> Column:
    """A plain string: the bases so many times."""
    return F.repeat(q["seq"], times)


def q_slice(q: Column, start: Column | int = 0, stop: Column | int | None = None) -> Column:
    """Half-open slice; negative places count from the end and places beyond an end stop there."""
    lo = F.lit(start) if isinstance(start, int) else start
    hi = F.length(q["seq"]) if stop is None else F.lit(stop) if isinstance(stop, int) else stop

    def cut(v):
        n = F.length(v["q"]["seq"])
        place = lambda x: F.greatest(F.lit(0), F.least(n, F.when(x < 0, x + n).otherwise(x))).cast("int")
        return let(F.struct(place(v["lo"]).alias("lo"), place(v["hi"]).alias("hi")), lambda p: quality_seq(F.substring(v["q"]["seq"], p["lo"] + 1, F.greatest(F.lit(0), p["hi"] - p["lo"])), F.slice(v["q"]["qual"], p["lo"] + 1, F.greatest(F.lit(0), p["hi"] - p["lo"]))))

    return F.when(q.isNotNull(), let(F.struct(q.alias("q"), lo.alias("lo"), hi.alias("hi")), cut))


def phred(qual: Column, base: int = 33) -> Column:
    return F.array_join(F.transform(qual, lambda x: F.chr(F.least(x + base, F.lit(126)))), "")


def unphred(text: Column, base: int = 33) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c) - base)


def fastq(title: Column, q: Column) -> Column:
    """The four lines of a record, the last line feed included."""
    return F.concat(F.lit("@"), title, F.lit("\n"), q["seq"], F.lit("\n+\n"), phred(q["qual"]), F.lit("\n"))


def is_adapter(seq: Column, config: Config = MOUSE) -> Column:
    """Whether a clip looks like an adapter: one base but T twelve times, a repeated pair of bases, or part of an adapter."""
    s = F.upper(seq)
    pair = (F.substring(s, 1, 1) != F.substring(s, 2, 1)) & (F.repeat(F.substring(s, 1, 2), 6) == F.substring(s, 1, 12))
    # Adapters count in both directions, a clip in both too.
    known = F.lit(False)
    for a in config.adapters:
        known = known | F.lit(a).contains(s) | F.lit(a).contains(revcomp(s))
    return F.when(seq.isNull(), None).otherwise((F.length(s) >= 2) & (s.isin("G" * 12, "C" * 12, "A" * 12) | pair | known))


def clean_length(seq: Column, config: Config = MOUSE) -> Column:
    """Bases of a clip that stay when a tail of G and the adapter are cut off.

    A tail of at least min_g_run G goes, but never the first base. Then one pass looks for the adapter: a match grows
    with each base, starts again at a mismatch, and ends the pass when it is adapter_stop long; a match of min_adapter
    or more at the end of the pass is cut.
    """
    adapter = config.adapters[0]
    tail = F.length(F.regexp_extract(seq, "G*$", 0))
    trimmed = F.when(tail >= config.min_g_run, F.greatest(F.lit(1), F.length(seq) - tail)).otherwise(F.length(seq))
    letters = F.slice(F.split(seq, ""), 1, trimmed)

    def step(st, c):
        wanted = F.substring(F.lit(adapter), st["j"] + 1, F.lit(1))
        grown = F.when(c == wanted, st["j"] + 1).when(c == adapter[0], F.lit(1)).otherwise(F.lit(0))
        done = st["j"] >= config.adapter_stop
        return F.struct(F.when(done, st["j"]).otherwise(grown).alias("j"), F.when(done, st["i"]).otherwise(st["i"] + 1).alias("i"))

    left = F.aggregate(letters, F.struct(F.lit(0).alias("j"), F.lit(0).alias("i")), step, lambda st: F.when(st["j"] >= config.min_adapter, st["i"] - st["j"]).otherwise(trimmed))
    return F.when(F.length(seq) < 2, 0).otherwise(left)


def clean_clip(q: Column, config: Config = MOUSE) -> Column:
    return let(q, lambda v: q_slice(v, 0, let(v["seq"], lambda s: clean_length(s, config))))


def match_score(seqs: Column, most: int = 24) -> Column:
    """Agreement of array<struct<seq, qual>> over the first bases of the shortest, -2 to 1; null if that is empty.

    Each place scores 1 if one of A, T, G, C, N has more than half the weight there, else -2. qual may be null: every
    base then weighs 1.
    """
    shortest = F.array_min(F.transform(seqs, lambda q: F.length(q["seq"])))
    n = F.least(F.lit(most), shortest)
    # Each sequence as the weights of its places, made once: array<array<struct<b, w>>>.
    spelt = F.transform(
        seqs,
        lambda q: F.transform(
            F.slice(F.split(q["seq"], ""), 1, most),
            lambda c, i: F.struct(c.alias("b"), F.when(q["qual"].isNull(), F.lit(1)).otherwise(F.get(q["qual"], i)).alias("w")),
        ),
    )

    def votes_for(base):
        return lambda acc, x: acc + F.when(x["b"] == base, x["w"]).otherwise(0)

    def total(all_spelt):
        def place(p):
            here = F.transform(all_spelt, lambda x: F.get(x, p))
            sums = F.array(*(F.aggregate(here, F.lit(0), votes_for(b)) for b in BASES + "N"))
            return F.transform(F.array(sums), lambda w: F.when(2 * F.array_max(w) > F.aggregate(w, F.lit(0), lambda a, x: a + x), 1).otherwise(-2))[0]

        return F.aggregate(F.sequence(F.lit(0), F.array_min(F.transform(all_spelt, F.size)) - 1), F.lit(0), lambda acc, p: acc + place(p))

    return F.when(n > 0, F.transform(F.array(spelt), total)[0] / n)


def pair_score(a: Column, b: Column, most: int = 24) -> Column:
    """match_score of two plain strings: both agree, or a place counts -2. A place with another letter than A, T, G, C, N has no weight."""
    n = F.least(F.lit(most), F.length(a), F.length(b))
    known = lambda c: c.isin(*(BASES + "N"))
    agrees = lambda x, y: (x == y) & known(x) | (known(x) != known(y))
    letters = lambda s: F.split(F.substring(s, F.lit(1), n), "")
    points = F.zip_with(letters(a), letters(b), lambda x, y: F.when(agrees(x, y), 1).otherwise(-2))
    return F.when(n > 0, F.aggregate(points, F.lit(0), lambda acc, x: acc + x) / n)


def is_low_complexity(seq: Column) -> Column:
    """Whether at least two of the four bases are missing."""
    present = sum((F.instr(seq, b) > 0).cast("int") for b in BASES)
    return present <= 2


def is_short_repeat(seq: Column, most: int = 4, over: int = 24) -> Column:
    """Whether the first bases repeat a unit of 1 to most bases."""
    out = F.lit(False)
    for n in range(1, most + 1):
        out = out | (F.repeat(F.substring(seq, 1, n), over // n) == F.substring(seq, 1, over))
    return out


def longest_run(seq: Column, base: str) -> Column:
    """struct<start, size>: the first longest run of base, start from 0; size 0 if there is none."""
    runs = F.regexp_extract_all(seq, F.lit(f"{base}+"), F.lit(0))
    size = F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))
    start = F.when(size > 0, F.instr(seq, F.repeat(F.lit(base), size)) - 1)
    return F.when(seq.isNull(), None).otherwise(F.struct(start.cast("int").alias("start"), size.alias("size")))


def allele_scores(seq: Column, qual: Column, ref: Column, alt: Column, direction: str) -> Column:
    """struct<q_ref, q_alt, q_art>: quality for and against two alleles over the compared ends; N is left out.

    Each base adds its quality to an allele that it equals and takes it from one that it does not; a quarter of it
    counts for an artefact either way.
    """
    n = F.least(F.length(seq), F.length(ref), F.length(alt))
    zero = F.struct(*(F.lit(0.0).alias(c) for c in ("q_ref", "q_alt", "q_art")))

    def end(s):
        return F.split(F.substring(s, F.lit(1) if direction == LEFT_TO_RIGHT else F.length(s) - n + 1, n), "")

    weight = F.slice(qual, F.lit(1) if direction == LEFT_TO_RIGHT else F.length(seq) - n + 1, n)
    # The ends are arrays of the fold, so that they are made once and not at each place.
    places = F.arrays_zip(end(seq).alias("s"), end(ref).alias("r"), end(alt).alias("a"), weight.alias("q"))

    def step(st, x):
        q = x["q"].cast("double")
        side = lambda allele: F.when(x["s"] == allele, q).otherwise(-q)
        grown = F.struct((st["q_ref"] + side(x["r"])).alias("q_ref"), (st["q_alt"] + side(x["a"])).alias("q_alt"), (st["q_art"] + q / 4).alias("q_art"))
        return F.when(x["s"] == "N", st).otherwise(grown)

    return F.when(n.isNull(), None).when(n == 0, zero).otherwise(F.aggregate(places, zero, step))


def query_offset(cigar: Column, start: Column, pos: Column) -> Column:
    """Place in the read, from 0, of the base aligned to pos; null if none is. cigar: array<struct<op, len>>."""
    state = F.struct(F.lit(0).cast("long").alias("q"), start.cast("long").alias("r"), F.lit(None).cast("long").alias("hit"))

    def step(st, c):
        both, query, reference = (c["op"].isin(*ops) for ops in ((MATCH, EQUAL, DIFFER), (MATCH, EQUAL, DIFFER, INSERT, SOFT), (MATCH, EQUAL, DIFFER, DELETE, SKIP)))
        here = both & (pos >= st["r"]) & (pos < st["r"] + c["len"])
        return F.struct(
            (st["q"] + F.when(query, c["len"]).otherwise(0)).alias("q"),
            (st["r"] + F.when(reference, c["len"]).otherwise(0)).alias("r"),
            F.when(here, st["q"] + pos - st["r"]).otherwise(st["hit"]).cast("long").alias("hit"),
        )

    return F.aggregate(cigar, state, step, lambda st: st["hit"])


def reference_end(cigar: Column, start: Column) -> Column:
    return start + F.aggregate(cigar, F.lit(0).cast("long"), lambda acc, c: acc + F.when(c["op"].isin(MATCH, EQUAL, DIFFER, DELETE, SKIP), c["len"]).otherwise(0))


def clip_side(cigar: Column) -> Column:
    """struct<side, left, right>: 'L' or 'R', the longer soft clip; side is null if there is none or both are alike."""
    size = lambda c: F.when(c["op"] == SOFT, c["len"]).otherwise(0)
    left, right = size(F.element_at(cigar, 1)), size(F.element_at(cigar, -1))
    side = F.when(left > right, "L").when(right > left, "R")
    return F.when(F.size(cigar) > 0, F.struct(side.alias("side"), left.alias("left"), right.alias("right")))


def near_supplementary(sa: Column, contig: Column, start: Column, within: int = MOUSE.same_contig_supplementary) -> Column:
    """Whether an SA tag names a place on contig less than within from start."""
    entries = F.filter(F.split(F.coalesce(sa, F.lit("")), ";"), lambda x: x != "")
    return F.exists(entries, lambda x: (F.split(x, ",")[0] == contig) & (F.abs(start - F.split(x, ",")[1].try_cast("long")) < within))


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(bit) != 0


# Bits of an alignment's flag.
PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, READ1, READ2, SECONDARY, QCFAIL, DUPLICATE, SUPPLEMENTARY = 2, 4, 8, 16, 64, 128, 256, 512, 1024, 2048


def polya_kind(seq: Column, flag: Column, run: int = MOUSE.polya_run) -> Column:
    """'A' or 'T' for a read of a discordant pair with such a run, if its direction fits; else null."""
    reverse, read1, read2 = (has_flag(flag, b) for b in (REVERSE, READ1, READ2))
    some_a, some_t = seq.contains("A" * run), seq.contains("T" * run)
    usable = ~has_flag(flag, PROPER) & ~has_flag(flag, MATE_UNMAPPED)
    is_a = some_a & ((reverse & read2) | (~reverse & read1))
    is_t = ~some_a & some_t & ((reverse & read1) | (~reverse & read2))
    return F.when(usable & is_a, "A").when(usable & is_t, "T")


def polya_clip(q: Column, flag: Column, kind: Column, config: Config = MOUSE) -> Column:
    """The clip of a poly-A or poly-T read, its first base next to the run's genome side; null or empty if there is none."""
    apart = has_flag(flag, READ1) != ~has_flag(flag, REVERSE)
    a, t = longest_run(q["seq"], "A"), longest_run(q["seq"], "T")
    head = q_slice(q, 0, F.coalesce(a["start"], F.lit(0)))
    of_a = F.when(a["start"] > 6, F.when(apart, clean_clip(q_revcomp(head), config)).otherwise(q_revcomp(clean_clip(head, config))))
    rest = q_slice(q, F.coalesce(t["start"], F.lit(0)) + 1)
    of_t = F.when(apart, q_revcomp(clean_clip(q_revcomp(rest), config))).otherwise(clean_clip(rest, config))
    return F.when(kind == "A", of_a).when(kind == "T", of_t)


def polya_side(flag: Column, kind: Column) -> Column:
    return F.when(kind.isNotNull(), F.when(~has_flag(flag, REVERSE) != (kind == "A"), "R").otherwise("L"))


def polya_breakpoint(flag: Column, kind: Column, mate_flag: Column, mate_start: Column, mate_end: Column, mate_mapq: Column, config: Config = MOUSE) -> Column:
    """Where the mate puts the poly-A breakpoint; null if the mate maps badly."""
    start = (~has_flag(flag, REVERSE) != (kind == "A")) != ~has_flag(mate_flag, REVERSE)
    return F.when(mate_mapq >= config.min_mapq, F.when(start, mate_start).otherwise(mate_end))


def usable_contig(contig: Column, config: Config = MOUSE) -> Column:
    return (F.length(contig) <= config.max_contig_name) & ~contig.isin("MT", "chrM")


def insertion_name(contig: Column, left: Column, right: Column) -> Column:
    return F.concat(contig, F.lit(":"), left.cast("string"), F.lit("-"), right.cast("string"))


def parse_name(name: Column) -> Column:
    """struct<contig, left, right, side> of contig:left-right[:side]; a place that is no number is null."""
    part = lambda k: F.regexp_extract(name, r"^([^:]*):([^-:]*)-([^:]*)(?::(.*))?$", k)
    side = F.when(part(4) != "", part(4))
    return F.struct(part(1).alias("contig"), part(2).try_cast("long").alias("left"), part(3).try_cast("long").alias("right"), side.alias("side"))


def with_chr(contig: Column) -> Column:
    return F.when(contig.startswith("chr"), contig).otherwise(F.concat(F.lit("chr"), contig))


def consensus_text(clipped: Column, aligned: Column, side: str) -> Column:
    """Clip in lower case beside the aligned part: before it on the left side, after it on the right."""
    if side == "L":
        return q_concat(q_lower(q_revcomp(clipped)), aligned)
    return q_concat(q_revcomp(aligned), q_lower(clipped))


def clipped_part(consensus: Column, section: str) -> Column:
    """The lower-case part of a written consensus: from the first lower-case base of the right one, up to the first upper-case base of the left one."""
    return F.regexp_extract(consensus, "[acgt].*" if section == "RIGHT_CONSENSUS" else "^[^ACGT]*", 0)
