"""Registered queries: each operator over whole tables, with the same result in SQL.

The tables hold no genomes, so reads are derived from them: bases are a digest's digits spelt as bases, places and
qualities are keys, days and quantities.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MOUSE
from ..functions import sequence as S
from ..operators import consensus, genotypes, insertions, intervals, ordered, reports, seeds
from ..sources import genomes, records

HEX = "0123456789abcdef"
SPELT, POOR = "ACGTACGTACGTACGT", "AAAAAATTTTTTACGT"
ADAPTER = MOUSE.adapters[0]


def _table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bases(key: Column | str, alphabet: str = SPELT) -> Column:
    return F.translate(F.md5(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")), HEX, alphabet)


def _sql_bases(key: str, alphabet: str = SPELT) -> str:
    return f"translate(md5(CAST({key} AS VARCHAR)), '{HEX}', '{alphabet}')"


def _day(column: str) -> Column:
    return F.datediff(column, F.lit("1995-01-01"))


SQL_DAY = "datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))"
QUERIES: dict = {}
ORACLE_SQL: dict = {}
FLAGSHIP = "genotype_matrix_filter"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"SELECT l_orderkey, l_partkey, l_linenumber, seq, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS rc FROM (SELECT *, {_sql_bases('l_partkey')} AS seq FROM lineitem)")
def revcomp_reads(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", bases("l_partkey").alias("seq"), S.revcomp(bases("l_partkey")).alias("rc"))


@query("""
SELECT o_orderkey, array_to_string(list_transform(range(1, 9), lambda i: chr(CAST(least((o_orderkey * 7 + i * i * 11) % 100 + 33, 126) AS INTEGER))), '') AS phred,
       array_to_string(list_transform(range(1, 9), lambda i: least((o_orderkey * 7 + i * i * 11) % 100, 93)), ',') AS decoded
FROM orders""")
def quality_strings(spark, sf_dir):
    qual = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: ((F.col("o_orderkey") * 7 + i * i * 11) % 100).cast("int"))
    text = _table(spark, sf_dir, "orders").select("o_orderkey", S.phred(qual).alias("phred"))
    return text.select("o_orderkey", "phred", F.array_join(S.unphred(F.col("phred")).cast("array<string>"), ",").alias("decoded"))


_CLIP = f"CASE o_orderkey % 4 WHEN 0 THEN substr('{ADAPTER}', CAST(o_orderkey % 20 + 1 AS INTEGER), 12) WHEN 1 THEN repeat(substr(b, 1, 2), 6) WHEN 2 THEN repeat(substr(b, 1, 1), 12) ELSE substr(b, 1, CAST(o_orderkey % 12 + 1 AS INTEGER)) END"
_LISTED = "[" + ", ".join(f"'{a}'" for a in MOUSE.adapters) + "]"


@query(f"""
SELECT o_orderkey, s, length(s) >= 2 AND (s IN ('GGGGGGGGGGGG', 'CCCCCCCCCCCC', 'AAAAAAAAAAAA')
       OR (s[1] <> s[2] AND repeat(s[1:2], 6) = s[1:12])
       OR list_bool_or(list_transform({_LISTED}, lambda a: contains(a, s) OR contains(a, reverse(translate(s, 'ACGT', 'TGCA')))))) AS adapter
FROM (SELECT o_orderkey, {_CLIP} AS s FROM (SELECT o_orderkey, {_sql_bases('o_orderkey')} AS b FROM orders))""")
def adapter_flags(spark, sf_dir):
    clips = _table(spark, sf_dir, "orders").select("o_orderkey", bases("o_orderkey").alias("b")).select("o_orderkey", F.expr(_CLIP.replace("INTEGER", "INT")).alias("s"))
    return clips.select("o_orderkey", "s", S.is_adapter(F.col("s")).alias("adapter"))


_READ = f"concat(substr(b, 1, CAST(o_orderkey % 20 + 1 AS INTEGER)), substr('{ADAPTER}', 1, CAST(o_custkey % 15 AS INTEGER)), substr(b, 25, CAST(o_orderkey % 3 AS INTEGER)), repeat('G', CAST(o_custkey % 8 AS INTEGER)))"


@query(f"""
SELECT o_orderkey, s, CAST(CASE WHEN length(s) < 2 THEN 0 WHEN e.j >= 4 THEN e.i - e.j ELSE t END AS INTEGER) AS kept FROM (
  SELECT o_orderkey, s, t, list_reduce(list_prepend({{'j': 0, 'i': 0, 'c': ''}}, list_transform(range(1, t + 1), lambda p: {{'j': 0, 'i': 0, 'c': s[p]}})),
    lambda a, x: CASE WHEN a.j >= 10 THEN a ELSE {{'j': CASE WHEN x.c = substr('{ADAPTER}', a.j + 1, 1) THEN a.j + 1 WHEN x.c = 'A' THEN 1 ELSE 0 END, 'i': a.i + 1, 'c': ''}} END) AS e
  FROM (SELECT o_orderkey, s, CASE WHEN g >= 5 THEN greatest(1, length(s) - g) ELSE length(s) END AS t
        FROM (SELECT o_orderkey, {_READ} AS s, length(regexp_extract({_READ}, 'G*$')) AS g FROM (SELECT o_orderkey, o_custkey, {_sql_bases('o_orderkey')} AS b FROM orders))))""")
def adapter_trim(spark, sf_dir):
    reads = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", bases("o_orderkey").alias("b")).select("o_orderkey", F.expr(_READ.replace("INTEGER", "INT")).alias("s"))
    return reads.select("o_orderkey", "s", S.clean_length(F.col("s")).alias("kept"))


_MIXED = "concat(substr(a, 1, CAST(l_orderkey % 25 AS INTEGER)), substr(z, CAST(l_orderkey % 25 + 1 AS INTEGER)))"


@query(f"""
SELECT l_orderkey, l_partkey, l_linenumber, score, score >= 0.6 AS agrees FROM (
  SELECT *, list_sum(list_transform(range(1, 25), lambda p: CASE WHEN a[p] = b[p] THEN 1 ELSE -2 END)) / 24.0 AS score
  FROM (SELECT *, {_MIXED} AS b FROM (SELECT *, {_sql_bases('l_partkey')} AS a, {_sql_bases('l_orderkey')} AS z FROM lineitem)))""")
def match_score_gate(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumn("a", bases("l_partkey")).withColumn("z", bases("l_orderkey")).withColumn("b", F.expr(_MIXED.replace("INTEGER", "INT")))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", S.pair_score(F.col("a"), F.col("b")).alias("score")).withColumn("agrees", F.col("score") >= MOUSE.match_score)


_SIGN = lambda allele, at: f"CAST(list_sum(list_transform(range(1, 13), lambda i: CASE WHEN s[{at}] = {allele}[i] THEN 1 ELSE -1 END * ((q + {at}) % 40))) AS DOUBLE)"


@query(f"""
SELECT l_orderkey, l_partkey, l_linenumber, {_SIGN('r', 'i')} AS ref_ltr, {_SIGN('a', 'i')} AS alt_ltr, list_sum(list_transform(range(1, 13), lambda i: (q + i) % 40)) / 4.0 AS art_ltr,
       {_SIGN('r', '(i + 4)')} AS ref_rtl, {_SIGN('a', '(i + 4)')} AS alt_rtl, list_sum(list_transform(range(1, 13), lambda i: (q + i + 4) % 40)) / 4.0 AS art_rtl
FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q, substr({_sql_bases('l_partkey')}, 1, 16) AS s, substr({_sql_bases('l_partkey')}, 1, 12) AS r, substr({_sql_bases('l_orderkey')}, 1, 12) AS a FROM lineitem)""")
def qscore_ref_alt(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumns({"a": bases("l_partkey"), "z": bases("l_orderkey")})
    rows = rows.withColumns({"s": F.substring("a", 1, 16), "r": F.substring("a", 1, 12), "t": F.substring("z", 1, 12), "q": F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: (F.col("l_quantity").cast("int") + i) % 40)})
    seq, qual, ref, alt = (F.col(c) for c in "sqrt")
    rows = rows.withColumn("x", S.allele_scores(seq, qual, ref, alt, S.LEFT_TO_RIGHT)).withColumn("y", S.allele_scores(seq, qual, ref, alt, S.RIGHT_TO_LEFT))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", *(F.col(f"{v}.q_{k}").alias(f"{k}_{d}") for v, d in (("x", "ltr"), ("y", "rtl")) for k in ("ref", "alt", "art")))


@query("""
SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN d < b THEN a + d WHEN d < b + c THEN NULL WHEN d < b + c + 9 THEN a + d - c WHEN d < b + c + 9 + 14 THEN a + d - c + 3 END AS query_place
FROM (SELECT *, l_orderkey % 7 AS a, l_partkey % 20 + 1 AS b, l_suppkey % 5 AS c, CAST(l_quantity AS BIGINT) - 1 AS d FROM lineitem)""")
def aligned_offset(spark, sf_dir):
    op = lambda code, n: F.struct(F.lit(code).alias("op"), n.cast("int").alias("len"))
    cigar = F.array(op(S.SOFT, F.col("l_orderkey") % 7), op(S.MATCH, F.col("l_partkey") % 20 + 1), op(S.DELETE, F.col("l_suppkey") % 5), op(S.EQUAL, F.lit(9)), op(S.INSERT, F.lit(3)), op(S.DIFFER, F.lit(14)))
    pos = F.lit(1000) + F.col("l_quantity").cast("long") - 1
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", S.query_offset(cigar, F.lit(1000), pos).alias("query_place"))


@query(f"""
SELECT o_orderkey, s, CASE WHEN n > 0 THEN instr(s, repeat('A', n)) - 1 END AS run_start, n AS run_size,
       (contains(s, 'A')::INT + contains(s, 'T')::INT + contains(s, 'G')::INT + contains(s, 'C')::INT) <= 2 AS low_complexity
FROM (SELECT o_orderkey, s, coalesce(list_max(list_transform(regexp_extract_all(s, 'A+'), lambda x: length(x))), 0)::INT AS n FROM (SELECT o_orderkey, {_sql_bases('o_orderkey', POOR)} AS s FROM orders))""")
def homopolymer_runs(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", bases("o_orderkey", POOR).alias("s"))
    return rows.withColumn("r", S.longest_run(F.col("s"), "A")).select("o_orderkey", "s", F.col("r.start").alias("run_start"), F.col("r.size").alias("run_size"), S.is_low_complexity(F.col("s")).alias("low_complexity"))


_RUN = "CASE l_partkey % 3 WHEN 0 THEN concat(substr(b, 1, 9), repeat('A', CAST(l_quantity AS INTEGER) % 20), substr(b, 10, 5)) WHEN 1 THEN concat(substr(b, 1, 9), repeat('T', CAST(l_quantity AS INTEGER) % 20), substr(b, 10, 5)) ELSE b END"


@query(f"""
SELECT l_orderkey, l_partkey, l_linenumber, kind, CASE WHEN kind IS NOT NULL THEN CASE WHEN fwd <> (kind = 'A') THEN 'R' ELSE 'L' END END AS side FROM (
  SELECT *, CASE WHEN usable AND has_a AND ((NOT fwd AND r2) OR (fwd AND r1)) THEN 'A' WHEN usable AND NOT has_a AND has_t AND ((NOT fwd AND r1) OR (fwd AND r2)) THEN 'T' END AS kind
  FROM (SELECT *, contains(s, repeat('A', 12)) AS has_a, contains(s, repeat('T', 12)) AS has_t, (f & 16) = 0 AS fwd, (f & 64) <> 0 AS r1, (f & 128) <> 0 AS r2, (f & 2) = 0 AND (f & 8) = 0 AS usable
        FROM (SELECT *, {_RUN} AS s, CAST((l_orderkey * 37 + l_linenumber * 11) % 256 AS INTEGER) AS f FROM (SELECT *, {_sql_bases('l_orderkey')} AS b FROM lineitem))))""")
def polya_detection(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumn("b", bases("l_orderkey")).withColumn("s", F.expr(_RUN.replace("INTEGER", "INT")))
    rows = rows.withColumn("f", ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 256).cast("int"))
    rows = rows.withColumn("kind", S.polya_kind(F.col("s"), F.col("f")))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "kind", S.polya_side(F.col("f"), F.col("kind")).alias("side"))


@query(f"""
WITH p AS (SELECT l_suppkey, {SQL_DAY} AS pos FROM lineitem),
g AS (SELECT *, CASE WHEN pos - lag(pos) OVER w < 6 THEN 0 ELSE 1 END AS far FROM p WINDOW w AS (PARTITION BY l_suppkey ORDER BY pos)),
c AS (SELECT l_suppkey, pos, sum(far) OVER (PARTITION BY l_suppkey ORDER BY pos RANGE UNBOUNDED PRECEDING)::BIGINT AS cluster FROM g),
n AS (SELECT l_suppkey, cluster, pos, count(*) AS n FROM c GROUP BY ALL)
SELECT l_suppkey, cluster, arg_min(pos, {{'n': -n, 'p': pos}})::INT AS mode, max(n) AS n FROM n GROUP BY ALL""")
def gap_cluster_mode(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_suppkey", _day("l_shipdate").alias("pos"))
    return ordered.mode(ordered.gap_clusters(rows, ["l_suppkey"], "pos"), ["l_suppkey", "cluster"], "pos")


_COPY = "CASE WHEN l_orderkey % 5 = 0 THEN z ELSE substr(a, 1, CAST(20 + l_orderkey % 12 AS INTEGER)) END"


@query(f"""
WITH r AS (SELECT l_partkey, {_COPY} AS s, CAST(l_quantity AS INTEGER) AS q FROM (SELECT *, {_sql_bases('l_partkey')} AS a, {_sql_bases('l_orderkey')} AS z FROM lineitem)),
one AS (SELECT l_partkey, count(*) AS n, any_value(s) AS s, any_value(q) AS q FROM r GROUP BY 1),
x AS (SELECT l_partkey, p, s[p] AS b, sum(q) AS w FROM (SELECT *, unnest(range(1, length(s) + 1)) AS p FROM r) GROUP BY ALL),
d AS (SELECT l_partkey, p, arg_max(b, w) AS b, (2 * max(w) - sum(w))::INT AS d FROM x GROUP BY ALL),
m AS (SELECT l_partkey, min(p) FILTER (d <= 0) AS cut FROM d GROUP BY 1),
c AS (SELECT l_partkey, string_agg(b, '' ORDER BY p) AS seq, string_agg(d::VARCHAR, ',' ORDER BY p) AS qual FROM d JOIN m USING (l_partkey) WHERE cut IS NULL OR p < cut GROUP BY 1)
SELECT l_partkey, CASE WHEN n = 1 THEN s ELSE coalesce(seq, '') END AS seq,
       CASE WHEN n = 1 THEN array_to_string(list_transform(range(length(s)), lambda i: q), ',') ELSE coalesce(qual, '') END AS qual FROM one LEFT JOIN c USING (l_partkey)""")
def consensus_prefix(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumn("a", bases("l_partkey")).withColumn("z", bases("l_orderkey")).withColumn("s", F.expr(_COPY.replace("INTEGER", "INT")))
    rows = rows.select("l_partkey", F.col("s").alias("seq"), F.array_repeat(F.col("l_quantity").cast("int"), F.length("s")).alias("qual"))
    return consensus.weighted_consensus(rows, ["l_partkey"], "seq", "qual").withColumn("qual", F.array_join(F.col("qual").cast("array<string>"), ","))


@query("""
WITH l AS (SELECT l_suppkey, l_orderkey AS pos, l_partkey FROM lineitem WHERE l_returnflag = 'A'), r AS (SELECT l_suppkey, l_orderkey AS pos, l_partkey FROM lineitem WHERE l_returnflag = 'R'),
j AS (SELECT l.l_suppkey, l.pos, l.l_partkey, min({'a': r.pos, 'b': r.l_partkey}) AS m, l.rowid AS id
      FROM (SELECT *, row_number() OVER () AS rowid FROM l) l JOIN r ON l.l_suppkey = r.l_suppkey AND r.pos BETWEEN l.pos + 2 AND l.pos + 40 GROUP BY ALL)
SELECT l_suppkey, pos, l_partkey, m.a AS right_pos, m.b AS right_l_partkey FROM j""")
def forward_asof_pairs(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("pos"), "l_partkey", "l_returnflag")
    return ordered.forward_pairs(rows.filter("l_returnflag = 'A'"), rows.filter("l_returnflag = 'R'"), ["l_suppkey"], "pos", payload=("l_partkey",))


_ENDS = "SELECT l_suppkey, l_orderkey AS bp, (CAST(l_orderkey AS BIGINT) * 100000 + l_partkey) * 10 + l_linenumber AS id, l_returnflag AS kind, CASE WHEN l_linenumber % 2 = 0 THEN 'L' ELSE 'R' END AS side FROM lineitem"
_SIDE = lambda kind: f"coalesce(list({{'p': bp, 'i': id, 's': side}} ORDER BY bp, id) FILTER (kind = '{kind}'), [])"


@query(f"""
WITH RECURSIVE lists AS (SELECT l_suppkey, {_SIDE('A')} AS ls, {_SIDE('R')} AS rs, {_SIDE('N')} AS ps FROM ({_ENDS}) GROUP BY 1),
walk AS (
  SELECT l_suppkey, 1 AS l, 1 AS r, 1 AS p, NULL::BIGINT AS left_id, NULL::BIGINT AS right_id, NULL::VARCHAR AS kind FROM lists
  UNION ALL
  SELECT l_suppkey, CASE WHEN step = 'pair' OR (step = 'behind') = hit THEN l + 1 ELSE l END, CASE WHEN step <> 'pair' AND (step = 'behind') <> hit THEN r + 1 ELSE r END, p,
    CASE WHEN step = 'beyond' AND hit THEN ps[p].i WHEN step = 'pair' OR hit THEN ls[l].i END, CASE WHEN step = 'behind' AND hit THEN ps[p].i WHEN step = 'pair' OR hit THEN rs[r].i END,
    CASE WHEN step = 'pair' THEN 'pair' WHEN step = 'behind' AND hit THEN 'polya_right' WHEN hit THEN 'polya_left' END
  FROM (
    SELECT *, p <= len(ps) AND CASE step WHEN 'behind' THEN ps[p].p - ls[l].p < 120 AND ps[p].s = 'R' WHEN 'beyond' THEN rs[r].p - ps[p].p > 12 AND ps[p].s = 'L' ELSE FALSE END AS hit
    FROM (
      SELECT l_suppkey, l, r, ls, rs, ps, step, CASE step WHEN 'pair' THEN p ELSE greatest(p, 1 + len(list_filter(ps, lambda x: x.p < CASE step WHEN 'behind' THEN ls[l].p + 12 ELSE rs[r].p - 120 END))) END AS p
      FROM (SELECT w.l_suppkey, l, r, p, ls, rs, ps, CASE WHEN rs[r].p - ls[l].p < 2 THEN 'behind' WHEN rs[r].p - ls[l].p > 40 THEN 'beyond' ELSE 'pair' END AS step
            FROM walk w JOIN lists USING (l_suppkey) WHERE l <= len(ls) AND r <= len(rs)))))
SELECT l_suppkey, left_id, right_id, kind FROM walk WHERE kind IS NOT NULL""")
def rescued_pairs(spark, sf_dir):
    place = (F.col("l_orderkey").cast("long") * 100_000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")
    rows = _table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("bp"), place.alias("id"), "l_returnflag", F.when(F.col("l_linenumber") % 2 == 0, "L").otherwise("R").alias("side"))
    of = lambda flag: rows.filter(F.col("l_returnflag") == flag)
    return ordered.pairs_with_rescue(of("A").drop("side"), of("R").drop("side"), of("N"), ["l_suppkey"])


_READS = f"SELECT l_suppkey % 100 AS contig, {SQL_DAY} AS read_start, {SQL_DAY} + 1 + CAST(l_quantity AS INTEGER) % 9 AS read_end, l_orderkey, l_partkey, l_linenumber FROM lineitem"
_TARGETS = "SELECT o_custkey % 100 AS contig, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS target_start, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 2 AS target_end, o_orderkey FROM orders"


def _reads(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 100).alias("contig"), _day("l_shipdate").alias("read_start"), (_day("l_shipdate") + 1 + F.col("l_quantity").cast("int") % 9).alias("read_end"), "l_orderkey", "l_partkey", "l_linenumber")


def _targets(spark, sf_dir):
    day = _day("o_orderdate")
    return _table(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("contig"), day.alias("target_start"), (day + 2).alias("target_end"), "o_orderkey")


@query(f"SELECT t.contig, o_orderkey, target_start, l_orderkey, l_partkey, l_linenumber, read_start, read_end FROM ({_TARGETS}) t JOIN ({_READS}) r ON t.contig = r.contig AND target_start < read_end AND read_start < target_end")
def interval_overlap(spark, sf_dir):
    # The fewer targets of a bin are held and the reads go past them.
    pairs = intervals.overlap_join(_reads(spark, sf_dir), _targets(spark, sf_dir), ["contig"], ("read_start", "read_end"), ("target_start", "target_end"), width=16)
    return pairs.select("contig", "o_orderkey", "target_start", "l_orderkey", "l_partkey", "l_linenumber", "read_start", "read_end")


@query(f"SELECT o_orderkey, count(l_orderkey) AS n FROM ({_TARGETS}) t LEFT JOIN ({_READS}) r ON t.contig = r.contig AND target_start < read_end AND read_start < target_end GROUP BY 1")
def region_counts(spark, sf_dir):
    return intervals.count_overlaps(_targets(spark, sf_dir), _reads(spark, sf_dir), ["contig"], ("target_start", "target_end"), ("read_start", "read_end"), ["o_orderkey"])


@query("""
WITH h AS (SELECT l_suppkey, l_orderkey // 100 * 100 AS bin FROM lineitem GROUP BY ALL HAVING count(*) >= 4)
SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber FROM lineitem x WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.l_suppkey = x.l_suppkey AND x.l_orderkey > bin - 50 AND x.l_orderkey < bin + 150)""")
def hot_bin_anti_join(spark, sf_dir):
    return intervals.without_hot_bins(_table(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey").select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber")


@query("""
WITH b AS (SELECT s_suppkey AS t, s_suppkey % 7 * 1000 AS s, s_suppkey % 7 * 1000 + 5000 AS e, s_suppkey * 10 AS q, s_suppkey % 2 = 0 AS fwd FROM supplier
           UNION ALL SELECT s_suppkey, s_suppkey % 7 * 1000 + 2500, s_suppkey % 7 * 1000 + 9000, s_suppkey, TRUE FROM supplier)
SELECT l_suppkey, l_orderkey, l_linenumber, concat('q', t) AS lifted_contig, CASE WHEN fwd THEN q + l_orderkey - s ELSE 100000 - 1 - (q + l_orderkey - s) END AS lifted_pos, CASE WHEN fwd THEN '+' ELSE '-' END AS lifted_strand
FROM lineitem JOIN b ON l_suppkey = t AND l_orderkey >= s AND l_orderkey < e""")
def liftover_points(spark, sf_dir):
    s, key = _table(spark, sf_dir, "supplier"), F.col("s_suppkey")

    def block(lo, hi, q, strand):
        return s.select(key.alias("t_contig"), lo.alias("t_start"), hi.alias("t_end"), F.concat(F.lit("q"), key).alias("q_contig"), q.alias("q_start"), F.lit(100_000).alias("q_size"), strand.alias("q_strand"))

    at = key % 7 * 1000
    blocks = block(at, at + 5000, key * 10, F.when(key % 2 == 0, "+").otherwise("-")).unionAll(block(at + 2500, at + 9000, key, F.lit("+")))
    return intervals.lift_over(_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), blocks, "l_suppkey", "l_orderkey", width=2000)


@query("""
WITH b AS (SELECT s_suppkey AS t, s_suppkey % 7 * 1000 AS s, s_suppkey % 7 * 1000 + 5000 AS e, s_suppkey * 10 AS q, s_suppkey % 3 * 50 AS score, 2 * s_suppkey AS nr FROM supplier
           UNION ALL SELECT s_suppkey, s_suppkey % 7 * 1000 + 2500, s_suppkey % 7 * 1000 + 9000, 50 * s_suppkey, s_suppkey % 2 * 50, 2 * s_suppkey + 1 FROM supplier),
p AS (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem)
SELECT l_suppkey, l_orderkey, concat('q', nr) AS lifted_contig, q + l_orderkey - s AS lifted_pos, '+' AS lifted_strand FROM p JOIN b ON l_suppkey = t AND l_orderkey >= s AND l_orderkey < e
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY score DESC, nr) = 1""")
def liftover_first_hits(spark, sf_dir):
    s, key = _table(spark, sf_dir, "supplier"), F.col("s_suppkey")

    def block(lo, hi, q, score, nr):
        return s.select(key.alias("t_contig"), lo.alias("t_start"), hi.alias("t_end"), F.concat(F.lit("q"), nr).alias("q_contig"), q.alias("q_start"), F.lit(10**9).alias("q_size"), F.lit("+").alias("q_strand"), score.cast("double").alias("score"), F.struct(nr).alias("chain"))

    at = key % 7 * 1000
    blocks = block(at, at + 5000, key * 10, key % 3 * 50, 2 * key).unionAll(block(at + 2500, at + 9000, 50 * key, key % 2 * 50, 2 * key + 1))
    points = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey").distinct()
    return intervals.first_hits(intervals.lift_over(points, blocks, "l_suppkey", "l_orderkey", width=2000), ["l_suppkey", "l_orderkey"])


_ASKED = "CASE o_custkey % 5 WHEN 0 THEN concat('', o_custkey % 30) WHEN 1 THEN concat('chr', o_custkey % 30) WHEN 2 THEN 'MT' WHEN 3 THEN concat('GL', o_custkey % 30, '.1') ELSE concat('K', o_custkey % 9) END"
_NAMED = "CASE WHEN n_nationkey < 15 THEN concat('chr', n_nationkey) WHEN n_nationkey = 15 THEN 'chrM' WHEN n_nationkey < 20 THEN concat('GL', n_nationkey, 'v2') WHEN n_nationkey < 23 THEN concat('un_GL', n_nationkey - 4, '_random') ELSE concat('K', n_nationkey - 20) END"


@query(f"""
WITH w AS (SELECT DISTINCT {_ASKED} AS contig FROM orders), g AS (SELECT {_NAMED} AS g FROM nation)
SELECT contig, coalesce((SELECT g FROM g WHERE g = contig), (SELECT g FROM g WHERE contig = 'MT' AND g = 'chrM'), (SELECT g FROM g WHERE g = concat('chr', contig)),
                        CASE WHEN length(contig) > 2 THEN (SELECT min(g) FROM g WHERE contains(g, regexp_replace(contig, '\\.1$', ''))) END) AS genome_contig FROM w""")
def contig_names(spark, sf_dir):
    return genomes.resolve_contigs(_table(spark, sf_dir, "orders").select(F.expr(_ASKED).alias("contig")), _table(spark, sf_dir, "nation").select(F.expr(_NAMED).alias("contig")))


@query(f"""
WITH g AS (SELECT p_partkey % 20 AS c, p_partkey // 20 * 32 AS g0, {_sql_bases('p_partkey')} AS s FROM part),
t AS (SELECT *, row_number() OVER () AS id, l_suppkey % 20 AS c, l_orderkey % 3000 AS a FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(string_agg(substr(s, greatest(a, g0) - g0 + 1, least(a + 12, g0 + 32) - greatest(a, g0)), '' ORDER BY g0), '') AS bases
FROM t LEFT JOIN g ON t.c = g.c AND a < g0 + 32 AND g0 < a + 12 GROUP BY id, l_orderkey, l_partkey, l_suppkey, l_linenumber""")
def genome_kmers(spark, sf_dir):
    genome = _table(spark, sf_dir, "part").select((F.col("p_partkey") % 20).alias("contig"), F.expr("p_partkey div 20 * 32").alias("chunk_start"), bases("p_partkey").alias("seq"))
    places = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (F.col("l_suppkey") % 20).alias("c"), (F.col("l_orderkey") % 3000).alias("a")).withColumn("e", F.col("a") + 12)
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    # Rows that repeat in all ids are looked up once and repeated.
    found = intervals.genome_slices(places.dropDuplicates(ids), genome, ids, "c", "a", "e", 32)
    return places.select(*ids).join(found, ids)


# A stretch of two neighbouring parts' bases, with one base changed in some, turned round in others; every fifth is of no part.
_STRETCH = f"substr(concat(CASE WHEN o_orderkey % 5 = 0 THEN {{own}} ELSE {{one}} END, {{two}}), CAST(1 + o_orderkey % 30 AS INTEGER), 34)"
_SPOILT = "CASE WHEN o_orderkey % 3 = 0 THEN concat(substr(s, 1, CAST(o_orderkey % 34 AS INTEGER)), 'A', substr(s, CAST(o_orderkey % 34 + 2 AS INTEGER))) ELSE s END"


@query(f"""
WITH t AS (SELECT string_agg({_sql_bases('p_partkey')}, '' ORDER BY p_partkey // 20) AS g, p_partkey % 20 AS contig FROM part WHERE p_partkey >= 20 GROUP BY 2),
k AS (SELECT contig, unnest(range(1, length(g) - 32)) AS p, g FROM t),
w AS (SELECT contig, p - 1 AS start, substr(g, p, 17) AS a, substr(g, p + 17, 17) AS b FROM k),
s AS (SELECT o_orderkey, {_STRETCH.format(own=_sql_bases('o_orderkey'), one=_sql_bases('p_partkey'), two=_sql_bases('p_partkey + 20'))} AS s FROM orders JOIN part ON p_partkey = o_custkey WHERE p_partkey >= 20),
q AS (SELECT o_orderkey, {_SPOILT} AS s FROM s),
d AS (SELECT o_orderkey, TRUE AS is_forward, s FROM q UNION ALL SELECT o_orderkey, FALSE, reverse(translate(s, 'ACGT', 'TGCA')) FROM q),
m AS (SELECT o_orderkey, is_forward, contig, start, s, concat(a, b) AS g FROM d JOIN w ON substr(s, 1, 17) = a UNION SELECT o_orderkey, is_forward, contig, start, s, concat(a, b) FROM d JOIN w ON substr(s, 18, 17) = b)
SELECT o_orderkey AS query, contig, start + 32 AS start, start + 66 AS "end", is_forward, CAST(hamming(s, g) AS INTEGER) AS mismatches FROM m WHERE length(g) = length(s) AND hamming(s, g) <= 1""")
def seed_search(spark, sf_dir):
    part = _table(spark, sf_dir, "part").filter("p_partkey >= 20").select("p_partkey")
    genome = part.select((F.col("p_partkey") % 20).alias("contig"), F.expr("p_partkey div 20 * 32").alias("chunk_start"), bases("p_partkey").alias("seq"))
    # Bases are spelt behind the join, so that it moves numbers only.
    asked = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(part, F.col("p_partkey") == F.col("o_custkey"))
    asked = asked.withColumns({"own": bases("o_orderkey"), "b": bases("p_partkey"), "next": bases(F.col("p_partkey") + 20)})
    asked = asked.withColumn("s", F.expr(_STRETCH.format(own="own", one="b", two="next").replace("INTEGER", "INT")))
    asked = asked.select(F.col("o_orderkey").alias("query"), F.expr(_SPOILT.replace("INTEGER", "INT")).alias("seq"))
    return seeds.find_places(asked, genome, seeds.genome_minimisers(genome), 32, longest=34)


_SCORES = {"lr": "(l_orderkey * 7) % 200 - 60", "la": "(l_partkey * 3 + l_orderkey) % 200 - 110", "lx": "(l_linenumber * 5) % 40", "rr": "(l_orderkey * 11 + l_linenumber) % 220 - 60", "ra": "(l_suppkey * 13 + l_orderkey) % 180 - 110", "rx": "(l_orderkey + l_linenumber) % 40"}


@query(f"""
WITH s AS (SELECT l_partkey, {', '.join(f'CAST({e} AS DOUBLE)' + (' / 4' if k[1] == 'x' else '') + f' AS {k}' for k, e in _SCORES.items())} FROM lineitem),
v AS (SELECT *, CASE WHEN greatest(lr, la) <= lx THEN 1 WHEN greatest(rr, ra) <= rx THEN 2 WHEN rr >= ra AND rr > 0 AND lr >= la AND lr > 0 THEN 3 WHEN rr >= ra AND rr > 0 AND la > 0 THEN 4 WHEN rr >= ra AND rr > 0 THEN 0
      WHEN ra > 0 AND lr >= la AND lr > 0 THEN 5 WHEN ra > 0 AND la > 0 THEN 6 ELSE 0 END AS k FROM s),
q AS (SELECT l_partkey, sum(CASE k WHEN 3 THEN rr - ra + lr - ra WHEN 4 THEN rr - ra WHEN 5 THEN lr - la ELSE 0 END) AS ref, sum(CASE k WHEN 4 THEN la - lr WHEN 5 THEN ra - rr ELSE 0 END) AS alt,
      sum(CASE k WHEN 1 THEN lx - greatest(lr, la) WHEN 2 THEN rx - greatest(rr, ra) WHEN 6 THEN la - lr + ra - rr ELSE 0 END) AS art, -count(*) FILTER (k = 3) AS hom FROM v GROUP BY 1),
c AS (SELECT *, CASE WHEN art >= greatest(ref, alt) THEN 'artefact' WHEN alt > art THEN CASE WHEN hom < 0 THEN CASE WHEN ref >= art THEN 'heterozygous' ELSE 'artefact' END WHEN alt >= ref THEN 'homozygous' ELSE 'heterozygous' END ELSE 'wild-type' END AS genotype FROM q)
SELECT l_partkey, genotype, trunc(CASE genotype WHEN 'artefact' THEN art WHEN 'wild-type' THEN ref ELSE alt END)::BIGINT AS score_genotype, trunc(CASE genotype WHEN 'artefact' THEN greatest(ref, alt) WHEN 'wild-type' THEN alt ELSE ref END)::BIGINT AS score_alternative FROM c""")
def genotype_call(spark, sf_dir):
    e = {k: F.expr(v).cast("double") / (4 if k[1] == "x" else 1) for k, v in _SCORES.items()}
    side = lambda s: F.struct(e[s + "r"].alias("q_ref"), e[s + "a"].alias("q_alt"), e[s + "x"].alias("q_art"))
    rows = _table(spark, sf_dir, "lineitem").select("l_partkey", side("l").alias("left"), side("r").alias("right"))
    return genotypes.call_genotypes(rows, ["l_partkey"])


_CALLS = """SELECT l_suppkey % 10 AS sample, l_partkey AS insertion, CASE m.f WHEN 'R' THEN 'wild-type' WHEN 'A' THEN 'heterozygous' ELSE 'artefact' END AS genotype, CAST(floor(m.p) AS BIGINT) AS score_genotype
FROM (SELECT l_suppkey % 10 AS l_suppkey, l_partkey, max({'o': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice, 'f': l_returnflag}) AS m FROM lineitem GROUP BY l_suppkey % 10, l_partkey)"""
_COLONIES = replace(MOUSE, min_wild_types=2, min_insertions=1, max_artefact=4, max_na=4, min_best_score=20_000)


def _calls(spark, sf_dir):
    last = F.max(F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")).alias("m")
    rows = _table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("sample"), F.col("l_partkey").alias("insertion")).agg(last)
    named = F.when(F.col("m.l_returnflag") == "R", genotypes.WILD_TYPE).when(F.col("m.l_returnflag") == "A", genotypes.HETEROZYGOUS).otherwise(genotypes.ARTEFACT)
    return rows.select("sample", "insertion", named.alias("genotype"), F.floor("m.l_extendedprice").cast("long").alias("score_genotype"))


@query(f"""
WITH c AS ({_CALLS}), k AS (
  SELECT insertion FROM c GROUP BY 1 HAVING count(*) FILTER (genotype = 'wild-type') >= 2 AND count(*) FILTER (genotype = 'heterozygous') >= 1 AND count(*) FILTER (genotype = 'artefact') <= 4
  AND (SELECT count(DISTINCT sample) FROM c) - count(*) <= 4 AND coalesce(max(score_genotype) FILTER (genotype = 'wild-type') >= 20000, TRUE) AND coalesce(max(score_genotype) FILTER (genotype = 'heterozygous') >= 20000, TRUE))
SELECT * FROM c WHERE insertion IN (SELECT insertion FROM k)""")
def genotype_matrix_filter(spark, sf_dir):
    return genotypes.filter_matrix(_calls(spark, sf_dir), config=_COLONIES).select("sample", "insertion", "genotype", "score_genotype")


@query(f"SELECT insertion, {', '.join(f'max(genotype) FILTER (sample = {i}) AS s{i}' for i in range(10))} FROM ({_CALLS}) GROUP BY 1")
def genotype_matrix(spark, sf_dir):
    calls = _calls(spark, sf_dir).withColumn("sample", F.concat(F.lit("s"), F.col("sample")))
    return genotypes.to_matrix(calls, [f"s{i}" for i in range(10)])


@query("""
WITH c AS (SELECT l_orderkey AS qname, CASE l_returnflag WHEN 'A' THEN 'L' WHEN 'R' THEN 'R' ELSE 'P' END AS side, l_partkey * 1000 + l_suppkey * 10 + l_linenumber AS ordinal, l_linenumber % 2 = 0 AS want FROM lineitem),
t AS (SELECT qname, max({'p': CASE side WHEN 'R' THEN 2 WHEN 'L' THEN 1 ELSE 0 END, 'o': CASE side WHEN 'P' THEN -ordinal ELSE ordinal END, 'w': want, 'bp': ordinal}) AS m,
      bool_and(want) FILTER (side <> 'P') AS lo, bool_or(want) FILTER (side <> 'P') AS hi FROM c GROUP BY 1),
w AS (SELECT qname, coalesce(lo, m.w) AS want, m.bp AS bp FROM t WHERE lo = hi OR lo IS NULL)
SELECT bp, o_orderkey, o_custkey FROM w JOIN orders ON qname = o_orderkey AND want = (o_custkey % 2 = 0)""")
def mate_lookup(spark, sf_dir):
    claims = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("qname"), F.when(F.col("l_returnflag") == "A", "L").when(F.col("l_returnflag") == "R", "R").otherwise("P").alias("side"),
        (F.col("l_partkey") * 1000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("ordinal"), (F.col("l_linenumber") % 2 == 0).alias("want_read1")).withColumn("bp", F.col("ordinal"))
    reads = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("qname"), (F.col("o_custkey") % 2 == 0).alias("is_read1"), "o_orderkey", "o_custkey")
    return insertions.find_mates(claims, reads, ["o_orderkey", "o_custkey"])


@query("SELECT user_id, event_type AS side, arg_max(props, {'v': value, 'l': -event_id}) AS model, max(value) AS score FROM events GROUP BY 1, 2")
def best_hit(spark, sf_dir):
    hits = _table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("side"), F.col("props").alias("model"), F.col("value").alias("score"), "event_id")
    return insertions.best_hit(hits, ["user_id", "side"], "model", "score", "event_id")


@query("""
WITH a AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'), j AS (SELECT a.l_orderkey AS x, b.l_orderkey AS y FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey)
SELECT count(x) AS n_a, count(y) AS n_b, count(*) FILTER (x = y) AS n_both, count(*) FILTER (y IS NULL) AS only_a, count(*) FILTER (x IS NULL) AS only_b FROM j""")
def set_overlap(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    return insertions.set_overlap(rows.filter("l_returnflag = 'A'"), rows.filter("l_returnflag = 'R'"), "l_orderkey")


@query("SELECT * FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')")
def symmetric_difference(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    return insertions.symmetric_difference(*(rows.filter(F.col("l_returnflag") == f).select("l_partkey", "l_suppkey") for f in "AR"))


_LEGACY = "concat('runs/', lpad(CAST(l_suppkey AS VARCHAR), 7, '0'), '_', l_linenumber)"


@query(f"SELECT l_partkey, substr(split_part({_LEGACY}, '/', 2), 1, 7) AS patient, count(*) AS n_found FROM lineitem GROUP BY 1, 2")
def patient_counts(spark, sf_dir):
    return records.patient_counts(_legacy(spark, sf_dir)).withColumnRenamed("name", "l_partkey")


def _legacy(spark, sf_dir) -> DataFrame:
    """File sections of a combined file, as the reader gives them."""
    return _table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("name"), F.lit("FILES").alias("section"), F.expr(_LEGACY.replace("VARCHAR", "STRING")).alias("value"))


@query(f"""
WITH c AS (SELECT l_partkey AS name, substr(split_part({_LEGACY}, '/', 2), 1, 7) AS patient, count(*) AS n_found FROM lineitem GROUP BY 1, 2),
t AS (SELECT lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS patient, count(*) AS n FROM lineitem WHERE l_orderkey % 3 > 0 GROUP BY 1)
SELECT name, patient, n_found, coalesce(n, 0) AS n_files FROM c LEFT JOIN t USING (patient) WHERE name IN (SELECT p_partkey FROM part WHERE p_size <= 25)""")
def germline_coverage(spark, sf_dir):
    paths = _table(spark, sf_dir, "lineitem").select(F.concat(F.lit("a/"), F.when(F.col("l_orderkey") % 3 == 0, "old_runs").otherwise("runs"), F.lit("/"), F.lpad(F.col("l_suppkey").cast("string"), 7, "0"), F.lit("_x.txt.gz")).alias("path"))
    listed = _table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("name"))
    return reports.coverage_by_patient(records.patient_counts(_legacy(spark, sf_dir)), listed, reports.patient_files(paths))


@query("""
WITH c AS (SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'L' ELSE 'R' END AS side, count(*) AS n, bool_or(l_returnflag = 'R' AND l_linenumber = 1) AS barred, nullif(count(*) FILTER (l_linenumber <= 3), 0) AS n_best,
                  count(*) = 1 AND bool_or(l_returnflag = 'A') AS rescued, CAST(max(l_quantity) AS INTEGER) - 20 AS clip, CAST(min(l_quantity) AS INTEGER) + 30 AS aligned, min(l_linenumber) = 1 AND max(l_linenumber) = 3 AS rep
           FROM lineitem GROUP BY l_partkey, l_suppkey % 7, l_suppkey % 2)
SELECT side, CASE WHEN rescued THEN 'rescued_polya' WHEN n = 1 THEN 'too_few' WHEN barred THEN 'excluded' WHEN coalesce(n_best, 0) < 2 THEN 'too_few_precise' WHEN clip <= 12 THEN 'short_clip' WHEN aligned <= 40 THEN 'short_aligned'
            WHEN rep THEN 'short_repeat' ELSE 'passed' END AS outcome, count(*) AS n_clusters FROM c GROUP BY 1, 2""")
def cluster_outcomes(spark, sf_dir):
    line, flag, size = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_quantity")
    side = F.when(F.col("l_suppkey") % 2 == 0, "L").otherwise("R")
    clusters = _table(spark, sf_dir, "lineitem").groupBy("l_partkey", (F.col("l_suppkey") % 7).alias("c"), side.alias("side")).agg(
        F.count("*").alias("n"), F.bool_or((flag == "R") & (line == 1)).alias("barred"), F.nullif(F.count_if(line <= 3), F.lit(0)).alias("n_best"), F.bool_or(flag == "A").alias("a"),
        (F.max(size).cast("int") - 20).alias("clip"), (F.min(size).cast("int") + 30).alias("aligned"), ((F.min(line) == 1) & (F.max(line) == 3)).alias("rep"))
    args = [F.col("n"), F.col("barred"), F.col("n_best"), (F.col("n") == 1) & F.col("a"), F.col("clip"), F.col("aligned"), F.col("rep")]
    return reports.outcome_counts(clusters.withColumn("outcome", reports.cluster_outcome(*args)), ["side"])


_HIT_LINE = "l_partkey * 10000 + l_suppkey * 10 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END"
_CLIPPED = "lower(CASE WHEN o_custkey % 5 > 0 THEN b WHEN side = 'L' THEN concat('TTTTTT', b) ELSE concat(b, 'AAAAAA') END)"


@query(f"""
WITH parts AS (SELECT o_orderkey AS insertion, side, {_CLIPPED} AS seq FROM (SELECT *, {_sql_bases('o_orderkey')} AS b, unnest(['L', 'R']) AS side FROM orders)),
h AS (SELECT l_orderkey AS insertion, CASE l_linenumber WHEN 1 THEN 'L' ELSE 'R' END AS side, arg_max(concat('m', l_partkey % 10), {{'s': l_extendedprice, 'n': -({_HIT_LINE})}}) AS model FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2),
m AS (SELECT insertion, side, arg_max({{'c': c, 's': l_partkey, 'e': l_partkey + 50, 'f': f}}, n) AS m FROM (SELECT *, l_orderkey AS insertion, CASE l_linenumber WHEN 3 THEN 'L' ELSE 'R' END AS side, concat('c', l_suppkey % 3) AS c, l_returnflag <> 'R' AS f, {_HIT_LINE} AS n FROM lineitem
      WHERE l_linenumber IN (3, 4) AND l_returnflag <> 'N' AND l_quantity + 10 >= 40) GROUP BY 1, 2),
s AS (SELECT insertion, side, seq, coalesce(model, CASE WHEN side = 'L' AND starts_with(seq, 'tttttt') OR side = 'R' AND ends_with(seq, 'aaaaaa') THEN 'polyA' END) AS model,
      concat(m.c, ':', m.s, '-', m.e, CASE WHEN m.f THEN '+' ELSE '-' END) AS a, concat(m.c, ':', CASE WHEN (side = 'R') <> m.f THEN m.s ELSE m.e END, CASE WHEN m.f THEN '+' ELSE '-' END) AS p, m IS NOT NULL AS there
      FROM parts LEFT JOIN h USING (insertion, side) LEFT JOIN m USING (insertion, side)),
w AS (SELECT insertion, {', '.join(f"max({e}) FILTER (side = '{x}'{' AND there' if c in ('align', 'place') else ''}) AS {n}_{c}" for e, c in (('seq', 'seq'), ('model', 'model'), ('a', 'align'), ('p', 'place')) for x, n in (('L', 'left'), ('R', 'right')))} FROM s GROUP BY 1)
SELECT * REPLACE (CASE WHEN right_align IS NOT NULL THEN left_align END AS left_align) FROM w""")
def annotated_insertions(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", bases("o_orderkey").alias("b"), F.explode(F.array(F.lit("L"), F.lit("R"))).alias("side"))
    parts = orders.select(F.col("o_orderkey").alias("insertion"), "side", F.expr(_CLIPPED).alias("seq"))
    rows = _table(spark, sf_dir, "lineitem").withColumn("insertion", F.col("l_orderkey")).withColumn("line_no", F.expr(_HIT_LINE))
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    hits = rows.filter(line <= 2).select("insertion", F.when(line == 1, "L").otherwise("R").alias("side"), F.concat(F.lit("m"), F.col("l_partkey") % 10).alias("model"), F.col("l_extendedprice").alias("score"), "line_no")
    mappings = rows.filter(line.isin(3, 4)).select("insertion", F.when(line == 3, "L").otherwise("R").alias("side"), F.when(flag == "N", S.SECONDARY).when(flag == "R", S.REVERSE).otherwise(0).alias("flag"), (F.col("l_quantity") + 10).cast("int").alias("mapq"),
        F.concat(F.lit("c"), F.col("l_suppkey") % 3).alias("contig"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 50).alias("end"), (flag != "R").alias("is_forward"), "line_no")
    return reports.annotate(_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("insertion")), parts, hits, mappings)


@query("""
WITH a AS (SELECT l_partkey AS k, count(*) AS a FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey % 9 = 0 GROUP BY 1), b AS (SELECT l_partkey AS k, count(*) AS b FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 9 < 2 GROUP BY 1), j AS (SELECT a, b FROM a FULL JOIN b ON a.k = b.k)
SELECT count(a) AS n_a, count(b) AS n_b, count(*) FILTER (a > 0 AND b > 0) AS n_both, count(*) FILTER (a = 1) AS single_a, count(*) FILTER (a = 1 AND b > 0) AS shared_single_a, count(*) FILTER (a = 1 AND b IS NULL) AS new_single_a, count(*) FILTER (a BETWEEN 2 AND 9 AND b IS NULL) AS new_few_a,
       count(*) FILTER (b = 1) AS single_b, count(*) FILTER (b = 1 AND a > 0) AS shared_single_b, count(*) FILTER (b = 1 AND a IS NULL) AS new_single_b, count(*) FILTER (b BETWEEN 2 AND 9 AND a IS NULL) AS new_few_b FROM j""")
def discovery_comparison(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("name"), F.col("l_orderkey").alias("file"), "l_returnflag", "l_suppkey")
    return reports.compare_discoveries(rows.filter("l_returnflag = 'A' AND l_suppkey % 9 = 0"), rows.filter("l_returnflag = 'R' AND l_suppkey % 9 < 2"), "name")


@query("""SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, l_partkey * 37 + l_suppkey AS f FROM lineitem) WHERE l_quantity + 20 >= 40 AND f & 256 = 0 AND f & 4 = 0 AND f & 512 = 0""")
def voting_reads(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumn("f", F.col("l_partkey") * 37 + F.col("l_suppkey"))
    return rows.filter(genotypes.evidence_read(F.col("f"), F.col("l_quantity") + 20)).select("l_orderkey", "l_partkey", "l_linenumber")


@query("""
WITH r AS (SELECT *, l_partkey * 37 + l_suppkey AS f, l_orderkey * 11 + l_linenumber AS mf, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'T' END AS kind FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN kind IS NOT NULL THEN CASE WHEN (f & 16 = 0) <> (kind = 'A') THEN 'R' ELSE 'L' END END AS side,
       CASE WHEN l_quantity >= 40 AND kind IS NOT NULL THEN CASE WHEN ((f & 16 = 0) <> (kind = 'A')) <> (mf & 16 = 0) THEN l_suppkey ELSE l_suppkey + 100 END END AS bp FROM r""")
def polya_placement(spark, sf_dir):
    flag = F.col("l_returnflag")
    rows = _table(spark, sf_dir, "lineitem").withColumns({"f": F.col("l_partkey") * 37 + F.col("l_suppkey"), "mf": F.col("l_orderkey") * 11 + F.col("l_linenumber"), "kind": F.when(flag == "A", "A").when(flag == "R", "T")})
    at = S.polya_breakpoint(F.col("f"), F.col("kind"), F.col("mf"), F.col("l_suppkey"), F.col("l_suppkey") + 100, F.col("l_quantity"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", S.polya_side(F.col("f"), F.col("kind")).alias("side"), F.when(F.col("kind").isNotNull(), at).alias("bp"))


@query(f"""
SELECT o_orderkey, concat(lower(reverse(translate(c, 'ACGT', 'TGCA'))), a) AS left_text, concat(reverse(translate(a, 'ACGT', 'TGCA')), lower(c)) AS right_text
FROM (SELECT o_orderkey, substr(b, 1, CAST(o_orderkey % 13 + 1 AS INTEGER)) AS c, substr(b, 14, 19) AS a FROM (SELECT o_orderkey, {_sql_bases('o_orderkey')} AS b FROM orders))""")
def consensus_strings(spark, sf_dir):
    none = F.lit(None).cast("array<int>")
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", bases("o_orderkey").alias("b"))
    clip, rest = S.quality_seq(F.substring("b", F.lit(1), (F.col("o_orderkey") % 13 + 1).cast("int")), none), S.quality_seq(F.substring("b", 14, 19), none)
    return rows.select("o_orderkey", S.consensus_text(clip, rest, "L")["seq"].alias("left_text"), S.consensus_text(clip, rest, "R")["seq"].alias("right_text"))


@query("""
WITH n AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT l_orderkey AS k, max(l_suppkey) AS s, max(l_partkey) AS a FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o_orderkey, CASE WHEN n > 5 THEN 'artefact' WHEN s IS NULL THEN 'wild-type' WHEN s % 2 = 0 THEN 'homozygous' ELSE 'heterozygous' END AS genotype, CASE WHEN n > 5 THEN 0 ELSE coalesce(s, 0) END AS score_genotype, CASE WHEN n > 5 THEN 0 ELSE coalesce(a, 0) END AS score_alternative
FROM orders LEFT JOIN n ON n.k = o_orderkey LEFT JOIN c ON c.k = o_orderkey""")
def completed_calls(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    calls = rows.filter("l_returnflag = 'R'").groupBy("o_orderkey").agg(F.max("l_suppkey").alias("score_genotype"), F.max("l_partkey").alias("score_alternative"))
    calls = calls.withColumn("genotype", F.when(F.col("score_genotype") % 2 == 0, genotypes.HOMOZYGOUS).otherwise(genotypes.HETEROZYGOUS))
    crowded = rows.groupBy("o_orderkey").agg(F.count("*").alias("n")).filter("n > 5")
    return genotypes.complete_calls(_table(spark, sf_dir, "orders"), calls, crowded, ["o_orderkey"])


_KMERS = {"left_ref": "substr(a, 1, 12)", "left_alt": "concat(substr(a, 1, CAST(l_quantity AS INTEGER) % 13), substr(z, 1, 12 - CAST(l_quantity AS INTEGER) % 13))", "right_alt": "substr(z, 13, 12)",
          "right_ref": "CASE l_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN concat('N', substr(a, 2, 11)) WHEN 2 THEN substr(z, 13, 12) WHEN 3 THEN substr(a, 1, 12) ELSE substr(a, 20, 12) END"}
_LIKE = lambda r, a: f"list_sum(list_transform(range(1, 13), lambda i: CASE WHEN {r}[i] = {a}[i] THEN 1 ELSE -2 END)) > 0"


@query(f"""
WITH k AS (SELECT *, {', '.join(f'{e} AS {c}' for c, e in _KMERS.items())}, CASE l_partkey % 4 WHEN 0 THEN 'right_polya' WHEN 1 THEN 'left_polya' ELSE 'full' END AS kind FROM (SELECT *, {_sql_bases('l_partkey')} AS a, {_sql_bases('l_orderkey')} AS z FROM lineitem))
SELECT l_orderkey, l_partkey, l_linenumber, kind, CASE
  WHEN (kind <> 'right_polya' AND right_ref = '') OR (kind <> 'left_polya' AND left_ref = '') THEN 'missing'
  WHEN (kind <> 'right_polya' AND contains(right_ref, 'N')) OR (kind <> 'left_polya' AND contains(left_ref, 'N')) THEN 'unknown_bases'
  WHEN kind = 'right_polya' AND {_LIKE('left_ref', 'left_alt')} THEN 'left_similar' WHEN kind = 'left_polya' AND {_LIKE('right_ref', 'right_alt')} THEN 'right_similar'
  WHEN kind = 'full' AND {_LIKE('left_ref', 'left_alt')} AND {_LIKE('right_ref', 'right_alt')} THEN 'both_similar'
  WHEN kind = 'full' AND (left_ref = reverse(translate(right_ref, 'ACGT', 'TGCA')) OR left_ref = right_ref) THEN 'identical' END AS problem FROM k""")
def kmer_similarity_filter(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumn("a", bases("l_partkey")).withColumn("z", bases("l_orderkey"))
    rows = rows.withColumns({c: F.expr(e.replace("INTEGER", "INT")) for c, e in _KMERS.items()}).withColumn("kind", F.when(F.col("l_partkey") % 4 == 0, insertions.RIGHT_POLYA).when(F.col("l_partkey") % 4 == 1, insertions.LEFT_POLYA).otherwise(insertions.FULL))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "kind", insertions.reference_problem(*(F.col(c) for c in ("kind", "left_ref", "left_alt", "right_ref", "right_alt"))).alias("problem"))


@query("""
WITH r AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, event_type, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS section FROM r""")
def record_runs(spark, sf_dir):
    rows = ordered.run_numbers(_table(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type"))
    return ordered.forward_fill(rows, ["user_id"], "event_id", F.when(F.col("event_type") == "error", F.col("value")), "section").select("user_id", "event_id", "event_type", "run", "section")


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) > 600)")
def file_cap(spark, sf_dir):
    return insertions.cap_by_file(_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"), "l_suppkey", 600)


_TRUTH = """
WITH f AS (SELECT l_suppkey AS contig, CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS l, CASE WHEN l_returnflag <> 'R' THEN l_orderkey + l_linenumber END AS r FROM lineitem)
SELECT o_orderkey, contig, "left", "right", CASE WHEN EXISTS (SELECT 1 FROM f WHERE f.contig = t.contig AND f.l = t."left" AND f.r = t."right") THEN 'exact' WHEN EXISTS (SELECT 1 FROM f WHERE f.contig = t.contig AND f.l = t."left" AND f.r IS NULL) THEN 'right_polya'
       WHEN EXISTS (SELECT 1 FROM f WHERE f.contig = t.contig AND f.l IS NULL AND f.r = t."right") THEN 'left_polya' END AS tier
FROM (SELECT o_orderkey, o_custkey % 100 AS contig, o_orderkey AS "left", o_orderkey + o_custkey % 7 AS "right" FROM orders) t"""


@query(_TRUTH)
def truth_membership(spark, sf_dir):
    flag = F.col("l_returnflag")
    found = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("contig"), F.when(flag != "N", F.col("l_orderkey")).alias("left"), F.when(flag != "R", F.col("l_orderkey") + F.col("l_linenumber")).alias("right"))
    truth = _table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 100).alias("contig"), F.col("o_orderkey").alias("left"), (F.col("o_orderkey") + F.col("o_custkey") % 7).alias("right"))
    return insertions.truth_tier(truth, found, ["contig"])


@query(f"""SELECT contig, count(tier) AS n_found, count(*) - count(tier) AS n_missed, 100.0 * count(tier) / count(*) AS found_percent, CASE WHEN count(tier) > 0 THEN 100.0 * count(*) FILTER (tier = 'right_polya') / count(tier) ELSE 0.0 END AS polya_percent FROM ({_TRUTH}) GROUP BY 1""")
def sensitivity_by_contig(spark, sf_dir):
    return reports.sensitivity(truth_membership(spark, sf_dir), ["contig"])


@query(f"""
WITH r AS (SELECT l_partkey, l_suppkey % 20 AS k, l_orderkey * 10 + l_linenumber AS o, {_COPY} AS s FROM (SELECT *, {_sql_bases('l_partkey')} AS a, {_sql_bases('l_orderkey')} AS z FROM lineitem)),
n AS (SELECT l_partkey, k, count(*) AS n, min(length(s)) AS m, arg_max(s, {{'n': length(s), 'o': -o}}) AS seq FROM r GROUP BY ALL),
p AS (SELECT r.l_partkey, r.k, p, s[p] AS b, count(*) AS w FROM (SELECT r.*, unnest(range(1, least(24, m) + 1)) AS p FROM r JOIN n ON r.l_partkey = n.l_partkey AND r.k = n.k) r GROUP BY ALL),
q AS (SELECT l_partkey, k, p, CASE WHEN 2 * max(w) > sum(w) THEN 1 ELSE -2 END AS v FROM p GROUP BY ALL), z AS (SELECT l_partkey, k, sum(v) / count(*) AS score FROM q GROUP BY ALL)
SELECT l_partkey, k, n AS n_merged, seq FROM n JOIN z USING (l_partkey, k) WHERE n = 1 OR score >= 0.6""")
def insertion_merge(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").withColumn("a", bases("l_partkey")).withColumn("z", bases("l_orderkey")).withColumn("s", F.expr(_COPY.replace("INTEGER", "INT")))
    rows = rows.select("l_partkey", (F.col("l_suppkey") % 20).alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"), S.quality_seq(F.col("s"), F.lit(None).cast("array<int>")).alias("clip"))
    return insertions.merge_insertions(rows, ["l_partkey", "k"], ["clip"], "o").select("l_partkey", "k", "n_merged", F.col("clip.seq").alias("seq"))


@query("""SELECT o_orderkey, concat('chr', o_custkey % 22, ':', o_orderkey, '-', o_orderkey + 8) AS name, concat('chr', o_custkey % 22) AS contig, o_orderkey AS "left", o_orderkey + 8 AS "right" FROM orders""")
def insertion_names(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", S.insertion_name(S.with_chr((F.col("o_custkey") % 22).cast("string")), F.col("o_orderkey"), F.col("o_orderkey") + 8).alias("name"))
    return rows.withColumn("p", S.parse_name(F.col("name"))).select("o_orderkey", "name", "p.contig", "p.left", "p.right")
