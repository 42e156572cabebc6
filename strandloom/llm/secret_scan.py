"""Secret scans in DataFrame expressions only: fixed patterns, and sliding-window entropy over candidate strings.

Spans are code-point offsets, end exclusive. A pattern's spans come from its matches and the gaps between them, whose
lengths are added up in running sums of two levels (within blocks, then over the blocks' totals), so many matches in
one text cost little more than proportionally. The entropy part takes runs of key-like characters, moves a window over
each, updates the counts of the character that enters and the one that leaves, and keeps the maximal stretches that are
covered by windows which reach the threshold of the run's character class; a run costs a fold in proportion to its
length. Windows that overlap a string of the allow list are suppressed; spans of the fixed patterns always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: kind -> (pattern, group whose length counts, least length).
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
#: For a cheap look whether a text can have a span of the kind at all.
MAYBE = {"assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""", "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}"}
#: The runs that hex keeps, without the short ones that would be dropped: the runs are maximal either way.
LONG_HEX = r"[0-9a-f]{16,}"

_KEY = r"[A-Za-z0-9+/_=-]"
#: Runs of key-like characters: of a window's length at least, or shorter ones that can reach the bits of their class: log2(8) is 3.0, log2(14) is 3.81.
CANDIDATE = rf"(?<!{_KEY})(?:(?=[+/_=-]*+[A-Za-z0-9]){_KEY}{{20,}}+|(?:(?=[A-Za-z+/_=-]*+[0-9]){_KEY}{{8,19}}+|[A-Za-z+/_=-]{{14,19}}+)(?!{_KEY}))"
WINDOW = 20
#: (class, what a run of that class matches, least bits a character in a window); the first that fits counts.
CLASSES = (("digits", r"^[0-9_=+/-]+$", 3.0), ("hex", r"^[0-9a-fA-F-]+$", 3.0), ("letters", r"^[A-Za-z_=+/-]+$", 3.8), ("base64", r"^.*$", 3.7))
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs name things
    r"(?i:example|sample|placeholder|dummy|x{6}|your[_-])",
    r"0123456789|abcdefghij|ABCDEFGHIJ",
)
#: Stands for characters that the allow list names; no run has it.
BARRED = "\x01"
_EMPTY = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def _running(items: Column, value, merge, zero: Column) -> Column:
    """The running merge of value(x) over items, each with those before it: in blocks of about the root of their number, then over blocks."""
    last = lambda made: F.coalesce(F.get(made, F.size(made) - 1), zero)
    empty = F.slice(F.array(zero), 1, 0)

    def over(values: Column, of) -> Column:
        return F.aggregate(values, empty, lambda made, x: F.concat(made, F.array(merge(last(made), of(x)))))

    def whole(items: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(items).cast("double"))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / step).cast("int")), lambda b: over(F.slice(items, b * step + 1, step), value))
        return _let(blocks, lambda blocks: _let(over(blocks, last), lambda tops: F.flatten(F.transform(blocks, lambda block, k: F.transform(block, lambda v: merge(F.coalesce(F.get(tops, k - 1), zero), v))))))

    return _let(items, lambda items: F.when(F.size(items) > 0, whole(items)).otherwise(empty))


def _located(text: Column, pattern: str, keep) -> Column:
    """[(start, end, match)] of the matches for which keep(match) holds."""
    zipped = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.split(text, pattern, -1),
        lambda m, gap: F.struct((F.length(gap) + F.coalesce(F.length(m), F.lit(0))).alias("size"), m.alias("match")),
    )
    placed = lambda items: F.zip_with(
        items,
        _running(items, lambda x: x["size"], lambda a, b: a + b, F.lit(0)),
        lambda x, end: F.struct((end - F.length(x["match"])).alias("start"), end.alias("end"), x["match"].alias("match")),
    )
    return _let(zipped, lambda items: F.filter(placed(items), lambda x: x["match"].isNotNull() & keep(x["match"])))


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one fixed pattern, leftmost and non-overlapping; matches that are too short are dropped after matching."""
    pattern, group, least = BASE[kind]
    number = list(BASE).index(kind)
    keep = (lambda m: F.length(F.regexp_extract(m, pattern, group)) >= least) if group else (lambda m: F.length(m) >= least)
    found = _located(text, LONG_HEX if kind == "hex" else pattern, keep)
    spans = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))
    return F.when(text.rlike(MAYBE[kind]), spans).otherwise(F.array().cast(_EMPTY))


def _clog(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def _hot_stretches(run: Column, least: Column, window: Column) -> Column:
    """array<struct<first, last>>: the maximal stretches of run, from 0, last exclusive, that windows of at least least bits cover. No window with a BARRED character counts."""
    # H = log2(w) - sum(c log2 c) / w; the sum changes in two terms at each step. counts has the characters in the window alone.
    stretches = F.array().cast("array<struct<first:int,last:int>>")
    state = F.struct(F.array().cast("array<struct<code:int,n:int>>").alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("barred"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), stretches.alias("done"))

    def with_last(st):
        return F.when(st["first"] >= 0, F.concat(st["done"], F.array(F.struct(st["first"].alias("first"), st["last"].alias("last"))))).otherwise(st["done"])

    def steps(codes: Column) -> Column:
        """(place from 1, the code that enters, the code that leaves or -1)."""
        return F.transform(codes, lambda c, k: F.struct((k + 1).alias("i"), c.alias("new"), F.coalesce(F.get(codes, k - window), F.lit(-1)).alias("old")))

    def fold(bound: Column, window: Column) -> Column:
        codes = F.transform(F.split(run, ""), lambda c: F.ascii(c))

        def step(st, x):
            n_of = lambda code: F.coalesce(F.get(F.filter(st["counts"], lambda e: e["code"] == code), F.lit(0))["n"], F.lit(0))
            change = lambda e: F.when(e["code"] == x["new"], 1).when(e["code"] == x["old"], -1).otherwise(0)
            moved = F.filter(F.transform(st["counts"], lambda e: F.struct(e["code"].alias("code"), (e["n"] + change(e)).alias("n"))), lambda e: e["n"] > 0)
            entered = F.array(F.struct(x["new"].alias("code"), F.lit(1).alias("n")))

            def moved_on(n: Column) -> Column:
                same = x["new"] == x["old"]
                total = F.when(same, st["sum"]).otherwise(st["sum"] - _clog(n["new"]) + _clog(n["new"] + 1) + F.when(x["old"] >= 0, _clog(n["old"] - 1) - _clog(n["old"])).otherwise(F.lit(0.0)))
                counts = F.when(same, st["counts"]).when(n["new"] > 0, moved).otherwise(F.concat(moved, entered))
                barred = F.when(x["new"] == F.ascii(F.lit(BARRED)), x["i"]).otherwise(st["barred"])
                from_ = x["i"] - window
                hot = (from_ >= 0) & (barred <= from_) & (bound >= total)
                apart = hot & ((st["first"] < 0) | (from_ > st["last"]))
                return F.struct(
                    counts.alias("counts"),
                    total.alias("sum"),
                    barred.alias("barred"),
                    F.when(apart, from_).otherwise(st["first"]).alias("first"),
                    F.when(hot, x["i"]).otherwise(st["last"]).alias("last"),
                    F.when(apart, with_last(st)).otherwise(st["done"]).alias("done"),
                )

            return _let(F.struct(n_of(x["new"]).alias("new"), n_of(x["old"]).alias("old")), moved_on)

        return _let(codes, lambda codes: F.aggregate(steps(codes), state, step, with_last))

    # The most that the sum may be in a window of enough bits.
    bound = lambda w: w.cast("double") * (F.log2(w.cast("double")) - least) + 1e-9
    return _let(window, lambda w: _let(bound(w), lambda b: fold(b, w)))


def entropy_spans(text: Column, window: int = WINDOW, classes=CLASSES, allowed=ALLOWED, candidate: str = CANDIDATE, number: int = len(BASE)) -> Column:
    """Spans of the stretches of candidate runs whose windows reach their class's entropy; windows that overlap a string of the allow list do not count.

    Spans of kind number; a run shorter than a window is one window, and its span of kind number + 1.
    """
    allow = "|".join(f"(?:{p})" for p in allowed)
    least = F.lit(99.0)

    def bits(run):
        out = least
        for _, fits, bound in reversed(classes):
            out = F.when(run.rlike(fits), F.lit(bound)).otherwise(out)
        return out

    def barred(run):
        """The run with BARRED for each character of a string of the allow list."""
        parts = F.zip_with(F.split(run, allow, -1), F.regexp_extract_all(run, F.lit(allow), F.lit(0)), lambda gap, m: F.concat(gap, F.coalesce(F.repeat(F.lit(BARRED), F.length(m)), F.lit(""))))
        return F.when(run.rlike(allow), F.array_join(parts, "")).otherwise(run)

    # No window has more bits than the run's different characters allow.
    can = lambda m: F.log2(F.size(F.array_distinct(F.split(m, ""))).cast("double")) >= bits(m) - 1e-9
    runs = _located(text, candidate, can)
    size = lambda x: F.length(x["match"])
    marked = F.transform(runs, lambda x: F.struct(x["start"].alias("start"), F.when(size(x) < window, number + 1).otherwise(number).alias("kind"), _hot_stretches(barred(x["match"]), bits(x["match"]), F.least(F.lit(window), size(x))).alias("hot")))
    spans = F.flatten(F.transform(marked, lambda x: F.transform(x["hot"], lambda h: F.struct((x["start"] + h["first"]).alias("start"), x["kind"].alias("kind"), (x["start"] + h["last"]).alias("end")))))
    return F.when(text.rlike(candidate), spans).otherwise(F.array().cast(_EMPTY))


def find_secrets(df: DataFrame, text_col: str = "text", into: str = "secret_spans") -> DataFrame:
    """df + into: array<struct<start, kind, end>> in order of start, then kind (0 assign, 1 access, 2 hex, 3 entropy, 4 entropy of a run under WINDOW).

    A null or empty text has no spans. Rows are independent, so repeated rows get equal spans; an empty table gives no
    rows. Spans of different kinds may overlap. Other columns stay; one that is named as into is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = F.array(*(base_spans(text, k) for k in BASE), entropy_spans(text))
    return df.withColumn(into, F.array_sort(F.flatten(parts)))


def redact(df: DataFrame, text_col: str = "text", spans_col: str = "secret_spans", mark: str = "[SECRET]") -> DataFrame:
    """Put mark in the place of each maximal stretch covered by spans; a text without spans, null too, stays as it is."""
    text = F.col(text_col)
    ends = _running(F.col(spans_col), lambda x: x["end"], lambda a, b: F.greatest(a, b), F.lit(0))

    def parts(ends: Column) -> Column:
        """(end of what is covered before the stretch, its start) of each maximal stretch."""
        before = lambda k: F.coalesce(F.get(ends, k - 1), F.lit(0))
        both = F.transform(F.col(spans_col), lambda x, k: F.struct(before(k).alias("at"), x["start"].alias("start"), (k == 0).alias("first")))
        return F.filter(both, lambda x: x["first"] | (x["start"] >= x["at"]))

    def put(chars: Column, ends: Column) -> Column:
        cut = lambda at, n: F.array_join(F.slice(chars, at + 1, n), "")
        kept = F.array_join(F.transform(parts(ends), lambda x: F.concat(cut(x["at"], x["start"] - x["at"]), F.lit(mark))), "")
        return _let(F.get(ends, F.size(ends) - 1), lambda end: F.concat(kept, cut(end, F.greatest(F.size(chars) - end, F.lit(0)))))

    clean = _let(F.split(text, ""), lambda chars: _let(ends, lambda ends: put(chars, ends)))
    return df.withColumn(text_col, F.when(F.size(spans_col) > 0, clean).otherwise(text))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*BASE, "entropy", "short")))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def op4(spark, sf_dir) -> DataFrame:
    """Secrets of every document as counts, a digest of the fixed patterns' spans, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_secrets(docs)
    count = lambda k: F.size(F.filter("secret_spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.filter("secret_spans", lambda x: x["kind"] < len(BASE))), 256).alias("base_sha256"),
        _joined(F.col("secret_spans")).alias("spans"),
    )
