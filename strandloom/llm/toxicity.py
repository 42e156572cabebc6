"""Toxicity by a support vector machine over a subsequence string kernel with Nystrom landmarks.

The kernel of two strings sums over all three-letter subsequences with small gaps, each occurrence weighing DECAY to the
number of letters skipped, so an insult with inserted or missing characters stays close to itself. Strings are the
units of a sentence: its words, without marks within them, and letters written apart, which are put together first. Landmarks are units of the labelled
sample; K^-1/2 of the landmarks' kernel maps a unit to a vector, in which a linear machine is trained. A labelled text
is a bag of units: a toxic one counts by the units that speak for its label and by its most toxic one, a clean one by its
most toxic unit and others, and the most toxic ones are chosen anew by the machine of each round.

The machine's value is linear in kernel values, and these are linear in the unit's subsequence weights; so it is folded
into one table with a weight for each three symbols, and a text costs a few array operations a byte, whatever the number
of landmarks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, prepare, raw_bytes

DECAY = 0.6
#: Places of the second and third letter after the first.
STEPS = tuple((a, b) for b in (2, 3, 4) for a in range(1, b))
#: The bound of the labelled sample: so many toxic and so many clean texts, the first by a hash of the id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1600, 3200
LANDMARKS = 200
#: Symbols: 0 is no letter, 1 to 26 are a to z, 27 is the start of a unit, the rest stand for the last bytes of other letters.
START, SYMBOLS = 27, 40
CUBE = SYMBOLS**3
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:192] = 28 + np.arange(64) % 12
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: What a byte is to letters written apart: more of a character, a letter, a mark or space, or none of these.
_INSIDE, _LETTER, _GAP, _OTHER = range(4)
_KIND = np.full(256, _GAP, np.uint8)
_KIND[97:123] = _KIND[65:91] = _KIND[192:] = _LETTER
_KIND[48:58], _KIND[128:192] = _OTHER, _INSIDE
#: First bytes and second bytes of marks beyond ASCII: Latin ones without the three letters among them, and general punctuation.
_MARKS = ((0xC2, np.setdiff1d(np.arange(128, 192), [0xAA, 0xB5, 0xBA])), (0xE2, np.array([0x80, 0x81])))
#: Marks and spaces that may stand between two letters written apart.
APART = 3
#: A unit's own kernel value counts as within these, so that very short and very long units compare with words.
LEAST_NORM, MOST_NORM = 4.0, 10.0
#: A text's evidence: the values of its TOP units, the number of those above 0, and its length.
TOP = 3
#: Bytes of text that are taken apart at a time.
SLICE = 1 << 20
#: Weight of either class's errors against the machine's width.
COST = 6_000.0
#: How strongly a unit of the sample must speak for the label to be positive by itself; weight of a clean text's most toxic unit.
TELLING, HARD = 10.0, 20.0
#: Weight of the changed spellings of such units, by all others, and the share of the toxic texts that a unit must be in to be changed.
VARIED, OFTEN = 0.15, 1 / 64
#: Clean texts with one insult put in that the curve sees, as a share of the toxic texts.
LONE = 1 / 16
#: Other units of clean texts that the machine sees.
CLEAN_UNITS = 15_000


@dataclass
class Model:
    table: np.ndarray  # weight of each three symbols
    bias: float
    curve: np.ndarray  # weights of a text's evidence in the logistic score, the constant last


def _framed(body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a line feed before each, and with letters written apart put together."""
    return _closed(np.insert(body, off[:-1], 10), off + np.arange(len(off)))


def _closed(body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Framed rows without the up to APART marks between two letters, and without spaces and marks between three or more letters that each stand alone."""
    kind = _KIND[body]
    for byte, after in _MARKS:
        at = np.flatnonzero(body[:-1] == byte)
        kind[at[np.isin(body[at + 1], after)]] = _GAP
    lead = np.flatnonzero(kind != _INSIDE)
    kind = np.append(kind[lead], _GAP)
    letter, gap = kind == _LETTER, kind == _GAP
    # From the last letter before a gap to the first one after it.
    a = np.flatnonzero(letter[:-1] & gap[1:])
    b = np.full(len(a), -1)
    for k in range(APART + 1, 1, -1):
        b = np.where(letter[np.minimum(a + k, len(kind) - 1)], a + k, b)
    for k in range(2, APART + 1):
        b[(b > a + k) & ~gap[np.minimum(a + k, len(kind) - 1)]] = -1
    a, b = a[b > 0], b[b > 0]
    same = np.searchsorted(off, lead[a], "right") == np.searchsorted(off, lead[b], "right")
    a, b = a[same], b[same]
    space = np.append(0, np.cumsum(_SPACE[body[lead]]))
    marks = space[b] == space[a]
    alone = gap[a - 1] & gap[b + 1]
    more = np.append((a[1:] == b[:-1]) & alone[1:], False) if len(a) else alone
    less = np.append(False, (a[1:] == b[:-1]) & alone[:-1]) if len(a) else alone
    linked = marks | (alone & (more | less))
    if not linked.any():
        return body, off
    edge = np.zeros(len(body) + 1, np.int8)
    edge[lead[a[linked] + 1]] = 1
    edge[lead[b[linked]]] = -1
    left = np.cumsum(edge[:-1], dtype=np.int8) == 0
    return body[left], np.concatenate([[0], np.cumsum(left)])[off]


def _units(body: np.ndarray, off: np.ndarray):
    """(first byte of each unit, its row, unit of each byte from the one before the first unit on) of framed rows."""
    space = _SPACE[body]
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if not len(starts):
        return starts, starts, starts
    stops = np.flatnonzero(~space & np.append(space[1:], True))
    single = (stops == starts) & (_SYMBOL[body[starts]] > 0)
    row = np.searchsorted(off, starts, "right") - 1
    joins = np.zeros(len(starts), bool)
    joins[1:] = single[1:] & single[:-1] & (row[1:] == row[:-1]) & (starts[1:] - starts[:-1] == 2)
    starts, row = starts[~joins], row[~joins]
    return starts, row, np.repeat(np.arange(len(starts)), np.diff(starts - 1, append=len(body)))


def _triples(body: np.ndarray, starts: np.ndarray, unit: np.ndarray):
    """For each step: (place from the byte before the first unit, index of the three symbols, weight)."""
    sym = _SYMBOL[body[starts[0] - 1 :]]
    sym[starts - starts[0]] = START
    for a, b in STEPS:
        m = len(sym) - b
        if m <= 0:
            continue
        at = np.flatnonzero((unit[:m] == unit[b:]) & (sym[:m] > 0) & (sym[a : m + a] > 0) & (sym[b:] > 0))
        yield at, (sym[at] * SYMBOLS + sym[at + a]) * SYMBOLS + sym[at + b], DECAY ** (b - 2)


def unit_values(body: np.ndarray, off: np.ndarray, table: np.ndarray):
    """(row of each unit of framed rows, sum of table over its subsequences divided by its norm, starts). table may have several columns."""
    starts, row, unit = _units(body, off)
    wide = table.reshape(CUBE, -1)
    if not len(starts):
        return row, np.zeros((0, wide.shape[1])), starts
    n = len(unit)
    norm = np.zeros(len(starts))
    total = np.zeros((len(starts), wide.shape[1]))
    if wide.shape[1] == 1:
        flat, along, own = wide[:, 0], np.zeros(n), np.zeros(n)
        for at, index, weight in _triples(body, starts, unit):
            along[at] += weight * flat[index]
            own[at] += weight * weight
        begin = starts - starts[0]
        total[:, 0] = np.add.reduceat(along, begin)
        norm = np.add.reduceat(own, begin)
    else:
        for at, index, weight in _triples(body, starts, unit):
            norm += np.bincount(unit[at], minlength=len(starts)) * weight * weight
            if len(at):
                cuts = np.flatnonzero(np.diff(unit[at], prepend=-1))
                total[unit[at][cuts]] += weight * np.add.reduceat(wide[index], cuts, axis=0)
    return row, total / np.sqrt(np.clip(norm, LEAST_NORM, MOST_NORM))[:, None], starts


def _slices(body: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each part, bytes, offsets) of rows laid end to end, SLICE bytes at a time.

    A longer row is cut at spaces between two words of several letters, which no unit spans; a row without such a
    place stays whole.
    """
    long = np.flatnonzero(np.diff(off) > SLICE)
    ends = [off]
    for r in long:
        text = body[off[r] : off[r + 1]]
        letter = _KIND[text] == _LETTER
        safe = np.flatnonzero(_SPACE[text[2:-2]] & letter[:-4] & letter[1:-3] & letter[3:-1] & letter[4:]) + 3
        places = np.searchsorted(safe, np.arange(SLICE, len(text), SLICE))
        ends.append(off[r] + safe[places[places < len(safe)]])
    ends = np.unique(np.concatenate(ends)) if len(long) else off
    row = np.searchsorted(off, ends[:-1], "right") - 1 if len(long) else np.arange(len(off) - 1)
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, "right")) - 1)
        yield row[at:to], body[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


def _pack(texts: list[bytes]):
    return _framed(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def _evidence(row: np.ndarray, value: np.ndarray, n: int, bias: float, count: np.ndarray | None = None) -> np.ndarray:
    """A text's evidence for each of n rows; units that are missing have the bias alone as their value. count: how often the text has the unit."""
    out = np.full((n, TOP + 2), bias)
    count = np.ones(len(row), np.int64) if count is None else count
    out[:, TOP] = np.log1p(np.bincount(row[value > 0], count[value > 0], minlength=n))
    out[:, TOP + 1] = np.log1p(np.bincount(row, count, minlength=n))
    few = np.minimum(count, TOP)
    row, value = np.repeat(row, few), np.repeat(value, few)
    per = np.bincount(row, minlength=n)
    by = np.lexsort((-value, row))
    begin = np.cumsum(per) - per
    for k in range(TOP):
        there = np.flatnonzero(per > k)
        out[there, k] = value[by[begin[there] + k]]
    return np.clip(out, -4, 12)


def _features(units: list[bytes]) -> np.ndarray:
    """Subsequence weights of few units, dense, of length one."""
    out = np.zeros((len(units), CUBE), np.float32)
    for k, u in enumerate(units):
        body, off = _pack([u.replace(b" ", b".")])
        starts, _, unit = _units(body, off)
        if len(starts):
            for _, index, weight in _triples(body, starts, unit):
                np.add.at(out[k], index, weight)
    for k in range(len(out)):
        out[k] /= max(float(np.sqrt(out[k] @ out[k])), 1e-9)
    return out


def _svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on its active set."""
    z = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(z.shape[1])
    reg = np.eye(z.shape[1]) * ridge
    reg[-1, -1] = 1e-6
    for _ in range(25):
        on = y * (z @ w) < 1
        a = z[on] * cost[on, None]
        new = np.linalg.solve(reg + a.T @ z[on], a.T @ y[on])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve of y over the columns of x, the constant last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.full(len(y), 1.0 / len(y))
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.eye(len(w)) * 1e-3
        w = w - np.linalg.solve(h, x.T @ (weight * (p - y)) + 1e-3 * w)
    return w


def _variants(unit: bytes) -> list[bytes]:
    """The unit with a letter or a digit put in. With marks in it or its letters apart it is the unit itself."""
    cuts = sorted({len(unit) // 3, len(unit) // 2, 2 * len(unit) // 3} - {0})
    return [unit[:i] + c + unit[i:] for i in cuts for c in (b"x", b"1")]


def bags(texts: pa.Array) -> list[tuple[list[bytes], list[int]]]:
    """Of each text, its different units in lower case without marks around them, and how often it has each."""
    body, off = raw_bytes(texts)
    found: list[Counter] = [Counter() for _ in range(len(off) - 1)]
    for rows, part, cuts in _slices(body, off):
        framed, ends = _framed(part, cuts)
        starts, r, _ = _units(framed, ends)
        raw = framed.tobytes().lower()
        stops = np.minimum(np.append(starts[1:], len(framed)), ends[r + 1]) if len(starts) else starts
        for k, i, j in zip(rows[r].tolist(), starts.tolist(), stops.tolist(), strict=True):
            found[k][raw[i:j].strip(b" \t\n\r\x0b\x0c.,;:!?\"'()")] += 1
    return [(list(c), list(c.values())) for c in found]


def train(held: list[tuple[list[bytes], list[int]]], labels: list[int], rounds: int = 4) -> Model:
    """The machine from the bags of a sample of labelled texts. With one class alone or no texts, every score is 0."""
    nothing = Model(np.zeros(CUBE), -1.0, np.append(np.zeros(TOP + 2), -5.0))
    y = np.array(labels, int)
    if not (y == 1).any() or not (y == 0).any():
        return nothing
    number: dict[bytes, int] = {}
    bag_row = np.repeat(np.arange(len(held)), [len(b[0]) for b in held])
    bag_unit = np.array([number.setdefault(u, len(number)) for b in held for u in b[0]], np.int64)
    bag_count = np.array([n for b in held for n in b[1]], np.int64)
    units = list(number)
    if not units:
        return nothing
    seen = [np.bincount(bag_unit[y[bag_row] == c], minlength=len(units)) for c in (0, 1)]
    rate = (seen[1] + 0.1) / (y == 1).sum() / ((seen[0] + 0.5) / (y == 0).sum())
    speaks = np.where((seen[1] >= 3) & (np.array([len(u) for u in units]) >= 3), np.log(rate) * np.sqrt(seen[1]), -np.inf)
    marks = np.argsort(-speaks, kind="stable")[: LANDMARKS * 2 // 3]
    common = np.argsort(-seen[0], kind="stable")[:400]
    marks = np.unique(np.concatenate([marks[np.isfinite(speaks[marks])], [u for u in common if len(units[u]) >= 3][: LANDMARKS // 3]]).astype(int))
    phi = _features([units[m] for m in marks])
    phi = phi[phi.any(axis=1)]
    if not len(phi):
        return nothing
    values, vectors = np.linalg.eigh((phi @ phi.T).astype(np.float64))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    table = phi.T @ root.astype(np.float32)  # symbols**3 x landmarks: a unit's vector is the sum of its subsequences' rows
    spelt = [u.replace(b" ", b".") or b"." for u in units]
    known: dict[int, np.ndarray] = {}

    del phi

    def vectors_of(chosen: np.ndarray) -> np.ndarray:
        new = [u for u in chosen if u not in known]
        for at in range(0, len(new), 2000):
            b, o = _pack([spelt[u] for u in new[at : at + 2000]])
            r, v, _ = unit_values(b, o, table)
            z = np.zeros((len(o) - 1, table.shape[1]), np.float32)
            z[r] = v
            known.update(zip(new[at : at + 2000], z, strict=True))
        return np.array([known[u] for u in chosen])

    # Units that speak for the label by themselves are positive throughout; each toxic text adds its most toxic one.
    telling = np.flatnonzero((speaks > TELLING) & (rate > 8))
    if not len(telling):
        telling = np.argsort(-speaks, kind="stable")[:1]
    order = np.argsort(np.random.default_rng(0).random(len(units)))
    clean_units = order[seen[0][order] > 0][:CLEAN_UNITS]
    best, hard = np.zeros(0, int), np.zeros(0, int)
    changed = [(v, seen[1][u]) for u in telling if len(units[u]) >= 4 and seen[0][u] == 0 and seen[1][u] >= OFTEN * (y == 1).sum() for v in _variants(spelt[u])]
    b, o = _pack([v for v, _ in changed])
    r, v, _ = unit_values(b, o, table)
    apart = np.zeros((len(changed), table.shape[1]))
    apart[r] = v
    apart_cost = np.sqrt(np.array([n for _, n in changed], float))
    for _ in range(rounds):
        good = np.union1d(telling, best)
        neg = np.setdiff1d(np.union1d(clean_units, hard), good)
        weight = np.where(np.isin(neg, hard), HARD, 1.0)
        often = np.sqrt(seen[1][good])
        cost = COST * np.concatenate([often / often.sum(), VARIED * apart_cost / max(1e-9, apart_cost.sum()), weight / max(1.0, weight.sum())])
        w, bias = _svm(np.vstack([vectors_of(good), apart, vectors_of(neg)]), np.concatenate([np.ones(len(good) + len(apart)), -np.ones(len(neg))]), cost)
        value, folded = np.full(len(units), bias), table @ w
        for at in range(0, len(units), 20_000):
            r, v, _ = unit_values(*_pack(spelt[at : at + 20_000]), folded)
            value[at + r] = v[:, 0] + bias
        by = np.lexsort((value[bag_unit], bag_row))
        last = by[np.append(np.diff(bag_row[by]) > 0, True)]
        top, of = bag_unit[last], y[bag_row[last]]
        best = top[(of == 1) & (rate[top] > 3)]
        hard = np.union1d(hard, top[of == 0])
    seen_in = _evidence(bag_row, value[bag_unit], len(held), bias, bag_count)
    # Toxic texts of the sample mostly hold several insults; clean ones with one insult put in, plain or changed, show the curve one alone.
    one = np.concatenate([value[telling], apart @ w + bias])
    one, quiet = one[one > 0], np.flatnonzero(y == 0)[: (y == 1).sum() // 8]
    if len(one) and len(quiet):
        kept = np.isin(bag_row, quiet)
        more = one[np.arange(len(quiet)) % len(one)]
        put = _evidence(np.append(bag_row[kept], quiet), np.append(value[bag_unit][kept], more), len(held), bias, np.append(bag_count[kept], np.ones(len(quiet), np.int64)))[quiet]
        seen_in, y = np.vstack([seen_in, put]), np.append(y, np.ones(len(quiet), int))
    curve = _logistic(seen_in, y)
    return Model((table @ w).astype(np.float64), bias, curve)


def text_scores(texts: pa.Array, model: Model) -> np.ndarray:
    """The score of each text: the logistic curve of its evidence."""
    body, off = raw_bytes(texts)
    found = [(np.zeros(0, np.int64), np.zeros(0))]
    for rows, part, cuts in _slices(body, off):
        row, value, _ = unit_values(*_framed(part, cuts), model.table)
        found.append((rows[row], value[:, 0] + model.bias))
    row, value = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    seen = _evidence(row, value, len(off) - 1, model.bias)
    return 1 / (1 + np.exp(-np.clip(seen @ model.curve[:-1] + model.curve[-1], -30, 30)))


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        units, counts = zip(*bags(batch.column("text")), strict=True)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(units, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "toxic", "units", "counts"])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, labels = [], []
    for batch in batches:
        held += zip(batch.column("units").to_pylist(), batch.column("counts").to_pylist(), strict=True)
        labels += batch.column("toxic").to_pylist()
    model = train(held, labels)
    yield pa.RecordBatch.from_arrays([pa.array([v.tolist()], pa.list_(pa.float64())) for v in (model.table, np.array([model.bias]), model.curve)], ["table", "bias", "curve"])


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """(doc_id, text), (doc_id, toxic) -> Model, from at most toxic and clean labelled texts, the first by a hash of their ids.

    Texts of the sample are reduced to counts of their units where they are; one task trains on these, and the driver
    gets the machine's weights alone. Of an id with several labels the largest counts, of several texts the least.
    """
    prepare(docs.sparkSession)
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    pick = lambda c, n: known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = pick(1, toxic).unionAll(pick(0, clean))  # bounded by the two parameters
    held = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(_bag_rows, "doc_id long, toxic int, units array<binary>, counts array<int>")
    rows = held.groupBy("doc_id").agg(F.min(F.struct("units", "counts", "toxic")).alias("bag")).select("doc_id", "bag.*")
    found = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(_trained, "table array<double>, bias array<double>, curve array<double>").first()
    return Model(np.array(found.table), found.bias[0], np.array(found.curve)) if found else train([], [])


def score(df: DataFrame, model: Model, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """df (without text_col, if keep_text is false) + score double, predicted int. Null and empty texts are scored too, low.

    Rows are independent: repeated rows get equal scores, an empty table gives no rows. Columns of df that are named
    score or predicted are replaced.
    """
    prepare(df.sparkSession)
    keep = [c for c in df.columns if (keep_text or c != text_col) and c not in ("score", "predicted")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            s = text_scores(batch.column(text_col), model)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*keep, "score", "predicted"])

    return df.mapInArrow(work, T.StructType([*(df.schema[c] for c in keep), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8(spark, sf_dir) -> DataFrame:
    """The toxicity of every document; labels of documents whose crc32(doc_id) mod 5 is 0 are not used. A null doc_id is not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(~held_out())
    return score(docs.withColumn("held_out", held_out()), fit(docs, labels)).select("doc_id", "held_out", "score", "predicted")
