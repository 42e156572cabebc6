import itertools
import random
import re

import duckdb
import pytest

from strandloom.llm import filter_audit

from .helpers import DOCS, LABELS, ODD, tables


def fails_of(text, all_before):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    return out + ("E" if text in all_before else "")


def brute(docs, labels):
    """Every order applied to the documents themselves, one filter after another."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = [(d, t or "", p or "") for d, t, p in docs]
    fails = [fails_of(t, {u for e, u, _ in texts if d is not None and e is not None and e < d}) for d, t, _ in texts]
    rows = {}
    for part in {p for _, _, p in texts}:
        mine = [(d, f) for (d, _, p), f in zip(texts, fails, strict=True) if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                redundant = sum(f in x for _, x in mine) - len(gone)
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                rows[part, order, step] = [len(left), len(gone), redundant, sum(x == f for _, x in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return rows


def random_docs(r, n):
    out = []
    for i in range(n):
        words = [r.choice(["tree", "House", "ÉTÉ", "x#y", "sky", *(f"w{k}" for k in range(150))]) for _ in range(r.choice([3, 150, 250, 400]))]
        text = r.choice([" ", "\n", "\t  "]).join(words)
        out.append((i, r.choice([text, text, out[-1][1] if out else text, None, ""])))
    return out


def rows_of(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def test_query_against_orders_applied_one_by_one(spark, tmp_path):
    r = random.Random(4)
    pairs = random_docs(r, 60) + [(i, t) for i, t in enumerate(ODD, 100)]
    # Rows that repeat, an id with two texts, rows without an id.
    pairs += [pairs[3], pairs[3], (5, "another text"), (None, "same words here"), (None, None), (200, "same words here")]
    langs = [r.choice(["en", "de", None, ""]) for _ in pairs]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i, _ in pairs if i is not None and r.random() < 0.6] + [(None, 1, 1), (7, 1, 0), (7, 0, 1)]
    got = rows_of(filter_audit.op12(spark, tables(spark, tmp_path, pairs, labels, langs=langs, extra=True)))
    want = brute([(i, t, p) for (i, t), p in zip(pairs, langs, strict=True)], labels)
    assert len(got) == 600 * len({p or "" for p in langs})
    assert got == want


def test_sql_gives_the_same(spark, tmp_path):
    r = random.Random(9)
    pairs = random_docs(r, 40)
    folder = tables(spark, tmp_path, pairs, [(i, i % 2, int(i % 3 == 0)) for i, _ in pairs if i % 4], langs=[r.choice(["en", "de", None]) for _ in pairs])
    with duckdb.connect() as con:
        for t in ("documents", "labels"):
            con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
        sql = con.execute(filter_audit.OP12_SQL).fetchall()
    assert {tuple(x[:3]): list(x[3:]) for x in sql} == rows_of(filter_audit.op12(spark, folder))


@pytest.mark.parametrize("n", [1, 2, 3, 255, 256, (1 << 63) - 1])
def test_fields_do_not_run_over(n):
    for mask in (0, 31, 127, 1 | filter_audit.GOOD):
        for order, step, *counts in filter_audit.audit_part({mask: n}):
            *plain, shapley = counts
            assert plain == [n * flag for flag in filter_audit.outcomes(mask, order, step)]
            assert shapley % n == 0


def test_shares_add_up():
    """Whatever the order, as many documents go as fail at least one filter; so do the shares of the filters."""
    counts = {m: m + 1 for m in range(128)}
    rows = list(filter_audit.audit_part(counts))
    failing = sum(n for m, n in counts.items() if m & 31)
    shares = {order[step - 1]: shapley for order, step, *_, shapley in rows}
    assert sum(shares.values()) == 120 * failing
    for order in {r[0] for r in rows}:
        assert sum(r[3] for r in rows if r[0] == order) == failing
        assert next(r[2] for r in rows if r[0] == order and r[1] == 5) == counts[0] + counts[32] + counts[64] + counts[96]


def test_empty_tables(spark, tmp_path):
    assert filter_audit.op12(spark, tables(spark, tmp_path, [])).count() == 0
    spark.createDataFrame([(1, "x y", "en", "s", 3)], DOCS).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    assert filter_audit.op12(spark, str(tmp_path)).count() == 600


def test_masks_that_count_nothing(spark):
    rows = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("a", None, 9), ("a", 3, 0), ("b", 2, None)], "part string, mask int, n long")
    got = rows_of(filter_audit.audit(rows))
    assert {k[0] for k in got} == {"a"} and got["a", "ABCDE", 1][1] == 5
