"""Filter interaction audit against brute force, in every order."""

import re
from collections import Counter
from itertools import permutations

from geoloom.llm import interaction

SCHEMA = "doc_id long, text string, source string, n_words int, row int, digest string"
LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, LONG, "a"), (2, LONG, "a"), (2, LONG, "b"), (7, LONG, None), (None, LONG, "a"), (None, None, ""), (3, "", "a"), (4, None, "a"), (4, None, "a"),
    (5, "A B # " + "x " * 80, "b"), (6, "x " * 80, "b"), (8, "ÄÖÜ Z", "b"), (9, " \t\x0b\n", "c"), (10, "a\xa0b\x1cc " * 60, "c"), (11, "QQ " * 2 + LONG, "c"), (12, "v " * 30000 + LONG, "c"), (6, "x " * 80, "b"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, None, 1), (6, 1, 1), (99, 1, 1), (None, 1, 1)]


def brute(rows, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    parts, out = {}, {}
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in rows))
        parts.setdefault(s or "", []).append((dict(zip("ABCDE", bad, strict=True)), d in good, d in toxic))
    for part, found in parts.items():
        share = Counter()
        for order in permutations("ABCDE"):
            left = found
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[0][f]]
                kept = [x for x in left if not x[0][f]]
                share[f] += len(gone)
                fails = [x for x in found if x[0][f]]
                out[part, "".join(order), step] = [len(kept), len(gone), len(fails) - len(gone), sum(sum(x[0].values()) == 1 for x in fails), sum(x[1] for x in gone), sum(x[2] for x in gone)]
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(share[order[step - 1]])
    return out


def rows_of(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def test_matches_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in ROWS], SCHEMA)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = interaction.report(docs, labels)
    assert got.count() == 4 * 600
    assert rows_of(got) == brute(ROWS, LABELS)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([(*r, 1, 2, "z") for r in ROWS], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.report(docs.limit(0), labels).count() == 0
    assert rows_of(interaction.report(docs, labels)) == brute(ROWS, [])


def test_words_are_grouped_without_another_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plan = interaction.cells(docs, labels)._jdf.queryExecution().executedPlan().toString()
    explodes = plan.index("Generate explode")
    assert "Exchange" not in plan[plan.rindex("HashAggregate(keys=[id", 0, explodes) : explodes]
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
