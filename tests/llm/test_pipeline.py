"""The pipeline, stage by stage, against brute-force versions."""

import re

import corpus_pipeline as cp
from pyspark.sql import functions as F

from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_pii import RULES, ok

SF = "/root/testdata/sf0.001"


def kept(rows):
    """One document of each group that links of 0.8 or more of shingle sets connect, by comparing all pairs."""

    def shingled(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return {b" ".join(w[i : i + cp.SHINGLE]) for i in range(max(1, len(w) - cp.SHINGLE + 1))} if w else set()

    s = {r.doc_id: shingled(r.text) for r in rows}
    label, pairs = {d: d for d in s}, [(a, b) for a in s for b in s if a < b and (s[a] == s[b] or 5 * len(s[a] & s[b]) >= 4 * len(s[a] | s[b]))]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {d for d in s if label[d] == d}


def redacted(t, tokens=()):
    """Base spans, and the given tokens as what the method adds."""
    spans = {(m.start(), m.end(), k) for k, p in RULES.items() for m in re.finditer(p, t or "") if ok(k, m.group())}
    spans = sorted(spans | {(m.start(), m.end(), "secret") for x in tokens for m in re.finditer(x, t or "") if not any(a < m.end() and m.start() < b for a, b, _ in spans)})
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [t[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join(out) + t[at:] if t else t


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(100001, "123 456 !!", "en", "s", 10), (100002, None, "en", "s", 0), (100003, None, None, "s", 0)], docs.schema)
    before = docs.unionByName(extra)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, before, SF)
        if i + 1 < len(cp.STAGES):
            assert out.schema.names == docs.schema.names
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        was, now = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert after.count() == len(now)
        if name == "language_id":
            assert set(was) - set(now) == {100001, 100002, 100003}
        elif name == "near_dedup":
            assert set(now) == kept(was.values())
        elif name == "decontaminate":
            hit = leaks([(d, r.text) for d, r in was.items()], bench)
            assert set(now) == {d for d in was if not hit[d][4]} and len(now) < len(was)
        elif name == "pii":
            tokens = {x for r in was.values() for x in re.findall(r'token = "([0-9a-f]{40})"', r.text)}
            assert {d: r.text for d, r in now.items()} in ({d: redacted(r.text) for d, r in was.items()}, {d: redacted(r.text, tokens) for d, r in was.items()})
            assert all(r.n_chars == len(r.text) for r in now.values())
        else:
            assert {d: r.n_tokens for d, r in now.items()} == {d: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for d, r in was.items()}
            assert len({(r.bucket, r.batch, r.slot) for r in now.values()}) == len(now)
        if name != "near_dedup" and name != "packing":
            assert all(now[d].lang == was[d].lang for d in now)
        before = after


def test_run_is_the_stages(spark):
    assert cp.run(spark, SF).count() > 0


def odd(spark):
    """Every name that an operator gives columns of its own, repeated rows, null ids and texts, and a very long text."""
    text = "the quick brown fox jumps over the lazy dog and writes to someone@mail.example.com every day"
    rows = [(1, text, "en"), (1, text, "en"), (2, None, None), (None, text + " again", None), (None, None, "en"), (3, "", "en"), (4, "word " * 300_000 + "4111 1111 1111 1111", "en"), (5, "another text that is quite different from the first one and has no other like it", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for i, c in enumerate(("score", "lang_pred", "items", "spans", "n_words", "hit_runs", "_spans", "_key", "key", "whole", "mentions", "added", "id", "label", "digest", "n", "fp", "h", "fingerprint", "component_id")):
        df = df.withColumn(c, F.lit(f"user {i}"))
    return df


def test_clashing_columns_come_back_as_they_were(spark):
    df = odd(spark)
    own = [c for c in df.columns if c not in ("doc_id", "text", "lang")]
    want = tuple(f"user {i}" for i in range(len(own)))
    left = {"language_id": 5, "near_dedup": 6, "decontaminate": 8, "pii": 8}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns
        rows = out.collect()
        assert {tuple(r[c] for c in own) for r in rows} == {want}, name
        assert len(rows) == left[name], name
    assert cp.packs(spark, df, SF).count() == 8


def test_pii_stage_on_odd_rows(spark):
    texts = [r.text for r in cp.personal_data(spark, odd(spark), SF).collect()]
    assert sum("[EMAIL]" in (t or "") for t in texts) == 3 and texts.count(None) == 2
    assert sum((t or "").endswith("[CARD]") and len(t) > 1_500_000 - 1 for t in texts) == 1


def test_empty_table(spark):
    df = odd(spark).limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, df, SF).count() == 0
