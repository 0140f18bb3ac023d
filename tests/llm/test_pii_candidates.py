"""Candidates of any length, and with hyphens."""

import re

from geoloom.llm import pii


def test_whole_tokens_are_candidates(spark):
    long = "x" * 30 + "1" * 61
    rows = [(1, "mail mary-jane@intranet now"), (2, "mail bartholomew.featherstonehaugh@localhost now"), (3, "pass AB-123456 now"), (4, f"id {long} now"), (5, "well-known --- (see) now")]
    got = {r.doc_id: [m.value for m in r.mentions] for r in pii.extracted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["mary-jane@intranet"], 2: ["bartholomew.featherstonehaugh@localhost"], 3: ["AB-123456"], 4: [long], 5: []}


def test_long_identifiers_are_redacted_to_their_end(spark):
    zeros = "0" * 80
    rows = [(i, f"reach the server at host {zeros}{10 + i}.20.{i}.9 now") for i in range(10)] + [(90, f"reach the server at host {zeros}300.20.1.9 now")]
    got = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {"reach the server at host [IP] now"}


def test_candidates_take_linear_time():
    for t in ("-" * 200_000, "a(" * 100_000, "1)" * 100_000, "a-1 " * 50_000, "x" * 200_000 + "@"):
        re.findall(pii.CANDIDATE, t)
