from __future__ import annotations

import time
import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.shared import ODD_TEXTS, documents
from tillwright.llm import personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = ODD_TEXTS + [
    "a@b.c_x@y.z.w q@r a@b..c a@b.c.",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 00000000000000000255.1.1.1",
    "4111 1111 1111 1111 41111111-11111111 4111  1111 1111 1111 4111111111111112",
    "+1 (555) 010-2030. +49.30.901820 ++12 345 678 901-) x",
    "😀é a@b.co 😀 1.2.3.4",
    "9" * 5000,
    "a" * 20000 + "@x",
    "x@y.z" * 1000,
    "4111111111111111 " * 600,
]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _base(text: str) -> list[str]:
    def valid(kind: str, own: str) -> bool:
        digits = re.sub("[^0-9]", "", own)
        if kind == "ip":
            return all(int(p) <= 255 for p in own.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and _luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if valid(kind, m.group())
    ]


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"base": F.lit(1), "version": F.lit(2)})
    found = {r["doc_id"]: r for r in personal.report(docs).collect()}
    assert len(found) == len(TEXTS)
    for i, text in rows:
        expected, row = _base(text or ""), found[i]
        assert row["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        assert row["spans"].split(",")[: len(expected)] == (expected or [""])[: len(expected)]
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(s.startswith(kind) for s in expected)


def test_contexts_of_seeds_find_more(spark):
    rng = random.Random(3)
    rows = [(i, f"Some words about the thing. Phone: +49 30 {rng.randrange(10**6, 10**7)} and more of the text") for i in range(20)]
    rows += [(20, "Phone: 030-1234567 call"), (21, "the 123456789 of the"), (22, "phone:  9981234 x"), (None, "phone: 9981235"), (None, "phone: 9981235")]
    found = personal.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    spans = {r["doc_id"]: r["spans"] for r in found}
    assert spans[20] == "id:7:18"
    assert spans[21] == ""
    assert spans[22] == "id:8:15"
    assert [r["spans"] for r in found if r["doc_id"] is None] == ["id:7:14"] * 2


def test_keys_are_seeds_and_spans_only_in_trusted_contexts(spark):
    keys = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(8)]
    rows = [(i, f'some words token = "{k}" and more') for i, k in enumerate(keys)]
    # another identifier where keys stand; a key, letters only and digits only where other words stand as well
    rows += [(8, 'token = "user-77812" x'), (9, f"the {keys[0]} of the"), (10, f"a {'ab' * 20} b"), (11, f"the {'7' * 33} of")]
    rows += [(12, "the words of the text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r["doc_id"]: r["spans"] for r in personal.report(docs).collect()}
    assert all(spans[i] == "id:20:60" for i in range(8))
    assert spans[8] == "id:9:19"
    assert all(spans[i] == "" for i in (9, 10, 11, 12))


def test_empty_table(spark):
    assert personal.report(documents(spark, TEXTS).limit(0)).count() == 0


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    """Spans of 200,000 matches; base spans and candidates overlap at each of them, or nowhere."""
    seconds = {}
    for n in (20_000, 200_000):
        rows = [(1, "1 " * n), (2, "ab1@cd.ef " * n), (3, "abc123 " * n), (4, "1.2.3.4 x12345 " * (n // 2))]
        start = time.perf_counter()
        found = {r["doc_id"]: r for r in personal.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        seconds[n] = time.perf_counter() - start
        assert [found[i]["n_email"] for i in (1, 2, 3, 4)] == [0, n, 0, 0]
        assert found[4]["n_ip"] == n // 2
        assert found[2]["spans"].endswith(f",email:{10 * n - 10}:{10 * n - 1}")
    assert seconds[200_000] < 30 * seconds[20_000]
