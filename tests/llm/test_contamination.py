from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tests.llm.shared import ODD_TEXTS, alphanumeric, documents
from tillwright.llm import contamination


def _plain(text, items):
    words, hit, found = alphanumeric(text), set(), set()
    for item, own in items:
        own = alphanumeric(own)
        if item is None or not own:
            continue
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit)


def _tables(spark):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 3, 9, 10, 14, 40])))) for i in range(40)]
    items += [(40, None), (41, ""), (42, " . "), (None, "v1 v2"), (43, items[3][1]), (44, " ".join(["v7"] * 2500))]
    texts = list(ODD_TEXTS)
    for i in range(60):
        own = [rng.choice(words) for _ in range(rng.randrange(0, 400))]
        if i % 3 == 0:
            own[5:5] = items[i % 40][1].upper().split()
        texts.append((" ", ", ", "\n")[i % 3].join(own))
    texts.append(" ".join(["v7"] * 700))
    return texts, items, documents(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")


def test_search_in_one_and_in_many_blocks(spark, monkeypatch):
    texts, items, docs, benchmark = _tables(spark)
    docs = docs.withColumn("doc_id", F.xxhash64(F.coalesce("text", F.lit("none"))))
    by_text = {t: _plain(t, items) for t in texts}
    ids = {r[0]: by_text[r[1]] for r in docs.select("doc_id", "text").collect()}
    for size in (contamination.BLOCK_BYTES, 2000):
        monkeypatch.setattr(contamination, "BLOCK_BYTES", size)
        rows = contamination.report(docs, benchmark).collect()
        assert len(rows) == len(texts)
        for row in rows:
            assert tuple(row)[1:] == ids[row["doc_id"]]


def test_clean_keeps_columns_of_clean_documents(spark):
    texts, items, docs, benchmark = _tables(spark)
    docs = docs.withColumn("_contamination", F.lit(1)).withColumn("found", F.lit(2))
    kept = contamination.clean(docs, benchmark)
    assert kept.columns == docs.columns
    expected = sorted(str(t) for t in texts if not _plain(t, items)[-1])
    assert sorted(str(r["text"]) for r in kept.collect()) == expected


def test_empty_tables(spark):
    _, _, docs, benchmark = _tables(spark)
    assert contamination.report(docs.limit(0), benchmark).count() == 0
    rows = contamination.report(docs, benchmark.limit(0)).collect()
    assert len(rows) == docs.count()
    assert not any(r["contaminated"] for r in rows)
