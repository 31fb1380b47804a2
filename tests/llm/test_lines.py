from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.shared import ODD_TEXTS, documents
from tillwright.llm import lines

PASSAGE = [f"passage line {i} with some words" for i in range(8)]
TEXTS = ODD_TEXTS + [
    "\n".join([f"own {i} {k}" for k in range(i % 4)] + PASSAGE + [f"end {i}"]) for i in range(12)
] + ["\n".join(PASSAGE)] * 3


def _plain(rows):
    """Texts after removal, from all chunks of all rows in one dictionary."""
    first = {}
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    for doc_id, text in rows:
        for pos, n, chunk in lines.chunks(text):
            if n >= 2 and chunk.strip(" \n"):
                first[chunk] = min(first.get(chunk, (doc_id, pos)), (doc_id, pos), key=order)
    out = defaultdict(list)
    for doc_id, text in rows:
        keep = [c for pos, n, c in lines.chunks(text) if n < 2 or first.get(c, (doc_id, pos)) == (doc_id, pos)]
        out[doc_id].append("\n".join(keep))
    return {k: sorted(v) for k, v in out.items()}


def _texts(docs):
    out = defaultdict(list)
    for row in lines.clean(docs).select("doc_id", "text").collect():
        out[row["doc_id"]].append(row["text"])
    return {k: sorted(v) for k, v in out.items()}


def test_chunks_make_up_the_text_and_do_not_depend_on_what_precedes():
    for text in TEXTS:
        cut = lines.chunks(text)
        assert "\n".join(c for _, _, c in cut) == (text or "")
        assert all(n >= 2 for _, n, _ in cut[:-1])
    inner = [{c for _, _, c in lines.chunks("\n".join([f"x{i}"] * i + PASSAGE * 3))} for i in range(5)]
    assert set.intersection(*inner)


def test_repeated_chunks_stay_once(spark):
    docs = documents(spark, TEXTS)
    docs = docs.unionByName(docs.where("doc_id = 14"))  # a repeated row
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert _texts(docs) == _plain(rows)
    assert sum(r["n_removed"] for r in lines.report(docs).collect()) > 0


def test_chunks_of_one_digest_with_unlike_bytes(spark, monkeypatch):
    docs = documents(spark, TEXTS)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same = F.transform(lines.candidates(F.col("text")), lambda c: c.withField("digest", F.lit("same")))
    monkeypatch.setattr(lines, "candidates", lambda text: same)
    found = lines.removals(docs).select("id", F.explode("gone.pos").alias("pos")).collect()
    kept = _plain(rows)
    assert len(found) > 0
    for doc_id, pos in {tuple(r) for r in found}:
        text = next(t for i, t in rows if i == doc_id)
        chunk = next(c for p, _, c in lines.chunks(text) if p == pos)
        assert all(text != k for k in kept[doc_id]) and chunk


def test_columns_and_empty_table(spark):
    docs = documents(spark, TEXTS).withColumns({"kept": F.lit(1), "_kept": F.lit(2), "gone": F.lit(3), "id": F.lit(4)})
    cleaned = lines.clean(docs)
    assert cleaned.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in cleaned.collect())
    assert lines.report(docs.limit(0)).count() == 0
