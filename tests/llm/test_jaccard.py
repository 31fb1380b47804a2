from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.shared import ODD_TEXTS, joined, near_copies, shingles
from tillwright.llm import components, jaccard, linkage

TEXTS = near_copies()
ROWS = [(i, t) for i, t in enumerate(TEXTS + ODD_TEXTS)] + [
    (None, TEXTS[3]), (None, None), (None, "nobody else has these words"), (5, "zz yy xx ww vv"), (5, "zz yy xx ww vv"), (6, TEXTS[0]),
]
SCHEMA = "doc_id bigint, text string"


def _expected():
    sets = [shingles(t, 4) for _, t in ROWS]
    component = joined(sets, 85)
    least: dict[int, list] = {}
    for (doc_id, _), c in zip(ROWS, component):
        least.setdefault(c, []).append(doc_id)
    rows = []
    for (doc_id, _), own, c in zip(ROWS, sets, component):
        known = [i for i in least[c] if i is not None]
        rows.append((doc_id, len(own), (min(known) if known else None) if own else doc_id))
    return rows, len({c for c, own in zip(component, sets) if own}) + sum(not own for own in sets)


def _sorted(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("region_rows", [linkage.REGION_ROWS, 40])
def test_components_are_those_of_all_pairs(spark, region_rows):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"id": F.lit(1), "region": F.lit(2), "n": F.lit(3)})
    found = jaccard.classes(docs, region_rows=region_rows).collect()
    assert _sorted(tuple(r) for r in found) == _sorted(_expected()[0])


def test_one_document_of_each_component_stays(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"_id": F.lit(1), "component": F.lit(2)})
    kept = jaccard.distinct(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = [r["text"] for r in rows]
    sets = [shingles(t, 4) for t in texts]
    component = joined(sets, 85)
    assert len({c for c, own in zip(component, sets) if own}) == sum(map(bool, sets))  # none is linked to another
    # a component of null ids only has no smallest id
    assert len(rows) >= _expected()[1] - 1


def test_empty_table(spark):
    assert jaccard.classes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert jaccard.distinct(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(50)]
    star = [(100, i) for i in range(101, 160)]
    ring = [(200, 201), (201, 202), (202, 200), (7, 7)]
    edges = spark.createDataFrame(chain + star + ring + ring, "a bigint, b bigint")
    found = dict(components.components(edges).collect())
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in range(200, 203)}
    assert components.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("others", [6, 27, 37])
def test_links_among_the_few_that_a_pivot_covers(spark, others):
    """One region: a pivot is within the bounds of two linked sets, but linked to neither; the others have no partner."""
    rng = random.Random(8)
    words = [[f"w{k}_{i}" for i in range(500)] for k in range(others + 1)]
    pivot = words[0][:490]
    near = list(pivot) + words[0][490:]
    for i in range(0, 500, 37):
        near[i] = f"x{i}"
    nearer = [*near[:-1], "y"]
    texts = [" ".join(t) for t in [pivot, near, nearer, *words[1:]]]
    rng.shuffle(texts)
    rule = jaccard.RULE
    rows = []
    for text in texts:
        own = next(rule.sets(pa.array([text])))
        rows.append((1, linkage.set_id(own), len(own), 0, linkage.sketch(own)))
    regions = spark.createDataFrame(rows, "region bigint, id bigint, n int, pos int, sketch binary")
    owned = spark.createDataFrame([(r[1], t) for r, t in zip(rows, texts)], "id bigint, text string")
    _, found = linkage.links(regions, lambda ids: owned.join(ids, "id"), rule)
    component = joined([shingles(t, 4) for t in texts], 85)
    linked = {frozenset(rows[k][1] for k in range(len(texts)) if component[k] == c) for c in component if component.count(c) > 1}
    assert [len(group) for group in linked] == [2]
    groups = {}
    for i, c in found.collect():
        groups.setdefault(c, set()).add(i)
    assert {frozenset(g) for g in groups.values()} == linked
