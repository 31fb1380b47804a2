"""Exact Jaccard links between shingle sets that meet in regions.

A region holds sets that may be alike. Its members carry a sketch, the histogram of their shingles over SKETCH
buckets: the city-block distance of two sketches is a metric and never exceeds the number of shingles that only one of
the two sets has, so that it bounds the Jaccard similarity from above.

1. A region of more than REGION_ROWS members is split in Spark: a few members are pivots, every member belongs to the
   Voronoi cell of its nearest pivot, and is also sent to each cell whose members may still be alike by the triangle
   inequality. Cells are split again; a region that its pivots can't split is dealt into pairs of blocks.
2. Inside a region, members become pivots one after the other, the most central first, unless an earlier pivot covers
   them; a pivot is paired with every member within the bounds, after a window around their distances to the first.
3. The pairs are verified on the whole shingle sets, and linked sets form components.
4. In regions that still hold several components, all pairs of different components within the bounds are verified.

Step 4 leaves out only pairs that the bounds rule out or whose sets are already in one component, so that the
components are those of all links, though not all pairs of a crowded region are made.

Defined results: sets are known by 64-bit hashes, and sets of one hash are one set; a member that a region lists twice
counts once; a set in no region, and a table without regions, have no links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import text as T
from tillwright.llm.components import components
from tillwright.session import stage

SKETCH = 64
REGION_ROWS = 20_000
PIVOTS = 8
# Regions up to this size are compared pair by pair at once.
SMALL = 8
SPLITS = 4


@dataclass(frozen=True)
class Rule:
    """Two sets of shingles of `size` words are linked when 100 * intersection >= percent * union."""

    size: int
    percent: int
    alphabet: str = "spaced"

    def linked(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (a + b - common)

    def sets(self, texts) -> Iterator[np.ndarray]:
        return T.shingle_sets(texts, self.size, T.SPACED)


def set_id(own: np.ndarray) -> int:
    """The identity of a set of shingles: 64 bits, so that two of n different sets agree with chance n * n / 2 ** 65."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(T.mix(own ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(own))
        return int(T.mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def sketch(own: np.ndarray) -> bytes:
    """Counts of the shingles by their last bits, each at most 255."""
    return np.minimum(np.bincount((own & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH), 255).astype(
        np.uint8
    ).tobytes()


def _matrix(sketches: pa.Array) -> np.ndarray:
    """The sketches of a column of equally long binaries as rows."""
    if not len(sketches):
        return np.zeros((0, SKETCH), dtype=np.int16)
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(-1, SKETCH).astype(np.int16)


@dataclass
class Members:
    """Members of one or several regions; label: the component so far."""

    id: np.ndarray
    n: np.ndarray
    pos: np.ndarray
    sketches: np.ndarray
    label: np.ndarray

    def take(self, rows) -> Members:
        return Members(self.id[rows], self.n[rows], self.pos[rows], self.sketches[rows], self.label[rows])


def _possible(rule: Rule, na, pa_, nb, pb) -> np.ndarray:
    """Sizes and the places of the shared shingle allow a link: of each set, what stands before it is not shared."""
    p = rule.percent
    right = 100 * np.minimum(na, nb) >= p * np.maximum(na, nb)
    return right & ((100 + p) * np.minimum(na - pa_, nb - pb) >= p * (na + nb))


def _near(rule: Rule, distance, na, nb) -> np.ndarray:
    return distance * (100 + rule.percent) <= (100 - rule.percent) * (na + nb)


def _small(rule: Rule, region: np.ndarray, m: Members) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the regions of at most SMALL consecutive members."""
    for d in range(1, SMALL):
        if d >= len(region):
            return
        a = np.flatnonzero(region[d:] == region[:-d])
        b = a + d
        own = _possible(rule, m.n[a], m.pos[a], m.n[b], m.pos[b]) & (m.label[a] != m.label[b])
        a, b = a[own], b[own]
        own = _near(rule, np.abs(m.sketches[a] - m.sketches[b]).sum(axis=1), m.n[a], m.n[b])
        yield m.id[a[own]], m.id[b[own]]


def _large(rule: Rule, m: Members, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs with pivots, or every pair of different labels, within the bounds."""
    m = m.take(np.lexsort((m.id, m.n, m.pos)))
    to_first = np.abs(m.sketches - m.sketches[0]).sum(axis=1)
    covered = np.zeros(len(m.id), dtype=bool)
    for i in range(len(m.id)):
        if covered[i] and not every:
            continue
        start = i + 1 if every else 0
        own = _possible(rule, m.n[i], m.pos[i], m.n[start:], m.pos[start:]) & (m.label[start:] != m.label[i])
        own &= _near(rule, np.abs(to_first[start:] - to_first[i]), m.n[i], m.n[start:])
        j = np.flatnonzero(own) + start
        if len(j):
            j = j[_near(rule, np.abs(m.sketches[j] - m.sketches[i]).sum(axis=1), m.n[i], m.n[j])]
            j = j[j != i]
            covered[j] = True
            yield np.full(len(j), m.id[i]), m.id[j]


PAIRS = "a bigint, b bigint"


def _pairs(rule: Rule, every: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def batch_of(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a = np.concatenate([x for x, _ in pairs]) if pairs else np.zeros(0, np.int64)
        b = np.concatenate([y for _, y in pairs]) if pairs else np.zeros(0, np.int64)
        low, high = np.minimum(a, b), np.maximum(a, b)
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    def joined(region: np.ndarray, m: Members) -> Iterator[pa.RecordBatch]:
        if not len(region):
            return
        cuts = np.concatenate([[0], np.flatnonzero(region[1:] != region[:-1]) + 1, [len(region)]])
        sizes = np.diff(cuts)
        few = np.repeat(sizes <= SMALL, sizes)
        yield batch_of(list(_small(rule, region[few], m.take(few))))
        out, held = [], 0
        for k in np.flatnonzero(sizes > SMALL):
            for pair in _large(rule, m.take(slice(cuts[k], cuts[k + 1])), every):
                out.append(pair)
                held += len(pair[0])
                if held >= 100_000:
                    yield batch_of(out)
                    out, held = [], 0
        if out:
            yield batch_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come sorted by region; the last region of a batch may go on in the next one."""
        parts: list[tuple[np.ndarray, Members]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {c: batch.column(c) for c in ("region", "id", "n", "pos", "label")}
            column = {c: v.to_numpy(zero_copy_only=False).astype(np.int64) for c, v in column.items()}
            m = Members(column["id"], column["n"], column["pos"], _matrix(batch.column("sketch")), column["label"])
            region = column["region"]
            first_of_last = int(np.flatnonzero(region == region[-1])[0])
            if first_of_last or not parts or parts[-1][0][-1] != region[-1]:
                if first_of_last or parts:
                    head = slice(0, first_of_last)
                    yield from joined(*_merged([*parts, (region[head], m.take(head))]))
                parts = []
            tail = slice(first_of_last, None)
            parts.append((region[tail], m.take(tail)))
        if parts:
            yield from joined(*_merged(parts))

    return run


def _merged(parts: list[tuple[np.ndarray, Members]]) -> tuple[np.ndarray, Members]:
    fields = ("id", "n", "pos", "sketches", "label")
    return np.concatenate([r for r, _ in parts]), Members(
        *(np.concatenate([getattr(m, f) for _, m in parts]) for f in fields)
    )


def _cells(rule: Rule) -> Callable[..., Column]:
    """The cells of a member: its nearest pivot's, and those that a partner may have as its own."""

    @F.arrow_udf("array<int>")
    def cells(n: pa.Array, sketches: pa.Array, pivots: pa.Array) -> pa.Array:
        own, out = _matrix(sketches), []
        radius = (100 - rule.percent) * n.to_numpy(zero_copy_only=False) / rule.percent
        for k, listed in enumerate(pivots):
            centre = np.frombuffer(b"".join(listed.as_py()), np.uint8).reshape(-1, SKETCH).astype(np.int16)
            distance = np.abs(centre - own[k]).sum(axis=1)
            out.append(np.flatnonzero(distance <= distance.min() + 2 * radius[k]).astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    return cells


def split(members: DataFrame, rule: Rule, region_rows: int = REGION_ROWS) -> DataFrame:
    """The members with regions of at most about region_rows rows; a member may be in several."""
    columns = ["region", "id", "n", "pos", "sketch", "label"]
    done: list[DataFrame] = []
    for depth in range(SPLITS + 1):
        crowded = members.groupBy("region").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > region_rows)
        crowded = stage(crowded, "crowded")
        if crowded.isEmpty():
            break
        done.append(members.join(crowded, "region", "left_anti").select(*columns))
        hot = members.join(crowded, "region")
        order = F.xxhash64("id", F.lit(depth))
        drawn = hot.groupBy("region", F.pmod(order, F.lit(PIVOTS)).alias("k")).agg(F.min(F.struct(order, "sketch")).alias("p"))
        pivots = drawn.groupBy("region").agg(F.collect_list("p.sketch").alias("pivots"))  # at most PIVOTS
        hot = hot.join(pivots, "region")
        hot = stage(hot.withColumn("cells", _cells(rule)(F.col("n"), F.col("sketch"), F.col("pivots"))).drop("pivots"), "cells")
        use = hot.groupBy("region").agg(F.sum(F.size("cells")).alias("sent"), F.max("rows").alias("of"))
        # pivots that send most members to most cells don't part a region
        useful = stage(use.where(F.col("sent") <= 2 * F.col("of")).select("region"), "useful") if depth < SPLITS else None
        stuck = hot.join(useful, "region", "left_anti") if useful is not None else hot
        blocks = F.ceil(F.col("rows") / region_rows).cast("int")
        block = F.pmod(F.xxhash64("id"), blocks).cast("int")
        stuck = stuck.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        low, high = F.least("block", "other"), F.greatest("block", "other")
        done.append(stuck.withColumn("region", F.xxhash64("region", F.lit(-1), low, high)).select(*columns))
        if useful is None:
            members = None
            break
        sent = hot.join(useful, "region").withColumn("cell", F.explode("cells"))
        members = stage(sent.withColumn("region", F.xxhash64("region", F.lit(depth), "cell")).select(*columns), "split")
    if members is not None:
        done.append(members.select(*columns))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def candidates(members: DataFrame, rule: Rule, every: bool) -> DataFrame:
    """Distinct pairs (a, b), a < b, of members that meet in a region and are within the bounds."""
    dealt = members.repartition("region").sortWithinPartitions("region")
    return dealt.mapInArrow(_pairs(rule, every), PAIRS).distinct()


def _verified(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(rule.sets(batch.column("text_a")), rule.sets(batch.column("text_b")))
            sizes = [(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in sets]
            common, a, b = np.array(sizes, dtype=np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], ["a", "b"]
            ).filter(pa.array(rule.linked(common, a, b)))

    return run


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose whole sets are linked; texts: (id, text), one for each id."""
    for side in ("a", "b"):
        own = texts.select(F.col("id").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_verified(rule), PAIRS)


def links(
    regions: DataFrame, texts_of: Callable[[DataFrame], DataFrame], rule: Rule, region_rows: int = REGION_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(a, b) links whose components are those of all links between sets that share a region, and these components.

    regions: region, id, n (size of the set), pos (how many of its shingles are known not to be shared when the
    region is the first that two sets share, else 0), sketch. texts_of: (id, text) of given ids, one row each.
    """
    members = stage(split(regions.withColumn("label", F.col("id")), rule, region_rows), "regions")
    first = stage(candidates(members, rule, every=False), "pairs")
    ids = first.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = stage(texts_of(ids), "texts")
    edges = stage(verified(first, texts, rule), "links")
    found = stage(components(edges), "components")
    # only sets with a possible partner are in a pair; the others are done
    left = members.drop("label").join(ids, "id", "left_semi").join(found, "id", "left")
    left = left.withColumn("label", F.coalesce("component", "id")).drop("component")
    several = left.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    # also regions of which few members are left: in the first pass, pivots may have covered them all
    several = several.where(F.col("low") != F.col("high")).select("region")
    rest = stage(candidates(left.join(several, "region", "left_semi"), rule, every=True).join(first, ["a", "b"], "left_anti"), "rest")
    if rest.isEmpty():
        return edges, found
    edges = stage(edges.unionByName(verified(rest, texts, rule)), "all_links")
    return edges, stage(components(edges), "components")
