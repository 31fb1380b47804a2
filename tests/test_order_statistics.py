from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillwright.catalogue import mart
from tillwright.operators.first_rows import first_rows
from tillwright.operators.quantiles import positions
from tillwright.plans import metrics


def grouped(spark, groups):
    cells = [(g, v) for g, values in groups.items() for v in values]
    return spark.createDataFrame(cells, "grp string, v double").repartition(8)


@pytest.mark.parametrize("accuracy", [10_000, 20])
@pytest.mark.parametrize("p", [0.25, 0.75, 0.0, 1.0])
def test_positions(spark, p, accuracy):
    """A coarse sketch gives wide or wrong brackets, which the counts must catch."""
    rng = random.Random(3)
    groups = {
        "even": [float(i) for i in range(5000)],
        "hot": [7.0] * 4000 + [rng.random() * 100 for _ in range(2000)],
        "skewed": [rng.paretovariate(0.5) for _ in range(3000)],
        "one": [4.25],
        "two": [1.0, 2.0],
    }
    found = positions(grouped(spark, groups), p, accuracy)
    assert set(found) == set(groups)
    for name, values in groups.items():
        assert found[name].count == len(values)
        assert found[name].interpolated == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_positions_over_many_ranges(spark):
    """No range holds a whole group, and neighbours of a position may lie in different ranges."""
    values = {"a": [float(i // 2) for i in range(4001)], "b": [float(-i) for i in range(997)], "c": [1.0, 9.0]}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for p in (0.1, 0.5, 0.77):
            found = positions(grouped(spark, values), p, 5)
            assert {g: f.interpolated for g, f in found.items()} == {g: pytest.approx(np.quantile(v, p)) for g, v in values.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_positions_without_values(spark):
    empty = spark.createDataFrame([("a", None)], "grp string, v double")
    assert positions(empty, 0.5) == {}


def test_slow_moving_equals_percent_rank(spark):
    found = metrics.mv_slow_moving_products(mart(spark, SMALL))
    by_region = Window.partitionBy("region").orderBy("total_quantity")
    compared = found.withColumn("ranked", F.percent_rank().over(by_region) <= 0.25)
    assert compared.where("ranked <> is_slow_moving").count() == 0
    assert compared.where("is_slow_moving").count() > 0


def test_first_rows(spark):
    cells = [(i % 3, i) for i in range(300)] + [(0, None)]
    df = spark.createDataFrame(cells, "g int, v int").repartition(7)
    found = first_rows(df, ["g"], ["v"], 4).orderBy("g", "_rank").collect()
    assert [(r["g"], r["v"], r["_rank"]) for r in found] == [(g, g + 3 * i, i + 1) for g in range(3) for i in range(4)]
    plan = first_rows(df, ["g"], ["v"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
