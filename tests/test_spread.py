"""Month spread on the edge rows of FIXTURES.md section 2 (expected weights from the recursive form)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from periodix.operators.spread import month_parts, month_weights

ROWS = [
    ("a", 1, "2024-01-31 10:00:00", "2024-04-30 12:00:00"),
    ("b", 1, "2024-01-10 00:00:00", "2024-03-01 00:00:00"),
    ("c", 1, "2024-01-10 00:00:00", "2024-01-10 00:00:00"),
    ("d", 1, "2024-03-10 00:00:00", "2024-01-05 00:00:00"),
    ("e", 1, "2024-03-10 00:00:00", None),
    ("f", 1, None, "2024-01-05 00:00:00"),
    ("g", 1, "2024-01-05 00:00:00", "2024-02-20 00:00:00"),
    ("g", 1, "2024-01-10 00:00:00", "2024-03-20 00:00:00"),
    ("h", 1, "2023-11-30 00:00:00", "2024-02-29 23:59:00"),
    ("i", 1, "2024-05-20 00:00:00", "2024-05-10 00:00:00"),
    ("j", 1, None, None),
]

EXPECTED = {
    "a": {(2024, 1): [0.006475], (2024, 2): [0.321924], (2024, 3): [0.344126], (2024, 4): [0.327475]},
    "b": {(2024, 1): [0.431373], (2024, 2): [0.568627]},
    "c": {(2024, 1): [1.0]},
    "d": {(2024, 3): [1.0]},
    "e": {(2024, 3): [1.0]},
    "f": {(None, None): [None]},
    "g": {(2024, 1): [0.216, 0.248], (2024, 2): [0.152, 0.232], (2024, 3): [0.152]},
    "h": {(2023, 11): [0.010870], (2023, 12): [0.336959], (2024, 1): [0.336959], (2024, 2): [0.315212]},
    "i": {(2024, 5): [1.0]},
    "j": {(None, None): [None]},
}


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(ROWS, "code string, idx long, s string, e string")
    return df.select("code", "idx", F.col("s").cast("timestamp_ntz").alias("s"),
                     F.col("e").cast("timestamp_ntz").alias("e"))


def _collect(parts):
    got = {}
    for r in parts.collect():
        w = None if r["weight"] is None else round(r["weight"], 6)
        got.setdefault(r["code"], {}).setdefault((r["start_year"], r["start_month"]), []).append(w)
    return {c: {k: sorted(v, key=lambda x: (x is None, x)) for k, v in m.items()} for c, m in got.items()}


def test_edge_weights_windowed(edge):
    got = _collect(month_parts(edge, ["code", "idx"], "s", "e"))
    assert got == {c: {k: sorted(v, key=lambda x: (x is None, x)) for k, v in m.items()} for c, m in EXPECTED.items()}


def test_edge_weights_unique_path(edge):
    uniq = edge.where(F.col("code") != "g")
    got = _collect(month_parts(uniq, ["code", "idx"], "s", "e", unique_key=True))
    exp = {c: m for c, m in EXPECTED.items() if c != "g"}
    assert got == exp


def test_part_bounds(edge):
    parts = month_parts(edge.where(F.col("code") == "e"), ["code", "idx"], "s", "e")
    (row,) = parts.collect()
    assert row["part_start"] == datetime(2024, 3, 10)
    assert row["part_end"] == datetime(2024, 4, 1)


def test_weights_sum_to_one(edge):
    w = month_weights(edge, ["code", "idx"], "s", "e").groupBy("code").agg(F.sum("weight").alias("w"))
    for r in w.collect():
        if r["code"] in ("f", "j"):
            assert r["w"] is None
        else:
            assert r["w"] == pytest.approx(1.0)
