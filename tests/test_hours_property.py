"""Hours branch B against a plain-Python model on random rows with many ties and exact duplicates,
spread over several partitions."""

import random

import pytest

from periodix import labels as L
from periodix.plans import hours as H
from tests.fixtures import NW, OBJECTS, TW, WORKS, ZHUFVR, frame, ts

PH = ("P1",)


def model(norm, raw_hours):
    """Expected (work, analytics, code, fact hours) multiset, by the definition."""
    groups = {}
    for r in norm:
        if r["fact_workload"] != 0:
            groups.setdefault((r["work_id"], r["analytics_value"]), []).append(r)
    out = []
    for (w, a), rows in groups.items():
        total = sum(r["fact_workload"] for r in rows)
        hours = raw_hours.get((w, a))

        def key(r):   # code descending with nulls first, then the other columns, largest first
            return (r["res_spider_code"] is None, r["res_spider_code"] or "", r["res_spider_name"] is not None,
                    r["res_spider_name"] or "", r["fact_workload"], r["norm_workload"])
        first = max(range(len(rows)), key=lambda i: key(rows[i]))
        for i, r in enumerate(rows):
            fact = r["fact_workload"]
            if i == first and hours is not None and total > hours + 1 and r["res_spider_code"] == L.MAIN_WORKER_CODE:
                v = fact - (total - hours)
            elif a in PH:
                v = 0.0
            else:
                v = fact
            out.append((w, a, r["res_spider_code"], v))
    return sorted(out, key=lambda t: (t[0], t[1], t[2] or "", t[3]))


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_branch_b_matches_model(spark, seed):
    rng = random.Random(seed)
    works = [f"w{i}" for i in range(8)]
    ctx = H.work_context(
        frame(spark, WORKS, [dict(work_id=w, zhufvr_id="z") for w in works]),
        frame(spark, ZHUFVR, [dict(link="z", territory_value="1", zhfvr_date=ts("2024-01-01"),
                                   delete_flag=False, is_done=True)]),
        frame(spark, OBJECTS, [dict(territory_value="1", spider_name="S")]))
    norm = [dict(work_id=rng.choice(works), analytics_value=rng.choice(["a", "b", "P1"]),
                 res_spider_code=rng.choice([L.MAIN_WORKER_CODE] * 6 + ["X", None]),
                 res_spider_name=rng.choice(["n", None]), fact_workload=float(rng.choice([0, 1, 2, 3])),
                 norm_workload=float(rng.choice([1, 2])), nt_res=None)
            for _ in range(120)]
    raw = {(w, a): float(rng.choice([0, 1, 5])) for w in works for a in ["a", "b", "P1"] if rng.random() < 0.8}
    tw = frame(spark, TW, [dict(work_id=w, analytics_value=a, hours=h) for (w, a), h in raw.items()])
    nw = frame(spark, NW, norm).repartition(5)   # copies of a row land in different partitions
    out = H.hours_normed(tw, nw, ctx, PH).collect()
    got = sorted(((r.work_id, r[L.COL_RESOURCE_CODE], r[L.COL_FACT_HOURS]) for r in out),
                 key=lambda t: (t[0], t[1] or "", t[2]))
    expected = model(norm, raw)
    want = sorted(((w, c, v) for w, _a, c, v in expected), key=lambda t: (t[0], t[1] or "", t[2]))
    assert got == want
    facts = {r["fact_workload"] for r in norm}
    assert any(v not in facts and v != 0.0 for *_k, v in expected)   # the excess rule fired
