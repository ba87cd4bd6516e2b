from pyspark.sql import functions as F

from periodix.llm.licenses import KNOWN, canonical, known_digests, scan
from tests.llm.conftest import TEXTS

MIT = next(body for name, body in KNOWN if name == "MIT" and len(body) > 100)


def test_canonical_forms(spark):
    pairs = [("Copyright (c) 2001 Some One\nAll rights reserved.\nLicensed  under the\nAPACHE Licence, v2.0", "licensed under the apache license version 2 0"),
             ("© X\n  (C) Y Inc\nper cent «whilst»", "percent while"), ("copyrighted text", "copyrighted text"), ("", ""), ("...", ""), (None, None)]
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "i int, a string").select("i", canonical(F.col("a")).alias("c"))
    assert [r.c for r in rows.orderBy("i").collect()] == [b for _, b in pairs]


def test_scan(spark):
    docs = [(1, "Copyright 2020 A\n" + MIT.upper().replace(",", " ,")), (2, "prose\n* Released under the MIT Licence *\nmore\n\nReleased under the MIT License"),
            (3, "Released under the MIT License, or not."), (4, None), (5, ""), (6, "\n\n"), (7, "x " * 200_000), (8, "released UNDER the mit license"), (8, "released UNDER the mit license")]
    table = spark.createDataFrame([(i, t, "d", 1, "w") for i, t in docs], "doc_id long, text string, digest string, line int, words string")
    got = sorted((r.doc_id, r.unit, r.line, r.license_id) for r in scan(table, known_digests(spark)).collect())
    assert got == [(1, "line", 2, "MIT"), (1, "text", 0, "MIT"), (2, "line", 2, "MIT"), (2, "line", 5, "MIT"),
                   (8, "line", 1, "MIT"), (8, "line", 1, "MIT"), (8, "text", 0, "MIT"), (8, "text", 0, "MIT")]


def test_odd_rows(spark, odd_docs, no_docs):
    assert scan(odd_docs, known_digests(spark, [("it", "ONE."), ("nothing", "...")])).where("license_id = 'it' and unit = 'text'").count() == sum(t == "one" for _, t in TEXTS)
    assert scan(no_docs, known_digests(spark)).count() == 0


def test_larger_tables_are_joined_by_shuffle(spark, odd_docs, monkeypatch):
    from periodix.llm import licenses

    known = licenses.digest_table(spark.createDataFrame([("it", "ONE."), ("nothing", "..."), (None, None)], "license_id string, body string"))
    few = sorted(map(tuple, scan(odd_docs, known).collect()), key=str)
    monkeypatch.setattr(licenses, "BROADCAST_DIGESTS", 0)
    assert sorted(map(tuple, scan(odd_docs, known).collect()), key=str) == few != []
