"""Calendar-exception adjustment (J8) on hand-computed edge rows."""

from periodix.operators.calendar import adjust_calendar
from tests.fixtures import ts


def _exceptions(spark):
    # one exception in March 2020 on calendar STD; 2020 is a leap year, so moving it to 2021 by the
    # day difference of the two 1 Januaries (366 days) drifts it by a day: 2020-03-05 -> 2021-03-06
    return spark.createDataFrame(
        [("STD", ts("2020-03-05"), ts("2020-03-12"), ts("2020-03-04"), ts("2020-03-13"))],
        "Calen_Code string, Start timestamp_ntz, Fin timestamp_ntz, Start_true timestamp_ntz, Fin_true timestamp_ntz")


def _parts(spark, rows):
    return spark.createDataFrame([(i, cal, ts(s), ts(e)) for i, (cal, s, e) in enumerate(rows)],
                                 "id int, Calen string, part_start timestamp_ntz, part_end timestamp_ntz")


def test_calendar_adjust_cases(spark):
    parts = _parts(spark, [
        ("SR_10", "2021-01-10", "2021-01-20"),   # 0: SR_ calendar in January: removed
        ("SR_10", "2021-07-10", "2021-07-20"),   # 1: SR_ calendar in July: kept, no exception
        ("STD", "2021-03-07", "2021-03-20"),     # 2: start inside the shifted window -> true end
        ("STD", "2021-03-01", "2021-03-10"),     # 3: end inside, same month as start -> true end
        ("STD", "2021-03-20", "2021-03-25"),     # 4: outside the window: unchanged
        ("XSR", "2021-02-01", "2021-02-02"),     # 5: not an SR_ pattern: kept
    ])
    got = {r.id: (r.start_date, r.end_date) for r in adjust_calendar(parts, _exceptions(spark)).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[1] == (ts("2021-07-10"), ts("2021-07-20"))
    assert got[2] == (ts("2021-03-14"), ts("2021-03-20"))   # 2020-03-13 + 366 days
    assert got[3] == (ts("2021-03-01"), ts("2021-03-14"))
    assert got[4] == (ts("2021-03-20"), ts("2021-03-25"))
