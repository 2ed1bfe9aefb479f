import pytest

from meterwise.sources import months as MO


def test_parse_and_errors():
    assert MO.parse_year_month("2024-03") == (2024, 3)
    for bad in ("2024/03", "24-03", "2024-13", "", "2024-00"):
        with pytest.raises(ValueError):
            MO.parse_year_month(bad)


def test_range_across_years(spark):
    r = [(x.year, x.month) for x in MO.month_range(spark, "2023-11", "2024-02").collect()]
    assert r == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert MO.iter_months((2023, 11), (2024, 2)) == r
    with pytest.raises(ValueError):
        MO.month_range(spark, "2024-02", "2023-11")


def test_coverage_and_resolve(spark):
    avail = spark.createDataFrame([(2024, 1), (2024, 3), (2024, 4)], "year int, month int")
    cov = {(r.year, r.month): r.status for r in
           MO.month_coverage(MO.month_range(spark, "2024-01", "2024-04"), avail).collect()}
    assert cov == {(2024, 1): "matched", (2024, 2): "missing", (2024, 3): "matched", (2024, 4): "matched"}
    assert MO.resolve_months(spark, avail, "2024-02", None) == [(2024, 3), (2024, 4)]
    assert MO.resolve_months(spark, avail) == [(2024, 1), (2024, 3), (2024, 4)]
    with pytest.raises(ValueError):
        MO.resolve_months(spark, avail, "2025-01", "2025-02")


def test_paths():
    assert MO.month_paths("s3://b/yellow/", [(2024, 1)]) == ["s3://b/yellow/year=2024/month=01"]
    assert MO.month_paths("/r", [(2024, 1)], padded=False) == ["/r/year=2024/month=1"]
