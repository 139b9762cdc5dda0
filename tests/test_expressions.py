"""Hand cases for the rules that are easy to get wrong."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from palisade.functions import activity as A
from palisade.functions import flows as N
from palisade.functions import numeric as M
from palisade.operators import correlation as R
from palisade.operators import profile as P
from palisade.operators import userday as U


def one(df, expression):
    return df.select(expression.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def unit(spark):
    return spark.range(1)


def test_friday_counts_as_weekend(unit):
    friday, thursday = F.lit("2024-01-05").cast("date"), F.lit("2024-01-04").cast("date")
    assert one(unit, A.weekend(A.iso_weekday(friday))) == 1
    assert one(unit, A.weekend(A.iso_weekday(thursday))) == 0
    assert one(unit, A.weekend(A.iso_weekday(friday), 6)) == 0


def test_after_hours_bounds_differ_for_mail(unit):
    assert [one(unit, A.after_hours(F.lit(h))) for h in (7, 8, 18, 19)] == [1, 0, 0, 1]
    assert one(unit, A.after_hours(F.lit(18), end_counts=True)) == 1


def test_activity_flags_ignore_case(unit):
    assert one(unit, A.equals_flag(F.lit("Connect"), "connect")) == 1
    assert one(unit, A.equals_flag(F.lit(None).cast("string"), "connect")) is None


def test_recipients_with_and_without_empty_entries(unit):
    fields = [F.lit("a@dtaa.com;b@x.org"), F.lit(None).cast("string"), F.lit(None).cast("string")]
    assert one(unit, A.recipients(fields)) == ["a@dtaa.com", "b@x.org"]
    kept = A.recipients(fields, drop_empty=False)
    assert one(unit, kept) == ["a@dtaa.com", "b@x.org", "", ""]
    assert one(unit, A.external_count(kept)) == 3
    assert one(unit, A.external_count(F.array(F.lit("me@dtaaxcom")))) == 1


def test_counts_of_missing_text(unit):
    nothing = F.lit(None).cast("string")
    assert one(unit, A.separated_count(nothing)) == 0
    assert one(unit, A.separated_count(F.lit("a;b"))) == 2
    assert one(unit, A.keyword_count(nothing)) is None
    assert one(unit, A.keyword_count(F.lit(""))) == 1


def test_url_without_scheme_has_no_domain(unit):
    assert one(unit, A.url_domain(F.lit("ftp://x/y"))) is None
    assert one(unit, A.url_domain(F.lit("https://a.b/c"))) == "a.b"
    assert one(unit, A.suspicious_url(F.lit("http://x/LOGIN"))) == 1


def test_timestamp_formats_and_bad_text(unit):
    want = dt.datetime(2010, 1, 2, 3, 4)
    for text in ("01/02/2010 03:04:00", "1/2/2010 3:04"):
        assert one(unit, A.parse_timestamp(F.lit(text))) == want
    assert one(unit, A.parse_timestamp(F.lit("2010-01-02"))) is None


def test_zscore_of_constant_or_single_day(unit):
    assert one(unit, M.zscore(F.lit(3.0), F.lit(3.0), F.lit(0.0))) == 0
    assert one(unit, M.zscore(F.lit(3.0), F.lit(3.0), F.lit(None).cast("double"))) == 0


def test_ratio_by_zero_is_zero(unit):
    assert one(unit, M.ratio_or_zero(F.lit(1), F.lit(0))) == 0


def test_non_finite_values_are_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    assert [r[0] for r in df.select(M.finite("x")).collect()] == [None, None, None, None, 2.0]
    row = P.missing_features(df, ["x"]).first()
    assert row["missing"] == 4 and P.infinite_features(df, ["x"]).first()["infinite"] == 2


def test_ddos_is_not_dos(unit):
    assert one(unit, N.class_group(F.lit("DDoS"))) == "DDoS"
    assert one(unit, N.class_group(F.lit("DDoS"), ddos_first=False)) == "DoS"
    assert one(unit, N.attack_family(F.lit("DDoS"))) == "DDoS"
    assert one(unit, N.attack_family(F.lit("Web Attack - XSS"))) == "Web Attack"
    assert one(unit, N.attack_family(F.lit("else"))) == "Other"


def test_threshold_itself_is_anomalous(unit):
    assert one(unit, N.is_anomalous(F.lit(0.5), 0.5))
    assert one(unit, N.action_text(F.lit(0.5), 0.5, F.lit("Bot"))) == "ATTACK: Bot"
    assert one(unit, N.drift_severity(F.lit(0.0567))) == "HIGH"


def test_correlation_of_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 7.0)], "a double, b double, c double")
    for wide in (["a", "b", "c"], ["a", "b", "c", "d", "e"]):
        many = df.withColumns({"d": F.lit(0.7), "e": F.col("a") * 3}).repartition(3)
        got = {(r.feature_a, r.feature_b): r.r for r in R.pearson(many, wide).collect()}
        assert all(r is None for pair, r in got.items() if "d" in pair)
        assert got[("a", "b")] is None and got[("b", "c")] is None
        assert abs(got[("a", "c")] - 0.993399) < 1e-6


def test_overlapping_periods_do_not_repeat_days(spark):
    days = spark.sql("SELECT 'u1' AS user, date'2024-01-02' AS date UNION ALL SELECT 'u1', date'2024-01-09'")
    periods = spark.sql(
        "SELECT 'u1' AS user, date'2024-01-01' AS start_date, date'2024-01-03' AS end_date "
        "UNION ALL SELECT 'u1', date'2024-01-02', date'2024-01-05'"
    )
    rows = U.label_periods(days, periods).orderBy("date").collect()
    assert [r.target for r in rows] == [1, 0]


def test_decoys_match_whatever_the_case_of_the_host(spark):
    files = spark.createDataFrame([("f", "pc-1"), ("g", "pc-1")], "filename string, pc string")
    decoys = U.decoy_lookup(
        spark.createDataFrame([("f", "PC-1"), ("f", "pc-1")], "decoy_filename string, pc string")
    )
    flags = U.lookup_flag(files, decoys, ["filename", "pc"], "hit").orderBy("filename").collect()
    assert [r.hit for r in flags] == [1, 0]
