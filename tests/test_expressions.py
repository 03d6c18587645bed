from datetime import date, datetime

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hireflow.functions import hashing, lists, text
from hireflow.functions.dates import date_class, days_between, parse_mixed_date, try_timestamp


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[1] for r in df.select("i", expr(F.col("c")).alias("o")).orderBy("i").collect()]


SAME_DAY = [
    "2024-12-22", "2024/12/22", "2024.12.22", "22-12-2024", "12/22/2024", "12.22.2024",
    "December 22, 2024", "Dec 22, 2024", "22-Dec-2024", "22-December-2024",
    "2024-12-22T10:11:12", "2024-12-22 10:11", "december 22, 2024",
]


def test_every_layout_gives_the_same_day(spark):
    padded = SAME_DAY + [f"  {v} " for v in SAME_DAY]
    assert set(column(spark, padded, parse_mixed_date)) == {date(2024, 12, 22)}


@pytest.mark.parametrize(
    "value,expected",
    [
        ("5-Sep-2025", date(2025, 9, 5)),
        ("1/2/2025", date(2025, 1, 2)),
        ("2025-1-2", date(2025, 1, 2)),
        ("05/06/2024", date(2024, 5, 6)),
        ("05.06.2024", date(2024, 5, 6)),
        ("05-06-2024", date(2024, 6, 5)),
        ("29-Feb-2024", date(2024, 2, 29)),
        ("May 5, 2024", date(2024, 5, 5)),
        ("5-May-2024", date(2024, 5, 5)),
    ],
)
def test_short_and_ambiguous_dates(spark, value, expected):
    assert column(spark, [value], parse_mixed_date) == [expected]


def test_unreadable_dates_are_null(spark):
    bad = [
        "31-Feb-2025", "13/01/2025", "20250102", "2025", "2025-01", "2025-11-08 junk",
        "12025-01-01", "", None, "Sept 5, 2024", "2025-13-01", "2025-02-29", "Foo 5, 2024",
    ]
    assert column(spark, bad, parse_mixed_date) == [None] * len(bad)


def test_timestamps(spark):
    good = ["2025-11-08", "2025-11-08T00:00:00", "2025/11/08", " 2025-11-08 ", "2025-11-08T00:00:00Z"]
    assert set(column(spark, good, try_timestamp)) == {datetime(2025, 11, 8)}
    assert column(spark, ["2025-11-08T10:00:00+02:00"], try_timestamp) == [
        datetime(2025, 11, 8, 10)
    ]
    bad = ["08-Nov-2025", "2025", "2025-11-08Tx", "2025-11-08 10", "", None, "2025-11-08T25:00:00"]
    assert column(spark, bad, try_timestamp) == [None] * len(bad)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dates(date(1600, 1, 1), date(9999, 12, 31)), min_size=1, max_size=60))
def test_rendered_dates_come_back(spark, days):
    layouts = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%d-%m-%Y", "%m/%d/%Y", "%m.%d.%Y",
               "%B %d, %Y", "%b %d, %Y", "%d-%b-%Y", "%d-%B-%Y"]
    texts = [d.strftime(x) for d in days for x in layouts]
    expected = [d for d in days for _ in layouts]
    assert column(spark, texts, parse_mixed_date) == expected


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30), min_size=1, max_size=50))
def test_any_text_is_parsed_without_error(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) <= 0xDFFF for c in t)] or [""]
    column(spark, texts, parse_mixed_date)
    column(spark, texts, try_timestamp)


def test_date_classes(spark):
    values = ["2024-01-02", "2024/01/02", "2024.01.02", "02-Jan-2024", "January 2, 2024",
              "2024-01-02T03:04:05", "01/02/2024"]
    assert column(spark, values, date_class) == [
        "YYYY-MM-DD", "YYYY/MM/DD", "YYYY.MM.DD", "DD-Mon-YYYY", "Month D, YYYY",
        "ISO timestamp", "other",
    ]


def test_days_count_midnights(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 23:59:59' a, timestamp_ntz'2024-01-02 00:00:01' b"
    )
    assert df.select(days_between(F.col("a"), F.col("b"))).first()[0] == 1
    assert df.select(days_between(F.col("b"), F.col("a"))).first()[0] == -1


def test_trim_keeps_tabs_and_strip_does_not(spark):
    assert column(spark, ["  a\t ", None], text.clean) == ["a\t", None]
    assert column(spark, ["  a\t\n ", None], text.strip) == ["a", None]


def test_null_tokens(spark):
    assert column(spark, ["N/A", "null", "None", "", "nan", "x", " NA ", None],
                  text.null_if_token) == [None] * 5 + ["x", " NA ", None]


def test_email_pattern(spark):
    assert column(spark, ["x@y.z", "x@y", None], text.looks_like_email) == [True, False, None]


def md5(value):
    return hashlib.md5(value.encode()).hexdigest()


def test_hash_keeps_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b", 2010), ("a", "b", None, 2010)],
                               "x string, y string, z string, n int")
    hashes = [r[0] for r in df.select(hashing.stable_hash(*map(F.col, "xyzn"))).collect()]
    assert hashes == [md5("a||||b||2010"), md5("a||b||||2010")]


def test_contact_hashes(spark):
    assert column(spark, [" X@Y.com\n", "x@y.com", None], hashing.email_hash) == [
        md5("x@y.com"), md5("x@y.com"), None]
    assert column(spark, [" +1 ", None], hashing.phone_hash) == [md5("+1"), None]


def test_batch_key(spark):
    row = spark.range(1).select(hashing.batch_key(F.lit("s"), F.lit("f"), F.lit("c"))).first()
    assert row[0] == md5("s|f|c")


def test_skill_lists(spark):
    values = ["b, a,C", "", None]
    assert column(spark, values, lists.sorted_items) == [["C", "a", "b"], [""], None]
    assert column(spark, values, lambda c: lists.item_count(lists.sorted_items(c))) == [3, 1, 0]


def test_skills_from_json(spark):
    values = ['["b"," a"]', '["a","b"]', "a,b", None, "[not a list"]
    assert column(spark, values, lists.list_to_csv) == ["b, a", "a,b", "a,b", None, "[not a list"]
    assert column(spark, values, lists.order_free_csv)[:4] == ["a,b", "a,b", "a,b", None]
