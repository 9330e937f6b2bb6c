"""Column functions against plain Python on edge values."""

import datetime as dt
import math

import pytest
from paperloom.functions import dates, text, vectors
from paperloom.schema import ModelSpec, registry
from pyspark.sql import functions as F

SPACES = ["", " ", "\n", "a", " a ", "\n a\nb \n", "\xa0a　", "a\r\nb", " x\x1f", "a  b\tc", None, "\x85v\x0b"]


def _column(spark, values, kind, expression):
    rows = [(k, v) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"k int, v {kind}").select("k", expression(F.col("v")).alias("out"))
    return [r.out for r in df.orderBy("k").collect()]


def test_flatten_text_strips_like_python(spark):
    expected = [(v or "").replace("\n", " ").strip() for v in SPACES]
    assert _column(spark, SPACES, "string", text.flatten_text) == expected


def test_split_categories_splits_like_python(spark):
    expected = [(v or "").split() for v in SPACES]
    assert _column(spark, SPACES, "string", text.split_categories) == expected


def test_author_names(spark):
    kind = "array<struct<keyname:string,forenames:string>>"
    values = [
        None,
        [],
        [("Doe", "Jane")],
        [("Doe", None), (None, "Jane"), (None, None), ("", ""), (" ", "\t")],
        [("Collab", ""), ("Roe", " R. ")],
    ]
    expected = [[], [], ["Jane Doe"], ["Doe", "Jane"], ["Collab", "R.  Roe"]]
    assert _column(spark, values, kind, text.author_names) == expected


def test_non_empty_keeps_order_and_commas(spark):
    values = [None, [], ["", None], ["A, B", "", "C"]]
    assert _column(spark, values, "array<string>", text.non_empty) == [[], [], [], ["A, B", "C"]]


def test_primary_date_treats_empty_as_missing(spark):
    df = spark.createDataFrame([("u", "c"), ("", "c"), (None, "c"), (None, None)], "u string, c string")
    assert [r[0] for r in df.select(text.primary_date("u", "c")).collect()] == ["u", "c", "c", None]


@pytest.mark.parametrize(
    "link, version, first_v",
    [
        ("http://x.org/abs/2301.00001v1", "2301.00001", "2301.00001"),
        ("http://x.org/abs/2301.00001", "2301.00001", "2301.00001"),
        ("http://x.org/abs/solv-int/9901001v12", "solv-int/9901001", "sol"),
        ("http://x.org/abs/a/abs/b2v3", "b2", "b2"),
        ("http://x.org/abs/v9", "", ""),
    ],
)
def test_id_from_link(spark, link, version, first_v):
    df = spark.createDataFrame([(link,)], "v string")
    row = df.select(text.id_from_link("v"), text.id_from_link("v", "first_v"), text.has_abs_link("v")).first()
    assert tuple(row) == (version, first_v, True)


def test_links_without_a_paper(spark):
    assert _column(spark, [None, "", "http://x.org/list/1"], "string", text.has_abs_link) == [False] * 3


def test_category_prefix_needs_a_dot(spark):
    values = [["cs.AI"], ["cs"], ["csx.AI"], [], None, ["stat.ML", "math.ST"]]
    hits = _column(spark, values, "array<string>", lambda c: text.in_categories(c, ["cs", "stat.ML"]))
    assert hits == [True, True, False, False, False, True]


def test_embed_text_keeps_the_line_break(spark):
    df = spark.createDataFrame([("t", "a"), (None, "a"), ("t", None), (None, None)], "title string, abstract string")
    assert [r[0] for r in df.select(text.embed_text()).collect()] == ["t\na", "\na", "t\n", "\n"]


def test_year_of_is_not_strict(spark):
    values = ["2024-02-29T10:00:00Z", "2023-02-29T10:00:00Z", "2024-02-29", "nope", "", None, "2024-02-29T10:00:00"]
    assert _column(spark, values, "string", dates.year_of) == [2024, None, None, None, None, None, None]


def test_year_of_both_formats(spark):
    both = lambda c: dates.year_of(c, (dates.TIMESTAMP_FORMAT, dates.DATE_FORMAT))
    assert _column(spark, ["2024-02-29T10:00:00Z", "1999-12-31", "x"], "string", both) == [2024, 1999, None]


def test_feed_date(spark):
    values = [
        "Mon, 01 Jan 2024 00:00:00 -0500",
        "01 Jan 2024 00:00:00 GMT",
        "Mon, 1 Jan 2024 23:30:00 +0130",
        "2024-01-01T00:00:00-05:00",
        "2024-01-01T00:00:00Z",
        "Mon, 01 Jan 2024 00:00:00 EST",
        "Mon, 01 Jan 2024 00:00 PDT",
        "2024-01-01T00:00:00.250Z",
        "someday",
        None,
    ]
    expected = [
        "2024-01-01T05:00:00Z",
        "2024-01-01T00:00:00Z",
        "2024-01-01T22:00:00Z",
        "2024-01-01T05:00:00Z",
        "2024-01-01T00:00:00Z",
        "2024-01-01T05:00:00Z",
        "2024-01-01T07:00:00Z",
        "2024-01-01T00:00:00Z",
        None,
        None,
    ]
    assert _column(spark, values, "string", dates.feed_date) == expected
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert _column(spark, values, "string", dates.feed_date) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_windows():
    assert dates.request_window(dt.date(2024, 3, 1)) == (dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    assert dates.request_window(dt.date(2024, 3, 1), start=dt.date(2024, 1, 5))[0] == dt.date(2024, 1, 5)
    today = dt.date(2024, 5, 6)
    assert dates.year_request(2024, today) == (dt.date(2024, 1, 1), today)
    assert dates.year_request(2023, today) == (dt.date(2023, 1, 1), dt.date(2023, 12, 31))


def test_within_is_inclusive_in_both_formats(spark):
    window = (dt.date(2024, 1, 30), dt.date(2024, 1, 31))
    values = ["2024-01-29", "2024-01-30", "2024-01-31", "2024-01-31T23:59:59Z", "2024-02-01", "2024-01-29T23:59:59Z"]
    inside = _column(spark, values, "string", lambda c: dates.within(c, window))
    assert inside == [False, True, True, True, False, False]


NAN = float("nan")
VECTORS = [None, [], [0.0, 0.0], [NAN, NAN], [1.0, NAN], [None, 2.0], [1.0, 2.0, 3.0], [1.0, -1.0], [1e-8, 0.0], [0.5, 0.25]]


def test_vector_sum(spark):
    sums = _column(spark, VECTORS, "array<float>", vectors.vector_sum)
    assert sums[:3] == [None, 0.0, 0.0] and math.isnan(sums[3]) and math.isnan(sums[4])
    assert sums[5:8] == [2.0, 6.0, 0.0] and sums[9] == 0.75


def test_near_zero_and_backlog_predicates(spark):
    near = [False, True, True, False, False, False, False, True, True, False]
    assert _column(spark, VECTORS, "array<float>", vectors.is_near_zero) == near
    needs = [True] + near[1:]
    assert _column(spark, VECTORS, "array<float>", vectors.needs_vector) == needs
    retry = [True, True, True, True, True, False, False, True, True, False]
    assert _column(spark, VECTORS, "array<float>", lambda c: vectors.needs_vector(c, True)) == retry


def test_repair(spark):
    fixed = _column(spark, VECTORS, "array<float>", lambda c: vectors.repair(c, 2))
    assert all(len(v) == 2 for v in fixed)
    assert fixed[9] == [0.5, 0.25] and fixed[5] == [None, 2.0]
    assert all(math.isnan(x) for k in (0, 1, 6) for x in fixed[k])


def test_any_nonzero_follows_three_valued_logic(spark):
    rows = [(1, [1.0], None), (2, [0.0], None), (3, None, None), (4, [0.0], [NAN]), (5, [0.0], [0.0])]
    df = spark.createDataFrame(rows, "k int, a array<float>, b array<float>")
    assert [r.k for r in df.filter(vectors.any_nonzero(["a", "b"])).orderBy("k").collect()] == [1, 4]


def test_cast_vector_checks_length(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(vectors.cast_vector("v", 2)).collect()] == [[1.0, 2.0], None]
    with pytest.raises(Exception, match="vector length is not 3"):
        df.select(vectors.cast_vector("v", 3)).collect()


def test_registry_shapes():
    settings = {"model_name": "n", "dimension": 4}
    expected = {"a": ModelSpec("a", "n", 4)}
    assert registry({"a": settings}) == expected
    assert registry([{"a": settings}, {"a": {"model_name": "later"}}]) == expected
    assert registry({"a": {"dimension": 4}, "plain": 3}) == {"a": ModelSpec("a", None, 4)}
