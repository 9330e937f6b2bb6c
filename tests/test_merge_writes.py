"""What a harvest that is merged writes besides its table."""

import datetime as dt

import paperloom.plans.harvest as harvest
from paperloom.operators.dedup import without_keys
from paperloom.operators.upsert import matched, winning
from paperloom.plans import harvest_years
from paperloom.sources.tables import read_years
from test_sources import _page, _record
from test_whole_pages import _rows

TODAY = dt.date(2025, 6, 1)


def test_winning_rows_are_the_new_ones_and_the_winners(spark):
    schema = "id string, year int, updated string, title string"
    stored = spark.createDataFrame(
        [("a", 1, "2020", "x"), ("b", 1, "2020", "x"), ("c", 1, None, "x"), ("d", 1, "2022", "x"), (None, 1, "2020", "x"), ("e", 1, "2020", None)],
        schema,
    )
    new = spark.createDataFrame(
        [("a", 1, "2020", "x"), ("b", 1, "2020", "y"), ("c", 1, "2019", "x"), ("d", 1, "2021", "y"), (None, 1, "2020", "x"), ("e", 1, "2020", None), ("f", 1, None, None), ("d", 1, None, "y")],
        schema,
    )
    for nulls in ("last", "first"):
        met = matched(stored, new, ("id", "year"), "updated", nulls)
        before = met.filter("__wins").drop("__wins").unionByName(without_keys(new, met, ("id", "year")))
        assert _rows(winning(stored, new, ("id", "year"), "updated", nulls)) == _rows(before)


def test_a_merge_writes_only_the_rows_that_change(spark, folder, monkeypatch):
    path, root, written = folder("pages"), folder("table"), []
    _page(path, "1.xml", *[_record(i) for i in "abcd"])
    assert harvest_years(spark, path, root, [2024, 2025], TODAY) == 4
    real = harvest.cut_lineage

    def seen(df, purpose):
        out = real(df, purpose)
        written.append((purpose, out.count()))
        return out

    monkeypatch.setattr(harvest, "cut_lineage", seen)
    before = _rows(read_years(spark, root))
    assert harvest_years(spark, path, root, [2024, 2025], TODAY, mode="merge") == 0
    assert [n for purpose, n in written if purpose != "pages"] == [0]
    assert _rows(read_years(spark, root)) == before
    _page(path, "2.xml", _record("e"))
    harvest_years(spark, path, root, [2024, 2025], TODAY, mode="merge")
    assert written[-1][1] == 1 and read_years(spark, root).count() == 5
