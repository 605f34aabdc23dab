from hypothesis import given, settings
from hypothesis import strategies as st

from panel_edit.functions.lists import next_free_year, parse_year_list, previous_free_year


def _loop(year, listed, limit, up):
    s = set(listed)
    if up:
        while year in s and year < limit + 1:
            year += 1
    else:
        while year in s and year > limit - 1:
            year -= 1
    return year


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(1995, 2005), st.sets(st.integers(1993, 2007), max_size=8)),
                min_size=150, max_size=150))
def test_free_year_equals_loop(spark, cases):
    df = spark.createDataFrame([(y, sorted(s)) for y, s in cases], "y int, l array<int>")
    got = df.select("y", "l", next_free_year("y", "l", 2001).alias("n"),
                    previous_free_year("y", "l", 1998).alias("p")).collect()
    for r in got:
        assert r.n == _loop(r.y, r.l, 2001, True)
        assert r.p == _loop(r.y, r.l, 1998, False)


def test_parse_year_list_cells(spark):
    df = spark.createDataFrame([("2010",), ("2010, 2011",), (None,), ("",), (" 2012.0 ,",), ("nan",)], "c string")
    assert [r.v for r in df.select(parse_year_list("c").alias("v")).collect()] == [
        [2010], [2010, 2011], [], [], [2012], []]
