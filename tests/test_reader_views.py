import pytest

from tidewell.operators import tables as T
from tidewell.operators.reader_views import as_reader, close_memberships, create_reader_view
from conftest import rows

EDGES = "member string, grp string"


def test_nested_groups_and_rings(spark):
    edges = [("ann", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("bob", "d"), ("ann", "a"), (None, "a"), ("eve", None)]
    closed = rows(close_memberships(spark.createDataFrame(edges, EDGES)))
    ring = [(m, g) for m in ("a", "ann", "b", "c") for g in ("a", "b", "c")]
    assert closed == sorted([*ring, ("bob", "d")])
    assert close_memberships(spark.createDataFrame([], EDGES)).count() == 0


def test_one_view_many_readers(spark):
    base = spark.createDataFrame([(1, "x@y", None), (2, None, 5), (3, "z@y", 7)], "id int, `e mail` string, n int")
    T.ctas(base, "rv_base")
    T.ctas(spark.createDataFrame([("ann", "o'brien"), ("bob", "rows")], EDGES), "rv_members")
    create_reader_view(spark, "rv_view", "rv_base", "rv_members", {"e mail": "o'brien"}, [("rows", "n > 5")], everyone="n = 5")
    create_reader_view(spark, "rv_stacked", "rv_view", "rv_members", rows=[("rows", "true")])

    def seen(name, view="rv_view"):
        with as_reader(spark, name):
            return [tuple(r) for r in spark.table(view).orderBy("id").collect()]
    assert seen("ann") == [(2, None, 5)]
    assert seen("bob") == [(2, "REDACTED", 5), (3, "REDACTED", 7)]       # n null: hidden
    assert seen("nobody") == [(2, "REDACTED", 5)]
    assert seen("ann", "rv_stacked") == [] and len(seen("bob", "rv_stacked")) == 2
    T.append_rows(spark.createDataFrame([("bob", "o'brien")], EDGES), "rv_members")
    assert seen("bob") == [(2, None, 5), (3, "z@y", 7)]                  # the same view, a new membership
    with pytest.raises(ValueError):
        create_reader_view(spark, "rv_view", "rv_base", "rv_members", {"missing": "a"})
