import os

import pytest

from quillsieve.plans import cut
from quillsieve.plans.components import components


def test_components_of_ids_near_the_largest(spark):
    a = 2**62
    edges = [(a + 1, a + 2), (a + 3, a + 4), (a + 2, a + 5), (-(2**62), -(2**62) - 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {a + 1: a + 1, a + 2: a + 1, a + 5: a + 1, a + 3: a + 3, a + 4: a + 3, -a: -a - 1, -a - 1: -a - 1}


def test_components_of_no_edges_and_text_nodes(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    got = {r.node: r.component for r in components(spark.createDataFrame([("b", "c"), ("c", "a"), (None, "x")], "u string, v string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a"}


def _there(df):
    return os.path.isdir(df.written_path.removeprefix("file://").removeprefix("file:"))


def test_scratch_tables_go_and_kept_ones_stay(spark):
    with cut.scratch() as outer:
        with cut.scratch() as inner:
            a, b = cut.written(spark.range(3), "a"), cut.written(spark.range(4), "b")
            inner.keep(b)
        assert not _there(a) and b.count() == 4
        c = cut.written(b, "c")
        outer.keep(c)
    assert not _there(b) and c.count() == 4
    with pytest.raises(KeyError):
        with cut.scratch():
            d = cut.written(spark.range(2), "d")
            raise KeyError
    assert not _there(d)
