"""Property checks from the test strategy: identities that must hold on any input."""
import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepanel.operators import joins as J
from tidepanel.operators.reshape import pivot_first, unpivot_long

cells = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.sampled_from(["m1", "m2"]),
                           st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(cells)
def test_unpivot_after_pivot_is_identity(spark, rows):
    uniq = {(e, t, m): v for e, t, m, v in rows}
    df = spark.createDataFrame([(e, t, m, v) for (e, t, m), v in uniq.items()],
                               "entity string, date int, metric string, value double")
    wide = pivot_first(df, ["entity", "date"], ["m1", "m2"])
    back = unpivot_long(wide, ["entity", "date"], ["m1", "m2"], drop_nulls=True)
    assert sorted(tuple(r) for r in back.collect()) == sorted((e, t, m, v) for (e, t, m), v in uniq.items())


@settings(max_examples=8, deadline=None)
@given(cells)
def test_balanced_output_has_equal_counts(spark, rows):
    df = spark.createDataFrame(rows, "entity string, date int, metric string, value double")
    out = J.balanced_semi_join(df).toPandas()
    if len(out):
        per = out.drop_duplicates(["entity", "date"]).groupby("entity").date.nunique()
        assert per.nunique() == 1 and set(out.entity) == set(r[0] for r in rows)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(1990, 2005), min_size=1, max_size=6),
       st.lists(st.tuples(st.integers(1990, 2005), st.sampled_from(["x", "y"]), st.floats(0, 10)), max_size=8))
def test_scaffold_has_no_nulls_and_full_grid(spark, years, obs):
    ydf = spark.createDataFrame([(y,) for y in years], "year int")
    odf = spark.createDataFrame(list({(y, m): (y, m, v) for y, m, v in obs}.values()) or [(0, "x", 0.0)],
                                "year int, metric string, value double")
    out = J.scaffold_left_join(odf, ydf, ["x", "y"]).toPandas()
    assert len(out) == 2 * len(set(years)) and out.value.notna().all()
