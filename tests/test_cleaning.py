"""Hand-computed results of the cleaning operators."""

import math

import pytest
from conftest import column

from sparkprep.functions.scalar import tier
from sparkprep.operators import columns as cols
from sparkprep.operators import derive, impute, scale
from sparkprep.operators import stats as st
from sparkprep.operators.profile import scale_types


def test_sparse_columns_strictly_above_threshold(table):
    df = table("id int, a int, b int", *[(i, 1 if i == 0 else None, None) for i in range(5)])
    model = cols.SparseColumnDropper(threshold=0.8).fit(df)
    assert model.dropped() == ["b"]
    assert model.transform(df).columns == ["id", "a"]


def test_tiers(table):
    df = table("id int, p double", (1, 81.0), (2, 80.0), (3, 50.0), (4, 20.0), (5, 0.0))
    out = df.select("id", tier(df.p).alias("t"))
    assert column(out, "t") == ["drop", "complex", "simple", "minimal", "none"]


def test_lenient_cast(table):
    df = table("id int, a string", (1, "1.5"), (2, "abc"), (3, None))
    assert column(cols.LenientCaster(inputCols=["a"]).transform(df), "a") == [1.5, None, None]


def test_lenient_cast_of_typed_columns(table):
    df = table("id int, b boolean", (1, True), (2, None))
    assert column(cols.LenientCaster(inputCols=["b"]).transform(df), "b") == [1.0, None]


def test_sentinel_then_timing(table):
    df = table("id int, q1_total_timing double", (1, None), (2, 500.0), (3, 1800000.0), (4, 9000000.0))
    out = scale.TimingCap().transform(impute.SentinelFill().transform(df))
    assert column(out, "q1_total_timing") == [-1.0, 0.5, 1800.0, 1800.0]


@pytest.mark.parametrize("n, expected", [(20, -1.0), (21, 7.0)])
def test_tiered_fill_boundary(table, n, expected):
    df = table("id int, x double", *[(i, None if i == 0 else 7.0) for i in range(n)])
    assert column(impute.TieredFill(inputCols=["x"]).fit(df).transform(df), "x")[0] == expected


def test_median_fill(table):
    df = table("id int, a int, b int", (1, 1, None), (2, None, None), (3, 4, None), (4, 2, None), (5, 10, None))
    out = impute.MedianFill(inputCols=["a", "b", "absent"]).fit(df).transform(df)
    assert column(out, "a") == [1.0, 3.0, 4.0, 2.0, 10.0]
    assert column(out, "b") == [0.0] * 5
    assert dict(out.dtypes)["a"] == "double"


def test_mode_fill_ties_and_null_candidate(table):
    df = table("id int, x string, y int", *[(i, v, None) for i, v in enumerate(["a", "a", "b", "b", None, None, None])])
    plain = impute.ModeFill(inputCols=["x", "y"]).fit(df).transform(df)
    assert column(plain, "x")[-1] == "a"
    assert column(plain, "y") == [-1] * 7
    literal = impute.ModeFill(inputCols=["x"], nullCandidate=True).fit(df).transform(df)
    assert column(literal, "x")[-1] == "Unknown"
    kept = impute.ModeFill(inputCols=["y"], fillEmpty=False).fit(df).transform(df)
    assert column(kept, "y") == [None] * 7


def test_mode_fill_keeps_column_types(table):
    df = table("id int, x bigint, d date, b boolean", (1, 5, None, None), (2, None, None, True))
    out = impute.ModeFill(inputCols=["x", "b", "d"]).fit(df).transform(df)
    assert dict(out.dtypes) == {"id": "int", "x": "bigint", "d": "string", "b": "boolean"}
    assert column(out, "d") == ["Unknown", "Unknown"]


def test_remaining_fill_leaves_no_null(table):
    df = table("id int, a double, b string, c double", (1, None, None, None), (2, 3.0, "z", None))
    out = impute.RemainingFill().fit(df).transform(df)
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 3.0, "z", 0.0), (2, 3.0, "z", 0.0)]


def test_minmax_keeps_flag(table):
    df = table("id int, a double, b double", (1, -1.0, -1.0), (2, 10.0, 7.0), (3, 20.0, 7.0), (4, 30.0, 7.0), (5, None, None))
    out = scale.FlagMinMaxScaler(inputCols=["a", "b"]).fit(df).transform(df)
    assert column(out, "a") == [-1.0, 0.0, 0.5, 1.0, -1.0]
    assert column(out, "b") == [-1.0, 7.0, 7.0, 7.0, None]


def test_population_scaler(table):
    df = table("id int, a double, b double", (1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, None, None))
    out = scale.PopulationScaler(inputCols=["a", "b"]).fit(df).transform(df)
    a = column(out, "a")
    assert a[0] == pytest.approx(-1.224745, abs=1e-6) and a[1] == 0 and a[3] is None
    assert column(out, "b") == [0.0, 0.0, 0.0, None]


def test_winsorize_nearest_rank_and_null(table):
    df = table("id int, a int", *[(i, i) for i in range(1, 11)], (11, None))
    out = scale.Winsorizer(inputCols=["a"], lower=0.25, upper=0.25).fit(df).transform(df)
    assert column(out, "a") == [3, 3, 3, 4, 5, 6, 7, 8, 8, 8, None]


def test_composite_mean(table):
    df = table("id int, a int, b int, c int", (1, 1, 3, 0), (2, None, 4, 0), (3, None, None, 0))
    out = derive.CompositeMean(definitions={"s": ["a", "b"], "t": ["c", "gone"]}).transform(df)
    assert out.columns == ["id", "c", "s"]
    assert column(out, "s") == [2.0, 4.0, None]


def test_occupation_groups(table):
    df = table("id int, t string", (1, "2310"), (2, "0110"), (3, "-5"), (4, ""), (5, "X1"), (6, None))
    out = derive.OccupationGrouper(inputCols=["t"]).transform(df)
    assert column(out, "t_grouped") == [2, 0, None, None, None, None]
    ints = table("id int, t int", (1, 110), (2, 2310))
    assert column(derive.OccupationGrouper(inputCols=["t"]).transform(ints), "t_grouped") == [1, 2]
    assert column(derive.OccupationGrouper(inputCols=["t"], width=4).transform(ints), "t_grouped") == [0, 2]


def test_interactions(table):
    rows = [(1, 0.5, 10.0), (2, 1.0, 4.0), (3, -1.0, 10.0), (4, 0.5, -1.0), (5, 1.0, 5.0)]
    df = table("id int, m_average_score double, m_total_timing double", *rows)
    out = derive.InteractionFeatures().transform(df)
    assert out.columns == ["id", "m_is_fast_guesser", "m_efficiency"]
    assert column(out, "m_efficiency") == [0.05, 0.25, -0.1, -1.0, 0.2]
    assert column(out, "m_is_fast_guesser") == [0.0, 1.0, 0.0, 0.0, 0.0]
    assert column(derive.InteractionFeatures(respectFlag=True).transform(df), "m_efficiency")[2] == -1.0


def test_scale_types(table):
    sets = {"a": [1, 2, 3, 4, 5], "b": [1, 2, 4], "c": [-99, 1, 2, 3], "d": [1, 2, 3, 4, 5, 6]}
    rows = [tuple(v[i] if i < len(v) else None for v in sets.values()) for i in range(6)]
    df = table("a int, b int, c int, d int", *rows)
    got = {r.variable: r.scale_type for r in scale_types(df, list(sets)).collect()}
    assert got == {"a": "likert_5", "b": "other", "c": "with_special_codes", "d": "quantity_ranges"}


def test_strict_drop_and_select(table):
    df = table("id int", (1,))
    with pytest.raises(ValueError, match="nope"):
        cols.ColumnDropper(inputCols=["nope"], strict=True).transform(df)
    with pytest.raises(ValueError, match="nope"):
        cols.select_columns(df, ["nope"])
    assert cols.split_present(df, ["id", "nope"]) == (["id"], ["nope"])


def test_column_names_with_dots(table):
    df = table("id int, `a.b` double", (1, None), (2, 4.0))
    out = impute.MedianFill(inputCols=["a.b"]).fit(df).transform(df)
    assert column(out, "a.b") == [4.0, 4.0]
    assert {r.variable: r.missing_count for r in st.null_counts(df).collect()} == {"id": 0, "a.b": 1}


def test_nan_to_null(table):
    df = table("id int, x double", (1, math.nan), (2, 1.0), (3, None))
    assert column(cols.nan_to_null(df), "x") == [None, 1.0, None]


def test_value_scope_flag_and_text_columns(table):
    df = table("id int, a double, s string", (1, 7200.9, "x"), (2, 1.0, "y"))
    got = {r.variable: r.suspicious for r in st.value_scope(df).collect()}
    assert got == {"id": False, "a": False}


def test_histogram_edges(table):
    df = table("id int, a double, b double", (1, 0.0, 5.0), (2, 30.0, 5.0), (3, None, 5.0))
    got = {(r.variable, r.bin): r.n for r in st.histogram(df, ["a", "b"]).collect()}
    assert got == {("a", 0): 1, ("a", 29): 1, ("b", 15): 3}


def test_empty_table(table):
    df = table("id int, a double, s string")
    assert st.missing_total(df).first().missing_pct == 0.0
    out = impute.RemainingFill().fit(df).transform(df)
    assert out.count() == 0
    assert impute.MedianFill(inputCols=["a"]).fit(df).values() == {"a": 0.0}
