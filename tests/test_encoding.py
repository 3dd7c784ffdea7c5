"""Encoders: results on small tables, invariants, storage."""

import pytest
from conftest import column

from sparkprep.operators import encode
from sparkprep.session import scratch_path


def test_ordinal_numeric_order_unknown_and_null(table):
    train = table("id int, c int", (1, 10), (2, 2), (3, 1))
    other = table("id int, c int", (1, 1), (2, 2), (3, 10), (4, 3), (5, None))
    model = encode.OrdinalCoder(inputCols=["c"]).fit(train)
    assert column(model.transform(other), "c") == [0.0, 1.0, 2.0, -1.0, None]


@pytest.mark.parametrize("inline", [64, 1])
def test_table_and_inline_paths_agree(table, monkeypatch, inline, spark):
    monkeypatch.setattr(encode, "INLINE_LEVELS", inline)
    train = table("id int, s string, d double", *[(i, f"v{i % 12:02d}", (i % 12) / 4 - 1) for i in range(60)], (60, None, None))
    other = table("id int, s string, d double", (1, "v03", -1.0), (2, "new", 9.0), (3, None, None), (4, "v11", -0.0))
    ordinal = encode.OrdinalCoder(inputCols=["s", "d"]).fit(train)
    out = ordinal.transform(other)
    assert column(out, "s") == [3.0, -1.0, None, 11.0] and column(out, "d") == [0.0, -1.0, None, 4.0]
    assert out.columns == other.columns
    freq = encode.FrequencyCoder(inputCols=["s"]).fit(train)
    assert column(freq.transform(other), "s") == [5 / 61, 0.0, 0.0, 5 / 61]
    assert freq.transform(other).columns == ["id", "d", "s"]
    path = scratch_path(spark, "coder")
    freq.save(path)
    again = encode.FrequencyModel.load(path)
    assert column(again.transform(other), "s") == [5 / 61, 0.0, 0.0, 5 / 61]


def test_binary(table):
    train = table("id int, c string, d string", (1, "No", "x"), (2, "Yes", "y"), (3, "No", None))
    model = encode.BinaryCoder(inputCols=["c", "d"]).fit(train)
    assert column(model.transform(train), "c") == [0, 1, 0]
    assert column(model.transform(train), "d") == ["x", "y", None]  # null is a third value
    strange = table("id int, c string", (1, "Maybe"))
    with pytest.raises(Exception, match="unseen value in binary column c: Maybe"):
        model.transform(strange).collect()
    soft = encode.BinaryCoder(inputCols=["c"], handleInvalid="null").fit(train)
    assert column(soft.transform(strange), "c") == [None]


def test_onehot_unknown_and_null(table):
    train = table("id int, c string, k int", (1, "A", 1), (2, "B", 2), (3, "C", None))
    model = encode.OneHotCoder(inputCols=["c", "k"]).fit(train)
    out = model.transform(table("id int, c string, k int", (1, "D", 1), (2, "B", None)))
    assert out.columns == ["id", "c_A", "c_B", "c_C", "k_1", "k_2", "k_None"]
    assert [tuple(r)[1:] for r in out.orderBy("id").collect()] == [(0, 0, 0, 1, 0, 0), (0, 1, 0, 0, 0, 1)]


def test_frequency_needs_more_than_ten_levels(table):
    train = table("id int, few string, many int", *[(i, f"f{i % 10}", i % 11) for i in range(110)])
    out = encode.FrequencyCoder(inputCols=["few", "many"]).fit(train).transform(train)
    assert out.columns == ["id", "few", "many"]
    assert column(out, "many") == [10 / 110] * 110
    assert column(out, "few")[0] == "f0"


def test_rare_levels(table):
    train = table("id int, c string, n int", *[(i, "X" if i < 197 else "Y" if i < 199 else "Z", i % 2) for i in range(200)])
    model = encode.RareGrouper(inputCols=["c", "n"]).fit(train)
    out = model.transform(table("id int, c string, n int", (1, "X", 0), (2, "Y", 1), (3, "Z", 5), (4, "new", None), (5, None, 1)))
    assert column(out, "c") == ["X", "Y", "Other", "new", None]
    assert dict(out.dtypes)["n"] == "int"  # no rare level, type kept


def test_target_encoding_uses_other_folds_only(table):
    from pyspark.sql import functions as F

    df = table("id int, g string, y double", (0, "a", 1.0), (1, "a", 3.0), (2, "a", 5.0), (3, "b", 10.0))
    out = encode.target_encode(df, "g", "y", F.col("id") % 2, 2, "t")
    # a, fold 0: mean of fold 1 = 3; a, fold 1: mean(1, 5) = 3; b only in fold 1: mean of fold 0 = 3
    assert column(out, "t") == [3.0, 3.0, 3.0, 3.0]


def test_fit_reads_no_test_row(table):
    train = table("id int, c string", *[(i, f"v{i % 3}") for i in range(30)])
    test = table("id int, c string", *[(i, "only here") for i in range(30)])
    for step in (encode.OrdinalCoder, encode.OneHotCoder, encode.RareGrouper):
        model = step(inputCols=["c"]).fit(train)
        assert "only here" not in str(model.getState())
        assert model.transform(test).count() == 30
