"""Results that must not depend on the number of columns or levels, or on large values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep import session
from sparkprep.functions.scalar import order_key
from sparkprep.operators import joins, knn, quantiles, shuffle, split, stats
from sparkprep.operators.assoc import pearson_matrix
from sparkprep.operators.encode import BinaryCoder, FrequencyCoder
from sparkprep.operators.knn import KnnFill, _block_search
from sparkprep.operators.scale import ClipModel, FlagMinMaxScaler, PopulationScaler
from sparkprep.operators.stats import describe
from sparkprep.streaming.apply import write_transformed


def test_nan_is_missing_for_few_and_many_columns(spark):
    rows = [(float(i), float("nan") if i == 3 else 2.0 * i) for i in range(20)]
    few = spark.createDataFrame(rows, "a double, b double")
    many = few.select("*", *[(F.col("a") * k + F.rand(k)).alias(f"x{k}") for k in range(17)])
    for df in (few, many):
        r = pearson_matrix(df).where("var_a = 'a' and var_b = 'b'").first()
        assert r.n == 19 and abs(r.r - 1) < 1e-9


def test_counts_of_an_empty_table_are_zero(spark):
    few = spark.createDataFrame([], "a double, b double")
    many = spark.createDataFrame([], ", ".join(f"c{i} double" for i in range(80)))
    for df in (few, many):
        assert {r["count"] for r in describe(df, df.columns).collect()} == {0}


def test_encoded_columns_keep_the_input_order(spark):
    for n in (60, 100):
        df = spark.createDataFrame([(f"v{i}", f"s{i % 12}") for i in range(n)], "big string, small string")
        out = FrequencyCoder(inputCols=["big", "small"]).fit(df).transform(df)
        assert [c for c in out.columns if c.startswith(("big", "small"))] == ["big", "small"]


def test_clip_leaves_values_inside_alone(spark):
    df = spark.createDataFrame([(9007199254740993,), (None,), (-5,)], "x bigint")
    got = [r.x for r in ClipModel({"x": (0.0, 1e18)}).transform(df).collect()]
    assert got == [9007199254740993, None, 0]


def test_neighbours_of_large_values():
    import pandas as pd

    donors = pd.DataFrame({"x": [[1e8 + d, v] for d, v in ((0, 1.0), (0.5, 2.0), (1, 3.0), (2, 4.0))], "n": 1})
    receivers = pd.DataFrame({"x": [[1e8 + 2.1, None]], "profile": ["p"]})
    assert _block_search(2, 1)(receivers, donors)["value"].tolist()[0] == 4.0


def test_keys_of_several_columns_do_not_collide(spark):
    df = spark.createDataFrame([("a", "b#c"), ("a#b", "c"), (None, "x"), ("", "x"), ("x", None)], "p string, q string")
    assert df.select(order_key(["p", "q"], 1).alias("k")).distinct().count() == 5


def test_read_out_returns_one_row_per_rank(spark, monkeypatch):
    """The driver sees bins and ranks, not the values inside the brackets."""
    names = [f"c{i}" for i in range(10)]
    df = spark.range(60_000).select(*[F.rand(i).alias(n) for i, n in enumerate(names)])
    probs = [i / 10 for i in range(1, 10)]
    kind, seen = type(df), []
    collect = kind.collect

    def counted(self):
        rows = collect(self)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", counted)
    got = quantiles.exact_quantiles(df, names, probs)
    monkeypatch.undo()
    assert sum(seen) <= len(names) * (quantiles.BINS + 2 * len(probs) + 1)
    want = df.select(*[F.percentile(n, probs).alias(n) for n in names]).first()
    for n in names:
        assert max(abs(a - b) for a, b in zip(got[n], want[n])) < 1e-12


def test_undersampling_with_very_many_classes(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 5000).alias("c")).where("id < 25000 or c = 7")
    out = split.undersample(df, "c", ["id"])
    sizes = out.groupBy("c").count()
    assert sizes.count() == 5000 and {r["count"] for r in sizes.collect()} == {5}


def test_undersampling_cuts_a_large_class_in_ranges(spark, monkeypatch):
    df = spark.range(4000).select("id", F.when(F.col("id") % 40 == 0, "b").otherwise("a").alias("c"))
    whole = sorted(r.id for r in split.undersample(df, "c", ["id"]).collect())
    monkeypatch.setattr(split, "ROWS_PER_CUT", 50)
    assert sorted(r.id for r in split.undersample(df, "c", ["id"]).collect()) == whole and len(whole) == 200


def test_distinct_decimals_stay_apart(spark):
    big = "12345678901234567890123456789012345678"
    df = spark.sql(f"SELECT CAST(v AS decimal(38,0)) AS d FROM VALUES ({big}), ({big[:-1]}9), ({big}), (NULL) AS t(v)")
    assert stats.n_unique(df).first().n_unique == 3
    out = FrequencyCoder(inputCols=["d"]).fit(df).transform(df)
    assert out.select("d").distinct().count() >= 2


def test_one_level_and_null_is_binary(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "x")], "id int, c string")
    out = BinaryCoder(inputCols=["c"]).fit(df).transform(df)
    assert [r.c for r in out.orderBy("id").collect()] == [0, 1, 0]


def test_fits_leave_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "x double")
    assert PopulationScaler(inputCols=["x"]).fit(df).getState() == {"x": [2.0, 1.0]}
    assert FlagMinMaxScaler(inputCols=["x"]).fit(df).getState()["range"] == {"x": [1.0, 3.0]}


def test_side_by_side_tables_must_match(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    b = spark.createDataFrame([(1, "c")], "id int, q string")
    with pytest.raises(ValueError, match="1 ids differ"):
        joins.join_on_id(a, b, ["id"])
    assert joins.join_on_id(a.where("id = 1"), b, ["id"]).count() == 1


def test_lookup_of_long_rows_is_not_broadcast(spark, monkeypatch):
    lookup = spark.range(50).select("id", F.lit(1).alias("n"), F.repeat(F.lit("x"), 1000).alias("v"))
    df = spark.range(60)
    assert joins.is_small(lookup)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10_000)
    assert not joins.is_small(lookup)
    out = joins.join_levels(df, lookup, "id")
    assert out.count() == 60 and out.where("v is null").count() == 10


def test_stream_with_a_large_lookup_and_a_neighbour_model(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.1), (3, 5.0, 9.0), (4, 1.2, None)], "id int, a double, b double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    model = KnnFill(inputCols=["a", "b"], k=1).fit(df)
    assert model.output_schema(df) == model.transform(df).schema
    write_transformed(model, stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted(got.collect()) == sorted(model.transform(df).select(got.columns).collect())

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    lookup = spark.createDataFrame([(1.0, 3, "x"), (5.0, 1, "y")], "a double, n bigint, v string")
    query = joins.join_levels(stream, lookup, "a").writeStream.format("parquet").outputMode("append")
    query = query.option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True)
    query.start(str(tmp_path / "out2")).awaitTermination()
    assert {r.id: r.v for r in spark.read.parquet(str(tmp_path / "out2")).collect()} == {1: "x", 2: None, 3: "y", 4: None}


def test_pruned_neighbours_equal_the_whole_search(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 40, 800) * 1000.0
    x = np.stack([centre + rng.integers(0, 30, 800), centre / 7 + rng.integers(0, 30, 800), rng.integers(0, 5, 800)], 1)
    rows = [[None if f and i % 9 == f + 3 else float(v) for f, v in enumerate(row)] for i, row in enumerate(x)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a double, b double, c double")
    fill = KnnFill(inputCols=["a", "b", "c"], k=3).fit(df)
    whole = sorted(fill.transform(df).collect())
    used, search = [], knn._search_pairs
    monkeypatch.setattr(knn, "_search_pairs", lambda left, right, pairs, *more: used.append(pairs.count()) or search(left, right, pairs, *more))
    monkeypatch.setattr(knn, "DONOR_BLOCK", 25)
    monkeypatch.setattr(knn, "RECEIVER_BLOCK", 20)
    assert sorted(fill.transform(df).collect()) == whole
    n_profiles = df.distinct().count()
    assert len(used) == 3 and sum(used) < 0.5 * (n_profiles / 25) * (sum(None in r for r in rows) / 20)


def test_release_deletes_what_was_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_application_dir", lambda s: f"{tmp_path}/app")
    stored = session.materialise(spark.range(3), "some")
    assert stored.count() == 3 and (tmp_path / "app").exists()
    assert session.release(spark) and not (tmp_path / "app").exists()
    assert not session.release(spark)


def test_exchanged_rows_carry_all_columns_of_their_partner(spark, monkeypatch):
    monkeypatch.setattr(shuffle, "ROWS_PER_BLOCK", 50)
    df = spark.range(200).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("a"), (F.col("id") * 2).alias("b"))
    out = shuffle.with_partner(df, ["a", "b"], ["id"], 5).collect()
    partners = [r._partner.b // 2 for r in out]
    assert sorted(partners) == list(range(200)) and all(p != r.id for p, r in zip(partners, out, strict=True))
    assert all(r._partner.a == (p if p % 3 else None) for p, r in zip(partners, out, strict=True))


def test_neighbours_under_twenty_missing_patterns(spark, monkeypatch):
    rng = np.random.default_rng(8)
    patterns = [[f for f in range(6) if f not in gone] for gone in ([], *[[f] for f in range(6)], *[[f, (f + 1) % 6] for f in range(6)], *[[f, (f + 2) % 6, 5 - f] for f in range(6)], [0, 1, 2, 3, 4])]
    patterns = list({tuple(p) for p in patterns})[:20]
    rows, low = [], []
    for i in range(2000):
        near = rng.integers(0, 30) * 100.0
        low += [i] if near < 300 else []
        has = patterns[i % len(patterns)]
        rows.append((i, *[float(near * (f + 1) + rng.integers(0, 9)) if f in has else None for f in range(6)]))
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in "abcdef"))
    fill = KnnFill(inputCols=list("abcdef"), k=4).fit(df)
    some = df.where(F.col("id").isin(low))
    whole = sorted(fill.transform(some).collect())
    used, search = [], knn._search_pairs

    def counted(left, right, pairs, *more):
        # compared profiles, not blocks: blocks differ in size
        sizes = lambda t, name: t.groupBy(F.col("block").alias(name)).agg(F.count("*").alias(f"{name}_rows"))
        both = pairs.join(sizes(left, "rb"), "rb").join(sizes(right, "db"), "db")
        used.append(both.agg(F.sum(F.col("rb_rows") * F.col("db_rows"))).first()[0] or 0)
        return search(left, right, pairs, *more)

    monkeypatch.setattr(knn, "_search_pairs", counted)
    monkeypatch.setattr(knn, "DONOR_BLOCK", 16)
    monkeypatch.setattr(knn, "RECEIVER_BLOCK", 16)
    assert sorted(fill.transform(some).collect()) == whole
    share = sum(used) / (len(rows) * sum(None in rows[i] for i in low))
    assert 0 < share < 0.35, share


def test_rows_that_share_no_column_with_a_donor_get_the_mean(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 2.0), (3, None, 4.0)], "id int, a double, b double")
    out = KnnFill(inputCols=["a", "b"], k=2).fit(df).transform(df)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.0, 3.0), (2, 1.0, 2.0), (3, 1.0, 4.0)]
