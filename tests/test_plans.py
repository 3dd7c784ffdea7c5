"""Plans, reports, sources, storage and streams."""

import pytest
from conftest import column
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.operators import profile, stats, validate
from sparkprep.operators.encode import FrequencyCoder, OrdinalCoder, RareGrouper
from sparkprep.operators.impute import RemainingFill
from sparkprep.operators.knn import KnnFill
from sparkprep.operators.shuffle import permuted_column
from sparkprep.operators.split import split_stratified, stratified_folds, undersample
from sparkprep.plans import numeric, preprocessors, roles
from sparkprep.plans.selection import run_selection
from sparkprep.session import scratch_path, shared_dir
from sparkprep.sources import tables
from sparkprep.streaming.apply import write_transformed


def _survey(spark, n=60, start=0):
    rows = [
        (
            start + i,
            i % 5 + 1 if i % 7 else None,
            i % 4 if i % 5 else None,
            1 + i % 3,
            f"{i * 137 % 10000:04d}" if i % 11 else None,
            "x" if i % 3 else None,
            "admin",
            float(i) if i % 10 else None,
            float(i * 100_000) if i % 2 else None,
            None,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "CNTSTUID int, PA003 int, ST300 int, ST005 int, OCOD1 string, LANGTEST_COG string, CYC string, AGE double, "
        "math_q1_total_timing double, math_q1_average_score double",
    )


def test_default_roles():
    names = roles.numeric_names()
    assert len(names) == 135 and len(set(names)) == 135
    assert names[25] == "reading_q1_average_score" and names[-1] == "science_q19_total_timing"
    r = roles.VariableRoles()
    assert (len(r.ordinal), len(r.categorical), len(r.grouping)) == (14, 20, 6)
    assert roles.VariableRoles.from_json(r.to_json()) == r


def test_roles_from_sheet(table):
    sheet = table("o string, n string", ("ST1", "AGE"), (" ST2 ", None), (None, ""))
    r = roles.VariableRoles.from_df(sheet, {"ordinal": "o", "numeric": "n"})
    assert r.ordinal == ["ST1", "ST2"] and r.numeric == ["AGE"] and r.categorical == []


def test_stage1_columns_of_train_and_test(spark):
    train, test = _survey(spark), _survey(spark, 10, 1000)
    r = roles.VariableRoles(
        numeric=["AGE", "math_q1_total_timing", "math_q1_average_score"], grouping=["CNTSTUID", "CYC"], ordinal=[], categorical=[]
    )
    a, b = numeric.stage1(train, test, r, text_codes=["CYC"])
    assert a.columns == b.columns == ["PA003", "ST300", "ST005", "OCOD1", "LANGTEST_COG", "AGE", "math_q1_total_timing", "CNTSTUID"]
    assert a.schema == b.schema
    assert stats.missing_total(b, ["AGE", "math_q1_total_timing"]).first().missing_cells == 0
    # AGE is 10 % missing: flag, not median
    assert column(b, "AGE", "CNTSTUID")[0] == -1.0


def test_preprocessors_state_and_storage(spark):
    df = _survey(spark)
    wanted = ["PA003", "ST300", "ST005"]
    step = preprocessors.OrdinalPreprocessor(inputCols=wanted)
    model = step.fit(df)
    assert wanted == ["PA003", "ST300", "ST005"]  # the caller's list is not touched
    assert model.variables_to_drop == ["ST005"]
    assert model.composite_scores == {"Score_Support_Parental": ["PA003", "ST300"]}
    assert model.ordinal_vars == ["Score_Support_Parental"]
    out = model.transform(df)
    assert not {"PA003", "ST300", "ST005"} & set(out.columns)
    assert stats.null_rates(out)["Score_Support_Parental"] == 0
    assert stats.null_rates(model.shape(df))["Score_Support_Parental"] > 0
    path = scratch_path(spark, "prep")
    model.save(path)
    again = preprocessors.OrdinalPreprocessorModel.load(path)
    assert again.transform(df).collect() == out.collect()
    assert df.columns[1] == "PA003"


def test_categorical_preprocessor(spark):
    df = _survey(spark)
    model = preprocessors.CategoricalPreprocessor(inputCols=["CYC", "LANGTEST_COG", "OCOD1"]).fit(df)
    assert model.variables_to_drop == ["CYC"]
    assert model.isco_mapping == {"OCOD1": "OCOD1_grouped"}
    assert model.categorical_vars == ["LANGTEST_COG", "OCOD1_grouped"]
    assert model.mode_values["LANGTEST_COG"] == "x"
    out = model.transform(df)
    assert dict(out.dtypes)["OCOD1_grouped"] == "bigint"
    assert stats.null_rates(out, ["LANGTEST_COG", "OCOD1_grouped"]) == {"LANGTEST_COG": 0, "OCOD1_grouped": 0}
    lone = df.where("CNTSTUID = 0")
    assert model.transform(lone).first().LANGTEST_COG == "x"


def test_stage2_report_and_audit(spark):
    df = _survey(spark)
    ordinal = preprocessors.OrdinalPreprocessor(inputCols=roles.ORDINAL)
    categorical = preprocessors.CategoricalPreprocessor(inputCols=roles.CATEGORICAL)
    model = preprocessors.Stage2(ordinal, categorical).fit(df)
    out = model.transform(df)
    assert out.columns == ["CNTSTUID", "LANGTEST_COG", "AGE", "math_q1_total_timing", "Score_Support_Parental", "OCOD1_grouped"]
    result = validate.report_values(validate.validate_preparation(df, out, "AGE", ["CNTSTUID"]))
    assert result["stats", "missing_values"] == "0" and result["result", "validation_passed"] == "false"  # AGE was filled
    assert result["stats", "target_changed_rows"] == "6" and result["errors", "target_unchanged"] == "target AGE was changed"
    report = validate.report_values(validate.preparation_report(df, out, model.ordinal, model.categorical))
    assert report["preprocessing_summary", "n_samples"] == "60"
    assert report["feature_changes", "features_added"] == "OCOD1_grouped, Score_Support_Parental"
    path = scratch_path(spark, "stage2")
    model.save(path)
    again = preprocessors.Stage2Model.load(path).transform(df)
    assert sorted(again.collect()) == sorted(out.collect())
    test = _survey(spark, 12, 500)
    assert model.transform(test).schema == out.schema
    assert "math_q1_average_score" in model.transform_refit(test).columns


def test_validation_finds_both_faults(table):
    before = table("id int, y double, x int", (1, 1.0, 1), (2, None, 2), (3, 3.0, 3))
    after = table("id int, y double, x int", (1, 1.0, 1), (2, None, None), (3, 4.0, 3))
    r = validate.report_values(validate.validate_preparation(before, after, "y", ["id"]))
    assert sum(section == "errors" for section, _ in r) == 2 and r["stats", "target_changed_rows"] == "1"
    assert r["result", "validation_passed"] == "false"
    same = validate.report_values(validate.validate_preparation(before, before.drop("x"), "y", ["id"]))
    assert same["stats", "target_unchanged"] == "true" and same["checks", "fewer_columns"] == "true"
    assert ("warnings", "all_numeric") not in same
    no_target = validate.report_values(validate.validate_preparation(before, before.drop("y"), "y", ["id"]))
    assert ("stats", "target_changed_rows") not in no_target
    assert validate.changed_rows(before, before.where("id < 3"), "y", ["id"]) == 1


def test_profile_example(table):
    df = table("c string", *[(v,) for v in ["a"] * 6 + ["b"] * 2 + [None] * 2])
    row = profile.profile_categorical(df, ["c", "unknown"]).collect()
    assert len(row) == 1
    assert (row[0].cardinality, row[0].missing_pct, row[0].imbalance_ratio, row[0].cardinality_type) == (3, 20.0, 3.0, "faible")


def test_csv_modes(spark):
    df = spark.createDataFrame([(1, "2.5"), (2, "bad"), (3, None)], "id int, x string")
    path = scratch_path(spark, "csv")
    tables.write_csv(df, path)
    lenient = tables.read_csv(spark, path, {"id": "int", "x": "double"})
    assert column(lenient, "x") == [2.5, None, None]
    with pytest.raises(Exception):
        tables.read_csv(spark, path, {"id": "int", "x": "double"}, strict=True).collect()
    assert tables.header_schema(spark, path, {"x": "double"}).simpleString() == "struct<id:string,x:double>"


def test_runs_and_artefacts(spark):
    root = scratch_path(spark, "runs")
    with pytest.raises(Exception):
        tables.read_latest_run(spark, root)
    tables.write_run(spark.range(2), root, "20240101_000000")
    tables.write_run(spark.range(5), root, "20240301_000000")
    assert tables.run_timestamps(spark, root) == ["20240101_000000", "20240301_000000"]
    assert tables.read_latest_run(spark, root).count() == 5
    path = scratch_path(spark, "json")
    tables.write_artefact(spark, path, {"a": [1, 2], "b": {"c": "d"}})
    assert tables.read_artefact(spark, path) == {"a": [1, 2], "b": {"c": "d"}}


def test_attach_target(table):
    x = table("id int, a int", (1, 1), (2, 2))
    y = table("id int, value double", (1, 10.0), (2, 20.0))
    assert column(tables.attach_target(x, y, "score", ["id"]), "score") == [10.0, 20.0]
    inline = table("id int, score int", (1, 7))
    assert tables.attach_target(inline, None, "score", ["id"]) is inline
    for bad in (y.where("id = 1"), y.union(y), y.union(table("id int, value double", (3, 0.0)))):
        with pytest.raises(ValueError, match="one to one"):
            tables.attach_target(x, bad, "score", ["id"])
    with pytest.raises(ValueError, match="no companion"):
        tables.attach_target(x, None, "score", ["id"])


def test_selection_job(spark):
    from test_split_select import _planted

    result = run_selection(_planted(spark), ["a", "b", "n1", "n2", "n3"], "y", ["id"], n_features=2, folds=2, trees=[5], depths=[5])
    assert set(result.selected) == {"a", "b"}
    assert result.report["n_features_original"] == 5 and result.report["best_rf_params"]["max_depth"] == 5
    assert result.data.columns == ["id", *result.selected, "y", "split"] and result.data.count() == 600
    frame = tables.selection_frame(spark, result.report, "20240101_000000").first()
    assert frame.selected_features == result.selected


def test_stream_equals_batch(spark):
    df = _survey(spark).select("CNTSTUID", "AGE", "math_q1_total_timing", "math_q1_average_score")
    model = numeric.NumericCleaner(inputCols=df.columns[1:]).fit(df)
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    df.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    write_transformed(model, stream, out, scratch_path(spark, "state")).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == sorted(model.transform(df).collect())


def test_pipeline_model_is_one_projection(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_totalprice", F.lit(None).cast("double").alias("x_score"))
    model = numeric.NumericCleaner(inputCols=["o_totalprice", "x_score"]).fit(df)
    assert isinstance(model, PipelineModel)
    plan = model.transform(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1 and "Join" not in plan


def test_shared_dir_follows_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_remaining_fill_is_idempotent(spark):
    df = _survey(spark)
    once = RemainingFill().fit(df).transform(df)
    twice = RemainingFill().fit(once).transform(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_unfinished_runs_are_passed_over(spark, tmp_path):
    root = str(tmp_path / "runs")
    tables.write_run(spark.range(3), root, "20240101_000000")
    # a writer that died: data without a manifest, one that left only its scratch folder, and one that lost a file
    spark.range(9).write.parquet(f"{root}/run_ts=20240102_000000")
    (tmp_path / "runs" / "run_ts=20240103_000000" / "_temporary").mkdir(parents=True)
    tables.write_run(spark.range(4).repartition(2), root, "20240104_000000")
    next((tmp_path / "runs" / "run_ts=20240104_000000").glob("part-*.parquet")).unlink()
    assert tables.read_latest_run(spark, root).count() == 3
    assert len(tables.run_timestamps(spark, root)) == 4
    with pytest.raises(FileNotFoundError):
        (tmp_path / "runs" / "run_ts=20240101_000000" / tables.MANIFEST).unlink()
        tables.read_latest_run(spark, root)


def test_lenient_csv_reads_swapped_headers_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n10,x\n")
    (tmp_path / "2.csv").write_text('b,a,"c,d"\ny,20,z\n')
    (tmp_path / "3.csv").write_text("")
    got = tables.read_csv(spark, str(tmp_path), {"a": "int"})
    assert got.columns == ["a", "b", "c,d"]
    assert {tuple(r) for r in got.collect()} == {(10, "x", None), (20, "y", "z")}
    given = tables.read_csv(spark, str(tmp_path), T.StructType.fromDDL("b string, a int"))
    assert {tuple(r) for r in given.collect()} == {("x", 10), ("y", 20)}


def test_columns_named_like_internal_ones_come_back(spark):
    names = "_profile _v0 _class _key _row _id _block _partner _key0 _value0 _bin _cut _place _rows _need _ranges".split()
    rows = [(i, float(i) if i % 5 else None, f"l{i % 90}", "xy"[i % 2], *[f"{n}{i}" for n in names]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x double, level string, side string, " + ", ".join(f"{n} string" for n in names))
    want = {r[0]: r[4:] for r in rows}
    outs = [
        KnnFill(inputCols=["x"]).fit(df).transform(df),
        undersample(df, "side", ["id"]),
        permuted_column(df, "x", ["id"], 3),
        split_stratified(df, "x", ["id"]).select(*df.columns),
        stratified_folds(df, "x", ["id"]).select(*df.columns),
        *[c(inputCols=["level"]).fit(df).transform(df) for c in (OrdinalCoder, FrequencyCoder, RareGrouper)],
    ]
    for out in outs:
        got = {r.id: tuple(r[n] for n in names) for r in out.collect()}
        assert got and all(want[i] == v for i, v in got.items())


def test_equal_tables_are_known_without_an_exchange_of_rows(spark):
    rows = [(i, None if i % 3 else float(i)) for i in range(50)] + [(None, 5.0), (7, None)]
    df = spark.createDataFrame(rows, "id long, y double")
    print_of = lambda t: validate.fingerprint(t, ["id", "y"]).first()
    assert print_of(df) == print_of(df.repartition(7).orderBy("y"))
    swapped = spark.createDataFrame([(5, None)], "id long, y double"), spark.createDataFrame([(None, 5.0)], "id long, y double")
    assert print_of(swapped[0]) != print_of(swapped[1])
    assert print_of(df) != print_of(df.unionByName(df.limit(1))) and print_of(df.where("false")).n == 0
    plan = validate.fingerprint(df, ["id", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert validate.changed_rows(df.dropna(subset=["id"]), df.dropna(subset=["id"]), "y", ["id"]) == 0
    assert validate.changed_rows(df.where("id < 50"), df.where("id < 50").selectExpr("id", "IF(id = 9, 1.0D, y) AS y"), "y", ["id"]) == 1
