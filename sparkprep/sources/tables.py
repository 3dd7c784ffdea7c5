"""Tables in and out: csv with a schema, timestamped runs, targets, artefacts."""

from __future__ import annotations

import csv
import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions.scalar import col
from sparkprep.operators.joins import ids_off


def header_schema(spark: SparkSession, path: str, column_types: dict[str, str], default: str = "string") -> T.StructType:
    """Schema in file order: the header gives the names, ``column_types`` the types.

    Only the header line is read.
    """
    names = spark.read.option("header", True).csv(path).columns
    return T.StructType([T.StructField(n, T._parse_datatype_string(column_types.get(n, default))) for n in names])


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` by the names in their header; only first lines are read."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        line = spark.read.text(file).head()
        found.setdefault(tuple(next(csv.reader([line[0]]))) if line else (), []).append(file)
    return found


def read_csv(spark: SparkSession, path: str, column_types: dict[str, str] | T.StructType, strict: bool = False) -> DataFrame:
    """Csv with a header of one line.  A cell that does not fit its type is null, or an error when ``strict``.

    ``strict`` also compares the header of every file with the schema.  Otherwise files whose headers name columns in
    another order, or name others, are read by name: a column that a file lacks is null there, and columns that only
    later files have are appended.  A given schema fixes the columns; files that have none of them are read by position.
    """
    if strict:
        schema = column_types if isinstance(column_types, T.StructType) else header_schema(spark, path, column_types)
        return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    given = column_types.names if isinstance(column_types, T.StructType) else None
    types = {f.name: f.dataType.simpleString() for f in column_types} if given else column_types

    def read(where, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(where)

    def typed(names) -> T.StructType:
        return T.StructType([T.StructField(n, T._parse_datatype_string(types.get(n, "string"))) for n in names])

    headers = {h: files for h, files in _headers(spark, path).items() if h}
    if len(headers) <= 1:
        names = next(iter(headers), None)
        if given and (names is None or names == tuple(given) or not set(names) & set(given)):
            return read(path, column_types)
        if not given:
            return read(path, header_schema(spark, path, types))
    out = None
    for names, files in headers.items():
        by_name = not given or set(names) & set(given)
        part = read(files, typed(names) if by_name else column_types)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if given:
        return out.select(*[col(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in column_types])
    return out


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def run_timestamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S")


def write_run(df: DataFrame, root: str, run_ts: str | None = None, fmt: str = "parquet") -> str:
    """Write one run below ``root/run_ts=...`` and return its timestamp."""
    run_ts = run_ts or run_timestamp()
    df.write.format(fmt).option("header", True).save(f"{root}/run_ts={run_ts}")
    _finish(df.sparkSession, f"{root}/run_ts={run_ts}")
    return run_ts


#: Written last into a finished run; readers of data skip names that start so.
MANIFEST = "_manifest.json"


def _files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Data files below a folder with their sizes."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    root, found = fs.makeQualified(path).toString(), {}
    listed = fs.listFiles(path, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString()[len(root) + 1 :]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found[name] = status.getLen()
    return found


def _finish(spark: SparkSession, folder: str) -> None:
    """The manifest: names and sizes of the run's files, put in place by a rename."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    draft = path(f"{folder}/_{MANIFEST}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(_files(spark, folder)).encode()))
    out.close()
    if not fs.rename(draft, path(f"{folder}/{MANIFEST}")):
        raise OSError(f"can't finish the run {folder}")


def is_finished(spark: SparkSession, folder: str) -> bool:
    """Whether a run has its manifest and every file that it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFEST}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    stream = fs.open(path)  # Spark's readers skip its name
    named = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    there = _files(spark, folder)
    return all(there.get(name) == size for name, size in named.items())


def run_timestamps(spark: SparkSession, root: str) -> list[str]:
    """Timestamps of the runs below ``root``, finished or not, oldest first (a folder listing)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("run_ts="))


def read_latest_run(spark: SparkSession, root: str, fmt: str = "parquet", **options) -> DataFrame:
    """The finished run with the greatest timestamp; no other run is read.  Runs whose writer died are passed over."""
    for ts in reversed(run_timestamps(spark, root)):
        if is_finished(spark, f"{root}/run_ts={ts}"):
            return spark.read.format(fmt).options(header=True, **options).load(f"{root}/run_ts={ts}")
    raise FileNotFoundError(f"no finished run below {root}")


def attach_target(
    features: DataFrame, target_table: DataFrame | None, target: str, id_cols: list[str]
) -> DataFrame:
    """Features with their target; a target inline wins, else the companion is joined by id.

    Every feature row needs exactly one target row; otherwise this raises.
    """
    if target in features.columns:
        return features
    if target_table is None:
        raise ValueError(f"column {target} is absent and no companion table is given")
    named = [c for c in target_table.columns if c not in set(id_cols)]
    value = target if target in named else named[0]
    y = target_table.select(*[col(c) for c in id_cols], col(value).alias(target))
    bad = ids_off(features, y, id_cols)
    if bad:
        raise ValueError(f"features and target do not match one to one: {bad} ids differ")
    return features.join(y, id_cols, "inner")


def write_artefact(spark: SparkSession, path: str, content: dict) -> None:
    """A small report as one json object."""
    text = json.dumps(content, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def read_artefact(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r.value for r in spark.read.text(path).collect()))


def selection_frame(spark: SparkSession, report: dict, run_ts: str) -> DataFrame:
    """Selection report as a one-row table for ``write.json``."""
    lists = ["selected_features", "features_mi_only", "features_rfe_only", "intersection"]
    schema = (
        "timestamp string, n_features_original int, n_features_selected int, method string, "
        + ", ".join(f"{n} array<string>" for n in lists)
        + ", mi_scores map<string,double>, best_rf_params map<string,string>"
    )
    row = (
        run_ts,
        report["n_features_original"],
        report["n_features_selected"],
        report["method"],
        *[report[n] for n in lists],
        report["mi_scores"],
        {k: str(v) for k, v in report["best_rf_params"].items()},
    )
    return spark.createDataFrame([row], schema)


def write_splits(df: DataFrame, root: str, run_ts: str | None = None, split: str = "split") -> str:
    """The three parts of a projected table below one run, one folder per part."""
    run_ts = run_ts or run_timestamp()
    df.write.partitionBy(split).parquet(f"{root}/run_ts={run_ts}")
    _finish(df.sparkSession, f"{root}/run_ts={run_ts}")
    return run_ts
