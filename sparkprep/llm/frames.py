"""Small DataFrame helpers of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkprep.functions.scalar import col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column, null as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def comma_joined(c: Column) -> Column:
    """A sorted array of numbers as text."""
    return F.array_join(F.transform(F.array_sort(c), lambda x: x.cast("string")), ",")


def map_texts(df: DataFrame, keep: list[str], texts: list[str], fn, fields: str, size: int = 2_000_000) -> DataFrame:
    """Row by row over texts in Arrow batches: ``fn(*lists)`` gives one list or array for each new column.

    ``keep`` columns pass through untouched (nulls and large numbers included).  A batch is cut so that ``fn`` sees at
    most ``size`` characters at once, or a single longer text.
    """
    kept = df.select(*keep, *texts)
    schema = T.StructType([*df.select(*keep).schema.fields, *T.StructType.fromDDL(fields).fields])

    def run(batches):
        import pyarrow as pa

        target = to_arrow_schema(schema)
        for batch in batches:
            values = [batch.column(batch.schema.get_field_index(t)).to_pylist() for t in texts]
            lengths = [sum(map(len, row)) for row in zip(*values, strict=True)]
            at = 0
            while at < len(lengths):
                end, total = at + 1, lengths[at]
                while end < len(lengths) and total + lengths[end] <= size:
                    total += lengths[end]
                    end += 1
                new = fn(*[v[at:end] for v in values])
                old = [batch.column(batch.schema.get_field_index(k)).slice(at, end - at) for k in keep]
                arrays = [a.cast(f.type) for a, f in zip(old, target, strict=False)]
                arrays += [pa.array(v, type=f.type) for v, f in zip(new, list(target)[len(keep) :], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
                at = end

    return kept.mapInArrow(run, schema)


def fold_texts(df: DataFrame, inputs: list[str], start, step, finish, schema: str) -> DataFrame:
    """One result for each task: ``state = start()``, ``step(state, *lists)`` for each batch, ``finish(state)`` gives columns."""
    target = T.StructType.fromDDL(schema)

    def run(batches):
        import pyarrow as pa

        state, rows = None, 0
        for batch in batches:
            if batch.num_rows:
                state = start() if state is None else state
                rows += batch.num_rows
                # small slices: a batch of long texts is never unpacked as a whole
                for at in range(0, batch.num_rows, 256):
                    step(state, *[batch.column(batch.schema.get_field_index(c)).slice(at, 256).to_pylist() for c in inputs])
        if rows:
            fields = to_arrow_schema(target)
            columns = finish(state)
            for at in range(0, len(columns[0]), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 10_000], type=f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return df.select(*inputs).mapInArrow(run, target)
