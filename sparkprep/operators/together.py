"""Which columns are missing together, for all pairs of many columns in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col

SCHEMA = "i int, j int, n bigint"


def _pair_counts(p: int):
    """Rows of a task in which columns ``i`` and ``j`` are both null; ``(-1, -1)`` counts the rows.

    The null flags of a column arrive as one bit a row, so a pair costs an eighth of a byte a row.
    """
    import numpy as np
    import pyarrow as pa

    def words(flags: pa.Array) -> np.ndarray:
        bits = np.frombuffer(flags.buffers()[1], dtype=np.uint8)
        if flags.offset:
            bits = np.packbits(np.unpackbits(bits, bitorder="little")[flags.offset :], bitorder="little")
        out = np.zeros(-(-len(flags) // 64) * 8, dtype=np.uint8)
        size = -(-len(flags) // 8)
        out[:size] = bits[:size]
        if len(flags) % 8:
            out[size - 1] &= (1 << len(flags) % 8) - 1
        return out.view(np.uint64)

    def count(batches):
        n, rows = np.zeros((p, p), dtype=np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows += batch.num_rows
            masks = np.stack([words(batch.column(i)) for i in range(p)])
            for i in range(p):
                n[i, i:] += np.bitwise_count(masks[i:] & masks[i]).sum(axis=1, dtype=np.int64)
        i, j = np.nonzero(n)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array([*i.tolist(), -1], pa.int32()),
                "j": pa.array([*j.tolist(), -1], pa.int32()),
                "n": pa.array([*n[i, j].tolist(), rows], pa.int64()),
            }
        )

    return count


def missing_together(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(var_a, var_b, n_rows, n_a, n_b, n_both, r)`` for each pair of columns, a before b.

    ``n_both`` counts the rows in which both are null, ``r`` is the correlation of the two null flags (null if one
    of them never changes).  NaN is a value.  Counts of each task are added by pair; an empty table has zero counts.
    """
    cols = cols or df.columns
    spark, p = df.sparkSession, len(cols)
    flags = df.select(*[col(c).isNull().alias(f"c{i}") for i, c in enumerate(cols)])
    counts = flags.mapInArrow(_pair_counts(p), SCHEMA).groupBy("i", "j").agg(F.sum("n").alias("n"))
    # one row for each pair of columns
    at = {(r.i, r.j): r.n for r in counts.collect()}
    rows = at.get((-1, -1), 0)
    out = []
    for i in range(p):
        for j in range(i + 1, p):
            a, b, both = at.get((i, i), 0), at.get((j, j), 0), at.get((i, j), 0)
            # whole numbers of any size: no rounding before the last step
            spread = a * (rows - a) * b * (rows - b)
            r = (rows * both - a * b) / spread**0.5 if spread else None
            out.append((cols[i], cols[j], rows, a, b, both, r))
    return spark.createDataFrame(out, "var_a string, var_b string, n_rows bigint, n_a bigint, n_b bigint, n_both bigint, r double")
