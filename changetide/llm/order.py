"""Places and running values in ordered groups of any size, and walks over sorted partitions.

No group has to fit a task: ranges of the order are counted apart, running values are made in blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changetide.llm.common import stored

#: Rows of a group that one window sees.
BLOCK = 4096


def placed(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> tuple[DataFrame, str]:
    """Adds `place` (from 0, nulls first) and `size` within groups; returns the rows and a folder to drop later.

    The rows are sorted by ranges of (by, order) and written; a range counts its part of each group, and
    the parts before it are added. Rows equal in all of these are told apart by a running number, so that
    one repeated row does not fill a range. Names that begin with an underscore are used here.
    """
    keys = [*by, *order, "_salt"]
    ranged = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = ranged.drop("_salt").withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    numbered, folder = stored(numbered, name)
    parts = numbered.groupBy(*by, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        *(F.col(c).alias(f"_by_{c}") for c in by),
        F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
        F.sum("_n").over(group).alias("size"),
    )
    same = F.col("_part") == F.col("_of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    joined = numbered.join(bases, same).withColumn("place", F.col("_base") + F.col("_row"))
    return joined.select(*rows.columns, "place", "size"), folder


def running(rows: DataFrame, by: str, place: str, values: Sequence[str], function: str) -> DataFrame:
    """Adds, per value v, `v_before` (over the rows before this one) and `v_all` (over the whole group).

    `function` is an SQL aggregate that undoes nothing and starts at 0: `sum` or `bit_xor`. Places of a
    group are distinct. A block of places is one window; blocks are combined by their totals.
    """
    start = F.lit(0).cast("long")
    over = lambda v, w: F.coalesce(F.expr(f"{function}({v})").over(w), start)
    rows = rows.withColumn("_block", F.floor(F.col(place) / BLOCK))
    inside = Window.partitionBy(by, "_block").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    told = rows.withColumns({f"_in_{v}": over(v, inside) for v in values})
    totals = rows.groupBy(by, "_block").agg(*(F.expr(f"{function}({v})").alias(v) for v in values))
    blocks = Window.partitionBy(by)
    earlier = blocks.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col(by).alias("_by"),
        F.col("_block").alias("_of"),
        *(over(v, earlier).alias(f"_base_{v}") for v in values),
        *(over(v, blocks).alias(f"{v}_all") for v in values),
    )
    joined = told.join(bases, (F.col(by) == F.col("_by")) & (F.col("_block") == F.col("_of")))
    plus = (lambda a, b: a.bitwiseXOR(b)) if function == "bit_xor" else (lambda a, b: a + b)
    kept = [c for c in rows.columns if c != "_block"]
    return joined.select(
        *kept,
        *(plus(F.col(f"_in_{v}"), F.col(f"_base_{v}")).alias(f"{v}_before") for v in values),
        *(f"{v}_all" for v in values),
    )


def side_by_side(rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The rows of a key in one partition, next to each other and in order; a partition has many keys."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def runs(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[dict[str, list]]:
    """Columns of each run of rows with equal keys, whatever batches it lies in."""
    held: dict[str, list] | None = None
    last = None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        marks = list(zip(*(columns[k] for k in keys), strict=True))
        start = 0
        while start < len(marks):
            stop = start + 1
            while stop < len(marks) and marks[stop] == marks[start]:
                stop += 1
            piece = {n: v[start:stop] for n, v in columns.items()}
            if held is not None and marks[start] == last:
                for n, v in piece.items():
                    held[n] += v
            else:
                if held is not None:
                    yield held
                held, last = piece, marks[start]
            start = stop
    if held is not None:
        yield held


def batches_of(found: Iterable[dict[str, list]], schema: pa.Schema, most: int = 8192) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about `most` rows from column lists."""
    held: dict[str, list] = {n: [] for n in schema.names}
    for columns in found:
        for n in schema.names:
            held[n] += columns[n]
        if len(held[schema.names[0]]) >= most:
            yield pa.RecordBatch.from_pydict(held, schema=schema)
            held = {n: [] for n in schema.names}
    if held[schema.names[0]]:
        yield pa.RecordBatch.from_pydict(held, schema=schema)
