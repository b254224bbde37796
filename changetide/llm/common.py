"""What several operators share: stored intermediate results and walks over Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import changetide
from changetide.session import scratch_dir

#: Spark then removes the shuffle files of a write as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write rows to the shared scratch folder; returns them as read again, and the folder.

    Cuts the lineage: what follows needs no lost executor's data, and nothing is computed twice.
    """
    spark = rows.sparkSession
    folder = scratch_dir(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(folder), folder


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, wherever the driver imported it from."""
    if (application := spark.sparkContext.applicationId) not in _shipped:
        root = Path(changetide.__file__).parent
        # The driver hands this file out as long as the application runs.
        archive = os.path.join(tempfile.mkdtemp(prefix="changetide-"), "changetide-package.zip")
        with zipfile.ZipFile(archive, "w") as packed:
            for file in sorted(root.rglob("*.py")):
                packed.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def map_arrow(rows: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` with this package at hand in the workers."""
    ship(rows.sparkSession)
    return rows.mapInArrow(function, schema)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes in a column, so that long texts come few at a time."""
    for batch in batches:
        start = size = 0
        for row, value in enumerate(batch.column(column)):
            size += len(value.as_buffer()) if value.is_valid else 0
            if size >= most:
                yield batch.slice(start, row + 1 - start)
                start, size = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
