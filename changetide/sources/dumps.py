"""Dump files: compressed newline-delimited JSON, one change event per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.functions.columns import base_name
from changetide.schema import DUMP_GLOB, MAX_EVENTS_PER_SLICE

LINES_SCHEMA = "path string, line_pos struct<block:bigint,seq:bigint>, raw binary"

FILES_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Plain values: read 4 MiB of text at a time, hand lines on in batches of at most 20,000.
_CHUNK_BYTES = 4 * 1024 * 1024
_LINES_PER_BATCH = 20_000

#: Files up to this size come through Spark's reader, as one value each; larger ones are opened in the task.
WHOLE_BYTES = 256 * 1024 * 1024


def _line_reader(chunk_bytes: int = _CHUNK_BYTES, lines_per_batch: int = _LINES_PER_BATCH):
    """The function run by the Python workers: files in, lines out.

    Files without a column `content` are opened by their paths and inflated as they are read: a task
    holds a piece of the packed bytes and one of the text. All it needs is inside, so it travels by
    value and executors need no copy of this package.
    """
    import gzip
    import io
    from contextlib import closing
    from urllib.parse import quote

    import pyarrow as pa
    from pyarrow import fs

    position = pa.struct([("block", pa.int64()), ("seq", pa.int64())])

    def opened(path):
        # Spark writes paths without escapes, Arrow reads URIs.
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
        store, name = fs.FileSystem.from_uri(quote(path.replace("s3a:", "s3:", 1), safe=":/@"))
        return store.open_input_file(name)

    def lines_of(file):
        packed = bytes(file.read_at(2, 0)) == b"\x1f\x8b" if file.size() else False
        file.seek(0)
        source = pa.BufferedInputStream(file, chunk_bytes)
        stream = io.BufferedReader(gzip.GzipFile(fileobj=source)) if packed else source
        tail = b""
        while chunk := stream.read(chunk_bytes):
            *lines, tail = (tail + chunk).split(b"\n")
            yield lines
        if tail:
            yield [tail]

    def read(batches):
        for batch in batches:
            whole = "content" in batch.schema.names
            for row, path in enumerate(batch.column("path")):
                seq = 0
                # The mark of a file: also one without lines is seen.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.as_py()], pa.string()),
                        pa.StructArray.from_arrays([pa.array([0]), pa.array([-1])], fields=list(position)),
                        pa.array([None], pa.binary()),
                    ],
                    names=["path", "line_pos", "raw"],
                )
                # Only the packed bytes of a small file are held as a whole.
                file = pa.BufferReader(batch.column("content")[row].as_buffer()) if whole else opened(path.as_py())
                with closing(file):
                    for lines in lines_of(file):
                        for start in range(0, len(lines), lines_per_batch):
                            part = lines[start : start + lines_per_batch]
                            numbers = pa.array(range(seq, seq + len(part)), pa.int64())
                            blocks = pa.array([0] * len(part), pa.int64())
                            seq += len(part)
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array([path.as_py()] * len(part), pa.string()),
                                    pa.StructArray.from_arrays([blocks, numbers], fields=list(position)),
                                    pa.array(part, pa.binary()),
                                ],
                                names=["path", "line_pos", "raw"],
                            )

    return read


def unpack_dumps(files: DataFrame, marks: bool = False, by_path: bool = False) -> DataFrame:
    """`(path, content)` rows to `(path, line_pos, value)` rows, batch or streaming.

    With `marks` each file also has a row without a value. With `by_path` the column `content` is
    not looked at; tasks open the files themselves, in any store that Arrow knows.

    Spark's text reader picks the codec by file suffix and would take a closed dump for plain text,
    hence the one Python step. Files go to it in Arrow batches limited by
    `spark.sql.execution.arrow.maxBytesPerBatch`, so a task holds a few dumps at a time. One dump is
    one hour or half a million events at most.
    """
    files = files.select("path") if by_path else files.select("path", "content")
    lines = files.mapInArrow(_line_reader(), LINES_SCHEMA)
    if not marks:
        lines = lines.where(F.col("raw").isNotNull())
    return lines.select("path", "line_pos", F.col("raw").cast("string").alias("value"))


def list_dumps(spark: SparkSession, folder: str | list[str], glob: str | None = None) -> DataFrame:
    """Files of a folder, without reading them: path, file name, modification time, length."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(folder)
    return files.select("path", base_name("path").alias("filename"), "modificationTime", "length")


def read_dumps(
    spark: SparkSession, paths: str | list[str], glob: str | None = DUMP_GLOB, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """Every line of the dumps, readable or not: path, position in the file, text.

    `paths` are dump files or folders of them; `glob` keeps files still being written out of the way.
    A value in Spark has 2 GiB at most, so files above `whole_bytes` are only listed and then read piece
    by piece in the task: both filters on the length reach the scan, which opens no file they exclude.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths)
    large = unpack_dumps(files.where(F.col("length") > whole_bytes), by_path=True)
    return unpack_dumps(files.where(F.col("length") <= whole_bytes)).unionByName(large)


def read_lines(spark: SparkSession, paths: str | list[str], glob: str | None = DUMP_GLOB) -> DataFrame:
    """Every line of the dumps, by Spark's own reader where the names tell it the codec."""
    if glob and glob.endswith(".gz"):
        return read_text_dumps(spark, paths, glob)
    return read_dumps(spark, paths, glob)


def read_text_dumps(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """As `read_dumps` for plain text (split among tasks) and for names ending in `.gz`.

    Block start and row number order the lines of a file also when several tasks read it.
    """
    # Only LF ends a line, as in the packed dumps; a lone CR is white space inside JSON.
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("line_pos"),
        "value",
    )


def stream_dumps(
    spark: SparkSession, folder: str, glob: str = DUMP_GLOB, max_files: int | None = None, marks: bool = False
) -> DataFrame:
    """Lines of dumps as they turn up; the name tells closed dumps from open ones; marks: see `unpack_dumps`."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILES_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return unpack_dumps(reader.load(folder), marks)


def write_dumps(
    lines: DataFrame,
    folder: str,
    dump: str = "dump",
    order: tuple[str, ...] = (),
    max_lines: int = MAX_EVENTS_PER_SLICE,
) -> None:
    """Write `(dump, value, *order)` rows as gzip files, one folder `dump=<name>` per dump.

    Ranges of `(dump, *order)` go to the tasks, so a dump with most of the rows is written by many
    of them, and the files of a dump, by name, hold its lines in order. `max_lines` bounds a file.
    """
    (
        lines.repartitionByRange(dump, *order)
        .sortWithinPartitions(dump, *order)
        .select(dump, "value")
        .write.partitionBy(dump)
        .option("maxRecordsPerFile", max_lines)
        .option("compression", "gzip")
        .text(folder)
    )
