"""Document folders as DataFrames."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions.text import basename

ANY_AGE = "36500d"
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# Files in pieces: ``piece`` grows along the file.
PIECE_SCHEMA = "path string, modificationTime timestamp, length long, piece long, content binary"
# A writer looks at the size of its row group after 100 rows, and a reader may hold a row group
# twice: pieces are small, and so are the row groups.
PIECE_BYTES = 1 << 17
PIECE_OPTIONS = {"parquet.block.size": 1 << 24}

# Paths are taken as they are, not as patterns.
AS_GIVEN = {"__globPaths__": "false"}
MARK = b"\xef\xbb\xbf"


def scan_documents(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """One row per file with its bytes. The glob prunes files before any is opened."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def list_documents(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Directory listing; leaving ``content`` out means no file is read."""
    return scan_documents(spark, folder, glob).select(
        "path", basename(F.col("path")).alias("name"), "length", "modificationTime"
    )


def folder_is_empty(spark: SparkSession, folder: str) -> bool:
    """True for an empty or missing folder. Any other error is raised."""
    try:
        return list_documents(spark, folder).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return True
        raise


def exclude_by_name(df: DataFrame, name: Column, part: str) -> DataFrame:
    """Rows whose name does not contain ``part``."""
    return df.where(~name.contains(part))


def stream_documents(
    spark: SparkSession, folder: str, glob: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """The folder as a stream: each file is delivered once per checkpoint, whatever its date.

    Spark passes over files a week older than the newest unless told otherwise; copies and
    archives keep old dates.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def file_pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The bytes of ``files`` (path, modificationTime, length), in rows of bounded size.

    Files of up to ``piece_bytes`` are one row. A longer one is read by one task, in order and
    never held as a whole, and gives several rows. The driver holds the names, so ``files``
    are to be a bounded batch. A file whose name is one character is always one row.
    """
    spark = files.sparkSession
    listed = files.select("path", "modificationTime", "length").toArrow()
    whole, long = [], {}
    for path, length in zip(*(listed.column(c).to_pylist() for c in ("path", "length")), strict=True):
        name = path.rpartition("/")[2]
        if length <= piece_bytes or len(name) < 2:
            whole.append(path)
        else:
            suffix = name[name.rindex(".") :] if "." in name else name[-1]
            long.setdefault(suffix, {})[path] = length
    found = []
    if whole:
        rows = spark.read.format("binaryFile").options(**AS_GIVEN).load(whole)
        found.append(rows.select("path", F.lit(0).cast("long").alias("piece"), "content"))
    found += [_cut_files(spark, lengths, suffix, piece_bytes) for suffix, lengths in long.items()]
    if not found:
        return spark.createDataFrame([], PIECE_SCHEMA)
    known = spark.createDataFrame(listed)
    rows = reduce(DataFrame.unionAll, found).join(F.broadcast(known), "path")
    return rows.select("path", "modificationTime", "length", "piece", "content")


def _cut_files(
    spark: SparkSession, lengths: dict[str, int], suffix: str, piece_bytes: int
) -> DataFrame:
    """(path, piece, content) of files that end in ``suffix``, in the order of each file.

    The only reader of Spark that goes through a file without holding it is that of lines. It
    gives their bytes unchanged, but drops a byte order mark and does not tell whether the last
    line is ended: the length of the file does. A codec that changes nothing keeps
    the reader from unpacking the file, and from splitting it.
    """
    options = {
        "lineSep": "\n",
        "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
        "io.compress.passthrough.extension": suffix,
        # Its name where Hadoop's packages are shaded, as in Spark's own distribution.
        "org.apache.hadoop.shaded.io.compress.passthrough.extension": suffix,
    }
    lines = spark.read.format("text").options(**AS_GIVEN, **options).load(list(lengths))
    rows = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("content"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, parts, held, number, total = None, [], 0, 0, 0

        def row(piece: int, content: bytes) -> pa.RecordBatch:
            columns = [pa.array([path]), pa.array([piece]), pa.array([content], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["path", "piece", "content"])

        def ending() -> Iterator[pa.RecordBatch]:
            rest, over = b"".join(parts), total - lengths[path]
            if over in (1, -2):
                rest, over = rest[:-1], over - 1
            if over == -len(MARK):
                yield row(-1, MARK)
            elif over:
                raise ValueError(f"{path} has changed while it was read")
            if rest:
                yield row(number, rest)

        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))
            start = 0
            for stop, shown in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                if unquote(shown) != path:
                    if path is not None:
                        yield from ending()
                    path, parts, held, number, total = unquote(shown), [], 0, 0, 0
                some = _joined(batch.column(1).slice(start, stop - start))
                start = stop
                parts.append(some)
                held += len(some)
                total += len(some)
                # The last byte may be one too many, so that some are kept back.
                if held > piece_bytes:
                    whole = b"".join(parts)
                    at = 0
                    while len(whole) - at > piece_bytes:
                        yield row(number, whole[at : at + piece_bytes])
                        at, number = at + piece_bytes, number + 1
                    parts, held = [whole[at:]], len(whole) - at
        if path is not None:
            yield from ending()

    return rows.mapInArrow(cut, "path string, piece long, content binary")


def _joined(values: pa.Array) -> bytes:
    """The bytes of all values together, as they lie."""
    wide = pa.types.is_large_binary(values.type)
    offsets = pa.array([], pa.int64() if wide else pa.int32()).type
    ends = pa.Array.from_buffers(offsets, len(values) + 1, [None, values.buffers()[1]], offset=values.offset)
    return values.buffers()[2][ends[0].as_py() : ends[-1].as_py()].to_pybytes()


def piece_digests(pieces: DataFrame, *keys: str) -> DataFrame:
    """(path, length, digest): the MD5 of each file whose rows are ``pieces``.

    Files that differ in ``keys`` are told apart also if their paths are equal. The
    pieces of a file meet in one task, sorted, and pass through it one by one.
    """
    file = [*keys, "path"]
    rows = pieces.select(*file, "length", "piece", "content")
    rows = rows.repartition(*file).sortWithinPartitions(*file, "piece")
    same = F.struct(*file).cast("string")
    rows = rows.select("path", "length", F.sha2(same, 256).alias("file"), "content")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, last, state = None, (), None

        def row() -> pa.RecordBatch:
            columns = [pa.array([value]) for value in (*last, state.hexdigest())]
            return pa.RecordBatch.from_arrays(columns, ["path", "length", "digest"])

        for batch in batches:
            for path, length, key, content in zip(*batch.columns, strict=True):
                if key.as_py() != file:
                    if state is not None:
                        yield row()
                    file, last, state = key.as_py(), (path.as_py(), length.as_py()), hashlib.md5()
                state.update(content.as_buffer())
        if state is not None:
            yield row()

    return rows.mapInArrow(digest, "path string, length long, digest string")


def page_images(df: DataFrame, path: Column, pattern: str = r"page_(\d+)") -> DataFrame:
    """Map page number to image location, read off the image paths."""
    number = F.regexp_extract(path, pattern, 1)
    return df.where(number != "").select(
        number.try_cast("int").alias("pdf_page"), path.alias("page_image_loc")
    )
