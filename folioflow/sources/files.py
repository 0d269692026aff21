"""Uploads and extraction manifests as tables."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.text import last_part


LISTED = "at STRING, length BIGINT, modified TIMESTAMP, folder BOOLEAN"
LISTED_AT_ONCE = 10_000
CONTENT_BYTES = 8_000_000


def hidden(name: str) -> bool:
    """Whether Spark's readers pass a name over."""
    marked = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return marked and not name.startswith(("_common_metadata", "_metadata"))


def opened(base: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a whole path such as Spark writes them, and the path there."""
    scheme, _, path = base.partition(":")
    return pyarrow.fs.FileSystem.from_uri(path if scheme == "file" else base)


def listing(base: str, whole: bool):
    """Lists the folders among rows of LISTED, with all below if ``whole``, else one level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("at", pa.string()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("folder", pa.bool_())])
        system, root = opened(base)
        for batch in batches:
            yield batch.filter(pc.invert(batch.column("folder"))).cast(schema)
            folders = batch.filter(batch.column("folder")).column("at").to_pylist()
            while folders:
                at = folders.pop()
                found = []
                for info in system.get_file_info(pyarrow.fs.FileSelector(root + at, allow_not_found=True)):
                    if hidden(info.base_name):
                        continue
                    below = info.type == pyarrow.fs.FileType.Directory
                    if below and whole:
                        folders.append(f"{at}/{info.base_name}")
                    else:
                        # Whole milliseconds, as Spark's own listing has them.
                        found.append((f"{at}/{info.base_name}", info.size, None if below else info.mtime_ns // 1_000_000 * 1_000, below))
                for start in range(0, len(found), LISTED_AT_ONCE):
                    at_, size, time, below = zip(*found[start : start + LISTED_AT_ONCE])
                    times = pa.array(time, pa.int64()).cast(schema.field("modified").type)
                    yield pa.RecordBatch.from_arrays([pa.array(at_), pa.array(size, pa.int64()), times, pa.array(below)], schema=schema)

    return run


def contents(base: str):
    """The contents of files, as a function of their places below ``base``."""

    @F.arrow_udf("binary")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        system, root = opened(base)
        for places in batches:
            held, size = [], 0
            for at in places.to_pylist():
                with system.open_input_stream(root + at, compression=None) as file:
                    held.append(file.read())
                size += len(held[-1])
                if size > CONTENT_BYTES:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            yield pa.array(held, pa.binary())

    return read


def read_files(spark: SparkSession, path: str, stream: bool = False, recursive: bool = True) -> DataFrame:
    """(path, filename, size, modified, content) of every file, of any type and not empty.

    Names and sizes come from listing, so a plan that does not use ``content``
    never opens a file. As a stream, files come once, when they are there. Spark
    plans no work for empty files, so they give no row.

    Tasks list the folders, one task each of the first level with all below it, so the
    driver holds no names; and a stream keeps the names it has seen in its state. One
    folder is one task's list. Paths that pyarrow cannot open, patterns, single files and
    folders without those below go to Spark's reader, whose list is the driver's.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = system.makeQualified(hadoop).toString()
    try:
        known = opened(base)[0].get_file_info(opened(base)[1]).type == pyarrow.fs.FileType.Directory
    except (pa.ArrowException, OSError):
        known = False
    if not (known and recursive) or any(c in path for c in "*?[{"):
        return _listed_by_driver(spark, path, stream, recursive)
    root = F.lit("").alias("at"), F.lit(0).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified"), F.lit(True).alias("folder")
    if stream:  # a row for each batch, and so a listing
        start = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    else:
        start = spark.range(0, 1, 1, 1)
    found = start.select(*root).mapInArrow(listing(base, False), LISTED).repartition("at").mapInArrow(listing(base, True), LISTED)
    found = found.dropDuplicates(["at"]) if stream else found.repartition("at")
    path_ = F.concat(F.lit(base), "at")
    return found.filter(F.col("length") > 0).select(
        path_.alias("path"), last_part(path_).alias("filename"), F.col("length").alias("size"), "modified", contents(base)("at").alias("content")
    )


def _listed_by_driver(spark: SparkSession, path: str, stream: bool, recursive: bool) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).format("binaryFile")
    if stream:
        reader = reader.schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    return (
        reader.option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select(
            "path",
            last_part(F.col("path")).alias("filename"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
            "content",
        )
    )


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """(path) of files written under ``folder`` from (filename, content).

    A file is written beside its place and then moved there, so a reader, or a stream
    that lists the folder, sees it whole; a task that runs again writes the same file
    over it. NULL content is an empty file. Files lie in subfolders by their names' hash,
    so that no folder gets a long list.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        drafts = f"{root}/_drafts"
        system.create_dir(drafts, recursive=True)
        there: set[str] = set()
        for batch in batches:
            paths = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                draft = f"{drafts}/{uuid.uuid4().hex}"
                with system.open_output_stream(draft, compression=None) as out:
                    out.write(content.as_buffer() or b"")
                place = f"{root}/{zlib.crc32(name.encode()) & 255:02x}"
                if place not in there:
                    system.create_dir(place, recursive=True)
                    there.add(place)
                system.move(draft, f"{place}/{name}")
                paths.append(f"{place}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return files.select("filename", F.col("content").cast("binary")).mapInArrow(write, "path STRING")


def manifest_segments(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, errors) from (job_id, manifest_json).

    Segments keep the order of the manifest in (asset_no, segment_no); empty
    paths are skipped. A job without any path is an error.
    """
    parsed = manifests.withColumn("_m", F.from_json("manifest_json", schemas.MANIFEST))
    carried = [c for c in manifests.columns if c != "manifest_json"]
    paths = F.flatten(
        F.transform(
            F.col("_m.output_metadata"),
            lambda asset, a: F.transform(
                asset["segment_metadata"],
                lambda segment, s: F.struct(
                    a.alias("asset_no"),
                    s.alias("segment_no"),
                    segment["standard_output_path"].alias("result_path"),
                ),
            ),
        )
    )
    # An asset without segments is NULL inside the list, and would make all of
    # it NULL when flattened; such assets are taken out first.
    listed = parsed.withColumn(
        "_m",
        F.col("_m").withField(
            "output_metadata",
            F.filter(
                F.coalesce(F.col("_m.output_metadata"), F.expr("array()")),
                lambda asset: asset["segment_metadata"].isNotNull(),
            ),
        ),
    ).withColumn(
        "_paths",
        F.filter(paths, lambda p: F.coalesce(p["result_path"], F.lit("")) != ""),
    )
    segments = (
        listed.select(*carried, F.col("_m.semantic_modality").alias("semantic_modality"), F.explode_outer("_paths").alias("p"))
        .filter(F.col("p").isNotNull())
        .select(*carried, "semantic_modality", "p.asset_no", "p.segment_no", "p.result_path")
    )
    errors = listed.filter(F.coalesce(F.size("_paths"), F.lit(0)) <= 0).select(
        *carried, F.lit("no output segments for this file").alias("reason")
    )
    return segments, errors
