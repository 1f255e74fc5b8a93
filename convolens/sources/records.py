"""Record sources and sinks: JSON lines from files, folders and ZIP archives; Parquet and JSON out; SQL over marts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.util import inheritable_thread_target

#: Tables written at the same time.
WRITERS = 4

LINES = "source_path string, line_number long, value string"


def read_jsonl(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """(source_path, line_number, value) of the non-blank lines under ``path``: a file, or a folder at any depth.

    Large files are split.  Line numbers, blank lines counted, take a pass of their own that counts the lines of each split; without
    them (null) the lines are read once."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").option("lineSep", "\n").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block"), F.rtrim("value", F.lit("\r")).alias("value"))
    if not numbered:
        return rows.where(F.trim("value") != "").select("source_path", F.lit(None).cast("long").alias("line_number"), "value")
    placed = rows.mapInArrow(_placed, "source_path string, block long, place long, value string")
    ends = rows.groupBy("source_path", "block").agg(F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ends.select("source_path", "block", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.where(F.trim("value") != "").join(offsets, ["source_path", "block"]).select("source_path", (F.col("before") + F.col("place")).alias("line_number"), "value")


def _placed(batches: Iterator) -> Iterator:
    """Lines numbered from 1 within their split; a task reads each of its splits from its start in order."""
    import pyarrow as pa

    last, n = None, 0
    for batch in batches:
        places = []
        for split in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = n + 1 if split == last else 1
            last = split
            places.append(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.int64()), batch.column(2)], names=["source_path", "block", "place", "value"])


def _numbered(name: str, data: bytes, encoding: str = "utf-8") -> Iterator[tuple[str, int, str]]:
    for k, line in enumerate(data.decode(encoding).split("\n"), 1):
        if line.strip():
            yield name, k, line.rstrip("\r")


def _batch(rows):
    import pyarrow as pa

    cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["source_path", "line_number", "value"])


def _chunks(rows: Iterator, size: int = 20_000) -> Iterator:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def read_zip(spark: SparkSession, path: str) -> DataFrame:
    """The same from the .jsonl members of ZIP archives, by name; archive clutter is skipped, non-UTF-8 is an error."""

    def unpack(batches: Iterator) -> Iterator:
        import io
        import zipfile

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(data.as_py())) as archive:
                    for member in sorted(archive.namelist()):
                        if not _wanted(member):
                            continue
                        yield from _chunks(_numbered(f"{name}!{member}", archive.read(member), "utf-8-sig"))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return files.mapInArrow(unpack, LINES)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a file, archive or folder of both."""
    if path.endswith(".zip"):
        return read_zip(spark, path)
    if path.endswith(".jsonl"):
        return read_jsonl(spark, path)
    return read_jsonl(spark, path).unionByName(read_zip(spark, path))


def _wanted(member: str) -> bool:
    base = PurePosixPath(member).name
    return base.endswith(".jsonl") and not member.startswith("__MACOSX") and not base.startswith("._")


def _members(spark: SparkSession, fs, hadoop) -> list[str]:
    """Names of an archive's .jsonl members, sorted; only headers are kept while it is read through."""
    stream = spark._jvm.java.util.zip.ZipInputStream(fs.open(hadoop))
    names = []
    try:
        while (entry := stream.getNextEntry()) is not None:
            if _wanted(entry.getName()):
                names.append(entry.getName())
    finally:
        stream.close()
    return sorted(names)


def inspect(spark: SparkSession, path: str, sample: int = 12) -> dict:
    """Kind, number of entries, the first entries by name, and warnings."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return {"kind": "missing", "entries": 0, "first": [], "warnings": [f"no such path: {path}"]}
    if fs.getFileStatus(hadoop).isFile():
        kind = "zip" if path.endswith(".zip") else "jsonl" if path.endswith(".jsonl") else "other"
        if kind == "zip":
            members = _members(spark, fs, hadoop)
            return {"kind": kind, "entries": len(members), "first": members[:sample], "warnings": [] if members else ["no .jsonl members"]}
        return {"kind": kind, "entries": 1, "first": [PurePosixPath(path).name], "warnings": [] if kind != "other" else ["not a .jsonl or .zip file"]}
    names, walk = [], fs.listFiles(hadoop, True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        if name.endswith((".jsonl", ".zip")):
            names.append(name)
    return {"kind": "directory", "entries": len(names), "first": sorted(names)[:sample], "warnings": [] if names else ["no .jsonl or .zip files"]}


def tee_lines(lines: DataFrame, path: str) -> None:
    """The raw lines as they came."""
    lines.select("value").write.mode("overwrite").text(path)


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """One folder for each table; ``fmt`` is parquet, orc or json."""
    out = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    # Several jobs at a time, so that the last tasks of one table don't leave the executors idle.
    with ThreadPoolExecutor(WRITERS) as pool:
        jobs = [pool.submit(inheritable_thread_target(df.sparkSession)(df.write.mode("overwrite").format(fmt).save), out[name]) for name, df in tables.items()]
        for job in jobs:
            job.result()
    return out


def save_snapshot(rows: DataFrame, folder: str, run: str) -> str:
    """Keep a table of one run beside those of earlier runs."""
    path = f"{folder.rstrip('/')}/{run}"
    rows.write.mode("overwrite").parquet(path)
    return path


def latest_snapshot(spark: SparkSession, folder: str, before: str | None = None) -> DataFrame | None:
    """The table of the last run in ``folder``, or of the last one before ``before``; None without one.  Run ids sort by time, and a run
    that did not finish writing doesn't count."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return None
    runs = [x.getPath() for x in fs.listStatus(hadoop) if x.isDirectory()]
    done = sorted(p.getName() for p in runs if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    done = [n for n in done if before is None or n < before]
    return spark.read.parquet(f"{folder.rstrip('/')}/{done[-1]}") if done else None


def register_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> None:
    """Views of stored tables, for spark.sql."""
    for name, path in paths.items():
        spark.read.format(fmt).load(path).createOrReplaceTempView(name)


def write_text_if_changed(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless it already holds that text; says whether it wrote."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    data = text.encode()
    if fs.exists(target) and fs.getFileStatus(target).getLen() == len(data):
        stream = fs.open(target)
        try:
            same = hashlib.sha256(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))).digest() == hashlib.sha256(data).digest()
        finally:
            stream.close()
        if same:
            return False
    out = fs.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return True


def copy_if_different(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a file unless both paths name the same one; says whether it copied."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    here, there = a.getFileSystem(conf), b.getFileSystem(conf)
    if here.makeQualified(a).equals(there.makeQualified(b)):
        return False
    return jvm.org.apache.hadoop.fs.FileUtil.copy(here, a, there, b, False, True, conf)


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both, the newest of each key; on equal times the new table's."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in {*keys, "__new"}]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, "__new")).alias("r"))
    return best.select(*keys, "r.*")
