"""Sinks: JSON lines, parquet, Arrow files, reports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tablewright.session import durable, reachable

COMPRESSIONS = {None: "uncompressed", "none": "uncompressed", "snappy": "snappy", "gzip": "gzip", "lz4": "lz4_raw", "zstd": "zstd"}


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).option("ignoreNullFields", False).json(path)


def write_parquet(
    df: DataFrame, path: str, compression: str | None = "snappy", mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {sorted(map(str, COMPRESSIONS))}")
    df.write.mode(mode).partitionBy(*partition_by).option("compression", COMPRESSIONS[compression]).parquet(path)


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str
    rows: int


class ArrowFileWriter(DataSourceArrowWriter):
    """Each task writes one IPC file under a temporary name; commit renames them all."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.overwrite, self.token = path, overwrite, uuid.uuid4().hex
        self.schema = schema

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, base = self._open()
        fs.create_dir(base, recursive=True)
        name, rows, writer = f"part-{self.token}-{uuid.uuid4().hex}.arrow", 0, None
        with fs.open_output_stream(f"{base}/.{name}.tmp") as sink:
            for batch in iterator:
                if writer is None:
                    writer = pa.ipc.new_file(sink, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer is None:
                writer = pa.ipc.new_file(sink, to_arrow_schema(self.schema))
            writer.close()
        return WrittenFile(name, rows)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        fs, base = self._open()
        from pyarrow.fs import FileSelector

        old = [
            f.path for f in fs.get_file_info(FileSelector(base, allow_not_found=True))
            if f.base_name.endswith(".arrow") and not f.base_name.startswith(".")
        ] if self.overwrite else []
        for m in messages:
            if m is not None and (m.rows or not any(x and x.rows for x in messages)):
                fs.move(f"{base}/.{m.name}.tmp", f"{base}/{m.name}")
            elif m is not None:
                fs.delete_file(f"{base}/.{m.name}.tmp")
        for path in old:
            fs.delete_file(path)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        fs, base = self._open()
        for m in messages:
            if m is not None:
                fs.delete_file(f"{base}/.{m.name}.tmp")


class ArrowFiles(DataSource):
    """``df.write.format("arrowfiles").mode(...).save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "arrowfiles"

    def writer(self, schema: StructType, overwrite: bool) -> ArrowFileWriter:
        return ArrowFileWriter(self.options["path"], schema, overwrite)


def write_arrow(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One Arrow file from each task, under its final name once all have ended. Tasks open the path
    themselves, so it must be one that all executors reach."""
    path = reachable(df.sparkSession, path)
    df.sparkSession.dataSource.register(ArrowFiles)
    df.write.format("arrowfiles").mode(mode).save(path)


FORMATS = {"jsonl": write_jsonl, "parquet": write_parquet, "arrow": write_arrow}


def export(df: DataFrame, path: str, formats: Sequence[str]) -> list[str]:
    """Write every known format below ``path``; returns the names not known."""
    unknown = [f for f in formats if f not in FORMATS]
    if len(formats) - len(unknown) > 1:
        df = durable(df)  # each format reads it again
    for f in formats:
        if f in FORMATS:
            FORMATS[f](df, f"{path.rstrip('/')}/{f}")
    return unknown


def export_splits(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A folder per dataset and split, for later partition pruning."""
    by = [c for c in ("dataset", "split") if c in df.columns]
    if fmt == "parquet":
        write_parquet(df, path, partition_by=by)
    elif fmt == "jsonl":
        write_jsonl(df, path, partition_by=by)
    else:
        raise ValueError(f"Unknown format: {fmt}")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small document as one text file in a folder."""
    spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(path)


def write_stats_json(profile: DataFrame, path: str) -> None:
    """A profile in long form as one JSON document: section, column, stat.

    A profile has a few rows per column of the profiled table.
    """
    stats = F.map_from_entries(F.array_sort(F.collect_list(F.struct("stat", "value")))).alias("stats")
    columns = profile.groupBy("section", "column").agg(stats)
    sections = columns.groupBy("section").agg(
        F.collect_list(F.struct("column", "stats")).alias("columns")
    )
    document = sections.groupBy().agg(F.collect_list(F.struct("section", "columns")).alias("sections"))
    document.select(F.to_json(F.struct("sections")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_report_csv(summary: DataFrame, path: str) -> None:
    summary.select("model", "dataset", "metric", "value").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report_json(summary: DataFrame, path: str) -> None:
    """A JSON document per model and dataset."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("metrics")
    summary.groupBy("model", "dataset").agg(entries).coalesce(1).write.mode("overwrite").json(path)


def write_report_markdown(spark: SparkSession, text: str, path: str) -> None:
    write_text(spark, text, path)

