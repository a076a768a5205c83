"""Sources: files by format, a catalog of named datasets, conversations and logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.scan import Neighbour, Running, scan
from tablewright.operators.split import head_n
from tablewright.session import reachable

RECORD = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(target))


def _per_split(spark: SparkSession, paths: str | Mapping[str, str], read) -> DataFrame:
    """One path, or a path per split; splits whose path is missing are left out."""
    if isinstance(paths, str):
        return read(paths)
    found = {s: p for s, p in paths.items() if p and path_exists(spark, p)}
    if not found:
        raise FileNotFoundError(f"none of the paths exists: {sorted(paths.values())}")
    parts = [read(p).withColumn("split", F.lit(s)) for s, p in found.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_jsonl(spark: SparkSession, paths: str | Mapping[str, str], schema: T.StructType) -> DataFrame:
    """JSON lines; a line that does not parse is kept in ``_corrupt_record``."""
    full = schema if CORRUPT in schema.names else T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return _per_split(spark, paths, reader.json)


def read_csv(
    spark: SparkSession, paths: str | Mapping[str, str], schema: T.StructType | None = None, text_column: str = "text"
) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
    if schema is not None:
        reader = reader.schema(schema)
    frame = _per_split(spark, paths, reader.csv)
    return frame.withColumnRenamed(text_column, "text") if text_column != "text" else frame


def read_parquet(spark: SparkSession, paths: str | Mapping[str, str]) -> DataFrame:
    return _per_split(spark, paths, spark.read.parquet)


def map_columns(df: DataFrame, mapping: Mapping[str, str | None]) -> DataFrame:
    """Rename ``{target: source}``; blank or missing sources are skipped."""
    renames = {src: dst for dst, src in mapping.items() if src and src in df.columns and src != dst}
    return df.withColumnsRenamed(renames)


@dataclass(frozen=True)
class Dataset:
    """A catalog entry: where a dataset is and how its columns are called."""

    name: str
    path: str | Mapping[str, str]
    fmt: str = "parquet"
    mapping: Mapping[str, str | None] = field(default_factory=dict)
    schema: T.StructType | None = None
    max_samples: int | None = None
    order: str = "row_id"
    is_eval: bool = False
    weight: float = 1.0


def read_named(spark: SparkSession, catalog: Sequence[Dataset], names: Sequence[str] | None = None) -> DataFrame:
    """The chosen datasets of a catalog as one table with a ``dataset`` column."""
    known = {d.name: d for d in catalog}
    unknown = [n for n in names or () if n not in known]
    if unknown:
        raise ValueError(f"Unknown datasets: {unknown}. Available: {sorted(known)}")
    out = None
    for d in [known[n] for n in names] if names else catalog:
        if d.fmt == "json":
            frame = read_jsonl(spark, d.path, d.schema).drop(CORRUPT)
        elif d.fmt == "csv":
            frame = read_csv(spark, d.path, d.schema)
        elif d.fmt == "parquet":
            frame = read_parquet(spark, d.path)
        else:
            raise ValueError(f"Unknown format: {d.fmt}")
        frame = map_columns(frame, d.mapping).withColumn("dataset", F.lit(d.name))
        if d.max_samples is not None:
            frame = head_n(frame, d.max_samples, "dataset", d.order)
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    if out is None:
        raise ValueError("the catalog is empty")
    return out


def catalog_table(spark: SparkSession, catalog: Sequence[Dataset]) -> DataFrame:
    rows = [(d.name, d.is_eval, float(d.weight)) for d in catalog]
    return spark.createDataFrame(rows, "dataset string, is_eval boolean, weight double")


NEAREST = 1000  # names in an error at most


def select_dataset(df: DataFrame, name: str, column: str = "dataset") -> DataFrame:
    """One dataset; an unknown name is an error that tells the number of datasets and the nearest names."""
    chosen = df.filter(F.col(column) == name)
    if chosen.select(column).isEmpty():
        names = df.select(column).distinct().filter(F.col(column).isNotNull())
        near = names.orderBy(F.levenshtein(column, F.lit(name)), column).limit(NEAREST).collect()
        raise ValueError(f"no rows of dataset {name!r}; of {names.count()} names the nearest are {sorted(r[0] for r in near)}")
    return chosen


def conversations_to_pairs(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """User turns answered by the next turn, with the system message in force as input."""
    system = F.when(F.col(role) == "system", F.struct(F.col(turn).alias("at"), F.col(text).alias("t")))
    seen = scan(
        df.select(conv, turn, role, text),
        [conv],
        [turn],
        Neighbour("_next_role", F.col(role), +1),
        Neighbour("_next_text", F.col(text), +1),
        Running("_system", "max", system, inclusive=False),
    )
    return seen.filter((F.col(role) == "user") & (F.col("_next_role") == "assistant")).select(
        F.col(conv),
        F.col(turn),
        F.col(text).alias("instruction"),
        F.coalesce(F.col("_system.t"), F.lit("")).alias("input"),
        F.col("_next_text").alias("output"),
    )


# The fields of a structured log line.
LOG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("timestamp", "level", "logger", "message", "module", "function", "service", "version")]
    + [T.StructField("line", T.LongType())]
)


def parse_log_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed fields of JSON log lines; other keys go to ``extras``, bad lines are marked."""
    fields = F.from_json(F.col(column), LOG_SCHEMA).alias("_f")
    everything = F.from_json(F.col(column), "map<string,string>")
    extras = F.map_filter(everything, lambda k, v: ~k.isin(*LOG_SCHEMA.names))
    return lines.select(
        fields, extras.alias("extras"), everything.isNull().alias("malformed")
    ).select("_f.*", "extras", "malformed")


def read_log_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_json(spark.read.text(path).filter(F.length(F.trim("value")) > 0))


def log_metrics(logs: DataFrame, step: str = "step") -> DataFrame:
    """Numeric extras of log lines as ``(timestamp, step, metric, value)`` rows."""
    return (
        logs.filter(~F.col("malformed"))
        .select(
            "timestamp",
            F.try_element_at("extras", F.lit(step)).try_cast("long").alias("step"),
            F.explode(F.map_filter("extras", lambda k, v: k != step)).alias("metric", "_v"),
        )
        .select("timestamp", "step", "metric", F.col("_v").try_cast("double").alias("value"))
        .filter(F.col("value").isNotNull())
    )


def read_arrow(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Arrow files of a folder, one task per file, batch by batch."""
    import pyarrow as pa
    from pyarrow import fs as pafs

    path = reachable(spark, path)
    uri = path if "://" in path else f"file://{path}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arrow").load(path).select("path")
    n = max(files.count(), 1)
    local = "://" not in uri or uri.startswith("file:")

    def load(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if local:
                    source, target = pafs.LocalFileSystem(), name.removeprefix("file:")
                else:
                    source, target = pafs.FileSystem.from_uri(name)
                with source.open_input_file(target) as f:
                    reader = pa.ipc.open_file(f)
                    for i in range(reader.num_record_batches):
                        yield reader.get_batch(i)

    return files.repartition(n).mapInArrow(load, schema)
