"""File sources: table scans, incremental file streams, schema evolution,
rescued data and the CSV trip sample format."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw trip schemas (types of the columns the pipeline touches).
RAW_SCHEMAS = {
    "yellow": ("tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
               "PULocationID BIGINT, DOLocationID BIGINT, VendorID BIGINT, passenger_count BIGINT, "
               "trip_distance DOUBLE, fare_amount DOUBLE, total_amount DOUBLE, payment_type BIGINT"),
    "green": ("lpep_pickup_datetime TIMESTAMP_NTZ, lpep_dropoff_datetime TIMESTAMP_NTZ, "
              "PULocationID BIGINT, DOLocationID BIGINT, VendorID BIGINT, passenger_count BIGINT, "
              "trip_distance DOUBLE, fare_amount DOUBLE, total_amount DOUBLE, payment_type BIGINT, "
              "trip_type BIGINT"),
    "fhv": ("pickup_datetime TIMESTAMP_NTZ, dropOff_datetime TIMESTAMP_NTZ, PUlocationID BIGINT, "
            "DOlocationID BIGINT, dispatching_base_num STRING"),
    "fhvheavy": ("pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ, PULocationID BIGINT, "
                 "DOLocationID BIGINT, hvfhs_license_num STRING, base_passenger_fare DOUBLE, "
                 "trip_miles DOUBLE, driver_pay DOUBLE, tips DOUBLE"),
}
ZONE_SCHEMA = "LocationID INT, Borough STRING, Zone STRING"

# The 9-column headered CSV sample (ISO timestamps).
SAMPLE_CSV_SCHEMA = ("tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
                     "PULocationID BIGINT, DOLocationID BIGINT, VendorID BIGINT, passenger_count BIGINT, "
                     "trip_distance DOUBLE, fare_amount DOUBLE, total_amount DOUBLE")


def schema_of(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)


def read_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental parquet file stream: each file is processed once; the
    query checkpoint records which files were seen."""
    r = spark.readStream.schema(schema_of(schema))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def read_trip_csv(spark: SparkSession, path: str, schema=SAMPLE_CSV_SCHEMA) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema_of(schema))


# --------------------------------------------------------------------------- schema evolution


def merge_schema(known, new) -> T.StructType:
    """Additive evolution: known fields keep their position and type; fields
    only in ``new`` (by case-insensitive name) are appended."""
    known, new = schema_of(known), schema_of(new)
    seen = {f.name.lower() for f in known.fields}
    return T.StructType(list(known.fields) + [f for f in new.fields if f.name.lower() not in seen])


def align(df: DataFrame, schema) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become NULL, present
    ones are cast (``try_cast``) to the declared type."""
    schema = schema_of(schema)
    lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = lower.get(f.name.lower())
        c = F.col(src).try_cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a directory whose files gained columns over time: the
    union of all file schemas, older rows NULL in newer columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def _schema_log(spark: SparkSession, location: str) -> list[tuple[int, str, T.StructType]]:
    """Entries (version, checked_at, schema) recorded at ``location``."""
    from tripflow.session import path_exists
    if not path_exists(spark, location):  # nothing recorded yet
        return []
    lines = [r.value for r in spark.read.text(location).collect()]  # one short line per check
    out = []
    for line in lines:
        version, checked_at, js = line.split("\t", 2)
        out.append((int(version), checked_at, T.StructType.fromJson(json.loads(js))))
    return sorted(out, key=lambda e: (e[0], e[1]))


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """Latest schema recorded at ``location`` (None when none yet)."""
    log = _schema_log(spark, location)
    return log[-1][2] if log else None


def evolve_stream_schema(spark: SparkSession, landing: str, location: str, initial=None) -> T.StructType:
    """Schema for the next start of a file stream over ``landing``.

    All files' footers are merged (a distributed Spark job), whatever their
    modification times, and the result is
    merged additively into the schema recorded at ``location`` (the stream's
    schema location, next to its checkpoint). Each check appends one line
    (version, time, schema); the version grows only with the schema. The
    stream is then restarted with the returned schema and the same
    checkpoint: old files read NULL in new columns, new files carry them.
    """
    log = _schema_log(spark, location)
    known = log[-1][2] if log else (schema_of(initial) if initial is not None else None)
    version = log[-1][0] if log else 0
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    empty = files.load(landing).select("path").isEmpty()
    seen = None if empty else spark.read.option("mergeSchema", True).parquet(landing).schema
    merged = known if seen is None else (merge_schema(known, seen) if known is not None else seen)
    if merged is None:
        raise ValueError(f"no schema known or inferable for {landing}")
    if log and len(merged.fields) != len(known.fields):
        version += 1
    line = f"{version}\t{now.isoformat()}\t{json.dumps(merged.jsonValue())}"
    spark.createDataFrame([(line,)], "value STRING").coalesce(1).write.mode("append").text(location)
    return merged


def union_evolving(frames: list[DataFrame]) -> DataFrame:
    """Union by name of frames with differing (additive) schemas."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --------------------------------------------------------------------------- rescued data


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _fitted(raw: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column]:
    """A raw value as ``target``, and whether it does not fit: then the first is NULL.
    Text fits if it parses, a number if nothing of it is lost; a number is no time."""
    if source == target or isinstance(target, T.StringType):
        return raw.cast(target), F.lit(False)
    known = isinstance(source, T.StringType) or any(isinstance(source, k) and isinstance(target, k) for k in (_NUMBERS, _TIMES))
    if not known:
        return F.lit(None).cast(target), raw.isNotNull()
    cast = raw.try_cast(target)
    if isinstance(source, _NUMBERS):
        # Back again through the wider of both sides: 1.5 is no BIGINT, 2^53 + 1 no DOUBLE.
        wide = "decimal(38,9)" if isinstance(source, _WHOLE) or isinstance(target, _WHOLE) else "double"
        odd = F.isnan(raw.cast("double")) | (F.abs(raw.cast("double")) == float("inf"))
        same = cast.try_cast(wide) == raw.try_cast(wide)
        if isinstance(target, (T.FloatType, T.DoubleType)) and not isinstance(source, _WHOLE):
            same = same | odd  # NaN and infinity are floating-point values like others
        cast = F.when(F.coalesce(same, F.lit(False)), cast)
    return cast, raw.isNotNull() & cast.isNull()


def rescue(df: DataFrame, schema) -> DataFrame:
    """Type a frame (text, or of types that drifted) against ``schema`` without losing values.

    A non-NULL raw value that its declared type cannot hold becomes NULL there and, like
    every column not in the schema, is kept in ``_rescued_data`` as a JSON object
    ``{column: raw text}`` (NULL when nothing was rescued).
    """
    schema = schema_of(schema)
    declared = {f.name.lower(): f for f in schema.fields}
    source = {f.name.lower(): f for f in df.schema.fields}
    typed: list[Column] = []
    bad: list[tuple[str, Column]] = []
    for f in schema.fields:
        src = source.get(f.name.lower())
        if src is None:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value, misfit = _fitted(F.col(f"`{src.name}`"), src.dataType, f.dataType)
        typed.append(value.alias(f.name))
        if src.dataType != f.dataType:
            bad.append((src.name, misfit))
    bad += [(f.name, F.col(f"`{f.name}`").isNotNull()) for f in df.schema.fields if f.name.lower() not in declared]
    if not bad:
        return df.select(*typed, F.lit(None).cast("string").alias("_rescued_data"))
    any_bad = reduce(lambda a, b: a | b, [b for _, b in bad])
    payload = F.to_json(F.struct(*[F.when(b, F.col(f"`{c}`").cast("string")).alias(c) for c, b in bad]))
    return df.select(*typed, F.when(any_bad, payload).alias("_rescued_data"))


def schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files that can be read together, with their merged schema: all of them where their
    types agree (one Spark job over the footers), else each half's groups, and so on."""
    if not files:
        return []
    try:
        return [(spark.read.option("mergeSchema", True).parquet(*files).schema, files)]
    except Exception as e:  # noqa: BLE001 - only the merge's own failure means two groups
        if len(files) == 1 or not any(x in str(e) for x in ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "Failed merging schema")):
            raise
    half = len(files) // 2
    merged: list[tuple[T.StructType, list[str]]] = []
    for schema, some in schema_groups(spark, files[:half]) + schema_groups(spark, files[half:]):
        kinds = {f.name.lower(): f.dataType for f in schema.fields}
        for i, (known, others) in enumerate(merged):
            if all(kinds.get(f.name.lower(), f.dataType) == f.dataType for f in known.fields):
                merged[i] = (merge_schema(known, schema), others + some)
                break
        else:
            merged.append((schema, some))
    return merged


def landed_files(spark: SparkSession, path: str) -> list[str]:
    """The parquet files below a folder (their names alone are read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(path).select("path"))
    return sorted(r.path for r in files.collect())


def read_landed(spark: SparkSession, files: list[str], schema) -> DataFrame:
    """Landing files whose columns may have drifted, as ``schema``, the columns that some of
    them have beyond it, and ``_rescued_data``. Each group of files of agreeing types is a
    scan of its own types, so that no value is lost to a wrong reading."""
    groups = schema_groups(spark, files)
    known = reduce(merge_schema, [g for g, _ in groups], schema_of(schema))
    frames = [rescue(spark.read.schema(g).parquet(*some), known) for g, some in groups]
    return union_evolving(frames) if frames else spark.createDataFrame([], merge_schema(known, "_rescued_data STRING"))


def stream_landed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The names of landing files, each once, as a stream: what a micro-batch is to read."""
    r = (spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
         .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("path")


def read_parquet_rescued(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet files whose column types drifted from ``schema``, without failing and without
    losing values; columns beyond ``schema`` go to ``_rescued_data`` too."""
    frames = [rescue(spark.read.schema(g).parquet(*some), schema) for g, some in schema_groups(spark, landed_files(spark, path))]
    return union_evolving(frames) if frames else spark.createDataFrame([], merge_schema(schema, "_rescued_data STRING"))
