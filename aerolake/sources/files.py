"""File readers with explicit schemas (no inference on the production path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.schemas import POSITIONS_CLEAN, POSITIONS_TEXT, RAW_STATES, RAW_TRACE

CORRUPT = "_corrupt_record"


def read_states_json(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot documents ``{"time": ..., "states": [[...], ...]}``, one multi-line JSON each."""
    return spark.read.schema(RAW_STATES).option("multiLine", True).json(path)


def read_trace_json(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Unpacked trace documents.  Unparseable files land in ``_corrupt_record`` (PERMISSIVE)."""
    schema = T.StructType(RAW_TRACE.fields + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return df if keep_corrupt else df.drop(CORRUPT)


def with_errors(docs: DataFrame, *required: str) -> DataFrame:
    """Documents of a reader that keeps corrupt ones, with source_file and an error on each that is no JSON or whose
    ``required`` fields don't parse; such a document yields no rows further on."""
    lost = F.lit(False)
    for name in required:
        lost = lost | F.col(name).isNull()
    return docs.withColumns({"source_file": F.col("_metadata.file_path"),
                             "error": F.when(F.col(CORRUPT).isNotNull() & lost, F.lit("invalid JSON document"))}).drop(CORRUPT)


def read_positions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Flattened positions as CSV text with a header; splits of large files replace the
    fixed-size chunks of a single-process reader.  All columns stay text for clean_positions."""
    return spark.read.schema(POSITIONS_TEXT).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_positions_parquet(spark: SparkSession, path: str, schema: T.StructType = POSITIONS_CLEAN) -> DataFrame:
    """Hive-partitioned Parquet (``event_date=YYYY-MM-DD``).  The schema is given, so files
    written with drifting types are read as one type; filters on ``event_date`` prune
    directories."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Plain Parquet with a declared schema: columns are read by name as the declared types
    (compatible widening only), so per-file type drift cannot change the table's schema."""
    return spark.read.schema(schema).parquet(path)


# One flight record of the REST API (camelCase, as delivered).
FLIGHT_RECORD = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("firstSeen", T.LongType()),
    T.StructField("estDepartureAirport", T.StringType()),
    T.StructField("lastSeen", T.LongType()),
    T.StructField("estArrivalAirport", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("estDepartureAirportHorizDistance", T.DoubleType()),
    T.StructField("estDepartureAirportVertDistance", T.DoubleType()),
    T.StructField("estArrivalAirportHorizDistance", T.DoubleType()),
    T.StructField("estArrivalAirportVertDistance", T.DoubleType()),
    T.StructField("departureAirportCandidatesCount", T.LongType()),
    T.StructField("arrivalAirportCandidatesCount", T.LongType()),
])
BATCH_NAME = r"flights_batch_(\d+)_(\d+)_(\d+)\.json$"   # run id, days back, window number


def read_flight_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batches of flight records (one JSON array per file).  Column names are folded to lower
    case and the run id / window number come from the file name, where it has them (else NULL)."""
    df = (spark.read.schema(FLIGHT_RECORD).option("multiLine", True)
          .option("pathGlobFilter", "flights_batch_*.json").option("recursiveFileLookup", True).json(path))
    fp = F.col("_metadata.file_path")
    df = df.select(*[F.col(c).alias(c.lower()) for c in df.columns],
                   F.regexp_extract(fp, BATCH_NAME, 1).try_cast("long").alias("run_id"),
                   F.regexp_extract(fp, BATCH_NAME, 3).try_cast("int").alias("window_no"),
                   fp.alias("source_file"))
    return df


def stream_paths(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Paths of files as they turn up; their contents are not read."""
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    return (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(path).select("path"))


def _stream_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.readStream.schema(kept).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def stream_trace_json(spark: SparkSession, path: str) -> DataFrame:
    """Unpacked trace documents in the columns of ``archives.parse_documents``: the file stands for the archive."""
    docs = with_errors(_stream_json(spark, path, RAW_TRACE), "icao", "timestamp", "trace")
    return docs.select(F.col("source_file").alias("archive"), F.lit(None).cast("string").alias("member"), "error", *(f.name for f in RAW_TRACE.fields))


def stream_states_json(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot documents with source_file and error."""
    return with_errors(_stream_json(spark, path, RAW_STATES), "time", "states")


def stream_positions_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(POSITIONS_TEXT).option("header", True).option("mode", "PERMISSIVE").csv(path)


def stream_positions_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Flat positions in whatever types the files have (those of the files there now); missing columns are null."""
    from aerolake.schemas import POSITIONS_RAW
    from aerolake.sources.sinks import align_by_name

    return align_by_name(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path), POSITIONS_RAW)


def stream_flight_batches(spark: SparkSession, path: str) -> DataFrame:
    """Flight records of the batches that turn up, in the columns of the raw flights table but ``processed_at``."""
    df = (spark.readStream.schema(FLIGHT_RECORD).option("multiLine", True)
          .option("pathGlobFilter", "flights_batch_*.json").option("recursiveFileLookup", True).json(path))
    return df.select(*(F.col(c).alias(c.lower()) for c in (
        "icao24", "callsign", "estDepartureAirport", "estArrivalAirport", "firstSeen", "lastSeen",
        "estDepartureAirportHorizDistance", "estArrivalAirportHorizDistance")))
