"""File sources: whole bundle files and tab-separated vocabulary files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions import exprs as X
from clinlake.sources.contracts import CONCEPT


def bundle_columns(files: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Name the text and add provenance: file, load time, hash of the whole text, size and time of the file."""
    return files.select(
        F.col("value").alias("bundle_json"),
        F.col("_metadata.file_path").alias("_source_file"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("_loaded_at"),
        X.content_hash(F.col("value")).alias("_content_hash"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def bundle_reader(reader, glob: str | None):
    """Reader (batch or stream) that returns each file as one row.

    ``wholetext`` is given to the generic loader: ``text()`` would reset it to its own
    default and return a row per line.
    """
    reader = reader.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    return reader if glob is None else reader.option("pathGlobFilter", glob)


def scan_bundles(
    spark: SparkSession, path: str | list[str], loaded_at: Column | None = None, glob: str | None = None
) -> DataFrame:
    """Every bundle file below ``path`` as one row.

    A whole file is one row and so one task's work; small files are packed together up to
    ``spark.sql.files.maxPartitionBytes``.
    """
    return bundle_columns(bundle_reader(spark.read, glob).load(path), loaded_at)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Every file below ``path`` by its metadata alone: where to load it, its name, size and time. No content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.col("path").alias("load_path"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_vocab_tsv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = CONCEPT,
    date_format: str = "yyyyMMdd",
) -> DataFrame:
    """A tab-separated vocabulary file with a header line.

    Names hold stray quotes, so quoting is off. With a schema, dates are read as
    ``date_format`` and, where that fails, as ISO dates. Without one, types are inferred.
    """
    reader = spark.read.option("header", True).option("sep", "\t").option("quote", "")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = reader.schema(text).csv(path)
    return raw.select(*[_typed(f, date_format).alias(f.name) for f in schema])


def _typed(field: T.StructField, date_format: str) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        return F.coalesce(F.try_to_date(text, date_format), text.try_cast("date"))
    return text.try_cast(field.dataType)


def optional_vocab(spark: SparkSession, path: str, schema: T.StructType | None = CONCEPT) -> DataFrame | None:
    """As ``read_vocab_tsv``, but None when there is no such file. Other errors are raised."""
    try:
        return read_vocab_tsv(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
