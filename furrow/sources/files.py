"""CSV landing files: scan, lines that do not fit, audit columns, column profile and column guard."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, FloatType, MapType, StringType, StructField, StructType, UserDefinedType, VariantType,
)

from furrow.sources import shared

_REJECTED = "_rejected"
AUDIT = ("_ingestion_timestamp", "_source_file")


def scan_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, trim: bool = False
) -> DataFrame:
    """Read CSV files with a header; give a schema to save the inference pass over the data."""
    reader = spark.read.options(
        header=True, ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def with_audit(scanned: DataFrame) -> DataFrame:
    """Add the load time and the file each row came from."""
    return scanned.withColumns({
        AUDIT[0]: F.current_timestamp(),
        AUDIT[1]: F.col("_metadata.file_path"),
    })


def _same_path(path: Column) -> Column:
    """A file's name in one spelling, as listings and ``_metadata`` differ in slashes and escapes."""
    return F.url_decode(F.regexp_replace(path, "^([a-z]+):/+", "$1:/"))


def not_landed(listed: DataFrame, stored: DataFrame) -> list[str]:
    """Files of a scan that no row of the stored table names in ``_source_file``; only new names reach the driver."""
    spark = listed.sparkSession
    names = spark.createDataFrame([(name,) for name in sorted(listed.inputFiles())], "file string")
    known = stored.select(_same_path(F.col("_source_file")).alias("known")).distinct()
    return [row.file for row in names.join(known, _same_path(F.col("file")) == F.col("known"), "left_anti").collect()]


def scan_checked(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Lines of CSV files that fit the schema, and those that do not.

    The first frame has the schema's columns. The second has ``_line`` (the line as it stands in the file) and
    ``_source_file``: lines with too few or too many fields, or with a field that is not of its column's
    type. The header of each file must name the schema's columns in their order, else reading fails.
    Blank lines are neither. The lines are parsed once and written to the shared folder, as what is
    malformed depends on which columns are parsed. An empty folder gives two empty frames.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    parsed = spark.read.schema(StructType([*wanted.fields, StructField(_REJECTED, StringType())])).options(
        header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_REJECTED,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path).withColumn("_source_file", F.col("_metadata.file_path"))
    staged = shared.fresh_path(spark, "parsed")
    parsed.withColumn("_fits", F.col(_REJECTED).isNull()).write.partitionBy("_fits").parquet(staged)
    rows = spark.read.schema(StructType([*parsed.schema.fields, StructField("_fits", BooleanType())])).parquet(staged)
    rejected = rows.where("NOT _fits").select(F.col(_REJECTED).alias("_line"), "_source_file")
    return rows.where("_fits").select(*wanted.names), rejected


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability, and what its values are like.

    ``rows``, ``present`` (neither NULL nor NaN), ``nan``, ``least`` and ``greatest`` as text (NaN left out; null for
    columns that have no order) and ``about_distinct`` come from one aggregate over the whole table, whose
    single row is then turned into a row a column.
    """
    entries = []
    for position, field in enumerate(df.schema, 1):
        value, kind = F.col(f"`{field.name}`"), field.dataType
        inexact = isinstance(kind, (FloatType, DoubleType))
        known = F.nanvl(value, F.lit(None).cast(kind)) if inexact else value
        ordered = not isinstance(kind, (MapType, VariantType, ArrayType, StructType, UserDefinedType))
        text = lambda edge: edge(known).cast("string") if ordered else F.lit(None).cast("string")  # noqa: B023,E731
        entries.append(F.struct(
            F.lit(position).alias("ordinal"), F.lit(field.name).alias("column_name"),
            F.lit(kind.simpleString()).alias("data_type"), F.lit(field.nullable).alias("nullable"),
            F.count(F.lit(1)).alias("rows"), F.count(known).alias("present"),
            (F.count_if(F.isnan(value)) if inexact else F.lit(0).cast("bigint")).alias("nan"),
            text(F.min).alias("least"), text(F.max).alias("greatest"),
            (F.approx_count_distinct(known) if ordered else F.lit(None).cast("bigint")).alias("about_distinct"),
        ))
    if not entries:
        raise ValueError("a frame without columns has no profile")
    return df.agg(F.array(*entries).alias("columns")).select(F.inline("columns"))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail while the plan is built when a column is missing."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
