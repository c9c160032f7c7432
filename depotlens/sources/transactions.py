"""Reading, landing and exporting the transaction log and other file data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.config import EngineConfig
from depotlens.schemas import TABLES, TRANSACTIONS
from depotlens.session import materialize
from depotlens.sources.workbook import CORRUPT, register

# Column headers of the published log and their names here.
LOG_HEADERS = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}


def text_log_schema(line_column: str | None = None) -> T.StructType:
    """Declared types of a text log: identifiers stay text, customer numbers may print as 17850.0."""
    kinds = {f.name: f.dataType for f in TRANSACTIONS} | {"customer_id": T.DoubleType()}
    fields = [T.StructField(header, kinds[name]) for header, name in LOG_HEADERS.items()]
    return T.StructType(fields + ([T.StructField(line_column, T.LongType())] if line_column else []))


def load_transactions(
    spark: SparkSession, path: str, fmt: str = "parquet", line_column: str | None = None, **options: str
) -> DataFrame:
    """The 8-column log plus ``line_no``.

    CSV, JSON and workbooks are read with a declared schema, never inferred. ``line_column`` names a column
    that gives the position in the log; without one the position is the order of the file splits,
    which equals the line order of a single file.
    """
    if fmt in DECLARED:
        raw = _declared(spark, path, fmt, text_log_schema(line_column), options)
    else:
        raw = spark.read.format(fmt).options(**options).load(path)
    return _renamed(raw, line_column)


#: Formats without types of their own.
DECLARED = ("csv", "json", "workbook")


def load_checked(
    spark: SparkSession, path: str, fmt: str, line_column: str | None = None, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The log without the rows that do not parse, and those rows as (line_no, raw): their text as it stands in the file.

    A value that does not fit its declared type would be NULL otherwise, as if the log had none there.
    """
    if fmt not in DECLARED:
        raise ValueError(f"{fmt} files have types of their own; a row cannot fail to parse")
    schema = text_log_schema(line_column).add(CORRUPT, T.StringType())
    raw = _declared(spark, path, fmt, schema, {**options, "columnNameOfCorruptRecord": CORRUPT})
    position = (F.col(line_column) if line_column else F.monotonically_increasing_id()).cast("bigint").alias("line_no")
    numbered = raw.select("*", position) if line_column != "line_no" else raw
    bad = F.col(CORRUPT).isNotNull()
    # Written with all columns: text files cannot be asked for the raw text of their bad rows alone.
    malformed = materialize(numbered.where(bad), "malformed").select("line_no", F.col(CORRUPT).alias("raw"))
    return _renamed(numbered.where(~bad), "line_no"), malformed


def _declared(spark: SparkSession, path: str, fmt: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    if fmt == "workbook":
        register(spark)
    header = {"header": "true"} if fmt == "csv" else {}
    return spark.read.format(fmt).schema(schema).options(**header, **options).load(path)


def _renamed(raw: DataFrame, line_column: str | None) -> DataFrame:
    position = F.col(line_column) if line_column else F.monotonically_increasing_id()
    renamed = raw.withColumnsRenamed(LOG_HEADERS)
    return renamed.select(
        *(renamed[f.name].cast(f.dataType).alias(f.name) for f in TRANSACTIONS if f.name != "line_no"),
        position.cast("bigint").alias("line_no"),
    )


def stores_table(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    schema = TABLES["stores"].schema
    literal = T.StructType(schema.fields[:-1])
    return spark.createDataFrame(list(cfg.stores), literal).withColumn("is_synthetic", F.lit(True))


def land_raw(df: DataFrame, directory: str, run_ts: datetime, prefix: str = "log") -> str:
    """Append the payload as JSON under its UTC run time before anything parses it."""
    path = f"{directory}/{prefix}/ingest_ts={run_ts:%Y%m%dT%H%M%SZ}"
    df.write.mode("errorifexists").json(path)
    return path


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def publish_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Hand a finished mart to another tool's database."""
    df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)
