"""Sources and sinks (S1-S12) with explicit schemas; nothing is inferred.

Counts reported by loads come from ``Observation`` metrics gathered while
the write runs, so a load is a single pass over its data.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shopstar.functions.cleaning import whole_number
from shopstar.sources.schemas import PRODUCT_DOCUMENT, SOURCE, conform
from shopstar.sources.splits import CSV, JSON_ARRAY, MalformedFile, read_records

RELATIONAL = tuple(SOURCE)


#: RFC 4180: quotes are doubled inside quotes, blanks belong to the value.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}


class SourceNotFound(FileNotFoundError):
    pass


def _found(read, path: str):
    try:
        return read(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFound(f"no source file at {path}") from None
        raise


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header row under a fixed schema (S1). Integer columns also
    take ``3.0`` and NaN, as frames with missing values write them (P4). A
    missing path, a malformed row or another header is an error. Files are read
    in splits; with ``multi_line`` quoted values may hold newlines, and records
    are found by a scan of the quotes (see ``sources.splits``), which reads the
    text twice."""
    whole = (T.LongType, T.IntegerType)
    as_text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, whole)
                                          else f.dataType, True) for f in schema.fields])
    options = {**CSV_DIALECT, "mode": "FAILFAST", "nullValue": "\0"}  # absent is NULL, a quoted empty value ""
    if multi_line:
        rows = _csv_rows(spark, path, schema.names, as_text, options)
    else:
        rows = _found(spark.read.schema(as_text).options(**options, enforceSchema=False).csv, path)
    return rows.select(*[
        whole_number(F.col(f.name), f.dataType).alias(f.name) if isinstance(f.dataType, whole)
        else F.col(f.name) for f in schema.fields])


def _text_options(options: dict) -> dict[str, str]:
    return {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}


def _csv_rows(spark: SparkSession, path: str, names: list[str], schema: T.StructType, options: dict) -> DataFrame:
    """The records of CSV files, their header lines checked and left out."""
    records, _ = _found(lambda p: read_records(spark, p, CSV), path)
    line = F.regexp_replace("value", r"\r\z", "")
    cells = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names) + 1)])
    header = F.from_csv(line, cells.simpleString()[len("struct<"):-1].replace(":", " "),
                        _text_options({**options, "mode": "PERMISSIVE"}))
    same = header[f"c{len(names)}"].isNull()
    for k, name in enumerate(names):
        same &= header[f"c{k}"].eqNullSafe(F.lit(name))
    fault = F.raise_error(F.concat(F.lit(f"CSV header does not match {','.join(names)}: "), line))
    is_row = F.when(~F.col("first"), F.lit(True)).when(same, F.lit(False)).otherwise(fault.cast("boolean"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.where(is_row).where(line != "").select(F.from_csv(line, ddl, _text_options(options)).alias("r")) \
        .select("r.*")


def read_documents(spark: SparkSession, path: str, schema: T.StructType = PRODUCT_DOCUMENT,
                   multi_line: bool = False) -> DataFrame:
    """JSON documents under a fixed schema (S2): JSON lines by default,
    ``multi_line`` for files that are one array of documents each. Both are
    read in splits; the documents of an array are found by a scan of quotes and
    brackets (see ``sources.splits``); open attributes come as compact JSON. A malformed document or array is an
    error. A store-specific ``_id`` field is never part of the schema (S5)."""
    if not multi_line:
        return _found(spark.read.schema(schema).options(mode="FAILFAST").json, path)
    records, rest = _found(lambda p: read_records(spark, p, JSON_ARRAY), path)
    if odd := rest.where(~F.col("value").rlike(r"\A\s*(\[\s*)?\]\s*\z")).limit(1).collect():
        raise MalformedFile(f"not an array of documents: {odd[0].value[:80]!r}")
    between = F.when(F.col("first"), F.lit(r"\A\s*\[\s*(?=\{)")).otherwise(F.lit(r"\A\s*,\s*(?=\{)"))
    text = F.concat(F.regexp_replace(F.col("value"), between, F.lit("")), F.lit("}"))
    fault = F.raise_error(F.concat(F.lit("not a document of an array: "), F.left(text, F.lit(80)))).cast("string")
    document = F.when(text.startswith("{"), text).otherwise(fault)
    return records.select(F.from_json(document, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A relational table (S3): a catalog table name or a folder of files."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, partitions: int, properties: dict | None = None) -> DataFrame:
    """A database table read in ``partitions`` parallel key ranges (S3)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions,
                           properties=properties or {})


def read_sql(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """A parameterised SELECT with named markers bound as values (S4). Tables
    are handed in by name, ``{name}`` in the text; the session gets no view."""
    return spark.sql(sql, args=args or {}, **tables)


def write_csv(df: DataFrame, path: str) -> int:
    """One CSV folder per entity with a header (S6); returns rows written."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
        .options(**CSV_DIALECT).csv(path)
    return int(obs.get["rows"])


def write_documents(df: DataFrame, path: str) -> int:
    """Each file one JSON array of documents, a document to a line, as the
    catalog lands (S7); returns rows written. Open attributes are text in a
    frame and JSON in the file."""
    obs = Observation()
    columns = [F.parse_json(c).alias(c) if c == "attributes" else F.col(c) for c in df.columns]
    documents = df.observe(obs, F.count(F.lit(1)).alias("rows")).select(F.to_json(F.struct(*columns)).alias("value"))

    def in_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            if batch.num_rows:
                leads = pa.array([lead] + [","] * (batch.num_rows - 1))
                lead = ","
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(
                    leads, batch.column(0).cast(pa.string()), "")], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"])], ["value"])

    documents.mapInArrow(in_array, "value string").write.mode("overwrite").text(path)
    return int(obs.get["rows"])


def load(df: DataFrame, path: str, schema: T.StructType | None = None) -> int:
    """Truncate-and-load a table (S8): select/cast by the table's schema
    (S12, positional order), overwrite, return the observed row count."""
    if schema is not None:
        df = conform(df, schema)
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


AUDIT_SCHEMA = "audit_id string, table_name string, row_count long, loaded_at timestamp_ntz"


def record_audit(spark: SparkSession, path: str, loaded: dict[str, int],
                 at: dt.datetime | None = None) -> None:
    """Append one audit row per loaded table (S9), in a single append: the
    folder has one writer at a time."""
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    entries = F.array(*[F.struct(F.lit(t).alias("table_name"),
                                 F.lit(int(n)).cast("long").alias("row_count"))
                        for t, n in loaded.items()])
    spark.range(1).select(F.inline(entries)).select(
        F.uuid().alias("audit_id"), "table_name", "row_count",
        F.lit(at).cast("timestamp_ntz").alias("loaded_at"),
    ).write.mode("append").parquet(path)


def export_sources(sources: dict[str, DataFrame], folder: str) -> dict:
    """Write the landing files that :func:`read_landing` reads, relational
    sources as CSV and product documents as JSON arrays, plus a manifest of
    counts and time (S6, S7); returns the manifest. An entity is a folder of
    files, named as its single file would be."""
    counts = {name: write_csv(sources[name], f"{folder}/{name}.csv") for name in RELATIONAL}
    counts["products"] = write_documents(sources["products"], f"{folder}/products.json")
    manifest = {"generated_at": dt.datetime.now(dt.timezone.utc).isoformat(), "counts": counts}
    spark = sources["products"].sparkSession
    spark.range(1).select(F.lit(json.dumps(manifest)).alias("value")) \
        .write.mode("overwrite").text(f"{folder}/_manifest")
    return manifest


def read_landing(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Landing files under their schemas: ``<entity>.csv`` for each relational
    entity and the catalog as JSON arrays, ``products.json``; each a file, as
    the source system drops it, or a folder of files, as ``export_sources``
    writes it. The files' splits are summed up by overlapping jobs."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        found = {name: pool.submit(read_csv, spark, f"{folder}/{name}.csv", SOURCE[name]) for name in RELATIONAL}
        found["products"] = pool.submit(read_documents, spark, f"{folder}/products.json", multi_line=True)
        return {name: f.result() for name, f in found.items()}


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The files written by :func:`export_sources`: landing files."""
    return read_landing(spark, folder)
