"""Readers for vendor dumps that already lie in a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.functions import cleaning as cl
from tickerlake.functions.naming import camel_to_snake, lower_columns, snake_columns
from tickerlake.operators.upsert import dedupe_by_key
from tickerlake.sources import schemas
from tickerlake.sources.loads import load_files


def scan_csv_typed(spark: SparkSession, path: str | list[str], schema: str, multi_line: bool = False) -> DataFrame:
    """CSV with header and doubled-quote escapes into a declared schema; columns are found by name, letter case aside.

    The header of one file gives the order; a file whose header differs ends the read with an error instead of loading wrong columns. ``records.scan_csv_records`` takes
    files with different headers, and records with line breaks in parallel. ``multi_line`` admits line breaks inside quotes too, but makes each file one task.
    """
    declared = {f.name.lower(): f for f in spark.createDataFrame([], schema).schema}
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    found = [c.strip().lower() for c in spark.read.options(**options).csv(path).columns]
    missing = [name for name in declared if name not in found]
    if missing:
        raise ValueError(f"columns {missing} are not in the header of {path}")
    ordered = T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in found])
    rows = spark.read.schema(ordered).options(**options, enforceSchema=False).csv(path)
    return rows.select(*[f.name for f in declared.values()])


def cast_staged(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed columns from text ones; blank and malformed cells become NULL."""

    def typed(name: str, to: str):
        c = F.col(name)
        if to == "string":
            return cl.blank_to_null(c).alias(name)
        if to == "bigint":
            return cl.decimal_text_to_bigint(c).alias(name)
        if to == "double":
            return cl.safe_float(c).alias(name)
        return cl.safe_cast(c, to).alias(name)

    return df.select(*[typed(c, types.get(c, "string")) for c in df.columns])


def scan_csv_staged_text(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Land every column as text, lower-case the header, then cast per column."""
    text = spark.read.options(header=True, inferSchema=False, quote='"', escape='"').csv(path)
    return cast_staged(lower_columns(text), types)


def parse_lines(lines: DataFrame, line: str, columns: list[str]) -> DataFrame:
    """Cleaned lines to text columns named ``columns``, other columns kept."""
    cells = cl.normalised_cells(cl.clean_line(F.col(line), len(columns)), len(columns))
    kept = [c for c in lines.columns if c != line]
    # a one-element explode keeps later filters above the parsing, so a line is parsed once
    parsed = lines.select(*kept, F.explode(F.array(cells)).alias("_cells"))
    return parsed.select(*kept, *[F.col("_cells")[i].alias(c) for i, c in enumerate(columns)])


def split_parsable(
    lines: DataFrame, line: str, columns: list[str], types: dict[str, str]
) -> tuple[DataFrame, DataFrame]:
    """(parsable, quarantined): raw lines against column names and types, bad ones with the reason."""
    fields = cl.csv_fields(F.col(line))
    cells = F.transform(fields, lambda c: cl.blank_to_null(cl.unquote(cl.strip(c))))
    reason = F.when(cl.has_open_quote(F.col(line)), "open quote").when(F.size("_cells") > len(columns), "too many fields")
    for i, name in enumerate(columns):
        if name in types:
            cell = F.get("_cells", F.lit(i))
            bad = cell.isNotNull() & cell.try_cast(types[name]).isNull()
            reason = reason.when(bad, f"{name} is not a {types[name]}")
    checked = lines.withColumn("_cells", cells).withColumn("reason", reason).drop("_cells")
    return checked.filter("reason IS NULL").drop("reason"), checked.filter("reason IS NOT NULL")


def scan_partition_files(
    spark: SparkSession, path: str, columns: list[str], types: dict[str, str], keys: list[str]
) -> DataFrame:
    """All files of a folder, line-repaired and typed; the first file (by name) wins a key clash. See ``load_partition_files`` for the log."""
    return load_partition_files(spark, path, columns, types, keys)[0]


def load_partition_files(
    spark: SparkSession, path: str, columns: list[str], types: dict[str, str], keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows, log): rows of the readable files of a folder, line-repaired and typed, and a log with a row per file.

    A file that cannot be read to its end is left out whole and logged with the reason; lines without a key count as rejected. The first file (by name) wins a key
    clash. Files are split by line, so large ones are read by many tasks.
    """
    header = ",".join(columns).replace("_", "").lower()
    # a header may be quoted, camelCase or snake_case
    is_header = F.lower(F.regexp_replace("_line", '[" _]', "")) == header

    def read(files: list[str]) -> DataFrame:
        lines = spark.read.text(files).select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("source_file"))
        rows = parse_lines(lines.filter((F.trim("_line") != "") & ~is_header), "_line", columns)
        return cast_staged(rows, {**types, "source_file": "string"})

    rows, log = load_files(spark, path, read, lambda rows: cl.all_true([F.col(k).isNotNull() for k in keys]))
    named = rows.withColumn("source_file", F.element_at(F.split("source_file", "/"), -1))
    return dedupe_by_key(named, keys, ["source_file"]), log


def fund_seed_table(file_name: str) -> str:
    stem = file_name.removesuffix(schemas.FUND_SEED_SUFFIX)
    return schemas.FUND_SEED_EXCEPTIONS.get(file_name, camel_to_snake(stem))


def scan_fund_seed_files(spark: SparkSession, folder: str, files: list[str]) -> dict[str, DataFrame]:
    """One lazy text table per seed file, deduplicated by record id where it has one."""
    tables = {}
    for name in files:
        rows = snake_columns(spark.read.options(header=True, quote='"', escape='"').csv(f"{folder}/{name}"))
        tables[fund_seed_table(name)] = dedupe_by_key(rows, ["record_id"], []) if "record_id" in rows.columns else rows
    return tables


def scan_pricing_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Pricing files that differ in columns, unioned by name and deduplicated by instrument and date."""
    frames = [snake_columns(spark.read.options(header=True, quote='"', escape='"').csv(p)) for p in paths]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return dedupe_by_key(merged, ["instrument_key", "date"], [])


def ingest_json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON objects, one per line, to rows; a ``historical`` array becomes one row per element with the parent symbol."""
    rows = spark.read.schema(schema).json(path)
    if "historical" in rows.columns:
        rows = rows.select("symbol", F.explode("historical").alias("_h")).select("symbol", "_h.*")
    return snake_columns(rows)


def ingest_profile_json(spark: SparkSession, path: str) -> DataFrame:
    """camelCase profile objects to typed snake_case columns; a bad value becomes NULL."""
    names = {_camel(c): c for c in schemas.PROFILE_TYPES}
    raw = spark.read.schema(schemas.struct_of(list(names))).json(path)
    typed = cast_staged(raw.select(*[F.col(k).alias(c) for k, c in names.items()]), schemas.PROFILE_TYPES)
    return typed.filter("symbol IS NOT NULL").withColumnsRenamed(schemas.PROFILE_RENAMES)


def _camel(snake: str) -> str:
    head, *rest = snake.split("_")
    return head + "".join(w.capitalize() for w in rest)


def ingest_bulk_eod(spark: SparkSession, path: str) -> DataFrame:
    """One-day whole-market CSV in the quote columns, found by name; rows without a symbol are dropped."""
    rows = snake_columns(scan_csv_typed(spark, path, schemas.BULK_EOD_SCHEMA))
    return rows.filter("symbol IS NOT NULL AND symbol <> ''").withColumn("volume", F.rint("volume").cast("bigint"))


def ingest_treasury(spark: SparkSession, path: str) -> DataFrame:
    """First column a date, every other a number."""
    rows = lower_columns(spark.read.options(header=True).csv(path))
    first, *tenors = rows.columns
    return rows.select(cl.safe_date(F.col(first)).alias("date"), *[cl.safe_float(F.col(c)).alias(c) for c in tenors])


def fund_quotes_transform(df: DataFrame) -> DataFrame:
    """API columns to the fifteen fund quote columns; absent ones are NULL, never the text ``nan``."""

    def column(name: str):
        source = schemas.FUND_QUOTE_SOURCES.get(name)
        if source not in df.columns:
            return F.lit(None).cast("string").alias(name)
        if name == "instrument_key":
            return cl.safe_int(F.col(source)).alias(name)
        return F.col(source).cast("string").alias(name)

    return df.select(*[column(c) for c in schemas.FUND_QUOTE_COLUMNS])


def read_file_contents(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, length) per file, for the ledger of processed files."""
    return spark.read.format("binaryFile").load(path).select("path", "content", "length")
