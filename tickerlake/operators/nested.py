"""Semi-structured records: comma lists, arrays to rows, record JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.functions.cleaning import standard_decimal


def split_trim_explode(df: DataFrame, key: str, listing: str, out: str) -> DataFrame:
    """``'A, B,,C'`` to one row per non-blank entry."""
    parts = F.filter(F.transform(F.split(listing, ","), lambda p: F.trim(p)), lambda p: p != "")
    return df.select(key, F.explode(parts).alias(out))


def explode_array_index(df: DataFrame, identifier: str, numeric: list[str] | None = None) -> DataFrame:
    """One row per array element with its field, 0-based position and text.

    Arrays are appended, never crossed; a record whose arrays are all empty keeps one row.
    ``numeric`` columns become two-place decimals. The record's JSON is kept in ``raw_json``.
    """
    arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    scalars = [c for c in df.columns if c not in arrays and c != identifier]
    none = F.lit(None)
    empty = F.array(
        F.struct(
            none.cast("string").alias("array_source_field"), none.cast("int").alias("array_element_index"),
            none.cast("string").alias("array_element_value"),
        )
    )

    def entries(name: str):
        return F.transform(
            F.coalesce(F.col(name).cast("array<string>"), F.array().cast("array<string>")),
            lambda v, i: F.struct(
                F.lit(name).alias("array_source_field"), i.alias("array_element_index"), v.alias("array_element_value")
            ),
        )

    found = F.concat(*[entries(a) for a in arrays]) if arrays else F.slice(empty, 1, 0)
    rows = F.when(F.size(found) > 0, found).otherwise(empty)
    kept = [standard_decimal(F.col(c)).alias(c) if numeric and c in numeric else F.col(c) for c in scalars]
    return df.select(
        F.col(identifier).alias("identifier"), *kept, F.to_json(F.struct("*")).alias("raw_json"), F.inline(rows)
    )


def json_preserve(df: DataFrame) -> DataFrame:
    """The row with its own JSON."""
    return df.withColumn("raw_json", F.to_json(F.struct(*df.columns)))


def map_lookup_sector(symbols: DataFrame, sector_map: dict[str, str]) -> DataFrame:
    """Parent symbols with sector and type: mapped ones are sectors, the rest indexes."""
    spark = symbols.sparkSession
    mapping = spark.createDataFrame(list(sector_map.items()), "symbol string, sector string")
    return symbols.join(F.broadcast(mapping), "symbol", "left").withColumn(
        "type", F.when(F.col("sector").isNotNull(), "Sector").otherwise("Index")
    )
