"""Cleaning of fund data and fund quote rows that arrive as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.functions import cleaning as cl

# Width of each text column and the default of a missing one.
DATA_TEXT = {
    "record_id": ("RecordId", 50, None),
    "language": ("Language", 2, "EN"),
    "legal_name": ("LegalName", 255, None),
    "family_name": ("FamilyName", 150, None),
    "series_name": ("SeriesName", 150, None),
    "company": ("Company", 100, None),
    "currency": ("Currency", 3, "CAD"),
    "record_state": ("RecordState", 20, "Active"),
}
DATA_DATES = {"inception_date": "InceptionDate", "change_date": "ChangeDate"}
QUOTE_TEXT = {
    "record_id": ("RecordId", 50, None),
    "split": ("Split", 20, None),
    "record_state": ("RecordState", 20, "Active"),
}
QUOTE_DATES = {"date": "Date", "previous_date": "PreviousDate", "change_date": "ChangeDate"}
QUOTE_DECIMALS = {
    "navps": "NAVPS",
    "navps_penny_change": "NAVPSPennyChange",
    "navps_percent_change": "NAVPSPercentChange",
    "previous_navps": "PreviousNAVPS",
    "current_yield": "CurrentYield",
    "current_yield_percent_change": "CurrentYieldPercentChange",
}


def _clean(df: DataFrame, texts: dict, dates: dict, decimals: dict) -> DataFrame:
    def source(name: str):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    identifier = cl.blank_to_null(F.col("InstrumentKey")).alias("identifier")
    return df.select(
        identifier,
        *[cl.clip_text(source(s), width, default).alias(c) for c, (s, width, default) in texts.items()],
        *[cl.parse_date_any(source(s)).alias(c) for c, s in dates.items()],
        *[cl.parse_money(source(s)).alias(c) for c, s in decimals.items()],
        F.to_json(F.struct(*df.columns)).alias("raw_data"),
    ).filter("identifier IS NOT NULL")


def clean_fund_data_rows(df: DataFrame) -> DataFrame:
    return _clean(df, DATA_TEXT, DATA_DATES, {})


def clean_fund_quote_rows(df: DataFrame) -> DataFrame:
    return _clean(df, QUOTE_TEXT, QUOTE_DATES, QUOTE_DECIMALS)
