import csv
import io
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerlake.functions import cleaning as cl
from tickerlake.functions.naming import camel_to_snake
from tickerlake.sources import files


def apply(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", column(F.col("t"))).orderBy("i").collect()]


@pytest.mark.parametrize(
    "line, expected",
    [
        ('"October 29, 12",5,6', '"October 29 12",5,6'),
        # only copies of the first match are changed
        ('"May 1, 12","May 1, 12","June 2, 13"', '"May 1 12","May 1 12","June 2, 13"'),
        ('"open,5', '"open,5",,'),
        ('a,b"', 'a,b"'),
        ("  a  ", "a,,"),
        ("a,b,c,d", "a,b,c,d"),
        ('"x,y",z', '"x,y",z,'),
        ("", ""),
        ("   ", ""),
    ],
)
def test_clean_line(spark, line, expected):
    assert apply(spark, [line], lambda c: cl.clean_line(c, 3)) == [expected]


def reference_line(line, n):
    """The rules in plain Python, with the csv module counting the fields."""
    line = line.strip(" \t\r\n")
    if not line:
        return line
    found = re.search(r'"([A-Za-z]+ [0-9]+), ([0-9]+)"', line)
    if found:
        line = line.replace(found.group(0), f'"{found.group(1)} {found.group(2)}"')
    if line.count('"') % 2:
        if line.endswith('"'):
            return line
        line += '"'
    pieces = line.split('"')
    fields = 1 + sum(p.count(",") for p in pieces[::2])
    return line + "," * max(n - fields, 0)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='ab1 ,"M', max_size=14), min_size=30, max_size=60))
def test_clean_line_matches_rules(spark, lines):
    lines = [*lines, '"May 3, 12",a', 'x,"May 13, 1"']
    assert apply(spark, lines, lambda c: cl.clean_line(c, 4)) == [reference_line(t, 4) for t in lines]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.text(alphabet='ab ,"', max_size=6), min_size=3, max_size=3), min_size=20, max_size=40))
def test_parse_well_formed(spark, rows):
    """Lines the csv module writes are read back cell by cell."""
    rows = [r for r in rows if "".join(r).strip()]
    if not rows:
        return
    lines = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(row)
        lines.append(out.getvalue())
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, line string")
    got = [tuple(r)[1:] for r in files.parse_lines(df, "line", ["a", "b", "c"]).orderBy("i").collect()]
    assert got == [tuple(None if c.strip() in cl.EMPTY_CELLS else c.strip() for c in row) for row in rows]


def test_cells_are_cut_and_padded(spark):
    got = apply(spark, ["1, null ,None,4", "1", '"",NULL'], lambda c: cl.normalised_cells(c, 3))
    assert got == [["1", None, None], ["1", None, None], [None, None, None]]


@pytest.mark.parametrize(
    "text, expected",
    [("123.456789", "123.46"), ("15.7", "15.70"), ("0.045", "0.05"), (None, None), ("invalid", None), ("n/a", None),
     ("", None), ("999999999999.99", "999999999999.99"), ("-1.005", "-1.01")],
)
def test_standard_decimal(spark, text, expected):
    assert apply(spark, [text], cl.standard_decimal) == [Decimal(expected) if expected else None]


def test_casts(spark):
    assert apply(spark, ["12", " 12 ", "", "x", None, "12.7"], cl.safe_int) == [12, 12, None, None, None, None]
    assert apply(spark, ["1.5", "NaN", "Infinity", "y"], cl.safe_float) == [1.5, None, None, None]
    assert apply(spark, ["1234.0", "2.5", "3.5", "z"], cl.decimal_text_to_bigint) == [1234, 2, 4, None]
    assert apply(spark, ["true", "false", "maybe", ""], cl.safe_bool) == [True, False, None, None]
    assert apply(spark, ["12.5%", "7", "%"], cl.parse_percent) == [12.5, 7.0, None]
    assert [str(d) for d in apply(spark, ["2024-02-29", "02/28/2024", "28/02/2024", "x"], cl.parse_date_any)] == [
        "2024-02-29", "2024-02-28", "2024-02-28", "None"]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.from_regex(r"\A[a-z]{1,4}([A-Z][a-z0-9]{0,3}){0,4}\Z"), min_size=5, max_size=20))
def test_snake_case_column_and_name_agree(spark, names):
    assert apply(spark, names, cl.snake_case) == [camel_to_snake(n) for n in names]


def test_snake_case_examples():
    assert camel_to_snake("NAVPSPercentChange") == "navps_percent_change"
    assert camel_to_snake("adjClose") == "adj_close"


def test_seed_names():
    assert files.fund_seed_table("FundGeneralSeed.csv") == "fund_general"
    assert files.fund_seed_table("FundDailyNAVPSSeed.csv") == "fund_daily_nav"
    assert files.fund_seed_table("FundYearlyPerformanceRankingByClassSeed.csv") == "fund_yearly_performance_ranking"


def test_first_file_wins_and_header_is_skipped(spark, tmp_path):
    (tmp_path / "q_2000.csv").write_text('date,adjClose,symbol\n2000-01-03,1.5,A\n"2000-01-04,2.5,A\n')
    (tmp_path / "q_2001.csv").write_text("Date,adj_close,symbol\n2000-01-03,9.9,A\n2001-01-02,3.5,A,extra\n,,\n")
    got = files.scan_partition_files(
        spark, str(tmp_path), ["date", "adj_close", "symbol"], {"date": "date", "adj_close": "double"}, ["symbol", "date"])
    assert sorted((str(r.date), r.adj_close) for r in got.collect()) == [("2000-01-03", 1.5), ("2001-01-02", 3.5)]


def test_a_cut_before_a_word_leaves_no_blank(spark):
    texts = ["  1234 Growth Fund ", "1234567 Fund of the Month", "  ", "", None, "x"]
    assert apply(spark, texts, lambda c: cl.clip_text(c, 12, trim_end=True)) == ["1234 Growth", "1234567 Fund", None, None, None, "x"]
    assert apply(spark, texts, lambda c: cl.clip_text(c, 12))[0] == "1234 Growth "


def test_truncate_strings_trims_what_it_cuts(spark, tmp_path):
    from datetime import datetime

    from tickerlake import registry

    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_shipdate timestamp, l_extendedprice double, l_quantity double, l_tax double, l_discount double"
    rows = [(1, i, part, datetime(2020, 1, 1), 1.0, 1.0, 0.0, 0.0) for i, part in enumerate((1200, 120, 7))]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = {r.l_partkey: r.value for r in registry.QUERIES["truncate_strings"](spark, str(tmp_path)).collect()}
    assert found == {1200: "1200 Growth", 120: "120 Growth F", 7: "7"}
