"""The test-table views as SQL text, for the checking engine."""

from __future__ import annotations

_STEPS = "(SELECT unnest(range(-9, 10)) AS step)"


def _neighbours(base: str, same: str) -> str:
    return f"""SELECT a.symbol AS symbol, b.symbol AS peer_symbol FROM {base} a, {_STEPS} s, {base} b
        WHERE s.step <> 0 AND b.symbol = a.symbol + s.step AND a.{same} = b.{same}"""


VIEWS: dict[str, tuple[list[str], str]] = {
    "quotes": ([], """SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS adj_close,
        max(l_extendedprice) AS high, min(l_extendedprice) AS low, CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM lineitem GROUP BY 1, 2"""),
    "profile": ([], """SELECT s_suppkey AS symbol, s_name AS company_name, r_name AS sector, n_name AS industry,
        CASE WHEN s_suppkey % 2 = 0 THEN 'USD' ELSE 'CAD' END AS currency, s_acctbal AS mkt_cap
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "company": ([], """SELECT c_custkey AS symbol, c_name AS company_name, c_mktsegment AS sector, n_name AS industry,
        CASE WHEN c_custkey % 2 = 0 THEN 'USD' ELSE 'CAD' END AS currency,
        CASE WHEN c_custkey % 50 <> 0 THEN c_acctbal END AS mkt_cap
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "etf_profile": ([], """SELECT p_partkey AS symbol, p_name AS name,
        CASE WHEN p_partkey % 2 = 0 THEN 'USD' ELSE 'CAD' END AS currency, substr(p_brand, 1, 7) AS domicile,
        substr(p_type, 1, 1) AS asset_class, CASE WHEN p_partkey % 11 <> 0 THEN p_size / 100.0e0 END AS expense_ratio,
        CASE WHEN p_partkey % 13 <> 0 THEN p_retailprice * (1 + p_partkey % 7) END AS aum, p_retailprice AS price FROM part"""),
    "peers": (["profile"], _neighbours("profile", "sector")),
    "company_peers": (["company"], _neighbours("company", "sector")),
    "etf_peers": (["etf_profile"], _neighbours("etf_profile", "domicile")),
    "ratios": ([], """SELECT l_suppkey AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date,
        max(l_discount) AS return_on_equity, max(l_tax) AS net_profit_margin, min(l_discount) AS operating_profit_margin,
        count(*) / 10.0e0 AS debt_equity_ratio, max(l_quantity) / min(l_quantity) AS current_ratio,
        CASE WHEN count(*) % 4 = 0 THEN NULL ELSE max(l_quantity) END AS interest_coverage,
        max(l_extendedprice) / max(l_quantity) AS price_earnings_ratio, min(l_extendedprice) / 1000.0e0 AS price_to_book_ratio,
        CASE WHEN count(*) % 3 = 0 THEN NULL ELSE min(l_quantity) END AS price_earnings_to_growth_ratio
        FROM lineitem GROUP BY 1, 2"""),
    "growth": ([], """SELECT l_suppkey AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date,
        max(l_tax) - min(l_tax) AS revenue_growth, max(l_discount) - max(l_tax) AS three_y_revenue_growth_per_share,
        min(l_discount) - max(l_tax) AS three_y_net_income_growth_per_share
        FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2"""),
    "key_metrics": ([], """SELECT l_suppkey AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date,
        max(l_discount) AS roe FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2"""),
    "income": ([], """SELECT l_suppkey AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date, max(l_extendedprice) * 3 AS revenue,
        max(l_extendedprice) AS gross_profit, max(l_extendedprice) - min(l_extendedprice) AS operating_income,
        min(l_extendedprice) * max(l_discount) AS net_income, max(l_tax) * 10 AS eps, max(l_extendedprice) / 2 AS ebitda FROM lineitem GROUP BY 1, 2"""),
    "balance": ([], """SELECT l_suppkey AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date, max(l_extendedprice) * 20 AS total_assets,
        max(l_extendedprice) * 5 AS current_assets, min(l_extendedprice) * 8 AS total_liabilities,
        min(l_extendedprice) * (count(*) % 3) AS current_liabilities, max(l_extendedprice) * 20 - min(l_extendedprice) * 8 AS total_equity,
        min(l_extendedprice) * 3 AS total_debt FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2"""),
    "cash_flow": ([], """SELECT l_suppkey AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date, max(l_extendedprice) / 4 AS operating_cash_flow,
        max(l_extendedprice) / 4 - min(l_extendedprice) / 5 AS free_cash_flow FROM lineitem WHERE l_linenumber = 2 GROUP BY 1, 2"""),
    "financial_scores": ([], "SELECT s_suppkey AS symbol, s_acctbal / 1000 AS altman, s_suppkey % 10 AS piotroski FROM supplier"),
    "fund_scores": ([], """SELECT symbol, date, k % 101 AS performance, k % 83 AS risk, k % 97 AS management, k % 89 AS total_score FROM
        (SELECT DISTINCT l_suppkey AS symbol, last_day(CAST(l_shipdate AS DATE)) AS date, l_suppkey * 13 + month(l_shipdate) AS k FROM lineitem)"""),
    "bench": ([], "SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS close FROM orders GROUP BY 1"),
    "treasury": ([], """SELECT CAST(l_shipdate AS DATE) AS date, max(l_tax) * 100 AS month3
        FROM lineitem WHERE day(l_shipdate) % 3 = 0 GROUP BY 1"""),
    "holdings": ([], """SELECT l_orderkey AS etf_symbol, l_partkey AS asset, n_name AS country,
        max(l_extendedprice) AS market_value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3"""),
    "api_calls": ([], """SELECT event_id AS id, event_type AS endpoint, ts, user_id, value AS response_time_ms FROM events"""),
    "records": ([], """SELECT l_orderkey * 10 + l_linenumber AS record_id, CAST(l_shipdate AS DATE) AS change_date,
        l_extendedprice AS value, l_partkey AS part, l_suppkey AS supp FROM lineitem"""),
    "dirty_lines": ([], """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE WHEN l_orderkey % 5 = 0 THEN concat('"October ', CAST(l_linenumber AS VARCHAR), ', 12",', CAST(l_partkey AS VARCHAR), ',3')
             WHEN l_orderkey % 5 = 1 THEN concat('"open,', CAST(l_partkey AS VARCHAR))
             WHEN l_orderkey % 5 = 2 THEN CAST(l_partkey AS VARCHAR)
             WHEN l_orderkey % 5 = 3 THEN concat(' null , None,', CAST(l_partkey AS VARCHAR))
             ELSE concat('a,b,', CAST(l_partkey AS VARCHAR), ',extra') END AS line FROM lineitem"""),
    "messy": ([], """SELECT l_orderkey, l_linenumber, l_partkey,
        CASE l_partkey % 6 WHEN 0 THEN p WHEN 1 THEN ' ' || p || ' ' WHEN 2 THEN '' WHEN 3 THEN 'abc' WHEN 5 THEN '-7' END AS int_text,
        CASE l_partkey % 6 WHEN 0 THEN p || '.25' WHEN 1 THEN ' -' || p || '.5 ' WHEN 2 THEN ' ' WHEN 3 THEN 'NaN?'
            WHEN 5 THEN '1e3' END AS float_text,
        CASE l_partkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN ' FALSE ' WHEN 2 THEN '' WHEN 3 THEN 'maybe' WHEN 5 THEN '1' END AS bool_text,
        CASE l_partkey % 6 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%m/%d/%Y')
            WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y') WHEN 3 THEN ' ' WHEN 4 THEN 'soon' END AS date_text,
        CASE l_partkey % 6 WHEN 0 THEN p || '.5' WHEN 1 THEN p || '.0' WHEN 2 THEN p WHEN 3 THEN 'x' WHEN 4 THEN '' END AS volume_text,
        CASE l_partkey % 6 WHEN 0 THEN p || '.5%' WHEN 1 THEN p || '%' WHEN 2 THEN p WHEN 3 THEN '%' WHEN 4 THEN 'n%a' END AS percent_text,
        CASE l_partkey % 6 WHEN 0 THEN '$1,' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || '.75' WHEN 1 THEN ' $' || p
            WHEN 2 THEN p WHEN 3 THEN 'free' WHEN 4 THEN '$' END AS money_text,
        CASE l_partkey % 6 WHEN 0 THEN p || '.455' WHEN 1 THEN '0.' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')
            WHEN 2 THEN 'N/A' WHEN 3 THEN 'none' WHEN 4 THEN 'invalid' WHEN 5 THEN '999999999999.99' END AS decimal_text,
        CASE l_partkey % 6 WHEN 0 THEN '  ' || p || ' Growth Fund of the Month  ' WHEN 1 THEN p WHEN 2 THEN '  ' WHEN 3 THEN ''
            WHEN 5 THEN 'x' END AS name_text,
        CASE l_partkey % 6 WHEN 0 THEN 'NYSE' WHEN 1 THEN ' nasdaq' WHEN 2 THEN 'TSX' WHEN 3 THEN 'LSE' WHEN 5 THEN 'AMEX' END AS exchange,
        l_extendedprice - CASE WHEN l_partkey % 6 = 5 THEN 1000000 ELSE 0 END AS mkt_cap,
        l_quantity AS price, l_tax AS split, l_extendedprice, l_discount
        FROM (SELECT *, CAST(l_partkey AS VARCHAR) AS p FROM lineitem)"""),
}


def with_views(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named views and what they read."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n][1]})" for n in order)
