"""Plain SQL over the test tables, written independently of the Spark plans.

``sql(body, "name", ...)`` puts the named common table expressions, and those they build on, in front
of a query.
"""

from __future__ import annotations

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], text: str) -> None:
    _CTES[name] = (needs, text.strip())


_cte(
    "retail",
    (),
    """
SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
       CAST(l_partkey AS VARCHAR) AS StockCode,
       p_name AS Description,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS Quantity,
       strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate,
       CASE WHEN p_size = 25 THEN 0.0 ELSE p_retailprice END AS UnitPrice,
       CASE WHEN l_linenumber <> 7 THEN o_custkey END AS CustomerID,
       n_name AS Country
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
""",
)
_cte(
    "clean",
    ("retail",),
    """
SELECT *, Quantity * UnitPrice AS Revenue, strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS InvoiceTs
FROM retail
WHERE CustomerID IS NOT NULL AND InvoiceNo IS NOT NULL AND Quantity > 0 AND UnitPrice > 0
""",
)
_cte(
    "activity",
    (),
    """
SELECT user_id, count(*) AS n_events, sum(value) AS sum_value,
       count(*) FILTER (WHERE event_type = 'signup') AS n_signups,
       count(*) FILTER (WHERE event_type = 'purchase' AND value > 50) AS n_bought
FROM events GROUP BY user_id
""",
)
_cte(
    "bank_once",
    ("activity",),
    """
SELECT c_custkey,
       CAST(18 + c_custkey % 60 AS DOUBLE) AS age,
       c_mktsegment AS job,
       CASE c_custkey % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'married' ELSE 'divorced' END AS marital,
       r_name AS education,
       CASE WHEN c_custkey % 53 = 0 THEN 'yes' ELSE 'no' END AS "default",
       CASE WHEN c_custkey % 20 <> 0 THEN c_acctbal END AS balance,
       CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS housing,
       CASE WHEN c_custkey % 5 = 0 THEN 'yes' ELSE 'no' END AS loan,
       CASE c_custkey % 4 WHEN 0 THEN 'telephone' WHEN 1 THEN 'unknown' ELSE 'cellular' END AS contact,
       CAST(1 + c_custkey % 31 AS DOUBLE) AS day,
       lower(strftime(make_date(2000, CAST(1 + c_custkey % 12 AS INTEGER), 1), '%b')) AS month,
       round(coalesce(sum_value, 0.0), 2) AS duration,
       CAST(coalesce(n_events, 0) AS DOUBLE) AS campaign,
       CAST(CASE WHEN coalesce(n_events, 0) = 0 THEN -1 ELSE c_custkey % 400 END AS DOUBLE) AS pdays,
       CAST(coalesce(n_signups, 0) AS DOUBLE) AS previous,
       CASE c_custkey % 7 WHEN 0 THEN 'success' WHEN 1 THEN 'failure' ELSE 'unknown' END AS poutcome,
       CASE WHEN coalesce(n_bought, 0) > 0 THEN 'yes' ELSE 'no' END AS y
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN activity ON c_custkey = user_id
""",
)
_cte("bank", ("bank_once",), "SELECT * FROM bank_once UNION ALL SELECT * FROM bank_once WHERE c_custkey % 10 = 0")
_cte(
    "bank_clean",
    ("bank",),
    'SELECT DISTINCT * RENAME ("default" AS credit_default) FROM bank WHERE balance IS NOT NULL AND age IS NOT NULL',
)
_cte(
    "rollup",
    ("clean",),
    """
SELECT CustomerID, count(DISTINCT InvoiceNo) AS total_invoices, sum(Revenue) AS total_revenue,
       max(InvoiceTs) AS last_purchase_date, first(Country ORDER BY InvoiceTs, Country) AS country
FROM clean GROUP BY CustomerID
""",
)
_cte("numbered", ("rollup",), "SELECT CustomerID, row_number() OVER (ORDER BY CustomerID) AS row_idx FROM rollup")
_cte(
    "ranked",
    ("bank_clean",),
    "SELECT *, row_number() OVER (PARTITION BY job ORDER BY age, c_custkey) AS rank_in_job FROM bank_clean",
)
_cte(
    "keyed",
    ("ranked", "numbered"),
    "SELECT *, rank_in_job % (SELECT max(row_idx) FROM numbered) + 1 AS row_idx FROM ranked",
)
_cte(
    "silver",
    ("keyed", "rollup"),
    """
SELECT CustomerID, keyed.* EXCLUDE (rank_in_job, row_idx), total_invoices, total_revenue,
       last_purchase_date, country
FROM keyed LEFT JOIN numbered USING (row_idx) LEFT JOIN rollup USING (CustomerID)
""",
)
_cte(
    "rfm",
    ("clean",),
    """
SELECT CustomerID,
       CAST(coalesce(date_diff('day', max(InvoiceTs), (SELECT max(InvoiceTs) FROM clean)), 999) AS INTEGER) AS Recency,
       count(DISTINCT InvoiceNo) AS Frequency,
       coalesce(sum(Quantity * UnitPrice), 0.0) AS Monetary
FROM clean GROUP BY CustomerID
""",
)
_cte(
    "joined",
    ("silver", "rfm"),
    """
SELECT silver.*, coalesce(Recency, 999) AS Recency, coalesce(Frequency, 0) AS Frequency,
       coalesce(Monetary, 0.0) AS Monetary
FROM silver LEFT JOIN rfm USING (CustomerID)
""",
)
_cte(
    "gold",
    ("joined",),
    """
SELECT * REPLACE (CAST(Recency AS DOUBLE) AS Recency),
       CASE WHEN balance > 0 THEN balance / (balance + 1) ELSE 0.0 END AS debt_to_balance_ratio,
       CAST(housing = 'yes' AS INTEGER) AS has_housing_loan,
       CAST(loan = 'yes' AS INTEGER) AS has_personal_loan,
       CASE WHEN credit_default = 'yes' OR balance < 0 THEN 1 ELSE 0 END AS risk_score
FROM joined
""",
)
_cte(
    "caps",
    ("rfm",),
    """
SELECT quantile_cont(CAST(Recency AS DOUBLE), 0.95) AS r, quantile_cont(CAST(Frequency AS DOUBLE), 0.95) AS f,
       quantile_cont(Monetary, 0.95) AS m
FROM rfm
""",
)
_cte(
    "capped",
    ("rfm", "caps"),
    """
SELECT CustomerID, least(CAST(Recency AS DOUBLE), r) AS Recency, least(CAST(Frequency AS DOUBLE), f) AS Frequency,
       least(Monetary, m) AS Monetary
FROM rfm CROSS JOIN caps
""",
)


def _chain(names: tuple[str, ...], seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in seen:
            needs, text = _CTES[name]
            _chain(needs, seen)
            seen[name] = text
    return seen


def sql(body: str, *names: str) -> str:
    ctes = _chain(names, {})
    head = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in ctes.items())
    return f"WITH {head}\n{body.strip()}" if head else body.strip()
