"""Oracle SQL (DuckDB dialect) for every registered query.

The same semantics stated as plain SQL over the pre-registered test tables, used
by the driver to check each Spark result (row count, schema, values).  Nothing of
the operators is imported: quality rules and their order are literal SQL here.
Only the parameters of the queries (dates, top-n) are shared.  Fixture relations are the SQL of
FIXTURES.md; cleaning rules are spelled out with DuckDB's regex and
``TRY_CAST`` functions.
"""

from __future__ import annotations

from shelfwise.plans.queries import AS_OF, MERGE_EXISTING_BEFORE, MERGE_INCOMING_FROM, TOP_N

# ------------------------------------------------------------------ fixtures
FIXTURE_SQL = {
    "seller_catalog": """
SELECT 'S' || CAST(l_suppkey AS STRING) AS seller_id,
       CASE WHEN l_partkey % 50 = 0 OR COUNT(*) FILTER (WHERE l_linestatus = 'O') = 0 THEN 'C' ELSE 'I' END
         || CAST(l_partkey AS STRING) AS item_id,
       MIN(p_name) AS item_name,
       MIN(p_type) AS category,
       CAST(FLOOR(MIN(p_retailprice) * (100 + l_suppkey % 7) / 25) AS DOUBLE) / 4 AS marketplace_price,
       CAST(COUNT(*) FILTER (WHERE l_linestatus = 'O') AS INT) AS stock_qty
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_suppkey, l_partkey""",
    "company_sales": """
SELECT CASE WHEN l_partkey % 3 = 0 THEN 'X' ELSE 'I' END || CAST(l_partkey AS STRING) AS item_id,
       CAST(SUM(l_quantity) AS INT) AS units_sold,
       SUM(CAST(FLOOR(l_extendedprice * 4) AS DOUBLE) / 4) AS revenue,
       MAX(CAST(l_shipdate AS DATE)) AS sale_date
FROM lineitem WHERE l_returnflag = 'N'
GROUP BY l_partkey""",
    "competitor_sales": """
SELECT 'S' || CAST(l_suppkey AS STRING) AS seller_id,
       CASE WHEN l_partkey % 5 = 0 THEN 'Y' ELSE 'I' END || CAST(l_partkey AS STRING) AS item_id,
       CAST(l_quantity AS INT) AS units_sold,
       CAST(FLOOR(l_extendedprice * 4) AS DOUBLE) / 4 AS revenue,
       CAST(FLOOR(l_extendedprice / l_quantity * 4) AS DOUBLE) / 4 AS marketplace_price,
       CAST(l_shipdate AS DATE) AS sale_date
FROM lineitem WHERE l_returnflag <> 'N'""",
    "dirty_catalog": """
WITH p AS (
  SELECT l_suppkey AS s, l_partkey AS i, l_partkey * 31 + l_suppkey AS k,
         MIN(p_name) AS n, MIN(p_type) AS c, MIN(p_retailprice) AS pr
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, l_partkey),
d AS (SELECT s, i, k, n, c, pr FROM p UNION ALL SELECT s, i, k, n, c, pr + 1 FROM p WHERE k % 17 = 0)
SELECT CASE WHEN k % 97 = 0 THEN NULL WHEN k % 103 = 0 THEN '   ' WHEN k % 11 = 0 THEN '  S' || CAST(s AS STRING) || ' ' ELSE 'S' || CAST(s AS STRING) END AS seller_id,
       CASE WHEN k % 101 = 0 THEN NULL WHEN k % 13 = 0 THEN ' I' || CAST(i AS STRING) ELSE 'I' || CAST(i AS STRING) END AS item_id,
       CASE WHEN k % 89 = 0 THEN NULL WHEN k % 107 = 0 THEN chr(9) || n WHEN k % 3 = 0 THEN UPPER(n) ELSE ' ' || n || ' ' END AS item_name,
       CASE WHEN k % 83 = 0 THEN NULL ELSE LOWER(c) END AS category,
       CASE WHEN k % 79 = 0 THEN 'n/a' WHEN k % 73 = 0 THEN NULL WHEN k % 71 = 0 THEN '-5.00' WHEN k % 47 = 0 THEN '.5' WHEN k % 43 = 0 THEN '1e2' ELSE CAST(pr AS STRING) END AS marketplace_price,
       CASE WHEN k % 67 = 0 THEN 'many' WHEN k % 61 = 0 THEN NULL WHEN k % 59 = 0 THEN '-3' WHEN k % 53 = 0 THEN '12.7' WHEN k % 43 = 0 THEN '.5' WHEN k % 41 = 0 THEN '+5'
            WHEN k % 37 = 0 THEN chr(9) || '7' WHEN k % 31 = 0 THEN '1e3' ELSE CAST(k % 200 AS STRING) END AS stock_qty
FROM d""",
    "dirty_company": """
WITH p AS (
  SELECT l_partkey AS i, l_partkey * 13 + 5 AS k, SUM(l_quantity) AS q,
         SUM(CAST(FLOOR(l_extendedprice * 4) AS DOUBLE) / 4) AS r, MAX(CAST(l_shipdate AS DATE)) AS t
  FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_partkey),
d AS (SELECT i, k, q, r, t FROM p UNION ALL SELECT i, k, q + 1, r, t FROM p WHERE k % 9 = 0)
SELECT CASE WHEN k % 31 = 0 THEN NULL WHEN k % 11 = 0 THEN ' I' || CAST(i AS STRING) || ' ' ELSE 'I' || CAST(i AS STRING) END AS item_id,
       CASE WHEN k % 29 = 0 THEN 'many' WHEN k % 23 = 0 THEN NULL WHEN k % 19 = 0 THEN '-3' WHEN k % 28 = 0 THEN '12.7' WHEN k % 26 = 0 THEN '+5' WHEN k % 22 = 0 THEN '.'
            ELSE CAST(CAST(q AS INT) AS STRING) END AS units_sold,
       CASE WHEN k % 27 = 0 THEN 'n/a' WHEN k % 25 = 0 THEN NULL WHEN k % 17 = 0 THEN '-5.5' WHEN k % 32 = 0 THEN 'NaN' WHEN k % 34 = 0 THEN '+.5' ELSE CAST(CAST(r AS DECIMAL(18,2)) AS STRING) END AS revenue,
       CASE WHEN k % 21 = 0 THEN NULL WHEN k % 37 = 0 THEN 'not-a-date' WHEN k % 15 = 0 THEN '9999-12-31' WHEN k % 16 = 0 THEN '2024-1-5'
            WHEN k % 14 = 0 THEN '2024-01-05abc' WHEN k % 12 = 0 THEN '2024-02-30' ELSE ' ' || CAST(t AS STRING) END AS sale_date
FROM d""",
    "dirty_competitor": """
WITH d AS (SELECT l_orderkey * 7 + l_linenumber AS k, l_partkey AS i, l_suppkey AS s, l_quantity AS q,
                  CAST(FLOOR(l_extendedprice * 4) AS DOUBLE) / 4 AS r,
                  CAST(FLOOR(l_extendedprice / l_quantity * 4) AS DOUBLE) / 4 AS pr, l_shipdate AS t
           FROM lineitem WHERE l_returnflag <> 'N')
SELECT CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN '  ' WHEN k % 13 = 0 THEN 'S' || CAST(s AS STRING) || '  ' ELSE 'S' || CAST(s AS STRING) END AS seller_id,
       CASE WHEN k % 97 = 0 THEN NULL WHEN k % 11 = 0 THEN ' I' || CAST(i AS STRING) ELSE 'I' || CAST(i AS STRING) END AS item_id,
       CASE WHEN k % 67 = 0 THEN 'many' WHEN k % 61 = 0 THEN NULL WHEN k % 59 = 0 THEN '-3' WHEN k % 53 = 0 THEN '12.7' WHEN k % 51 = 0 THEN '.5' WHEN k % 49 = 0 THEN '+5'
            WHEN k % 45 = 0 THEN chr(9) || '8' ELSE CAST(CAST(q AS INT) AS STRING) END AS units_sold,
       CASE WHEN k % 79 = 0 THEN 'n/a' WHEN k % 73 = 0 THEN NULL WHEN k % 71 = 0 THEN '-5.5' WHEN k % 69 = 0 THEN 'NaN' ELSE CAST(r AS STRING) END AS revenue,
       CASE WHEN k % 43 = 0 THEN 'free' WHEN k % 41 = 0 THEN '-1.0' WHEN k % 39 = 0 THEN 'NaN' ELSE CAST(pr AS STRING) END AS marketplace_price,
       CASE WHEN k % 53 = 0 THEN NULL WHEN k % 47 = 0 THEN 'not-a-date' WHEN k % 37 = 0 THEN '9999-12-31' WHEN k % 35 = 0 THEN '2024-1-5'
            WHEN k % 33 = 0 THEN '2024-01-05abc' WHEN k % 32 = 0 THEN '2024- 1- 5' WHEN k % 31 = 0 THEN '2024-13-01' ELSE CAST(CAST(t AS DATE) AS STRING) END AS sale_date
FROM d""",
}

# ------------------------------------------------------------ value rules
_DATE = r"'^(\d+)-\s*(\d+)-\s*(\d+)'"


def _int(x: str) -> str:
    s = rf"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
    return (
        rf"(CASE WHEN regexp_matches({s}, '^[+-]?(\d+(\.\d*)?|\.\d*)$') THEN "
        rf"CASE WHEN regexp_extract({s}, '^[+-]?(\d*)', 1) = '' THEN 0 "
        rf"ELSE TRY_CAST(regexp_extract({s}, '^([+-]?\d*)', 1) AS INTEGER) END END)"
    )


def _dbl(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def _zero_dbl(x: str) -> str:
    return f"COALESCE(CASE WHEN isnan({x}) THEN NULL ELSE {x} END, CAST(0 AS DOUBLE))"


def _date(x: str) -> str:
    y, m, d = (f"regexp_extract({x}, {_DATE}, {i})" for i in (1, 2, 3))
    return (
        f"(CASE WHEN regexp_matches({x}, {_DATE}) THEN TRY_CAST("
        f"(CASE WHEN length({y}) < 4 THEN lpad({y}, 4, '0') ELSE {y} END) || '-' || "
        f"CAST(TRY_CAST({m} AS INTEGER) AS VARCHAR) || '-' || CAST(TRY_CAST({d} AS INTEGER) AS VARCHAR) AS DATE) END)"
    )


def _title(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def _first_per_key(src: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {src}) WHERE rn = 1"
    )


CLEAN_SQL = {
    "clean_catalog": _first_per_key(
        f"(SELECT trim(seller_id) AS seller_id, trim(item_id) AS item_id, {_title('item_name')} AS item_name, "
        f"{_title('category')} AS category, {_dbl('marketplace_price')} AS marketplace_price, "
        f"COALESCE({_int('stock_qty')}, 0) AS stock_qty FROM dirty_catalog)",
        "seller_id, item_id",
        "item_name ASC NULLS LAST, category ASC NULLS LAST, marketplace_price ASC NULLS LAST, stock_qty ASC NULLS LAST",
    ),
    "clean_company_sales": _first_per_key(
        f"(SELECT trim(item_id) AS item_id, COALESCE({_int('units_sold')}, 0) AS units_sold, "
        f"{_zero_dbl(_dbl('revenue'))} AS revenue, {_date('trim(sale_date)')} AS sale_date FROM dirty_company)",
        "item_id",
        "units_sold ASC NULLS LAST, revenue ASC NULLS LAST, sale_date ASC NULLS LAST",
    ),
    "clean_competitor_sales": (
        f"SELECT trim(seller_id) AS seller_id, trim(item_id) AS item_id, COALESCE({_int('units_sold')}, 0) AS units_sold, "
        f"{_zero_dbl(_dbl('revenue'))} AS revenue, {_zero_dbl(_dbl('marketplace_price'))} AS marketplace_price, "
        f"{_date('trim(sale_date)')} AS sale_date FROM dirty_competitor"
    ),
}

_TODAY = f"DATE '{AS_OF}'"
_NOW = f"CAST(TIMESTAMP '{AS_OF} 00:00:00' AS TIMESTAMP)"


# The rules of each feed in the order they are checked: the first that holds names the row.
REASON_SQL = {
    "catalog": ("seller_catalog", """CASE
  WHEN seller_id IS NULL THEN 'missing_seller_id'
  WHEN item_id IS NULL THEN 'missing_item_id'
  WHEN item_name IS NULL THEN 'missing_item_name'
  WHEN category IS NULL THEN 'missing_category'
  WHEN marketplace_price IS NULL THEN 'missing_marketplace_price'
  WHEN marketplace_price < 0 THEN 'negative_marketplace_price'
  WHEN stock_qty IS NULL THEN 'missing_stock_qty'
  WHEN stock_qty < 0 THEN 'negative_stock_qty' END"""),
    "company": ("company_sales", f"""CASE
  WHEN item_id IS NULL THEN 'missing_item_id'
  WHEN units_sold IS NULL THEN 'missing_units_sold'
  WHEN units_sold < 0 THEN 'negative_units_sold'
  WHEN revenue IS NULL THEN 'missing_revenue'
  WHEN revenue < 0 THEN 'negative_revenue'
  WHEN sale_date IS NULL THEN 'missing_sale_date'
  WHEN sale_date > {_TODAY} THEN 'future_sale_date' END"""),
    "competitor": ("competitor_sales", f"""CASE
  WHEN item_id IS NULL THEN 'missing_item_id'
  WHEN seller_id IS NULL THEN 'missing_seller_id'
  WHEN marketplace_price IS NULL THEN 'missing_marketplace_price'
  WHEN marketplace_price < 0 THEN 'negative_marketplace_price'
  WHEN units_sold IS NULL THEN 'missing_units_sold'
  WHEN units_sold < 0 THEN 'negative_units_sold'
  WHEN revenue IS NULL THEN 'missing_revenue'
  WHEN revenue < 0 THEN 'negative_revenue'
  WHEN sale_date IS NULL THEN 'missing_sale_date'
  WHEN sale_date > {_TODAY} THEN 'future_sale_date' END"""),
}
_CLEAN_OF = {"catalog": "clean_catalog", "company": "clean_company_sales", "competitor": "clean_competitor_sales"}
_RAW_OF = {"catalog": "dirty_catalog", "company": "dirty_company", "competitor": "dirty_competitor"}


def _with(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + body


def _tagged_ctes(ds: str) -> list[tuple[str, str]]:
    clean = _CLEAN_OF[ds]
    _, reason = REASON_SQL[ds]
    return [
        (_RAW_OF[ds], FIXTURE_SQL[_RAW_OF[ds]]),
        (clean, CLEAN_SQL[clean]),
        (f"tagged_{ds}", f"SELECT *, {reason} AS dq_failure_reason FROM {clean}"),
    ]


def _valid_ctes(ds: str) -> list[tuple[str, str]]:
    return _tagged_ctes(ds) + [(
        f"valid_{ds}",
        f"SELECT * EXCLUDE (dq_failure_reason), {_NOW} AS ingestion_timestamp FROM tagged_{ds} "
        f"WHERE dq_failure_reason IS NULL",
    )]


def _gold_competitor(src: str) -> str:
    return _first_per_key(
        src, "seller_id, item_id",
        "sale_date DESC NULLS LAST, units_sold ASC NULLS LAST, revenue ASC NULLS LAST, "
        "marketplace_price ASC NULLS LAST",
    )


_GOLD_CTES = [
    ("seller_catalog", FIXTURE_SQL["seller_catalog"]),
    ("company_sales", FIXTURE_SQL["company_sales"]),
    ("competitor_sales", FIXTURE_SQL["competitor_sales"]),
    ("competitor_gold", _gold_competitor("competitor_sales")),
]

_DIM = (
    "SELECT item_id, arg_min(item_name, seller_id) FILTER (WHERE item_name IS NOT NULL) AS item_name, "
    "arg_min(category, seller_id) FILTER (WHERE category IS NOT NULL) AS category, "
    "avg(marketplace_price) AS catalog_price FROM {cat} WHERE item_id IS NOT NULL GROUP BY item_id"
)
_COMPANY_M = (
    "SELECT item_id, CAST(SUM(units_sold) AS BIGINT) AS company_units_sold, SUM(revenue) AS company_revenue "
    "FROM {com} GROUP BY item_id"
)
_COMPETITOR_M = (
    "SELECT item_id, CAST(SUM(units_sold) AS BIGINT) AS competitor_units_sold, SUM(revenue) AS competitor_revenue, "
    "AVG(marketplace_price) AS competitor_avg_price FROM {cmp} GROUP BY item_id"
)
_COUNTS = "SELECT item_id, COUNT(DISTINCT seller_id) AS seller_count FROM {cat} GROUP BY item_id"
_MERGED = """SELECT *, company_units_sold + competitor_units_sold AS total_units_sold,
       CASE WHEN company_units_sold > 0 THEN company_revenue / company_units_sold END AS company_price_estimate
FROM (SELECT COALESCE(c.item_id, p.item_id) AS item_id,
             COALESCE(CAST(c.company_units_sold AS DOUBLE), CAST(0 AS DOUBLE)) AS company_units_sold,
             COALESCE(c.company_revenue, CAST(0 AS DOUBLE)) AS company_revenue,
             COALESCE(CAST(p.competitor_units_sold AS DOUBLE), CAST(0 AS DOUBLE)) AS competitor_units_sold,
             COALESCE(p.competitor_revenue, CAST(0 AS DOUBLE)) AS competitor_revenue,
             p.competitor_avg_price
      FROM company_m c FULL OUTER JOIN competitor_m p ON c.item_id = p.item_id)"""
_PRICED = """SELECT m.*, d.item_name, d.category, d.catalog_price,
       CASE WHEN s.seller_count IS NULL OR s.seller_count <= 0 THEN 1 ELSE s.seller_count END AS seller_count,
       CASE WHEN m.competitor_avg_price > 0 THEN m.competitor_avg_price
            WHEN m.company_price_estimate > 0 THEN m.company_price_estimate
            ELSE d.catalog_price END AS market_price
FROM merged m JOIN dim d ON m.item_id = d.item_id LEFT JOIN counts s ON m.item_id = s.item_id"""
_METRICS = """SELECT item_id, company_units_sold, company_revenue, competitor_units_sold, competitor_revenue,
       competitor_avg_price, total_units_sold, company_price_estimate, item_name, category, catalog_price,
       seller_count, market_price, total_units_sold / seller_count AS expected_units_sold,
       (total_units_sold / seller_count) * market_price AS expected_revenue
FROM priced WHERE total_units_sold > 0 AND market_price IS NOT NULL AND market_price > 0"""
_TOP = f"""SELECT item_id, item_name, category, market_price, expected_units_sold, expected_revenue, total_units_sold
FROM metrics WHERE item_name IS NOT NULL AND category IS NOT NULL
ORDER BY total_units_sold DESC, item_id ASC LIMIT {TOP_N}"""
_CANDIDATES = "SELECT s.seller_id, t.item_id FROM (SELECT DISTINCT seller_id FROM {cat}) s CROSS JOIN top_items t"
_MISSING = (
    "SELECT c.* FROM candidates c WHERE NOT EXISTS "
    "(SELECT 1 FROM {cat} x WHERE x.seller_id = c.seller_id AND x.item_id = c.item_id)"
)
_RECS = """SELECT m.seller_id, t.item_id, t.item_name, t.category, t.market_price, t.expected_units_sold,
       t.expected_revenue FROM missing m JOIN top_items t ON m.item_id = t.item_id"""


def _market_ctes(cat: str, com: str, cmp: str, upto: str) -> list[tuple[str, str]]:
    steps = [
        ("dim", _DIM.format(cat=cat)), ("company_m", _COMPANY_M.format(com=com)),
        ("competitor_m", _COMPETITOR_M.format(cmp=cmp)), ("counts", _COUNTS.format(cat=cat)),
        ("merged", _MERGED), ("priced", _PRICED), ("metrics", _METRICS), ("top_items", _TOP),
        ("candidates", _CANDIDATES.format(cat=cat)), ("missing", _MISSING.format(cat=cat)),
        ("recommendations", _RECS),
    ]
    names = [n for n, _ in steps]
    return steps[: names.index(upto) + 1]


def _market(upto: str, body: str | None = None, gold=_GOLD_CTES, cat="seller_catalog",
            com="company_sales", cmp="competitor_gold") -> str:
    return _with(gold + _market_ctes(cat, com, cmp, upto), body or f"SELECT * FROM {upto}")


def _cols(cols: str, src: str) -> str:
    return f"SELECT {cols} FROM {src}"


def _build() -> dict[str, str]:
    q: dict[str, str] = {}
    for name, raw in (("clean_catalog", "dirty_catalog"), ("clean_company_sales", "dirty_company"),
                      ("clean_competitor_sales", "dirty_competitor")):
        q[name] = _with([(raw, FIXTURE_SQL[raw])], CLEAN_SQL[name])
    for ds, columns in (("catalog", "seller_id item_id item_name category marketplace_price stock_qty"),
                        ("company", "item_id units_sold revenue sale_date"),
                        ("competitor", "seller_id item_id units_sold revenue marketplace_price sale_date")):
        raw = _RAW_OF[ds]
        q[f"bronze_parse_{ds}"] = _with([(raw, FIXTURE_SQL[raw])], _cols(
            ", ".join(f"NULLIF({c}, '') AS {c}" for c in columns.split()), raw))
    for ds in ("catalog", "company", "competitor"):
        q[f"dq_valid_{ds}"] = _with(_valid_ctes(ds), f"SELECT * FROM valid_{ds}")
        dataset, _ = REASON_SQL[ds]
        q[f"quarantine_{ds}"] = _with(
            _tagged_ctes(ds),
            f"SELECT *, {_NOW} AS ingestion_timestamp, '{dataset}' AS dataset_name FROM tagged_{ds} "
            f"WHERE dq_failure_reason IS NOT NULL",
        )
    all_tagged = sum((_tagged_ctes(ds) for ds in ("catalog", "company", "competitor")), [])
    q["dq_metrics"] = _with(all_tagged, "\nUNION ALL\n".join(
        f"SELECT '{REASON_SQL[ds][0]}' AS dataset_name, (SELECT COUNT(*) FROM {_RAW_OF[ds]}) AS raw_rows, "
        f"COUNT(*) AS clean_rows, COUNT(*) FILTER (WHERE dq_failure_reason IS NULL) AS valid_rows, "
        f"COUNT(*) FILTER (WHERE dq_failure_reason IS NOT NULL) AS invalid_rows FROM tagged_{ds}"
        for ds in ("catalog", "company", "competitor")))
    q["dq_reason_counts"] = _with(all_tagged, "\nUNION ALL\n".join(
        f"SELECT '{REASON_SQL[ds][0]}' AS dataset_name, COALESCE(dq_failure_reason, 'VALID') AS outcome, "
        f"COUNT(*) AS rows FROM tagged_{ds} GROUP BY 1, 2"
        for ds in ("catalog", "company", "competitor")))
    q["upsert_latest_competitor"] = _with([("competitor_sales", FIXTURE_SQL["competitor_sales"])],
                                          _gold_competitor("competitor_sales"))
    q["upsert_merge_existing"] = _with(
        [("competitor_sales", FIXTURE_SQL["competitor_sales"]),
         ("existing", _gold_competitor(f"(SELECT * FROM competitor_sales WHERE sale_date < DATE '{MERGE_EXISTING_BEFORE}')")),
         ("incoming", f"SELECT *, 'marketplace' AS channel FROM competitor_sales WHERE sale_date >= DATE '{MERGE_INCOMING_FROM}'"),
         ("both_sides", "SELECT *, 0 AS src FROM incoming UNION ALL SELECT *, CAST(NULL AS VARCHAR) AS channel, 1 AS src FROM existing")],
        "SELECT seller_id, item_id, units_sold, revenue, marketplace_price, sale_date, channel FROM ("
        + _first_per_key("both_sides", "seller_id, item_id",
                         "sale_date DESC NULLS LAST, src ASC, units_sold ASC NULLS LAST, revenue ASC NULLS LAST, "
                         "marketplace_price ASC NULLS LAST, channel ASC NULLS LAST") + ")",
    )
    q["item_dimension"] = _with([("seller_catalog", FIXTURE_SQL["seller_catalog"])], _DIM.format(cat="seller_catalog"))
    q["company_metrics"] = _with([("company_sales", FIXTURE_SQL["company_sales"])], _COMPANY_M.format(com="company_sales"))
    q["competitor_metrics"] = _market("competitor_m")
    q["seller_item_counts"] = _with([("seller_catalog", FIXTURE_SQL["seller_catalog"])], _COUNTS.format(cat="seller_catalog"))
    q["sales_full_outer"] = _market("merged")
    q["item_metrics"] = _market("metrics")
    q["item_metrics_fused"] = q["item_metrics"]
    q["item_metrics_keyed"] = q["item_metrics"]
    q["market_price"] = _market(
        "priced", "SELECT item_id, competitor_avg_price, company_price_estimate, catalog_price, market_price FROM priced")
    q["top_items"] = _market("top_items")
    q["top_items_pruned"] = q["top_items"]
    q["candidate_pairs"] = _market("candidates")
    q["missing_pairs"] = _market("missing")
    q["recommendations"] = _market("recommendations")
    q["recommendations_uncollapsed"] = _market("recommendations", cmp="competitor_sales")
    raw_gold = (_valid_ctes("catalog") + _valid_ctes("company") + _valid_ctes("competitor")
                + [("competitor_gold", _gold_competitor("(SELECT * EXCLUDE (ingestion_timestamp) FROM valid_competitor)"))])
    q["recommendations_from_raw"] = _market("recommendations", gold=raw_gold, cat="valid_catalog",
                                            com="valid_company", cmp="competitor_gold")
    return q


ORACLE_SQL: dict[str, str] = _build()
