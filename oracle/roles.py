"""DuckDB CTEs that build the eight role tables from the raw test tables.

Only the raw tables are registered as views in the oracle run, so every oracle query starts
with ``WITH`` + ``ROLE_CTES``. The rules equal ``demandlens.sources.testdata``.
"""

AS_OF_SQL = "DATE '1998-06-15'"

_STORE = "CASE WHEN {n} % 10 = 9 THEN 'L00' || ({n} % 3 + 1)::VARCHAR ELSE 'S' || ({n})::VARCHAR END"
_SOLD = "(l_quantity::DECIMAL(18,3) + (l_linenumber * 37)::DECIMAL(18,3) * 0.001)::DECIMAL(18,3)"

ROLE_CTES = f"""
lines AS (
    SELECT l_partkey AS part, l_partkey::VARCHAR AS material, l_partkey // 50 + l_linenumber % 2 AS n,
           {AS_OF_SQL} + (-16 + (l_orderkey * 7 + l_linenumber * 11) % 40)::INTEGER AS day,
           {_SOLD} AS sold, l_orderkey % 20 = 0 AS diag, l_orderkey % 50 = 1 AS promo,
           l_orderkey % 3 = 0 AS part_of_three,
           l_linenumber AS ln
    FROM lineitem
),
forecast AS (
    SELECT *, system_forecast + coalesce(s4_adjustment, 0) + coalesce(car_adjustment, 0)
                AS approved_forecast
    FROM (SELECT material, {_STORE.format(n='n')} AS store, day AS forecast_date,
                 least(day, {AS_OF_SQL}) AS snapshot_date, if(diag, 'D1', '') AS diag_id,
                 if(promo, 'P1', '') AS ofr_id, promo::INTEGER AS promo_flag,
                 sum(sold)::DECIMAL(18,3) AS system_forecast,
                 sum(sold * -0.75) FILTER (ln IN (2, 6, 7))::DECIMAL(18,3) AS s4_adjustment,
                 sum(-sold) FILTER (ln <= 4)::DECIMAL(18,3) AS car_adjustment
          FROM lines GROUP BY ALL)
),
sales_stock AS (
    SELECT caldate, material, {_STORE.format(n='n')} AS plant, promo::INTEGER AS ispromo,
           ['PD', 'ND', 'ZK', 'ZR', 'ZC', 'ZD', 'XX', NULL][(part + n) % 8 + 1] AS dismm,
           sum(went)::DECIMAL(18,3) AS sc_quantity
    FROM (SELECT *, day AS caldate, sold::DECIMAL(20,5) AS went FROM lines
          UNION ALL SELECT *, (day - INTERVAL 1 YEAR)::DATE,
                           if(part_of_three, sold::DECIMAL(20,5), (sold * 0.25)::DECIMAL(20,5))
                    FROM lines)
    GROUP BY ALL
),
product_dict AS (
    SELECT p_partkey::VARCHAR AS material, p_brand AS manager, p_name AS name,
           p_type AS node_2, 'Type ' || p_type AS node_2_name,
           p_brand AS node_3, 'Brand ' || p_brand AS node_3_name,
           p_type || '-' || p_brand AS node_4, p_type || ' ' || p_brand AS node_4_name,
           p_partkey::VARCHAR AS node_5, p_name AS node_5_name
    FROM part
),
assortment AS (
    SELECT DISTINCT material AS plu, {_STORE.format(n='n')} AS zavod,
           if((part + n) % 5 = 0, 'ND', 'AZ') AS az_type
    FROM lines
),
store_dict AS (
    SELECT DISTINCT {_STORE.format(n='n')} AS number,
           CASE WHEN n % 10 = 9 THEN 'DC' WHEN n % 7 < 3 THEN 'Mahalla'
                WHEN n % 7 < 6 THEN 'Supermarket' ELSE 'Express' END AS type_cf
    FROM (SELECT unnest([p_partkey // 50, p_partkey // 50 + 1]) AS n FROM part)
),
daily_sales AS (
    SELECT l_shipdate::DATE AS calc_date, l_partkey::VARCHAR AS plu,
           CASE l_suppkey % 10 WHEN 9 THEN 'L00' WHEN 8 THEN 'R00' WHEN 7 THEN 'B00'
                ELSE 'S' || (l_suppkey % 7)::VARCHAR END AS zavod,
           sum({_SOLD})::DECIMAL(18,3) AS sc_quantity,
           coalesce(sum({_SOLD}) FILTER (l_orderkey % 50 <> 1), 0)::DECIMAL(18,3)
             AS sc_quantity_not_anypromo
    FROM lineitem GROUP BY ALL
),
plu_cat AS (
    SELECT p_partkey::VARCHAR AS plu, p_brand AS km, p_type AS ui_5, p_type AS ui_5_name
    FROM part WHERE p_partkey % 11 <> 0
),
user_login AS (
    SELECT DISTINCT p_brand AS category_manager, 'user_' || lower(p_brand) AS "user"
    FROM part WHERE NOT suffix(p_brand, '3')
)"""


def with_roles(*ctes: str, role_ctes: bool = True) -> str:
    """``WITH`` clause holding the role CTEs followed by ``ctes`` (each ``name AS (...)``).

    With ``role_ctes=False`` the roles are expected as registered views (hand-made tables).
    """
    parts = ((ROLE_CTES.strip(),) if role_ctes else ()) + tuple(c.strip() for c in ctes)
    return ("WITH " + ",\n".join(parts)) if parts else ""
