"""DuckDB SQL equal to each registered query, over the pre-registered test tables.

Shared CTEs rebuild the stand-in inputs (FIXTURES.md §1) and the first-load
dimensions; each query then adds its own SELECT.  Unit prices use integer arithmetic
(half-up), since DuckDB divides decimals as doubles.
"""

from __future__ import annotations

# --- base CTEs ---------------------------------------------------------------------------
_CTE = {
    "products_t": """SELECT CAST(p_partkey AS INTEGER) AS ProductID, p_name AS ProductName,
        p_type AS Category, CAST(p_retailprice AS DECIMAL(18,2)) AS Price,
        CAST(p_size AS INTEGER) AS Stock FROM part""",
    "customers_t": """SELECT CAST(c.c_custkey AS INTEGER) AS CustomerID,
        split_part(c.c_name, '#', 1) AS FirstName,
        string_split(c.c_name, '#')[-1] AS LastName,
        lower(replace(c.c_name, '#', '.')) || '@example.com' AS Email,
        lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS Phone,
        COALESCE(g.n_name, '') AS City, COALESCE(g.r_name, '') AS Country
        FROM customer c LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation
             JOIN region ON n_regionkey = r_regionkey) g ON c.c_nationkey = g.n_nationkey""",
    "orders_t": """SELECT CAST(o_orderkey AS INTEGER) AS OrderID, CAST(o_custkey AS INTEGER) AS CustomerID,
        CAST(o_orderdate AS DATE) AS OrderDate, o_orderstatus AS Status FROM orders""",
    "details_t": """SELECT CAST(l_orderkey AS INTEGER) AS OrderID, CAST(l_partkey AS INTEGER) AS ProductID,
        CAST(l_quantity AS INTEGER) AS Quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS TotalPrice
        FROM lineitem""",
    "uniq": """SELECT OrderID, ProductID, Quantity, TotalPrice FROM (
        SELECT *, row_number() OVER (PARTITION BY OrderID, ProductID
                                     ORDER BY TotalPrice DESC, Quantity DESC) AS rn
        FROM details_t) WHERE rn = 1""",
    "db_orders_t": """SELECT CAST(o_orderkey AS INTEGER) AS PedidoId, CAST(o_custkey AS INTEGER) AS ClienteId,
        CAST(o_orderdate AS DATE) AS FechaPedido, o_orderstatus AS Estado,
        CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS FechaCreacion FROM orders""",
    "db_details_t": """SELECT CAST(u.OrderID AS BIGINT) * 1000000 + u.ProductID AS DetallePedidoId,
        u.OrderID AS PedidoId, u.ProductID AS ProductoId, u.Quantity AS Cantidad,
        {UP} AS PrecioUnitario, u.TotalPrice AS PrecioTotal, o.FechaCreacion
        FROM uniq u LEFT JOIN db_orders_t o ON u.OrderID = o.PedidoId""",
    "api_t": """SELECT CAST(p_partkey AS INTEGER) AS ProductID, upper(p_name) AS ProductName,
        p_type AS Category, CAST(p_retailprice AS DECIMAL(18,2)) AS Price,
        CAST(p_size AS INTEGER) AS Stock FROM part""",
    # first-load dimensions
    "d_status": """SELECT CAST(row_number() OVER (ORDER BY status) AS BIGINT) AS status_key, status
        FROM (SELECT DISTINCT upper(trim(o_orderstatus)) AS status FROM orders)
        UNION ALL SELECT -1, 'UNKNOWN'""",
    "d_customer": """SELECT CAST(row_number() OVER (ORDER BY CustomerID) AS BIGINT) AS customer_key,
        1 AS source_key, CustomerID AS customer_id,
        {CLEAN_FirstName} AS first_name, {CLEAN_LastName} AS last_name,
        nullif(lower(regexp_replace(Email, '\\s+', '', 'g')), '') AS email,
        {CLEAN_Phone} AS phone, {CLEAN_City} AS city, {CLEAN_Country} AS country
        FROM customers_t
        UNION ALL SELECT -1, -1, -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN'""",
    "prod_members": """SELECT 1 AS source_key, ProductID AS product_id, ProductName, Category, Price, Stock
        FROM products_t UNION ALL
        SELECT 3, ProductID, ProductName, Category, Price, Stock FROM api_t""",
    "d_product": """SELECT CAST(row_number() OVER (ORDER BY source_key, product_id) AS BIGINT) AS product_key,
        source_key, product_id, {CLEAN_ProductName} AS product_name, {CLEAN_Category} AS category,
        Price AS price, Stock AS stock FROM prod_members
        UNION ALL SELECT -1, -1, -1, 'UNKNOWN', 'UNKNOWN', NULL, NULL""",
    "d_date": """SELECT CAST(year(d)*10000 + month(d)*100 + day(d) AS INTEGER) AS date_key, d AS date,
        CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
        CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
        dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
        dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(t.g AS DATE) AS d FROM
              (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) s,
              generate_series(CAST(s.lo AS TIMESTAMP), CAST(s.hi AS TIMESTAMP), INTERVAL 1 DAY) AS t(g))
        UNION ALL SELECT -1, NULL, NULL, NULL, NULL, 'UNKNOWN', NULL, NULL, 'UNKNOWN', NULL, NULL""",
    "d_source": """SELECT * FROM (VALUES (1, 'CSV', 'file'), (2, 'DATABASE', 'relational'),
        (3, 'API', 'rest'), (-1, 'UNKNOWN', 'UNKNOWN')) t(source_key, source_name, source_type)""",
    "joined": """SELECT u.OrderID, u.ProductID, u.Quantity, u.TotalPrice, o.CustomerID, o.OrderDate,
        upper(trim(o.Status)) AS Status FROM uniq u JOIN orders_t o ON u.OrderID = o.OrderID""",
    "keyed": """SELECT j.*, CAST(year(j.OrderDate)*10000 + month(j.OrderDate)*100 + day(j.OrderDate) AS INTEGER) AS date_key,
        COALESCE(c.customer_key, -1) AS customer_key, COALESCE(p.product_key, -1) AS product_key,
        COALESCE(s.status_key, -1) AS status_key, 1 AS source_key
        FROM joined j
        LEFT JOIN d_customer c ON c.source_key = 1 AND c.customer_id = j.CustomerID
        LEFT JOIN d_product p ON p.source_key = 1 AND p.product_id = j.ProductID
        LEFT JOIN d_status s ON s.status = j.Status""",
    "fact": """SELECT date_key, customer_key, product_key, status_key, source_key,
        OrderID AS order_number, Quantity AS quantity, {UP_K} AS unit_price, TotalPrice AS total_amount
        FROM keyed""",
}

# unit price = total / quantity, half-up to cents, in integer arithmetic
_UP = "CAST(((CAST(round({t} * 100) AS BIGINT) * 2 + {q}) // (2 * {q})) / 100 AS DECIMAL(18,2))"


def _clean(col: str) -> str:
    return f"nullif(trim(regexp_replace({col}, '\\s+', ' ', 'g')), '')"


def _fill(sql: str) -> str:
    sql = sql.replace("{UP}", _UP.format(t="u.TotalPrice", q="u.Quantity"))
    sql = sql.replace("{UP_K}", _UP.format(t="TotalPrice", q="Quantity"))
    for col in ("FirstName", "LastName", "Phone", "City", "Country", "ProductName", "Category"):
        sql = sql.replace("{CLEAN_" + col + "}", _clean(col))
    return sql


_DEPS = {
    "uniq": ["details_t"], "db_details_t": ["uniq", "db_orders_t"],
    "d_customer": ["customers_t"], "prod_members": ["products_t", "api_t"],
    "d_product": ["prod_members"], "joined": ["uniq", "orders_t"],
    "keyed": ["joined", "d_customer", "d_product", "d_status"], "fact": ["keyed"],
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_fill(_CTE[n])})" for n in order) + "\n"


def _txt_dec(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


_STG = {
    "products": "SELECT CAST(ProductID AS VARCHAR) AS ProductID, ProductName, Category, "
                "CAST(Price AS VARCHAR) AS Price, CAST(Stock AS VARCHAR) AS Stock FROM products_t",
    "customers": "SELECT CAST(CustomerID AS VARCHAR) AS CustomerID, FirstName, LastName, Email, Phone, "
                 "City, Country FROM customers_t",
    "orders": "SELECT CAST(OrderID AS VARCHAR) AS OrderID, CAST(CustomerID AS VARCHAR) AS CustomerID, "
              "strftime(OrderDate, '%Y-%m-%d') AS OrderDate, Status FROM orders_t",
    "order_details": "SELECT CAST(OrderID AS VARCHAR) AS OrderID, CAST(ProductID AS VARCHAR) AS ProductID, "
                     "CAST(Quantity AS VARCHAR) AS Quantity, CAST(TotalPrice AS VARCHAR) AS TotalPrice "
                     "FROM details_t",
    "db_orders": "SELECT CAST(PedidoId AS VARCHAR) AS PedidoId, CAST(ClienteId AS VARCHAR) AS ClienteId, "
                 "strftime(FechaPedido, '%Y-%m-%d') AS FechaPedido, Estado, "
                 "strftime(FechaCreacion, '%Y-%m-%d %H:%M:%S.%f') || '0' AS FechaCreacion FROM db_orders_t",
    "db_order_details": "SELECT CAST(DetallePedidoId AS VARCHAR) AS DetallePedidoId, "
                        "CAST(PedidoId AS VARCHAR) AS PedidoId, CAST(ProductoId AS VARCHAR) AS ProductoId, "
                        "CAST(Cantidad AS VARCHAR) AS Cantidad, CAST(PrecioUnitario AS VARCHAR) AS PrecioUnitario, "
                        "CAST(PrecioTotal AS VARCHAR) AS PrecioTotal, "
                        "strftime(FechaCreacion, '%Y-%m-%d %H:%M:%S.%f') || '0' AS FechaCreacion "
                        "FROM db_details_t",
    "api_products": "SELECT CAST(ProductID AS VARCHAR) AS ProductID, ProductName, Category, "
                    "CAST(Price AS VARCHAR) AS Price, CAST(Stock AS VARCHAR) AS Stock FROM api_t",
}
_STG_SRC = {"products": "products_t", "customers": "customers_t", "orders": "orders_t",
            "order_details": "details_t", "db_orders": "db_orders_t",
            "db_order_details": "db_details_t", "api_products": "api_t"}


def _stg(table: str, alias: str | None = None) -> str:
    """A CTE list that ends with ``<alias or stg_table>`` holding the staged text."""
    return _with(_STG_SRC[table])[:-1] + f",\n{alias or 'stg_' + table} AS ({_STG[table]})\n"


def _sales(axis_sql: str, group: str, join: str) -> str:
    return _with("fact", "d_date", "d_product", "d_customer", "d_status") + f"""
SELECT {axis_sql}, CAST(count(DISTINCT f.order_number) AS BIGINT) AS n_orders,
       CAST(sum(f.quantity) AS BIGINT) AS quantity, sum(f.total_amount) AS amount
FROM fact f {join} GROUP BY {group}"""


_DETAIL_REASON = """CASE
  WHEN TRY_CAST(OrderID AS INTEGER) IS NULL THEN 'OrderID not an integer'
  WHEN TRY_CAST(ProductID AS INTEGER) IS NULL THEN 'ProductID not an integer'
  WHEN TRY_CAST(Quantity AS INTEGER) IS NULL THEN 'Quantity not an integer'
  WHEN TRY_CAST(replace(TotalPrice, ',', '') AS DECIMAL(18,2)) IS NULL THEN 'TotalPrice not a decimal'
  WHEN TRY_CAST(Quantity AS INTEGER) <= 0 THEN 'Quantity not positive'
  WHEN TRY_CAST(replace(TotalPrice, ',', '') AS DECIMAL(18,2)) < 0 THEN 'TotalPrice negative'
END"""

_CORRUPT_DETAILS = """corrupt AS (SELECT OrderID, ProductID,
    CASE WHEN CAST(OrderID AS INTEGER) % 50 = 0 THEN 'x' || Quantity
         WHEN CAST(OrderID AS INTEGER) % 70 = 0 THEN '0' ELSE Quantity END AS Quantity,
    CASE WHEN CAST(ProductID AS INTEGER) % 97 = 0 THEN '-' || TotalPrice ELSE TotalPrice END AS TotalPrice
  FROM stg_order_details)"""

_CORRUPT_ORDERS = """corrupt AS (SELECT
    CASE WHEN CAST(OrderID AS INTEGER) % 50 = 0 THEN 'x' || OrderID ELSE OrderID END AS OrderID,
    CASE WHEN CAST(OrderID AS INTEGER) % 90 = 0 THEN '' ELSE CustomerID END AS CustomerID,
    CASE WHEN CAST(OrderID AS INTEGER) % 70 = 0 THEN '2024-02-30' ELSE OrderDate END AS OrderDate,
    Status FROM stg_orders)"""

_PADDED = """padded AS (SELECT CustomerID,
    CASE WHEN CAST(CustomerID AS INTEGER) % 3 = 0 THEN '  ' || FirstName || ' ' ELSE FirstName END AS FirstName,
    CASE WHEN CAST(CustomerID AS INTEGER) % 4 = 0 THEN LastName || '   ' ELSE LastName END AS LastName,
    CASE WHEN CAST(CustomerID AS INTEGER) % 5 = 0 THEN ' ' || upper(Email) || ' ' ELSE Email END AS Email,
    CASE WHEN CAST(CustomerID AS INTEGER) % 7 = 0 THEN '   ' ELSE Phone END AS Phone,
    CASE WHEN CAST(CustomerID AS INTEGER) % 6 = 0 THEN replace(City, '_', '   _') ELSE City END AS City,
    CASE WHEN CAST(CustomerID AS INTEGER) % 8 = 0 THEN replace(Country, ' ', '    ') ELSE Country END AS Country
  FROM stg_customers)"""

_NEW_ID_OFFSET = 1_000_000_000

# second batches (see queries.second_product_batch / second_customer_batch)
_PROD2 = f"""p2 AS (
    SELECT ProductID, ProductName, Category,
           CASE WHEN ProductID % 50 = 0 THEN CAST(Price * 1.1 AS DECIMAL(18,2)) ELSE Price END AS Price, Stock
    FROM products_t
    UNION ALL SELECT ProductID + {_NEW_ID_OFFSET}, ProductName, Category, Price, Stock FROM products_t WHERE ProductID % 20 = 1),
  m2 AS (SELECT 1 AS source_key, ProductID AS product_id, {_clean('ProductName')} AS product_name,
           {_clean('Category')} AS category, Price AS price, Stock AS stock FROM p2
         UNION ALL SELECT 3, ProductID, {_clean('ProductName')}, {_clean('Category')}, Price, Stock FROM api_t),
  cur AS (SELECT * FROM d_product WHERE product_key <> -1),
  j AS (SELECT COALESCE(c.source_key, m.source_key) AS source_key, COALESCE(c.product_id, m.product_id) AS product_id,
           c.product_key, m.product_id IS NOT NULL AS inc,
           CASE WHEN c.product_key IS NULL THEN 'inserted'
                WHEN m.product_id IS NULL THEN 'kept'
                WHEN c.product_name IS NOT DISTINCT FROM m.product_name AND c.category IS NOT DISTINCT FROM m.category
                 AND c.price IS NOT DISTINCT FROM m.price AND c.stock IS NOT DISTINCT FROM m.stock THEN 'unchanged'
                ELSE 'updated' END AS state,
           CASE WHEN m.product_id IS NOT NULL THEN m.product_name ELSE c.product_name END AS product_name,
           CASE WHEN m.product_id IS NOT NULL THEN m.category ELSE c.category END AS category,
           CASE WHEN m.product_id IS NOT NULL THEN m.price ELSE c.price END AS price,
           CASE WHEN m.product_id IS NOT NULL THEN m.stock ELSE c.stock END AS stock
        FROM cur c FULL OUTER JOIN m2 m ON c.source_key = m.source_key AND c.product_id = m.product_id),
  mx AS (SELECT max(product_key) AS mk FROM cur),
  merged AS (SELECT COALESCE(j.product_key, mx.mk + row_number() OVER (PARTITION BY j.product_key IS NULL
                                                                        ORDER BY j.source_key, j.product_id)) AS product_key,
                    j.source_key, j.product_id, j.product_name, j.category, j.price, j.stock, j.state
             FROM j, mx)"""

_CUST2 = f"""c2 AS (
    SELECT CustomerID, FirstName, LastName, Email,
           CASE WHEN CustomerID % 50 = 0 THEN '+' || Phone ELSE Phone END AS Phone, City, Country FROM customers_t
    UNION ALL SELECT CustomerID + {_NEW_ID_OFFSET}, FirstName, LastName, Email, Phone, City, Country
    FROM customers_t WHERE CustomerID % 20 = 1),
  m2 AS (SELECT 1 AS source_key, CustomerID AS customer_id, {_clean('FirstName')} AS first_name,
           {_clean('LastName')} AS last_name, nullif(lower(regexp_replace(Email, '\\s+', '', 'g')), '') AS email,
           {_clean('Phone')} AS phone, {_clean('City')} AS city, {_clean('Country')} AS country FROM c2),
  cur AS (SELECT * FROM d_customer WHERE customer_key <> -1),
  j AS (SELECT COALESCE(c.source_key, m.source_key) AS source_key, COALESCE(c.customer_id, m.customer_id) AS customer_id,
           c.customer_key,
           CASE WHEN c.customer_key IS NULL THEN 'inserted'
                WHEN m.customer_id IS NULL THEN 'kept'
                WHEN c.first_name IS NOT DISTINCT FROM m.first_name AND c.last_name IS NOT DISTINCT FROM m.last_name
                 AND c.email IS NOT DISTINCT FROM m.email AND c.phone IS NOT DISTINCT FROM m.phone
                 AND c.city IS NOT DISTINCT FROM m.city AND c.country IS NOT DISTINCT FROM m.country THEN 'unchanged'
                ELSE 'updated' END AS state,
           CASE WHEN m.customer_id IS NOT NULL THEN m.first_name ELSE c.first_name END AS first_name,
           CASE WHEN m.customer_id IS NOT NULL THEN m.last_name ELSE c.last_name END AS last_name,
           CASE WHEN m.customer_id IS NOT NULL THEN m.email ELSE c.email END AS email,
           CASE WHEN m.customer_id IS NOT NULL THEN m.phone ELSE c.phone END AS phone,
           CASE WHEN m.customer_id IS NOT NULL THEN m.city ELSE c.city END AS city,
           CASE WHEN m.customer_id IS NOT NULL THEN m.country ELSE c.country END AS country
        FROM cur c FULL OUTER JOIN m2 m ON c.source_key = m.source_key AND c.customer_id = m.customer_id),
  mx AS (SELECT max(customer_key) AS mk FROM cur),
  merged AS (SELECT COALESCE(j.customer_key, mx.mk + row_number() OVER (PARTITION BY j.customer_key IS NULL
                                                                         ORDER BY j.source_key, j.customer_id)) AS customer_key,
                    j.source_key, j.customer_id, j.first_name, j.last_name, j.email, j.phone, j.city, j.country, j.state
             FROM j, mx)"""


def _extend(base: str, extra: str) -> str:
    return base[:-1] + ",\n  " + extra + "\n"


ORACLE: dict[str, str] = {}

# sources
ORACLE["csv_products"] = _with("products_t") + "SELECT * FROM products_t"
ORACLE["csv_customers"] = _with("customers_t") + "SELECT * FROM customers_t"
ORACLE["csv_orders"] = _with("orders_t") + "SELECT * FROM orders_t"
ORACLE["csv_order_details"] = _with("details_t") + "SELECT * FROM details_t"
_DBO = ("SELECT PedidoId AS OrderID, ClienteId AS CustomerID, FechaPedido AS OrderDate, "
        "Estado AS Status, FechaCreacion AS CreatedAt FROM db_orders_t")
_DBD = ("SELECT DetallePedidoId AS OrderDetailID, PedidoId AS OrderID, ProductoId AS ProductID, "
        "Cantidad AS Quantity, PrecioUnitario AS UnitPrice, PrecioTotal AS TotalPrice, "
        "FechaCreacion AS CreatedAt FROM db_details_t")
ORACLE["jdbc_orders"] = _with("db_orders_t") + _DBO
ORACLE["jdbc_order_details"] = _with("db_details_t") + _DBD
ORACLE["sorted_db_orders"] = ORACLE["jdbc_orders"] + " ORDER BY OrderID"
ORACLE["sorted_db_details"] = ORACLE["jdbc_order_details"] + " ORDER BY OrderDetailID"
ORACLE["api_products"] = _with("api_t") + "SELECT * FROM api_t"

# staging and text rendering
for _t in _STG:
    ORACLE[f"stage_{_t}"] = _stg(_t) + f"SELECT * FROM stg_{_t}"
ORACLE["text_ints"] = _stg("orders") + "SELECT OrderID, CustomerID FROM stg_orders"
ORACLE["text_decimals"] = _stg("products") + "SELECT ProductID, Price FROM stg_products"
ORACLE["text_dates"] = _stg("orders") + "SELECT OrderID, OrderDate FROM stg_orders"
ORACLE["text_timestamps"] = _stg("db_orders") + "SELECT PedidoId, FechaCreacion FROM stg_db_orders"
ORACLE["stage_skip_empty"] = ("SELECT 'stg.order_details' AS table_name, count(*) AS rows_before, "
                              "count(*) AS rows_after FROM lineitem")

# conversion, cleaning, validation
ORACLE["safe_convert"] = _extend(_stg("orders"), _CORRUPT_ORDERS) + """
SELECT OrderID AS order_id_text, CustomerID AS customer_id_text, OrderDate AS order_date_text,
       TRY_CAST(OrderID AS INTEGER) AS order_id, TRY_CAST(CustomerID AS INTEGER) AS customer_id,
       TRY_CAST(trim(OrderDate) AS DATE) AS order_date,
       TRY_CAST(OrderID AS INTEGER) IS NOT NULL AND TRY_CAST(CustomerID AS INTEGER) IS NOT NULL
         AND TRY_CAST(trim(OrderDate) AS DATE) IS NOT NULL AS accepted
FROM corrupt"""
ORACLE["validate_order_details"] = _extend(_stg("order_details"), _CORRUPT_DETAILS) + f"""
SELECT TRY_CAST(OrderID AS INTEGER) AS OrderID, TRY_CAST(ProductID AS INTEGER) AS ProductID,
       TRY_CAST(Quantity AS INTEGER) AS Quantity,
       TRY_CAST(replace(TotalPrice, ',', '') AS DECIMAL(18,2)) AS TotalPrice
FROM corrupt WHERE ({_DETAIL_REASON}) IS NULL"""
ORACLE["rejected_order_details"] = _extend(_stg("order_details"), _CORRUPT_DETAILS) + f"""
SELECT * FROM (SELECT OrderID AS order_id_text, ProductID AS product_id_text, Quantity AS quantity_text,
       TotalPrice AS total_text, {_DETAIL_REASON} AS reject_reason FROM corrupt)
WHERE reject_reason IS NOT NULL"""
ORACLE["normalize_customers"] = _extend(_stg("customers"), _PADDED) + f"""
SELECT TRY_CAST(CustomerID AS INTEGER) AS customer_id, {_clean('FirstName')} AS first_name,
       {_clean('LastName')} AS last_name, nullif(lower(regexp_replace(Email, '\\s+', '', 'g')), '') AS email,
       {_clean('Phone')} AS phone, {_clean('City')} AS city, {_clean('Country')} AS country
FROM padded"""
ORACLE["unit_price"] = _with("details_t") + "SELECT *, " + _UP.format(t="TotalPrice", q="Quantity") + \
    " AS unit_price FROM details_t"
ORACLE["fact_dedup"] = _with("uniq") + "SELECT * FROM uniq"
ORACLE["dedup_products"] = _with("products_t") + f"""
, both_ AS (SELECT * FROM products_t UNION ALL
            SELECT ProductID, ProductName, Category, Price + 1, Stock FROM products_t WHERE ProductID % 25 = 0),
  m AS (SELECT ProductID AS product_id, {_clean('ProductName')} AS product_name, {_clean('Category')} AS category,
               Price AS price, Stock AS stock FROM both_)
SELECT product_id, product_name, category, price, stock FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name NULLS FIRST,
         category NULLS FIRST, price NULLS FIRST, stock NULLS FIRST) AS rn FROM m) WHERE rn = 1"""
ORACLE["dup_order_lines"] = _with("details_t") + """
SELECT OrderID, ProductID, count(*) AS n FROM details_t GROUP BY OrderID, ProductID HAVING count(*) > 1"""
ORACLE["dup_groups_customers"] = _with("d_customer") + """
SELECT count(*) AS dup_groups, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS dup_rows FROM (
  SELECT source_key, customer_id, count(*) AS n FROM d_customer GROUP BY 1, 2 HAVING count(*) > 1)"""
ORACLE["dup_groups_products"] = _with("d_product") + """
SELECT count(*) AS dup_groups, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS dup_rows FROM (
  SELECT source_key, product_id, count(*) AS n FROM d_product GROUP BY 1, 2 HAVING count(*) > 1)"""
ORACLE["product_source_tag"] = _with("products_t", "api_t") + """
SELECT ProductID, 1 AS source_key FROM products_t UNION ALL SELECT ProductID, 3 FROM api_t"""

# joins
ORACLE["join_details_orders"] = _with("joined") + """
SELECT OrderID, ProductID, Quantity, TotalPrice, CustomerID, OrderDate, Status FROM joined"""
for _name, _key in [("lookup_date", "date_key"), ("lookup_customer", "customer_key"),
                    ("lookup_product", "product_key"), ("lookup_status", "status_key"),
                    ("lookup_source", "source_key")]:
    ORACLE[_name] = _with("keyed") + f"SELECT OrderID, ProductID, {_key} FROM keyed"
ORACLE["fact_sales"] = _with("fact") + "SELECT * FROM fact"
ORACLE["reconcile_details"] = _with("db_details_t", "uniq") + """
, db AS (SELECT PedidoId AS OrderID, ProductoId AS ProductID,
                CASE WHEN DetallePedidoId % 103 = 0 THEN Cantidad + 1 ELSE Cantidad END AS Quantity,
                PrecioTotal AS TotalPrice FROM db_details_t WHERE DetallePedidoId % 101 <> 0)
SELECT state, count(*) AS n FROM (
  SELECT CASE WHEN d.OrderID IS NULL THEN 'only_csv' WHEN u.OrderID IS NULL THEN 'only_db'
              WHEN u.Quantity IS NOT DISTINCT FROM d.Quantity AND u.TotalPrice IS NOT DISTINCT FROM d.TotalPrice
              THEN 'match' ELSE 'differs' END AS state
  FROM uniq u FULL OUTER JOIN db d ON u.OrderID = d.OrderID AND u.ProductID = d.ProductID)
GROUP BY state"""
ORACLE["reconcile_orders"] = _with("orders_t", "db_orders_t") + """
SELECT state, count(*) AS n FROM (
  SELECT CASE WHEN d.PedidoId IS NULL THEN 'only_csv' WHEN c.OrderID IS NULL THEN 'only_db'
              WHEN c.CustomerID IS NOT DISTINCT FROM d.ClienteId AND c.OrderDate IS NOT DISTINCT FROM d.FechaPedido
               AND upper(trim(c.Status)) IS NOT DISTINCT FROM upper(trim(d.Estado)) THEN 'match'
              ELSE 'differs' END AS state
  FROM orders_t c FULL OUTER JOIN db_orders_t d ON c.OrderID = d.PedidoId)
GROUP BY state"""
ORACLE["dim_change_counts"] = _with("d_product", "d_customer", "products_t", "api_t", "customers_t")[:-1] + """,
  pp AS (WITH """ + _PROD2 + """
         SELECT 'product' AS dimension, state, count(*) AS n FROM merged WHERE state <> 'kept' GROUP BY state),
  cc AS (WITH """ + _CUST2 + """
         SELECT 'customer' AS dimension, state, count(*) AS n FROM merged WHERE state <> 'kept' GROUP BY state)
SELECT * FROM pp UNION ALL SELECT * FROM cc"""
ORACLE["dim_product_upsert"] = _with("d_product", "products_t", "api_t")[:-1] + ",\n  " + _PROD2 + """
SELECT product_key, source_key, product_id, product_name, category, price, stock FROM merged
UNION ALL SELECT -1, -1, -1, 'UNKNOWN', 'UNKNOWN', NULL, NULL"""
ORACLE["dim_customer_upsert"] = _with("d_customer", "customers_t")[:-1] + ",\n  " + _CUST2 + """
SELECT customer_key, source_key, customer_id, first_name, last_name, email, phone, city, country FROM merged
UNION ALL SELECT -1, -1, -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN'"""
ORACLE["dim_new_products"] = _with("d_product", "products_t", "api_t")[:-1] + ",\n  " + _PROD2 + """
SELECT source_key, product_id, product_name, category, price, stock FROM merged WHERE state = 'inserted'"""
ORACLE["unknown_key_counts"] = _with("fact") + """
SELECT key_name, n FROM (
  SELECT 'date_key' AS key_name, count(*) FILTER (WHERE date_key = -1) AS n FROM fact UNION ALL
  SELECT 'customer_key', count(*) FILTER (WHERE customer_key = -1) FROM fact UNION ALL
  SELECT 'product_key', count(*) FILTER (WHERE product_key = -1) FROM fact UNION ALL
  SELECT 'status_key', count(*) FILTER (WHERE status_key = -1) FROM fact UNION ALL
  SELECT 'source_key', count(*) FILTER (WHERE source_key = -1) FROM fact)"""

# aggregations
ORACLE["source_counts"] = _with("uniq") + """
, c AS (SELECT 'products' AS name, count(*) AS n FROM part UNION ALL
        SELECT 'customers', count(*) FROM customer UNION ALL
        SELECT 'orders', count(*) FROM orders UNION ALL
        SELECT 'order_details', count(*) FROM lineitem UNION ALL
        SELECT 'db_orders', count(*) FROM orders UNION ALL
        SELECT 'db_order_details', count(*) FROM uniq UNION ALL
        SELECT 'api_products', count(*) FROM part)
SELECT name, n FROM c UNION ALL SELECT 'total', sum(n) FROM c"""
ORACLE["dim_counts"] = """
SELECT 'dim_source' AS dimension, 4 AS n UNION ALL
SELECT 'dim_status', count(DISTINCT o_orderstatus) + 1 FROM orders UNION ALL
SELECT 'dim_date', CAST(max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)) AS BIGINT) + 2 FROM orders UNION ALL
SELECT 'dim_customer', count(*) + 1 FROM customer UNION ALL
SELECT 'dim_product', 2 * count(*) + 1 FROM part"""
ORACLE["product_by_source"] = """
SELECT 'CSV' AS source_name, count(*) AS n FROM part UNION ALL
SELECT 'API', count(*) FROM part UNION ALL
SELECT 'UNKNOWN', 1"""
ORACLE["fact_load_metrics"] = _with("fact", "uniq") + """
SELECT 'rows_read' AS metric, count(*) AS n FROM lineitem UNION ALL
SELECT 'rows_inserted', count(*) FROM fact UNION ALL
SELECT 'rows_rejected', (SELECT count(*) FROM uniq) - (SELECT count(*) FROM fact) UNION ALL
SELECT 'rows_dropped_duplicates', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM uniq) UNION ALL
SELECT 'unknown_keys', count(*) FILTER (WHERE date_key = -1 OR customer_key = -1 OR product_key = -1
                                           OR status_key = -1 OR source_key = -1) FROM fact"""
ORACLE["fact_clean_report"] = _with("fact") + """
SELECT 'dw.fact_sales' AS table_name, count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM fact"""

# dimensions
ORACLE["dim_source"] = _with("d_source", "uniq") + """
, per AS (SELECT 1 AS source_key, (SELECT count(*) FROM part) + (SELECT count(*) FROM customer)
                 + (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS n
          UNION ALL SELECT 2, (SELECT count(*) FROM orders) + (SELECT count(*) FROM uniq)
          UNION ALL SELECT 3, (SELECT count(*) FROM part))
SELECT d.source_key, d.source_name, d.source_type, COALESCE(p.n, 0) AS rows_extracted
FROM d_source d LEFT JOIN per p ON d.source_key = p.source_key"""
ORACLE["dim_status"] = _with("d_status") + "SELECT * FROM d_status"
ORACLE["dim_date"] = _with("d_date") + "SELECT * FROM d_date"
ORACLE["dim_customer"] = _with("d_customer") + "SELECT * FROM d_customer"
ORACLE["dim_product"] = _with("d_product") + "SELECT * FROM d_product"
ORACLE["surrogate_keys"] = """
SELECT OrderID, ProductID, row_number() OVER (ORDER BY OrderID, ProductID) AS line_key
FROM (SELECT DISTINCT CAST(l_orderkey AS INTEGER) AS OrderID, CAST(l_partkey AS INTEGER) AS ProductID FROM lineitem)"""

# load control of one complete run (no clocks, no run id)
ORACLE["load_control"] = _with("fact", "uniq") + """
SELECT * FROM (VALUES ('dim_source', 'config', 'COMPLETED', 3, 3, 0, 0)) t(process, source, state, rows_read,
       rows_inserted, rows_updated, rows_rejected)
UNION ALL SELECT 'dim_status', 'stg.orders+stg.db_orders', 'COMPLETED', 2 * count(*),
       (SELECT count(DISTINCT o_orderstatus) FROM orders), 0, 0 FROM orders
UNION ALL SELECT 'dim_date', 'stg.orders+stg.db_orders', 'COMPLETED', 2 * count(*),
       CAST(max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)) AS BIGINT) + 1, 0, 0 FROM orders
UNION ALL SELECT 'dim_customer', 'stg.customers', 'COMPLETED', count(*), count(*), 0, 0 FROM customer
UNION ALL SELECT 'dim_product', 'stg.products+stg.api_products', 'COMPLETED',
       2 * count(*), 2 * count(*),
       0, 0 FROM part
UNION ALL SELECT 'fact_sales', 'stg.order_details', 'COMPLETED', (SELECT count(*) FROM lineitem),
       (SELECT count(*) FROM fact), 0, 0"""
ORACLE["load_state_counts"] = "SELECT 'COMPLETED' AS state, CAST(6 AS BIGINT) AS n, CAST(0 AS BIGINT) AS unfinished"

# sales indicators
ORACLE["sales_by_month"] = _sales("d.year, d.month", "d.year, d.month", "LEFT JOIN d_date d ON f.date_key = d.date_key")
ORACLE["sales_by_category"] = _sales("p.category", "p.category",
                                     "LEFT JOIN d_product p ON f.product_key = p.product_key")
ORACLE["sales_by_country"] = _sales("c.country", "c.country",
                                    "LEFT JOIN d_customer c ON f.customer_key = c.customer_key")
ORACLE["sales_by_status"] = _sales("s.status", "s.status", "LEFT JOIN d_status s ON f.status_key = s.status_key")
ORACLE["top_customers"] = _with("fact", "d_customer") + """
SELECT c.customer_id, c.first_name, c.last_name, c.country, CAST(count(DISTINCT f.order_number) AS BIGINT) AS n_orders,
       CAST(sum(f.quantity) AS BIGINT) AS quantity, sum(f.total_amount) AS amount
FROM fact f LEFT JOIN d_customer c ON f.customer_key = c.customer_key
GROUP BY c.customer_id, c.first_name, c.last_name, c.country
ORDER BY amount DESC, c.customer_id ASC LIMIT 10"""
