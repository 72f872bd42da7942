"""SQL for the registered queries, written from the rules and run by another engine.

Amounts are summed as decimals and shown as double, dates are shown as text.
"""

from __future__ import annotations

SOURCES = "sources(SourceSystemID, SourceSystemName) AS (VALUES (1, 'Orders'), (2, 'Events'))"

_EVENT_K = "CAST(regexp_extract(props, '\"k\": *(\\d+)', 1) AS BIGINT)"


def _key_of(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


_ORDERS_FACT = f"""
  SELECT {_key_of('o_orderdate')} AS DateKey,
         'ORDERS:' || CAST(o_custkey AS VARCHAR) AS CustomerID,
         CASE WHEN l_returnflag <> 'R' THEN 'ORDERS:' || CAST(l_suppkey AS VARCHAR) END AS EmployeeID,
         'ORDERS:' || CAST(l_partkey AS VARCHAR) AS ProductID,
         1 AS SourceSystemID,
         CAST(l_quantity AS BIGINT) AS SalesQuantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS SalesAmount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _events_fact(event_type: str, system_id: int, prefix: str) -> str:
    return f"""
  SELECT {_key_of('ts')} AS DateKey,
         '{prefix}:' || CAST(user_id AS VARCHAR) AS CustomerID,
         '{prefix}:N' || CAST(c_nationkey AS VARCHAR) AS EmployeeID,
         '{prefix}:' || CAST({_EVENT_K} AS VARCHAR) AS ProductID,
         {system_id} AS SourceSystemID,
         CAST(1 AS BIGINT) AS SalesQuantity,
         CAST(value AS DECIMAL(18,2)) AS SalesAmount
  FROM events JOIN customer ON user_id = c_custkey
  WHERE event_type = '{event_type}'"""


FACT = f"fact AS ({_ORDERS_FACT} UNION ALL {_events_fact('purchase', 2, 'EVENTS')})"

FACT3 = (
    f"fact3 AS ({_ORDERS_FACT} UNION ALL {_events_fact('purchase', 2, 'EVENTS')}"
    f" UNION ALL {_events_fact('signup', 3, 'SIGNUPS')})"
)

DIM_TIME = f"""dim_time AS (
  SELECT {_key_of('d')} AS DateKey, d AS FullDate, CAST(day(d) AS INTEGER) AS DayOfMonth,
         dayname(d) AS DayOfWeek, CAST(month(d) AS INTEGER) AS Month,
         CAST(quarter(d) AS INTEGER) AS Quarter, CAST(year(d) AS INTEGER) AS Year
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
        UNION SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'purchase') days)"""


def _event_customers(prefix: str) -> str:
    return f"""
  SELECT '{prefix}:' || CAST(user_id AS VARCHAR), c_name, n_name
  FROM (SELECT DISTINCT user_id FROM events) u
  LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""


_ORDER_CUSTOMERS = """
  SELECT 'ORDERS:' || CAST(c_custkey AS VARCHAR) AS CustomerID, c_name AS CustomerName, n_name AS Country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

DIM_CUSTOMER = f"dim_customer AS ({_ORDER_CUSTOMERS} UNION ALL {_event_customers('EVENTS')})"


def _desks(prefix: str) -> str:
    return f"""
  SELECT '{prefix}:N' || CAST(n_nationkey AS VARCHAR), n_name, 'Nation desk', CAST(NULL AS VARCHAR),
         '{prefix}:R' || CAST(n_regionkey AS VARCHAR) FROM nation
  UNION ALL
  SELECT '{prefix}:R' || CAST(r_regionkey AS VARCHAR), r_name, 'Region desk', NULL, NULL FROM region"""


_SUPPLIERS = """
  SELECT 'ORDERS:' || CAST(s_suppkey AS VARCHAR) AS EmployeeID, s_name AS EmployeeName,
         'Supplier' AS Title, n_name AS Country, CAST(NULL AS VARCHAR) AS ReportsTo
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

DIM_EMPLOYEE = f"dim_employee AS ({_SUPPLIERS} UNION ALL {_desks('EVENTS')})"


def _event_products(prefix: str) -> str:
    return f"""
  SELECT '{prefix}:' || CAST(k AS VARCHAR), p_name, NULL, p_brand, CAST(p_retailprice AS DECIMAL(18,2))
  FROM (SELECT DISTINCT {_EVENT_K} AS k FROM events) sold LEFT JOIN part ON k = p_partkey"""


_PARTS = """
  SELECT 'ORDERS:' || CAST(p_partkey AS VARCHAR) AS ProductID, p_name AS ProductName,
         p_type AS CategoryName, CAST(NULL AS VARCHAR) AS GenreName,
         CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice
  FROM part"""

DIM_PRODUCT = f"dim_product AS ({_PARTS} UNION ALL {_event_products('EVENTS')})"

SUMS = "CAST(sum(SalesAmount) AS DOUBLE) AS SalesAmount, CAST(sum(SalesQuantity) AS BIGINT) AS SalesQuantity"

INTAKE = f"""intake_lines AS (
  SELECT event_id,
    CASE WHEN event_id % 50 = 0 THEN 'junk' WHEN event_id % 50 = 1 THEN ''
         WHEN event_id % 50 = 2 THEN NULL
         WHEN event_id % 50 = 3 THEN strftime(ts, '%m/%d/%Y')
         WHEN event_id % 50 = 4 THEN strftime(ts, '%Y-%m-%d') || ' 25:99:99'
         WHEN event_id % 50 = 5 THEN strftime(ts, '%Y')
         WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS order_date,
    CASE WHEN event_id % 40 = 7 THEN NULL WHEN event_id % 40 = 9 THEN user_id + 10000000
         ELSE user_id END AS customer,
    CASE WHEN event_id % 60 = 11 THEN 'X' ELSE '' END || CAST({_EVENT_K} AS VARCHAR) AS product,
    CASE WHEN event_id % 70 = 0 THEN 'two' WHEN event_id % 70 = 1 THEN NULL
         WHEN event_id % 70 = 2 THEN '0' WHEN event_id % 70 = 3 THEN '-3' ELSE '1' END AS quantity,
    CASE WHEN event_id % 80 = 5 THEN 'free' WHEN event_id % 80 = 6 THEN NULL
         WHEN event_id % 80 = 7 THEN '-1.00'
         ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS price
  FROM events),
intake_dated AS (
  SELECT *, CASE WHEN regexp_matches(order_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}( .*)?$')
            THEN CAST(TRY_CAST(order_date AS TIMESTAMP) AS DATE) END AS d FROM intake_lines),
intake AS (
  SELECT CAST(event_id AS VARCHAR) AS LineKey, order_date AS RawDate, quantity AS RawQuantity,
         price AS RawPrice, {_key_of('d')} AS DateKey,
         'INTAKE:' || CAST(customer AS VARCHAR) AS CustomerID, CAST(NULL AS VARCHAR) AS EmployeeID,
         'INTAKE:' || product AS ProductID, 4 AS SourceSystemID,
         TRY_CAST(quantity AS BIGINT) AS SalesQuantity,
         TRY_CAST(price AS DECIMAL(18,2)) AS Price,
         CAST(TRY_CAST(price AS DECIMAL(18,2)) * TRY_CAST(quantity AS INTEGER) AS DECIMAL(18,2)) AS SalesAmount
  FROM intake_dated),
intake_fact AS (
  SELECT DateKey, CustomerID, EmployeeID, ProductID, SourceSystemID, SalesQuantity, SalesAmount
  FROM intake WHERE SalesQuantity IS NOT NULL AND Price IS NOT NULL),
fact4 AS (SELECT * FROM fact UNION ALL SELECT * FROM intake_fact)"""

MEASURE_FAULT = """CASE WHEN RawQuantity IS NULL THEN 'quantity missing'
         WHEN SalesQuantity IS NULL THEN 'quantity not a number'
         WHEN RawPrice IS NULL THEN 'price missing'
         WHEN Price IS NULL THEN 'price not a number'
         WHEN TRY_CAST(RawQuantity AS DECIMAL(38,10)) <> floor(TRY_CAST(RawQuantity AS DECIMAL(38,10))) THEN 'quantity not whole'
         WHEN SalesQuantity <= 0 THEN 'quantity not positive'
         WHEN Price < 0 THEN 'price negative' END"""

# The joined lines of all three systems, as delivered.
STAGED = INTAKE.rsplit(",\nintake_fact", 1)[0] + """,
staged AS (
  SELECT SourceSystemID, LineKey, RawDate, DateKey IS NULL AS Undated, RawQuantity, RawPrice, SalesQuantity, Price FROM intake
  UNION ALL
  SELECT 1, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), CAST(o_orderdate AS VARCHAR),
    o_orderdate IS NULL, CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR),
    CAST(floor(l_quantity) AS BIGINT), CAST(l_extendedprice AS DECIMAL(18,2))
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL
  SELECT 2, CAST(event_id AS VARCHAR), CAST(ts AS VARCHAR), ts IS NULL, '1', CAST(value AS VARCHAR), 1,
    CAST(value AS DECIMAL(18,2))
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase')"""

DUPLICATES = """SELECT 1 AS SourceSystemID,
      CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS LineKey, count(*) AS Copies
      FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 2, CAST(event_id AS VARCHAR), count(*) FROM events
      WHERE event_type = 'purchase' GROUP BY event_id HAVING count(*) > 1
    UNION ALL SELECT 4, CAST(event_id AS VARCHAR), count(*) FROM events GROUP BY event_id HAVING count(*) > 1"""

BAD_DATES = """SELECT SourceSystemID, LineKey, RawDate,
      CASE WHEN coalesce(trim(RawDate), '') = '' THEN 'date missing' ELSE 'date not readable' END AS Reason
      FROM staged WHERE Undated"""

BAD_MEASURES = f"""SELECT SourceSystemID, LineKey, RawQuantity, RawPrice, Reason,
      SalesQuantity IS NOT NULL AND Price IS NOT NULL AS Loaded
      FROM (SELECT *, {MEASURE_FAULT} AS Reason FROM staged) i WHERE Reason IS NOT NULL"""

KEY_USAGE = f"""{FACT}, {INTAKE}, {DIM_TIME}, {DIM_EMPLOYEE},
staff AS (SELECT EmployeeID, ReportsTo FROM dim_employee
          UNION ALL SELECT 'INTAKE' || substr(EmployeeID, 7), 'INTAKE' || substr(ReportsTo, 7)
          FROM dim_employee WHERE EmployeeID LIKE 'EVENTS:%'),
used_keys AS (
  SELECT 'DateKey' AS ForeignKey, CAST(DateKey AS VARCHAR) AS KeyValue FROM fact4
  UNION ALL SELECT 'CustomerID', CustomerID FROM fact4
  UNION ALL SELECT 'EmployeeID', EmployeeID FROM fact4
  UNION ALL SELECT 'ProductID', ProductID FROM fact4
  UNION ALL SELECT 'SourceSystemID', CAST(SourceSystemID AS VARCHAR) FROM fact4
  UNION ALL SELECT 'ReportsTo', ReportsTo FROM staff),
defined_keys AS (
  SELECT 'DateKey' AS ForeignKey, CAST(DateKey AS VARCHAR) AS KeyValue FROM dim_time
  UNION SELECT 'DateKey', CAST(DateKey AS VARCHAR) FROM intake
  UNION ALL SELECT 'CustomerID', 'ORDERS:' || CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL SELECT DISTINCT 'CustomerID', p || CAST(user_id AS VARCHAR)
            FROM events, (VALUES ('EVENTS:'), ('INTAKE:')) t(p)
  UNION ALL SELECT 'EmployeeID', EmployeeID FROM staff
  UNION ALL SELECT 'ReportsTo', EmployeeID FROM staff
  UNION ALL SELECT 'ProductID', 'ORDERS:' || CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT DISTINCT 'ProductID', p || CAST({_EVENT_K} AS VARCHAR)
            FROM events, (VALUES ('EVENTS:'), ('INTAKE:')) t(p)
  UNION ALL SELECT 'SourceSystemID', v FROM (VALUES ('1'), ('2'), ('4')) t(v)),
uses AS (SELECT ForeignKey, KeyValue, count(*) AS UsingRows FROM used_keys
         WHERE KeyValue IS NOT NULL GROUP BY 1, 2),
definitions AS (SELECT ForeignKey, KeyValue, count(*) AS DefiningRows FROM defined_keys
                WHERE KeyValue IS NOT NULL GROUP BY 1, 2)"""

# Columns of the tables the mart reads, with the type names Spark reports.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

SYSTEM_TABLES = {
    "Orders": ("customer", "lineitem", "nation", "orders", "part", "supplier"),
    "Events": ("customer", "events", "nation", "part", "region"),
}

SYSTEM_FOREIGN_KEYS = {
    "Orders": (
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ),
    "Events": (
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("events", "user_id", "customer", "c_custkey"),
        ("nation", "n_regionkey", "region", "r_regionkey"),
    ),
}

PRIMARY_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey,l_linenumber",
    "events": "event_id",
}


# Both loads of ORDERS: ids with what they stand for, and what became of them.
KEY_LOADS = """
before AS (
  SELECT 'DimCustomer' AS Dimension, 'ORDERS:' || c_custkey AS k, c_name AS who FROM customer
  UNION ALL SELECT 'DimEmployee', 'ORDERS:' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT 'DimProduct', 'ORDERS:' || p_partkey, p_name || chr(31) || p_type FROM part),
later AS (
  SELECT 'DimCustomer' AS Dimension,
    'ORDERS:' || (c_custkey + CASE WHEN c_custkey % 89 = 0 THEN 10000000 ELSE 0 END) AS k,
    c_name || CASE WHEN c_custkey % 79 = 0 THEN ' (new owner)' ELSE '' END AS who FROM customer WHERE c_custkey % 97 <> 0
  UNION ALL SELECT 'DimCustomer', 'ORDERS:' || (c_custkey + 20000000), c_name || ' (branch)' FROM customer WHERE c_custkey % 83 = 0
  UNION ALL SELECT 'DimEmployee', 'ORDERS:' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT 'DimProduct', 'ORDERS:' || (p_partkey + CASE WHEN p_partkey % 91 = 0 THEN 10000000 ELSE 0 END),
    p_name || chr(31) || p_type FROM part),
moved AS (
  SELECT Dimension, k, coalesce(b.who, l.who) AS who,
    CASE WHEN b.who IS NULL THEN 'added' WHEN l.who IS NULL THEN 'gone'
         WHEN b.who <> l.who THEN 'reassigned' ELSE 'stable' END AS Change
  FROM before b FULL JOIN later l USING (Dimension, k)),
pairs AS (
  SELECT Dimension, who, min(k) FILTER (Change = 'gone') AS OldKey, min(k) FILTER (Change = 'added') AS NewKey
  FROM moved WHERE Change IN ('gone', 'added') GROUP BY Dimension, who
  HAVING count(*) FILTER (Change = 'gone') = 1 AND count(*) FILTER (Change = 'added') = 1),
changes AS (
  SELECT Dimension, 'renamed' AS Change, OldKey, NewKey FROM pairs
  UNION ALL
  SELECT Dimension, Change, CASE WHEN Change <> 'added' THEN k END, CASE WHEN Change <> 'gone' THEN k END
  FROM moved m WHERE Change <> 'stable' AND NOT EXISTS (
    SELECT 1 FROM pairs p WHERE p.Dimension = m.Dimension AND m.Change <> 'reassigned' AND p.who = m.who))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in COLUMNS[table].split(", ")]


def _period(column: str, shown: str | None = None) -> str:
    shown = shown or column
    return _with(FACT, DIM_TIME) + (
        f"SELECT {shown} AS {column}, {SUMS} FROM fact JOIN dim_time USING (DateKey) GROUP BY {column}"
    )


def _top_customers(split: bool) -> str:
    name = "SourceSystemName, " if split else ""
    join = "JOIN sources USING (SourceSystemID)" if split else ""
    return _with(FACT, DIM_CUSTOMER, SOURCES) + f"""
    SELECT CustomerName, CAST(NULL AS VARCHAR) AS CompanyName, Country, {name}
           CAST(a AS DOUBLE) AS SalesAmount, q AS SalesQuantity
    FROM (SELECT CustomerID, SourceSystemID, sum(SalesAmount) AS a, CAST(sum(SalesQuantity) AS BIGINT) AS q
          FROM fact GROUP BY 1, 2) g
    LEFT JOIN dim_customer USING (CustomerID) {join}
    ORDER BY a DESC, CustomerID LIMIT 10"""


def _top_products(order: str = "a", split: bool = False) -> str:
    name = "SourceSystemName, " if split else ""
    join = "JOIN sources USING (SourceSystemID)" if split else ""
    return _with(FACT, DIM_PRODUCT, SOURCES) + f"""
    SELECT ProductName, GenreName, CategoryName, {name}
           CAST(a AS DOUBLE) AS SalesAmount, q AS SalesQuantity
    FROM (SELECT ProductID, SourceSystemID, sum(SalesAmount) AS a, CAST(sum(SalesQuantity) AS BIGINT) AS q
          FROM fact GROUP BY 1, 2) g
    LEFT JOIN dim_product USING (ProductID) {join}
    ORDER BY {order} DESC, ProductID LIMIT 10"""


def _employees(split: bool) -> str:
    name = "SourceSystemName, " if split else ""
    return _with(FACT, DIM_EMPLOYEE, SOURCES) + f"""
    SELECT EmployeeName, Title, {name} CAST(a AS DOUBLE) AS SalesAmount, q AS SalesQuantity
    FROM (SELECT EmployeeID, SourceSystemID, sum(SalesAmount) AS a, CAST(sum(SalesQuantity) AS BIGINT) AS q
          FROM fact WHERE EmployeeID IS NOT NULL GROUP BY 1, 2) g
    LEFT JOIN dim_employee USING (EmployeeID) JOIN sources USING (SourceSystemID)"""


def _narrative(fact: str) -> str:
    return f"""
    SELECT f.DateKey, f.CustomerID, f.EmployeeID, f.ProductID, f.SourceSystemID, f.SalesQuantity,
      CAST(f.SalesAmount AS DOUBLE) AS SalesAmount,
      'On ' || coalesce(strftime(FullDate, '%B %-d, %Y'), CAST(f.DateKey AS VARCHAR)) || ', one '
      || coalesce(SourceSystemName, 'an unknown source') || ' sales line item recorded customer '
      || coalesce(CustomerName, 'an unknown customer') || ' purchasing ' || f.SalesQuantity
      || ' unit(s) of ' || coalesce(ProductName, 'an unknown product') || ' for a SalesAmount of '
      || format('{{:,.2f}}', CAST(f.SalesAmount AS DOUBLE))
      || CASE WHEN e.EmployeeID IS NULL THEN '.' ELSE ', with the order attributed to ' || EmployeeName
         || coalesce(' (' || Title || ')', '') || '.' END AS Sentence
    FROM {fact} f LEFT JOIN dim_time USING (DateKey) LEFT JOIN sources USING (SourceSystemID)
    LEFT JOIN dim_customer USING (CustomerID) LEFT JOIN dim_product USING (ProductID)
    LEFT JOIN dim_employee e ON f.EmployeeID = e.EmployeeID"""


_FILTERED = "SELECT * FROM fact WHERE SourceSystemID IN (1, 2) AND DateKey BETWEEN 19960301 AND 20240115"

_ALL_DIMS = (FACT, DIM_TIME, DIM_CUSTOMER, DIM_EMPLOYEE, DIM_PRODUCT, SOURCES)


def _coverage() -> str:
    fact_columns = ["DateKey", "CustomerID", "EmployeeID", "ProductID", "SourceSystemID", "SalesQuantity", "SalesAmount"]
    time_columns = ["DateKey", "FullDate", "DayOfMonth", "DayOfWeek", "Month", "Quarter", "Year"]
    customer_columns = ["CustomerID", "CustomerName", "CompanyName", "City", "State", "Country", "PostalCode", "Phone", "Email"]
    employee_columns = ["EmployeeID", "EmployeeName", "Title", "City", "Country", "ReportsTo"]
    product_columns = ["ProductID", "ProductName", "CategoryName", "GenreName", "Composer", "UnitPrice"]
    required = {
        "FactSales": {"ProductID", "SourceSystemID", "SalesQuantity", "SalesAmount"},
        "DimTime": set(time_columns),
        "DimCustomer": {"CustomerID"},
        "DimEmployee": {"EmployeeID", "EmployeeName"},
        "DimProduct": {"ProductID", "ProductName"},
    }
    mapped = {
        ("Orders", "DimCustomer"): {"CustomerID", "CustomerName", "Country"},
        ("Events", "DimCustomer"): {"CustomerID", "CustomerName", "Country"},
        ("Orders", "DimEmployee"): {"EmployeeID", "EmployeeName", "Title", "Country"},
        ("Events", "DimEmployee"): {"EmployeeID", "EmployeeName", "Title", "ReportsTo"},
        ("Orders", "DimProduct"): {"ProductID", "ProductName", "CategoryName", "UnitPrice"},
        ("Events", "DimProduct"): {"ProductID", "ProductName", "GenreName", "UnitPrice"},
    }
    tables = {
        "FactSales": ("fact", fact_columns),
        "DimCustomer": ("dim_customer", customer_columns),
        "DimEmployee": ("dim_employee", employee_columns),
        "DimProduct": ("dim_product", product_columns),
    }
    parts = []

    def add(system: str, table: str, column: str, rows: str, condition: str) -> None:
        has = mapped.get((system, table))
        rule = "required" if column in required[table] else "optional"
        filled = f"count({column})"
        if has is not None and column not in has:
            rule, filled = "unmapped", "CAST(0 AS BIGINT)"
        holds = "TRUE"
        if rule == "required":
            holds = f"{filled} = count(*)"
        parts.append(
            f"SELECT '{system}' AS SourceSystemName, '{table}' AS TargetTable, '{column}' AS TargetColumn, "
            f"'{rule}' AS Rule, count(*) AS RowCount, {filled} AS FilledRows, {holds} AS Holds "
            f"FROM {rows} WHERE {condition}"
        )

    for system, prefix in (("Orders", "ORDERS:%"), ("Events", "EVENTS:%")):
        for table, (rows, columns) in tables.items():
            key = columns[0] if table != "FactSales" else "ProductID"
            for column in columns:
                add(system, table, column, rows, f"{key} LIKE '{prefix}'")
        days = (
            "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"
            if system == "Orders"
            else "(SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase')"
        )
        for column in time_columns:
            parts.append(
                f"SELECT '{system}', 'DimTime', '{column}', 'required', count(*), count(d), TRUE "
                f"FROM {days} days"
            )
    return _with(FACT, DIM_CUSTOMER, DIM_EMPLOYEE, DIM_PRODUCT) + "\nUNION ALL ".join(parts)


def _inventory() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{system}' AS SourceSystem, '{table}' AS TableName, count(*) AS RecordCount, "
        f"{len(_columns(table))} AS ColumnCount FROM {table}"
        for system, tables in SYSTEM_TABLES.items()
        for table in tables
    )


def _loads_together() -> str:
    """Filled values of each column in both loads; the later one lacks and adds a column."""
    parts = []
    for table, added in (("customer", ["c_since"]), ("part", [])):
        for load in "ab":
            for column in [*[c for c, _ in _columns(table)], *added]:
                missing = column == ("c_since" if load == "a" else "c_mktsegment")
                filled = "CAST(0 AS BIGINT)" if missing else "count(*)" if column in added else f"count({column})"
                parts.append(
                    f"SELECT '{table}' AS TableName, '{load}' AS Load, count(*) AS RowCount, "
                    f"'{column}' AS ColumnName, {filled} AS FilledRows FROM {table}"
                )
    return "\nUNION ALL ".join(parts)


def _source_inventory() -> str:
    counts = " ".join(
        f"WHEN '{system}' THEN {len(keys)}" for system, keys in SYSTEM_FOREIGN_KEYS.items()
    )
    return (
        "SELECT SourceSystem, count(*) AS TableCount, CAST(sum(ColumnCount) AS BIGINT) AS ColumnCount, "
        "CAST(sum(RecordCount) AS BIGINT) AS RecordCount, "
        f"CAST(CASE SourceSystem {counts} END AS BIGINT) AS RelationshipCount "
        f"FROM ({_inventory()}) inventory GROUP BY SourceSystem"
    )


def _profile() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{system}' AS SourceSystem, '{table}' AS TableName, '{column}' AS ColumnName, "
        f"'{data_type}' AS DataType, TRUE AS Nullable, "
        f"{str(column in PRIMARY_KEYS[table].split(',')).upper()} AS IsPrimaryKey, "
        f"count(*) AS RowCount, count({column}) AS FilledRows, count(*) - count({column}) AS MissingRows "
        f"FROM {table}"
        for system, tables in SYSTEM_TABLES.items()
        for table in tables
        for column, data_type in _columns(table)
    )


def _pk() -> str:
    parts = []
    for system, tables in SYSTEM_TABLES.items():
        for table in tables:
            keys = PRIMARY_KEYS[table]
            parts.append(
                f"SELECT '{system}' AS SourceSystem, '{table}' AS TableName, '{keys}' AS KeyColumns, "
                "CAST(sum(n) AS BIGINT) AS RecordCount, count(*) AS DistinctKeys, "
                "count(*) FILTER (WHERE n > 1) AS RepeatedKeys, CAST(0 AS BIGINT) AS NullKeyRows, "
                "max(n) = 1 AS IsPrimaryKey "
                f"FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys}) k"
            )
    return "\nUNION ALL ".join(parts)


def _discovered() -> str:
    """Keys of ORDERS' tables and references to them, from all values of whole numbers and texts."""
    tables = SYSTEM_TABLES["Orders"]
    kinds = {"int": "number", "bigint": "number", "string": "text"}
    columns = [(t, c, kinds[kind]) for t in tables for c, kind in _columns(t) if kind in kinds]
    counted = " UNION ALL ".join(
        f"SELECT '{t}' AS t, '{c}' AS c, '{kind}' AS kind, {i} AS nr, count(*) AS n, count({c}) AS f, count(DISTINCT {c}) AS d FROM {t}"
        for i, (t, c, kind) in enumerate(columns)
    )
    both = " UNION ALL ".join(
        f"SELECT '{t}' AS t, '{a}' AS a, '{b}' AS b, (SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM {t}) x) AS d"
        for i, (t, a, _) in enumerate(columns)
        for u, b, _ in columns[i + 1 :]
        if u == t
    )
    held = " UNION ".join(
        f"SELECT {i} AS nr, '{kind}' AS kind, CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL"
        for i, (t, c, kind) in enumerate(columns)
    )
    keys = ", ".join(f"('{t}', '{PRIMARY_KEYS[t]}')" for t in tables)
    links = ", ".join(
        f"('{t}', '{c}', '{p}({k})')" for t, c, p, k in SYSTEM_FOREIGN_KEYS["Orders"]
    )
    return f"""WITH counted AS ({counted}),
      single AS (SELECT * FROM counted WHERE n > 0 AND f = n AND d = n),
      both_ AS ({both}),
      held AS ({held}),
      met AS (SELECT a.nr AS child, b.nr AS parent, count(*) AS n FROM held a JOIN held b USING (kind, v)
              WHERE a.nr <> b.nr GROUP BY 1, 2)
      SELECT 'Orders' AS SourceSystem, t AS TableName, c AS KeyColumns, CAST(NULL AS VARCHAR) AS "References",
        (t, c) IN ({keys}) AS Declared FROM single
      UNION ALL
      SELECT 'Orders', x.t, x.a || ',' || x.b, NULL, (x.t, x.a || ',' || x.b) IN ({keys})
      FROM both_ x JOIN counted a ON a.t = x.t AND a.c = x.a JOIN counted b ON b.t = x.t AND b.c = x.b
      WHERE a.n > 0 AND a.f = a.n AND b.f = b.n AND a.d < a.n AND b.d < b.n AND x.d = a.n
      UNION ALL
      SELECT 'Orders', a.t, a.c, p.t || '(' || p.c || ')', (a.t, a.c, p.t || '(' || p.c || ')') IN ({links})
      FROM met JOIN counted a ON a.nr = child JOIN single p ON p.nr = parent WHERE met.n = a.d"""


def _fk() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{system}' AS SourceSystem, '{table}({column})' AS ForeignKey, "
        f"'{parent}({parent_column})' AS \"References\", count({column}) AS ChildRows, "
        f"count(DISTINCT {column}) AS ChildKeys, "
        f"count(DISTINCT {column}) FILTER (WHERE {column} NOT IN (SELECT {parent_column} FROM {parent})) AS OrphanKeys, "
        f"count({column}) FILTER (WHERE {column} NOT IN (SELECT {parent_column} FROM {parent})) AS OrphanRows "
        f"FROM {table}"
        for system, keys in SYSTEM_FOREIGN_KEYS.items()
        for table, column, parent, parent_column in keys
    )


ORACLE: dict[str, str] = {
    "dim_source_system": _with(FACT, SOURCES)
    + "SELECT SourceSystemID, SourceSystemName, count(*) AS FactRows "
    "FROM sources JOIN fact USING (SourceSystemID) GROUP BY 1, 2",
    "dim_customer": _with(DIM_CUSTOMER)
    + """SELECT CustomerID, CustomerName, CAST(NULL AS VARCHAR) AS CompanyName, CAST(NULL AS VARCHAR) AS City,
      CAST(NULL AS VARCHAR) AS State, Country, CAST(NULL AS VARCHAR) AS PostalCode,
      CAST(NULL AS VARCHAR) AS Phone, CAST(NULL AS VARCHAR) AS Email FROM dim_customer""",
    "dim_employee": _with(DIM_EMPLOYEE)
    + "SELECT EmployeeID, EmployeeName, Title, CAST(NULL AS VARCHAR) AS City, Country, ReportsTo FROM dim_employee",
    "dim_product": _with(DIM_PRODUCT)
    + "SELECT ProductID, ProductName, CategoryName, GenreName, CAST(NULL AS VARCHAR) AS Composer, "
    "CAST(UnitPrice AS DOUBLE) AS UnitPrice FROM dim_product",
    "dim_time": _with(DIM_TIME)
    + "SELECT * REPLACE (CAST(FullDate AS VARCHAR) AS FullDate) FROM dim_time",
    "fact_sales": _with(FACT) + "SELECT * REPLACE (CAST(SalesAmount AS DOUBLE) AS SalesAmount) FROM fact",
    "canonical_keys": """SELECT o_orderkey, 'A:' || CAST(o_custkey AS VARCHAR) AS FromBigint,
      'B:' || CAST(o_custkey AS VARCHAR) AS FromDouble, 'C:' || o_orderpriority AS FromText,
      CASE WHEN o_orderstatus <> 'P' THEN 'D:' || CAST(o_custkey AS VARCHAR) END AS FromOptional FROM orders""",
    "person_name": """SELECT p_partkey,
      trim(CASE WHEN p_size % 5 <> 0 THEN split_part(p_name, ' ', 1) ELSE '' END || ' '
        || CASE WHEN p_size % 7 <> 0 THEN split_part(p_name, ' ', 2) ELSE '' END) AS PersonName FROM part""",
    "indirect_attribution": _with(FACT, DIM_EMPLOYEE)
    + f"""SELECT EmployeeID, count(*) AS Lines, count(DISTINCT CustomerID) AS Customers, {SUMS}, EmployeeName
      FROM fact LEFT JOIN dim_employee USING (EmployeeID)
      WHERE SourceSystemID = 2 AND EmployeeID IS NOT NULL GROUP BY EmployeeID, EmployeeName""",
    "attribute_coverage": _coverage(),
    "revenue_by_source": _with(FACT, SOURCES)
    + f"SELECT SourceSystemName, {SUMS} FROM fact JOIN sources USING (SourceSystemID) GROUP BY 1",
    "filtered_revenue": _with(FACT, SOURCES)
    + f"""SELECT SourceSystemName, {SUMS} FROM ({_FILTERED}) f JOIN sources USING (SourceSystemID)
      WHERE SourceSystemName = 'Orders' GROUP BY 1""",
    "top_customers": _top_customers(False),
    "top_customers_split": _top_customers(True),
    "top_customers_per_source": _with(FACT, DIM_CUSTOMER, SOURCES)
    + """SELECT SourceSystemName, CAST(r AS INTEGER) AS Rank, CustomerName, CAST(NULL AS VARCHAR) AS CompanyName,
      Country, CAST(a AS DOUBLE) AS SalesAmount, q AS SalesQuantity
      FROM (SELECT *, row_number() OVER (PARTITION BY SourceSystemID ORDER BY a DESC, CustomerID) AS r
            FROM (SELECT CustomerID, SourceSystemID, sum(SalesAmount) AS a, CAST(sum(SalesQuantity) AS BIGINT) AS q
                  FROM fact GROUP BY 1, 2) g) ranked
      JOIN dim_customer USING (CustomerID) JOIN sources USING (SourceSystemID) WHERE r <= 10""",
    "top_products": _top_products(),
    "top_products_by_quantity": _top_products("q"),
    "top_products_by_source": _top_products(split=True),
    "employee_performance": _employees(False),
    "employee_performance_split": _employees(True),
    "sales_by_period_day": _period("FullDate", "CAST(FullDate AS VARCHAR)"),
    "sales_by_period_month": _period("Month"),
    "sales_by_period_quarter": _period("Quarter"),
    "sales_by_period_year": _period("Year"),
    "sales_by_period_source": _with(FACT, DIM_TIME, SOURCES)
    + f"""SELECT Month, SourceSystemName, {SUMS} FROM fact JOIN dim_time USING (DateKey)
      JOIN sources USING (SourceSystemID) GROUP BY 1, 2""",
    "period_source_pivot": _with(FACT, DIM_TIME)
    + """SELECT Month, CAST(sum(SalesAmount) FILTER (WHERE SourceSystemID = 2) AS DOUBLE) AS Events,
      CAST(sum(SalesAmount) FILTER (WHERE SourceSystemID = 1) AS DOUBLE) AS Orders
      FROM fact JOIN dim_time USING (DateKey) GROUP BY 1""",
    "sales_by_year_month": _with(FACT, DIM_TIME)
    + f"SELECT Year, Month, {SUMS} FROM fact JOIN dim_time USING (DateKey) GROUP BY 1, 2",
    "sales_by_day_of_week": _period("DayOfWeek"),
    "sales_by_day_of_month": _period("DayOfMonth"),
    "source_system_comparison": _with(FACT, SOURCES)
    + f"""SELECT SourceSystemName, {SUMS}, count(*) AS TransactionCount,
      CAST(sum(SalesAmount) AS DOUBLE) / count(*) AS AvgLineValue
      FROM fact JOIN sources USING (SourceSystemID) GROUP BY 1""",
    "revenue_share": _with(FACT, SOURCES)
    + """SELECT SourceSystemName, CAST(a AS DOUBLE) AS SalesAmount,
      CAST(a AS DOUBLE) * 100 / CAST((SELECT sum(SalesAmount) FROM fact) AS DOUBLE) AS SharePercent,
      CAST(a AS DOUBLE) / CAST(min(a) OVER () AS DOUBLE) AS RatioToSmallest
      FROM (SELECT SourceSystemID, sum(SalesAmount) AS a FROM fact GROUP BY 1) g
      JOIN sources USING (SourceSystemID)""",
    "scale_gap": _with(FACT)
    + """, g AS (SELECT CAST(sum(SalesAmount) AS DOUBLE) AS total, CAST(sum(SalesAmount) AS DOUBLE) / count(*) AS average
      FROM fact GROUP BY SourceSystemID)
      SELECT 'SalesAmount' AS Measure, min(total) AS MinValue, max(total) AS MaxValue,
        min(total) > 0 AND max(total) / min(total) >= 20 AS ScaleGap FROM g
      UNION ALL SELECT 'AvgLineValue', min(average), max(average),
        min(average) > 0 AND max(average) / min(average) >= 20 FROM g""",
    "totals_rollup": _with(FACT, SOURCES)
    + f"""SELECT coalesce(SourceSystemName, 'Combined') AS Label, {SUMS}
      FROM fact JOIN sources USING (SourceSystemID) GROUP BY ROLLUP (SourceSystemName)""",
    "totals_check": """WITH t AS (
        SELECT 'Orders' AS Label, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS a FROM lineitem
        UNION ALL SELECT 'Events', sum(CAST(value AS DECIMAL(18,2))) FROM events WHERE event_type = 'purchase')
      SELECT coalesce(Label, 'Combined') AS Label, CAST(sum(a) AS DOUBLE) AS Documented,
        CAST(sum(a) AS DOUBLE) AS Computed, CAST(0 AS DOUBLE) AS Difference, TRUE AS Matches
      FROM t GROUP BY ROLLUP (Label)""",
    "totals_check_selected": """WITH t AS (
        SELECT 'Orders' AS Label, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS a FROM lineitem
        UNION ALL SELECT 'Events', sum(CAST(value AS DECIMAL(18,2))) FROM events WHERE event_type = 'purchase')
      SELECT coalesce(Label, 'Combined') AS Label, CAST(sum(a) AS DOUBLE) AS Documented,
        CAST(sum(a) AS DOUBLE) AS Computed, CAST(0 AS DOUBLE) AS Difference, TRUE AS Matches, Selection
      FROM t, (VALUES ('all'), ('all sources by name')) s(Selection) GROUP BY Selection, ROLLUP (Label)""",
    "calendar_filter": _with(FACT, DIM_TIME)
    + f"SELECT SourceSystemID, Year, {SUMS} FROM fact JOIN dim_time USING (DateKey) WHERE Quarter = 3 GROUP BY 1, 2",
    "reports_after_reload": _with(FACT, SOURCES).replace("event_type = 'purchase'", "event_type = 'purchase' AND event_id % 5 <> 0")
    + f""", days AS (
        SELECT CAST(o_orderdate AS DATE) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        UNION ALL SELECT CAST(ts AS DATE) FROM events JOIN customer ON user_id = c_custkey
        WHERE event_type = 'purchase' AND event_id % 5 <> 0)
      SELECT SourceSystemName, {SUMS}, count(*) AS TransactionCount,
        CAST(sum(SalesAmount) AS DOUBLE) / count(*) AS AvgLineValue,
        (SELECT CAST(min(d) AS VARCHAR) FROM days) AS MinDate, (SELECT CAST(max(d) AS VARCHAR) FROM days) AS MaxDate,
        (SELECT count(*) FROM fact) AS FactRows
      FROM fact JOIN sources USING (SourceSystemID) GROUP BY 1""",
    "schema_drift": """SELECT * FROM (VALUES
        ('customer', 'c_mktsegment', 'gone', 'string', NULL), ('customer', 'c_since', 'added', NULL, 'date'),
        ('part', 'p_size', 'widened', 'int', 'bigint'), ('part', 'p_retailprice', 'retyped', 'double', 'string'))
      d(TableName, ColumnName, Change, TypeBefore, TypeAfter)""",
    "loads_together": _loads_together(),
    "retained_load": _with(f"fact AS ({_ORDERS_FACT})", DIM_TIME)
    + f"SELECT Year, Month, {SUMS} FROM fact JOIN dim_time USING (DateKey) GROUP BY Year, Month",
    "date_bounds": """SELECT CAST(min(d) AS VARCHAR) AS MinDate, CAST(max(d) AS VARCHAR) AS MaxDate FROM (
        SELECT CAST(o_orderdate AS DATE) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        UNION ALL SELECT CAST(ts AS DATE) FROM events JOIN customer ON user_id = c_custkey
        WHERE event_type = 'purchase') days""",
    "sales_by_classification": _with(FACT, DIM_PRODUCT)
    + f"""SELECT coalesce(GenreName, CategoryName, 'Unclassified') AS Classification, {SUMS}
      FROM fact LEFT JOIN dim_product USING (ProductID) GROUP BY 1""",
    "sales_by_title": _with(FACT, DIM_EMPLOYEE)
    + f"SELECT Title, {SUMS} FROM fact JOIN dim_employee USING (EmployeeID) GROUP BY 1",
    "fact_narrative": _with(*_ALL_DIMS) + _narrative("fact"),
    "picked_row_narrative": _with(*_ALL_DIMS)
    + f""", picked AS (SELECT * FROM ({_FILTERED}) f
      ORDER BY DateKey NULLS FIRST, CustomerID NULLS FIRST, EmployeeID NULLS FIRST, ProductID NULLS FIRST,
        SourceSystemID, SalesQuantity, SalesAmount LIMIT 1 OFFSET 1000)"""
    + _narrative("picked"),
    "top_parents_by_children": """SELECT n_nationkey AS ParentKey, n_name AS ParentName, count(s_suppkey) AS ChildCount
      FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1, 2
      ORDER BY ChildCount DESC, ParentName, ParentKey LIMIT 10""",
    "parent_child_listing": """SELECT n_name AS ParentName, s_name AS ChildName
      FROM nation JOIN supplier ON n_nationkey = s_nationkey ORDER BY n_name, s_name LIMIT 10""",
    "employee_manager": _with(DIM_EMPLOYEE)
    + """SELECT e.EmployeeID, e.EmployeeName, e.Title, e.ReportsTo, m.EmployeeName AS ManagerName,
      m.Title AS ManagerTitle FROM dim_employee e LEFT JOIN dim_employee m ON e.ReportsTo = m.EmployeeID""",
    "manager_rollup": "WITH RECURSIVE "
    + ",\n".join((FACT, DIM_EMPLOYEE))
    + """, own AS (SELECT EmployeeID, sum(SalesAmount) AS a FROM fact WHERE EmployeeID IS NOT NULL GROUP BY 1),
      chain(EmployeeID, BossID) AS (
        SELECT EmployeeID, ReportsTo FROM dim_employee WHERE ReportsTo IS NOT NULL
        UNION ALL SELECT c.EmployeeID, e.ReportsTo FROM chain c JOIN dim_employee e ON c.BossID = e.EmployeeID
        WHERE e.ReportsTo IS NOT NULL),
      below AS (SELECT BossID, count(*) AS people, sum(coalesce(a, 0)) AS a
        FROM chain LEFT JOIN own USING (EmployeeID) GROUP BY 1)
      SELECT e.EmployeeID, EmployeeName, coalesce(people, 0) AS PeopleBelow,
        CAST(coalesce(own.a, 0) AS DOUBLE) AS OwnAmount,
        CAST(coalesce(own.a, 0) + coalesce(below.a, 0) AS DOUBLE) AS TeamAmount
      FROM dim_employee e LEFT JOIN own ON own.EmployeeID = e.EmployeeID
      LEFT JOIN below ON BossID = e.EmployeeID""",
    "header_reconciliation": """SELECT o_orderkey AS HeaderKey, CAST(t AS DOUBLE) AS HeaderTotal,
      CAST(a AS DOUBLE) AS LinesTotal, CAST(a - t AS DOUBLE) AS Difference, abs(a - t) <= 0.01 AS Matches
      FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS t,
              coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS a
            FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_totalprice) g""",
    "dq_key_nulls": _with(FACT, INTAKE)
    + """, g AS (SELECT SourceSystemID, count(*) AS n, count(DateKey) AS d, count(CustomerID) AS c,
        count(EmployeeID) AS e, count(ProductID) AS p FROM fact4 GROUP BY 1)
      SELECT SourceSystemID, n AS FactRows, 'DateKey' AS KeyColumn, n - d AS NullRows FROM g
      UNION ALL SELECT SourceSystemID, n, 'CustomerID', n - c FROM g
      UNION ALL SELECT SourceSystemID, n, 'EmployeeID', n - e FROM g
      UNION ALL SELECT SourceSystemID, n, 'ProductID', n - p FROM g""",
    "dq_duplicate_lines": _with(STAGED) + DUPLICATES,
    "dq_orphans": _with(KEY_USAGE)
    + """SELECT ForeignKey, KeyValue, UsingRows FROM uses
      WHERE (ForeignKey, KeyValue) NOT IN (SELECT (ForeignKey, KeyValue) FROM definitions)""",
    "key_consistency": _with(KEY_USAGE)
    + """SELECT ForeignKey, CASE WHEN contains(KeyValue, ':') THEN split_part(KeyValue, ':', 1) ELSE '' END AS Namespace,
      count(UsingRows) AS UsedKeys, count(DefiningRows) AS DefinedKeys,
      count(*) FILTER (WHERE UsingRows IS NOT NULL AND DefiningRows IS NOT NULL) AS SharedKeys,
      count(*) FILTER (WHERE DefiningRows IS NULL) AS OrphanKeys,
      count(*) FILTER (WHERE DefiningRows > 1) AS RepeatedMembers,
      CAST(coalesce(sum(UsingRows), 0) AS BIGINT) AS UsingRows
      FROM uses FULL JOIN definitions USING (ForeignKey, KeyValue) GROUP BY 1, 2""",
    "dq_bad_dates": _with(STAGED) + BAD_DATES,
    "dq_bad_measures": _with(STAGED) + BAD_MEASURES,
    "quarantine": _with(STAGED)
    + f"""SELECT SourceSystemID, LineKey, CASE WHEN ok THEN 'loaded' ELSE 'rejected' END AS Status,
      CASE WHEN NOT ok THEN Reason END AS Reason
      FROM (SELECT *, {MEASURE_FAULT} AS Reason, SalesQuantity IS NOT NULL AND Price IS NOT NULL AS ok
            FROM staged) i""",
    "dq_violations": _with(STAGED)
    + f"""SELECT 'duplicate line' AS Rule, SourceSystemID, LineKey, CAST(Copies AS VARCHAR) || ' copies' AS Reason
        FROM ({DUPLICATES}) d
      UNION ALL SELECT 'date', SourceSystemID, LineKey, Reason FROM ({BAD_DATES}) b
      UNION ALL SELECT 'measure', SourceSystemID, LineKey, Reason FROM ({BAD_MEASURES}) m""",
    "line_measure": """SELECT l_orderkey, l_linenumber, a AS FromDouble, a AS FromText, a AS FromDecimal,
      CAST(floor(l_quantity / 4) AS BIGINT) AS Units
      FROM (SELECT *, CAST(CAST(CAST(l_extendedprice AS DECIMAL(20,6)) * CAST(l_quantity / 4 AS DECIMAL(17,6))
              AS DECIMAL(18,2)) AS DOUBLE) AS a FROM lineitem) m""",
    "third_source": _with(FACT, FACT3)
    + """, b AS (SELECT SourceSystemID, count(*) AS n, sum(SalesAmount) AS a FROM fact GROUP BY 1),
      c AS (SELECT SourceSystemID, count(*) AS n, sum(SalesAmount) AS a FROM fact3 GROUP BY 1)
      SELECT c.SourceSystemID, CASE c.SourceSystemID WHEN 1 THEN 'Orders' WHEN 2 THEN 'Events' ELSE 'Signups' END AS SourceSystemName,
        coalesce(b.n, 0) AS RowsBefore, c.n AS RowsAfter, CAST(coalesce(b.a, 0) AS DOUBLE) AS AmountBefore,
        CAST(c.a AS DOUBLE) AS AmountAfter, b.n = c.n AND b.a = c.a AS HistoryUnchanged
      FROM c LEFT JOIN b USING (SourceSystemID)""",
    "source_volume": _with(FACT, INTAKE)
    + """, f AS (SELECT SourceSystemID, count(*) AS n FROM fact4 GROUP BY 1),
      raw AS (SELECT 1 AS SourceSystemID, 'Orders' AS name, (SELECT count(*) FROM lineitem) AS delivered,
                (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS joined
        UNION ALL SELECT 2, 'Events', (SELECT count(*) FROM events WHERE event_type = 'purchase'),
                (SELECT count(*) FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase')
        UNION ALL SELECT 4, 'Intake', (SELECT count(*) FROM events), (SELECT count(*) FROM events))
      SELECT SourceSystemID, name AS SourceSystemName, delivered AS SourceLines, delivered - joined AS LostInJoins,
        joined - n AS Rejected, n AS FactRows FROM raw JOIN f USING (SourceSystemID)""",
    "key_changes": _with(KEY_LOADS) + "SELECT * FROM changes",
    "key_stability": _with(KEY_LOADS)
    + """, sizes AS (
        SELECT Dimension, count(*) FILTER (side = 'b') AS KeysBefore, count(*) FILTER (side = 'l') AS KeysAfter
        FROM (SELECT Dimension, 'b' AS side FROM before UNION ALL SELECT Dimension, 'l' FROM later) s GROUP BY 1),
      kinds AS (
        SELECT Dimension, count(*) FILTER (Change = 'added') AS Added, count(*) FILTER (Change = 'gone') AS Gone,
          count(*) FILTER (Change = 'renamed') AS Renamed, count(*) FILTER (Change = 'reassigned') AS Reassigned
        FROM changes GROUP BY 1)
      SELECT Dimension, KeysBefore, KeysAfter, coalesce(Added, 0) AS Added, coalesce(Gone, 0) AS Gone,
        coalesce(Renamed, 0) AS Renamed, coalesce(Reassigned, 0) AS Reassigned,
        KeysBefore - coalesce(Gone + Renamed + Reassigned, 0) AS Stable
      FROM sizes LEFT JOIN kinds USING (Dimension)""",
    "staged_load": _with(FACT, INTAKE)
    + """, f AS (SELECT SourceSystemID, count(*) AS n FROM fact4 GROUP BY 1),
      raw AS (SELECT 1 AS SourceSystemID, 'Orders' AS name, (SELECT count(*) FROM lineitem) AS delivered,
                (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS joined
        UNION ALL SELECT 2, 'Events', (SELECT count(*) FROM events WHERE event_type = 'purchase'),
                (SELECT count(*) FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase')
        UNION ALL SELECT 4, 'Intake', (SELECT count(*) FROM events), (SELECT count(*) FROM events)),
      v AS (SELECT SourceSystemID, name AS SourceSystemName, delivered AS SourceLines, delivered - joined AS LostInJoins,
        joined - n AS Rejected, n AS FactRows FROM raw JOIN f USING (SourceSystemID))
      SELECT *, SourceLines AS ObservedSourceLines, LostInJoins AS ObservedLostInJoins,
        Rejected AS ObservedRejected, FactRows AS ObservedFactRows FROM v""",
    "table_inventory": _inventory(),
    "business_tables": _inventory(),
    "source_inventory": _source_inventory(),
    "profile_columns": _profile(),
    "pk_uniqueness": _pk(),
    "discovered_keys": _discovered(),
    "source_foreign_keys": _fk(),
}
