"""For the queries of the catalogue, the same question in SQL that another engine answers."""

from __future__ import annotations

from tidemark.plans.derived import POSTGRES_TYPE_NAMES

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

FRAMES = {
    "idx_log": f"""
        SELECT 'dw' AS datastore_name, 'ev' AS database_name, event_type AS table_name,
               strftime(max(ts), {STAMP}) AS index_value, CAST(date_trunc('day', ts) AS TIMESTAMP) AS created_ts
        FROM events GROUP BY event_type, date_trunc('day', ts)""",
    "run_log": f"""
        SELECT max(ts) AS index_ts, date_trunc('day', ts) AS created_ts,
               row_number() OVER (ORDER BY date_trunc('day', ts) DESC) AS rn
        FROM events GROUP BY date_trunc('day', ts)""",
    "orders_tgt": "SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30'",
    "orders_stg": """
        SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate > TIMESTAMP '1998-03-31' AND o_orderdate <= TIMESTAMP '1998-12-31'""",
    "orders_drifted": """
        SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey // 64 % 20 = 3 AND o_orderkey % 3 = 1 THEN 1 ELSE 0 END AS o_totalprice)
        FROM orders
        WHERE (o_orderdate <= TIMESTAMP '1998-06-30' OR o_orderkey // 64 % 20 = 3)
          AND NOT (o_orderkey // 64 % 20 = 3 AND o_orderkey % 3 = 0)""",
    "lineitem_tgt": "SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-06-30'",
    "lineitem_stg": """
        SELECT * FROM lineitem
        WHERE l_shipdate > TIMESTAMP '1998-03-31' AND l_shipdate <= TIMESTAMP '1998-12-31'""",
    "nullkey_tgt": """
        SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderkey END AS k, o_orderstatus AS v FROM orders_tgt""",
    "nullkey_stg": """
        SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderkey END AS k, o_orderstatus AS v FROM orders_stg""",
    "events_nullidx": """
        SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS ts, event_type FROM events""",
    "orders_moved": """
        SELECT * FROM orders_tgt UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 365 DAY, o_orderpriority
        FROM orders_stg""",
    "col_src": "SELECT DISTINCT p_brand AS table_name, p_name AS column_name FROM part WHERE p_size >= 5",
    "col_tgt": """
        SELECT DISTINCT p_brand AS table_name, p_name AS column_name FROM part
        WHERE p_size >= 15 AND p_type <> 'ECONOMY'""",
    "acl_texts": "SELECT c_custkey, c_nationkey FROM customer",
    "settings": """
        SELECT p_partkey, (p_size & 1) > 0 AS ic, (p_size & 2) > 0 AS isql, (p_size & 4) > 0 AS ao,
               (p_size & 8) > 0 AS fr, (p_size & 16) > 0 AS qf, (p_size & 32) > 0 AS rb,
               p_type = 'STANDARD' AS pk, p_type = 'PROMO' AS tf, p_type = 'ECONOMY' AS sf
        FROM part""",
    "accounts_tgt": """
        SELECT c_custkey AS account_id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, 'crm' AS source_alias
        FROM customer WHERE c_nationkey < 15 UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'erp' FROM supplier WHERE s_nationkey < 15""",
    "accounts_stg": """
        SELECT c_custkey AS account_id, c_name AS name, c_nationkey AS nation, c_acctbal + 1 AS balance,
               'crm' AS source_alias
        FROM customer WHERE c_nationkey >= 10 UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal + 1, 'erp' FROM supplier WHERE s_nationkey >= 10""",
    "index_pairs": f"""
        SELECT event_id,
               CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN strftime(ts, {STAMP})
                    WHEN 'error' THEN 'abcd' WHEN 'purchase' THEN CAST(event_id AS VARCHAR) END AS old_value,
               CASE event_type WHEN 'view' THEN strftime(ts + to_seconds(user_id - 50), {STAMP}) WHEN 'purchase' THEN NULL
                    ELSE CAST(event_id AS VARCHAR) END AS new_value,
               CASE event_type WHEN 'view' THEN 'timestamp' ELSE 'int' END AS kind
        FROM events""",
    "dates_txt": """
        SELECT o_orderkey, CASE o_orderpriority WHEN '2-HIGH' THEN '0000-00-00 00:00:00' WHEN '3-MEDIUM' THEN ''
               WHEN '4-NOT SPECIFIED' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS d
        FROM orders""",
}


def _with(names: str, select: str) -> str:
    """The select, which may go on with frames of its own after a comma, behind the named frames."""
    frames = ", ".join(f"{name} AS ({FRAMES[name]})" for name in names.split())
    return f"WITH {frames} {select}"


def _upsert(target: str, staging: str, *keys: str) -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return (
        f"SELECT t.* FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {staging} s WHERE {on}) "
        f"UNION ALL BY NAME SELECT * FROM {staging}"
    )


def _bytes(*columns: str) -> str:
    return " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 0)" for c in columns)


#: Type texts, in the order of the frame ``mysql_types``, with what each must become; % stands for a number, # for four times it.
_MYSQL_EXPECTED = (
    ("tinyint(%) unsigned", "smallint"),
    ("smallint(%)", "smallint"),
    ("smallint unsigned", "integer"),
    ("MEDIUMINT(%)", "integer"),
    ("int", "integer"),
    ("int unsigned", "bigint"),
    ("INT(%) UNSIGNED ZEROFILL", "bigint"),
    ("bigint(%)", "bigint"),
    ("bigint unsigned", "numeric(65, 0)"),
    ("float unsigned", "real"),
    ("DOUBLE", "double precision"),
    ("decimal(%,2) unsigned", "decimal(%,2)"),
    ("VARCHAR(%)", "varchar(#)"),
    ("char(%)", "varchar(#)"),
    ("varchar(%000)", "varchar(#000)"),
    ("bit(1)", "boolean"),
    ("bit(64)", "varchar(64)"),
    ("set('a','b')", "varchar(65535)"),
    ("mediumtext", "varchar(65535)"),
    ("datetime(6)", "timestamp"),
    ("date", "date"),
    ("time(3)", "varchar(40)"),
    ("year", "integer"),
    ("char(36)", "char(36)"),
)


def _mysql_type() -> str:
    rows = ", ".join(f"({i}, '{s.replace(chr(39), chr(39) * 2)}', '{t}')" for i, (s, t) in enumerate(_MYSQL_EXPECTED))
    return f"""
        WITH wanted(i, s, t) AS (VALUES {rows}),
        n AS (SELECT p_partkey, replace(s, '%', CAST(p_size AS VARCHAR)) AS source_type,
                     CASE WHEN t LIKE 'varchar(#%' THEN 'varchar(' || least(65535,
                            4 * CAST(p_size AS BIGINT) * CASE WHEN t LIKE '%000)' THEN 1000 ELSE 1 END) || ')'
                          ELSE replace(t, '%', CAST(p_size AS VARCHAR)) END AS target_type
              FROM part JOIN wanted ON wanted.i = p_partkey % {len(_MYSQL_EXPECTED)})
        SELECT p_partkey, source_type, CASE WHEN source_type = 'char(36)' THEN 'char(36)' ELSE target_type END AS target_type
        FROM n"""


def _postgres_type() -> str:
    names = ", ".join(f"'{t}'" for t in POSTGRES_TYPE_NAMES)
    return f"""
        WITH t AS (SELECT p_partkey, ([{names}])[CAST(p_partkey % {len(POSTGRES_TYPE_NAMES)} + 1 AS INT)] AS source_type,
                          p_type, CASE WHEN p_size % 4 = 0 THEN -1 ELSE p_size END AS size,
                          least(p_size, 38) AS p, p_size % 7 AS s FROM part)
        SELECT p_partkey, source_type, CASE WHEN p_type = 'PROMO' THEN 'varchar(99)'
          WHEN source_type = 'numeric' AND p = 10 AND s = 3 THEN 'real'
          WHEN source_type IN ('numeric', 'decimal')
            THEN source_type || '(' || p || CASE WHEN s > 0 THEN ',' || s ELSE '' END || ')'
          WHEN source_type = 'varchar' THEN 'varchar(' || CASE WHEN size > 0 THEN CAST(size AS VARCHAR) ELSE 'max' END || ')'
          WHEN source_type IN ('text', 'jsonb') THEN 'varchar(max)' WHEN source_type = 'uuid' THEN 'char(36)'
          WHEN source_type = 'money' THEN 'decimal(19,2)' WHEN source_type = 'mood' THEN 'varchar(15)'
          ELSE source_type END AS target_type
        FROM t"""


def _grants() -> str:
    return _with(
        "acl_texts",
        """
        , wanted(kind, name, is_group, owner, "grant") AS (VALUES
            (2, 'PUBLIC', true, 'admin', 'SELECT'),
            (9, 'user', false, 'admin', 'INSERT'), (9, 'user', false, 'admin', 'SELECT'), (9, 'user', false, 'admin', 'UPDATE'),
            (9, 'user', false, 'admin', 'DELETE'), (9, 'user', false, 'admin', 'RULE'), (9, 'user', false, 'admin', 'REFERENCES'),
            (9, 'user', false, 'admin', 'TRIGGER'), (9, 'user', false, 'admin', 'DROP'),
            (9, 'reader', false, 'admin', 'INSERT'), (9, 'reader', false, 'admin', 'SELECT'),
            (9, 'group', true, 'owner', 'SELECT')),
        kinds AS (SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey,
                         CASE WHEN c_nationkey IN (0, 1, 3, 4) THEN 0 WHEN c_nationkey = 2 THEN 2 ELSE 9 END AS kind
                  FROM customer c)
        SELECT c_custkey, CASE name WHEN 'PUBLIC' THEN name WHEN 'group' THEN c_mktsegment || ',all' ELSE name || c_custkey END AS name,
               is_group, CASE owner WHEN 'owner' THEN owner || c_nationkey ELSE owner END AS owner, "grant"
        FROM kinds JOIN wanted USING (kind)""",
    )


def _profile() -> str:
    tables = {
        "region": "r_regionkey:long r_name:string",
        "nation": "n_nationkey:long n_name:string n_regionkey:long",
        "customer": "c_custkey:long c_name:string c_nationkey:long c_acctbal:double c_mktsegment:string",
        "supplier": "s_suppkey:long s_name:string s_nationkey:long s_acctbal:double",
        "part": "p_partkey:long p_name:string p_brand:string p_type:string p_size:long p_retailprice:double",
        "orders": "o_orderkey:long o_custkey:long o_orderstatus:string o_totalprice:double o_orderdate:string "
        "o_orderpriority:string",
        "lineitem": "l_orderkey:long l_partkey:long l_suppkey:long l_linenumber:long l_quantity:double "
        "l_extendedprice:double l_discount:double l_tax:double l_returnflag:string l_linestatus:string l_shipdate:string",
        "events": "event_id:long ts:string user_id:long event_type:string value:double props:string",
        "documents": "doc_id:long text:string lang:string source:string n_chars:long",
        "embeddings": "vec_id:long embedding:string label:long",
        "pages": "page_id:long url:string html:string",
        "benchmark": "item_id:long text:string",
        "labels": "doc_id:long quality:long toxic:long",
        "conversations": "conv_id:long turn:long role:string text:string",
    }
    listed = {t: [c.split(":") for c in columns.split()] for t, columns in tables.items()}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, '{s}' AS staging_type, "
        f"count(*) FILTER ({c} IS NULL) AS null_count, "
        # The text of an array has no size of its own.
        f"CAST(coalesce(max(strlen({'NULL' if c == 'embedding' else f'CAST({c} AS VARCHAR)'})), 0) AS BIGINT) AS max_bytes FROM {t}"
        for t, columns in listed.items()
        for i, (c, s) in enumerate(columns, 1)
    )


def _unique(table: str, *keys: str) -> str:
    key = ", ".join(keys)
    return (
        f"SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys, "
        f"CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"
    )


def _clock(micros: str) -> str:
    """A time of day from microseconds, with a fraction only when there is one."""
    return (
        f"CASE WHEN {micros} % 1000000 = 0 THEN strftime(make_timestamp({micros}), '%H:%M:%S') "
        f"ELSE strftime(make_timestamp({micros}), '%H:%M:%S.%f') END"
    )


def _iso(ts: str) -> str:
    return (
        f"CASE WHEN microsecond({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S') "
        f"ELSE strftime({ts}, {STAMP}) END"
    )


_FOLD = r"regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')"
_LATEST = "SELECT datastore_name, database_name, table_name, {0} AS index_value FROM idx_log GROUP BY ALL"

ORACLE: dict[str, str] = {
    "high_water_mark": f"""
        SELECT 'orders' AS table_name, strftime(max(o_orderdate), {STAMP}) AS index_value FROM orders UNION ALL
        SELECT 'orders_by_key', CAST(max(o_orderkey) AS VARCHAR) FROM orders UNION ALL
        SELECT 'events', strftime(max(ts), {STAMP}) FROM events UNION ALL
        SELECT 'lineitem', strftime(max(l_shipdate), {STAMP}) FROM lineitem""",
    "latest_index": _with("idx_log", _LATEST.format("arg_max(index_value, created_ts)")),
    "lookback_index": _with(
        "idx_log",
        """SELECT datastore_name, database_name, table_name, index_value FROM idx_log
           QUALIFY row_number() OVER (PARTITION BY datastore_name, database_name, table_name
                                      ORDER BY created_ts DESC) = 4""",
    ),
    "incremental_window": _with(
        "run_log",
        """SELECT * FROM events WHERE ts > (SELECT index_ts FROM run_log WHERE rn = 4)
           AND ts <= (SELECT index_ts FROM run_log WHERE rn = 1)""",
    ),
    "incremental_window_int": """
        SELECT * FROM orders WHERE o_orderkey > (SELECT (min(l_orderkey) + max(l_orderkey)) // 2 FROM lineitem)
        AND o_orderkey <= (SELECT max(o_orderkey) FROM orders)""",
    "first_load_window": _with(
        "run_log", "SELECT * FROM events WHERE ts <= (SELECT index_ts FROM run_log WHERE rn = 3)"
    ),
    "lookback_window": _with(
        "idx_log",
        """, ranked AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY created_ts DESC) AS rn FROM idx_log),
           b AS (SELECT table_name, CAST(max(index_value) AS TIMESTAMP) AS hi,
                        CAST(coalesce(max(index_value) FILTER (rn = 4), max(index_value) FILTER (rn = 1)) AS TIMESTAMP) AS lo
                 FROM ranked GROUP BY table_name)
           SELECT e.* FROM events e JOIN b ON b.table_name = e.event_type WHERE e.ts > b.lo AND e.ts <= b.hi""",
    ),
    "null_index_window": _with(
        "events_nullidx", "SELECT * FROM events_nullidx WHERE ts <= (SELECT max(ts) FROM events_nullidx)"
    ),
    "custom_index_sql": """
        SELECT max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS index_value FROM orders
        WHERE o_orderdate > TIMESTAMP '1996-06-30'""",
    "custom_sql_extract": """
        SELECT o.o_orderkey, o.o_orderdate, c.c_name, c.c_mktsegment
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
        WHERE o.o_orderdate > TIMESTAMP '1996-01-01' AND o.o_orderdate <= TIMESTAMP '2000-12-31' AND c.c_mktsegment <> 'MACHINERY'""",
    "state_key_override": """
        SELECT 'dw' AS datastore_name,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'urgent' ELSE o_orderpriority END AS database_name,
               o_orderstatus AS table_name, CAST(max(o_orderkey) AS VARCHAR) AS index_value,
               CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS created_ts
        FROM orders GROUP BY o_orderpriority, o_orderstatus, date_trunc('month', o_orderdate)""",
    "index_check": _with(
        "index_pairs",
        """SELECT *, CASE WHEN old_value IS NULL THEN true WHEN new_value IS NULL THEN false
             WHEN kind = 'int' THEN coalesce(try_cast(old_value AS BIGINT) <= try_cast(new_value AS BIGINT), false)
             ELSE coalesce(try_cast(old_value AS TIMESTAMP) <= try_cast(new_value AS TIMESTAMP), false) END AS follows
           FROM index_pairs""",
    ),
    "sync_plan": _with(
        "idx_log",
        f""", l AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY created_ts DESC) AS rn
                    FROM idx_log WHERE table_name <> 'signup'),
           m AS (SELECT event_type AS table_name, strftime(max(ts), {STAMP}) AS new_index_value FROM events GROUP BY 1),
           j AS (SELECT m.table_name, a.index_value AS old_v, b.index_value AS back_v, new_index_value
                 FROM m LEFT JOIN l a ON a.table_name = m.table_name AND a.rn = 1
                        LEFT JOIN l b ON b.table_name = m.table_name AND b.rn = 3)
           SELECT table_name, CASE WHEN old_v IS NULL THEN 'first_load' ELSE 'incremental' END AS mode,
                  old_v AS old_index_value, back_v AS lookback_index_value, coalesce(back_v, old_v) AS lower_value,
                  new_index_value FROM j""",
    ),
    "project_drop": "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "money_cast": "SELECT c_custkey, CAST(c_acctbal AS DECIMAL(19,2)) AS c_acctbal FROM customer",
    "zero_date_default": _with(
        "dates_txt",
        """SELECT o_orderkey, d, CASE WHEN d IS NULL THEN NULL
             ELSE coalesce(strftime(try_cast(d AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), '0001-01-01 00:00:00') END AS fixed
           FROM dates_txt""",
    ),
    "delete_using_staging": _with(
        "orders_tgt orders_stg",
        "SELECT t.* FROM orders_tgt t WHERE NOT EXISTS (SELECT 1 FROM orders_stg s WHERE s.o_orderkey = t.o_orderkey)",
    ),
    "delete_using_composite": _with(
        "lineitem_tgt lineitem_stg",
        """SELECT t.* FROM lineitem_tgt t WHERE NOT EXISTS (
             SELECT 1 FROM lineitem_stg s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)""",
    ),
    "upsert_orders": _with("orders_tgt orders_stg", _upsert("orders_tgt", "orders_stg", "o_orderkey")),
    "upsert_bucketed": _with("orders_tgt orders_stg", _upsert("orders_tgt", "orders_stg", "o_orderkey")),
    "delete_using_bitmap": _with(
        "lineitem_tgt lineitem_stg",
        """SELECT t.* FROM lineitem_tgt t WHERE NOT EXISTS (
             SELECT 1 FROM lineitem_stg s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)""",
    ),
    "source_drift": _with(
        "orders_tgt orders_drifted",
        """SELECT o_orderkey, CASE WHEN s.o_custkey IS NULL THEN 'deleted' WHEN t.o_custkey IS NULL THEN 'added' ELSE 'changed' END AS change
           FROM orders_tgt t FULL JOIN orders_drifted s USING (o_orderkey)
           WHERE t.o_custkey IS NULL OR s.o_custkey IS NULL OR t.o_totalprice <> s.o_totalprice""",
    ),
    "net_changes": _with(
        "lineitem_tgt lineitem_stg",
        ", new AS (" + _upsert("lineitem_tgt", "lineitem_stg", "l_orderkey", "l_linenumber") + """),
           gone AS (SELECT l_shipdate, count(*) AS n FROM (SELECT * FROM lineitem_tgt EXCEPT ALL SELECT * FROM new) GROUP BY 1),
           come AS (SELECT l_shipdate, count(*) AS n FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM lineitem_tgt) GROUP BY 1),
           same AS (SELECT l_shipdate, count(*) AS n FROM (SELECT * FROM new INTERSECT ALL SELECT * FROM lineitem_tgt) GROUP BY 1)
           SELECT l_shipdate, coalesce(gone.n, 0) AS deleted, coalesce(come.n, 0) AS inserted, coalesce(same.n, 0) AS unchanged
           FROM gone FULL JOIN come USING (l_shipdate) FULL JOIN same USING (l_shipdate)""",
    ),
    "upsert_composite_dupes": _with(
        "lineitem_tgt lineitem_stg", _upsert("lineitem_tgt", "lineitem_stg", "l_orderkey", "l_linenumber")
    ),
    "upsert_salted": _with(
        "lineitem_tgt lineitem_stg", _upsert("lineitem_tgt", "lineitem_stg", "l_orderkey", "l_linenumber")
    ),
    "upsert_null_keys": _with(
        "orders_tgt orders_stg nullkey_tgt nullkey_stg", _upsert("nullkey_tgt", "nullkey_stg", "k")
    ),
    "full_refresh": _with("orders_stg", "SELECT * FROM orders_stg"),
    "empty_refresh_keeps_target": _with("orders_tgt", "SELECT * FROM orders_tgt"),
    "scoped_truncate_refresh": _with(
        "orders_tgt orders_stg",
        """SELECT * FROM orders_tgt WHERE (o_orderpriority = '1-URGENT' AND o_totalprice > 1000) IS NOT TRUE
           UNION ALL SELECT * FROM orders_stg""",
    ),
    "append_only_load": """
        SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20' UNION ALL
        SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'""",
    "rebuild_new_schema": """
        SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'ch-' || o_orderstatus AS o_channel
        FROM orders""",
    "many_to_one_merge": _with(
        "accounts_tgt accounts_stg", _upsert("accounts_tgt", "accounts_stg", "source_alias", "account_id")
    ),
    "orphan_keys": _with(
        "orders_tgt",
        """SELECT o_orderkey FROM orders_tgt t WHERE NOT EXISTS (
             SELECT 1 FROM orders s WHERE NOT (s.o_orderstatus = 'F' AND s.o_orderpriority = '1-URGENT')
             AND s.o_orderkey = t.o_orderkey)""",
    ),
    "load_counts": _with(
        "lineitem_tgt lineitem_stg",
        """SELECT (SELECT count(*) FROM lineitem_tgt t WHERE EXISTS (
                     SELECT 1 FROM lineitem_stg s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
                  ) AS rows_deleted, (SELECT count(*) FROM lineitem_stg) AS rows_inserted""",
    ),
    "window_coverage": _with(
        "idx_log",
        """, ends AS (
             SELECT table_name, created_ts, CAST(index_value AS TIMESTAMP) - CASE
                    WHEN table_name = 'signup' AND dayofweek(created_ts) = 0 THEN INTERVAL 84 HOUR ELSE INTERVAL 0 HOUR END AS upper_ts
             FROM idx_log),
           logged AS (
             SELECT *, CASE table_name WHEN 'click' THEN created_ts WHEN 'error' THEN lag(upper_ts, 2) OVER w
                       ELSE lag(upper_ts, 1) OVER w END AS lower_ts
             FROM ends WINDOW w AS (PARTITION BY table_name ORDER BY created_ts)),
           before AS (
             SELECT *, row_number() OVER w AS n,
                    max(upper_ts) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
             FROM logged WINDOW w AS (PARTITION BY table_name ORDER BY created_ts)),
           steps AS (
             SELECT table_name, created_ts, lower_ts, upper_ts, reached,
                    CASE WHEN n = 1 THEN 'first' WHEN upper_ts < reached THEN 'back' WHEN lower_ts > reached THEN 'gap'
                         WHEN lower_ts = reached THEN 'adjoins' ELSE 'overlap' END AS step
             FROM before)
           SELECT *, CAST(1 + count(*) FILTER (WHERE step = 'gap') OVER (PARTITION BY table_name ORDER BY created_ts) AS BIGINT) AS island
           FROM steps""",
    ),
    "balanced_ranges": """
        SELECT 'lineitem' AS table_name, CAST(16 AS BIGINT) AS ranges, count(*) AS rows, true AS even FROM lineitem UNION ALL
        SELECT 'events', 16, count(*), true FROM events""",
    "profile_merged": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, true AS as_the_whole, "
        "true AS near_exact FROM events"
        for c in ("event_id", "user_id", "event_type", "value", "props")
    ),
    "footer_high_water_mark": f"""
        SELECT 'orders' AS table_name, CAST(max(o_orderkey) AS VARCHAR) AS index_value FROM orders UNION ALL
        SELECT 'lineitem', CAST(max(l_orderkey) AS VARCHAR) FROM lineitem UNION ALL
        SELECT 'events', strftime(max(ts), {STAMP}) FROM events""",
    "props_shape": """
        SELECT event_type, count(*) AS row_count, count(*) FILTER (WHERE event_type = 'error' AND event_id % 5 = 0) AS malformed,
               CASE event_type WHEN 'purchase' THEN 'OBJECT<k: BIGINT, label: STRING, tags: ARRAY<STRING>>'
                    WHEN 'view' THEN 'OBJECT<k: DECIMAL(3,1)>' WHEN 'signup' THEN 'VOID' ELSE 'OBJECT<k: BIGINT>' END AS shape
        FROM events GROUP BY event_type""",
    "props_members": """
        SELECT event_id, CASE WHEN event_type = 'signup' OR event_type = 'error' AND event_id % 5 = 0 THEN NULL
                    ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) + CASE event_type WHEN 'view' THEN 0.5 ELSE 0 END END AS k,
               CASE event_type WHEN 'purchase' THEN 'n' || json_extract_string(props, '$.k') END AS label,
               CASE event_type WHEN 'purchase' THEN 'b' END AS second_tag
        FROM events""",
    "stream_lookback_once": "SELECT * FROM events",
    "stream_index_window": "SELECT * FROM events",
    "conform_to_target": _with("orders_stg", "SELECT * FROM orders_stg"),
    "schema_diff": _with(
        "col_src col_tgt",
        """SELECT coalesce(s.table_name, t.table_name) AS table_name, coalesce(s.column_name, t.column_name) AS column_name,
                  CASE WHEN t.table_name IS NULL THEN 'source' ELSE 'target' END AS side
           FROM col_src s FULL JOIN col_tgt t ON s.table_name = t.table_name AND s.column_name = t.column_name
           WHERE s.table_name IS NULL OR t.table_name IS NULL""",
    ),
    "target_status": _with(
        "col_src col_tgt",
        """, x AS (SELECT table_name, count(*) AS n FROM col_tgt t WHERE NOT EXISTS (SELECT 1 FROM col_src s
                   WHERE s.table_name = t.table_name AND s.column_name = t.column_name) GROUP BY 1),
           y AS (SELECT table_name, count(*) AS n FROM col_src s WHERE NOT EXISTS (SELECT 1 FROM col_tgt t
                   WHERE s.table_name = t.table_name AND s.column_name = t.column_name) GROUP BY 1)
           SELECT b.table_name, CASE WHEN b.table_name NOT IN (SELECT table_name FROM col_tgt) THEN 'non-existent'
                    WHEN b.table_name IN (SELECT p_brand FROM part WHERE p_size = 50) THEN 'rebuild'
                    WHEN coalesce(x.n, 0) > 0 THEN 'incorrect' ELSE 'ok' END AS status,
                  coalesce(x.n, 0) AS extra_target_columns, coalesce(y.n, 0) AS extra_source_columns
           FROM (SELECT DISTINCT table_name FROM col_src) b LEFT JOIN x USING (table_name) LEFT JOIN y USING (table_name)""",
    ),
    "schema_profile": _profile(),
    "key_uniqueness": " UNION ALL ".join(
        [
            _unique("orders", "o_orderkey"),
            _unique("lineitem", "l_orderkey", "l_linenumber"),
            _unique("conversations", "conv_id", "turn"),
        ]
    ),
    "not_null_violations": _with(
        "events_nullidx",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS violations FROM events_nullidx"
            for c in ("event_id", "ts", "event_type")
        ),
    ),
    "mysql_type_map": _mysql_type(),
    "postgres_type_map": _postgres_type(),
    "type_override_cast": """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
               CAST(l_discount AS DECIMAL(12,2)) AS l_discount, CAST(l_tax AS DECIMAL(12,2)) AS l_tax,
               l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
        FROM lineitem""",
    "staging_types": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority, true AS as_declared
        FROM orders""",
    "iso_timestamp": f"""
        SELECT 'events' AS src, event_id AS id, {_iso('ts')} AS text FROM events UNION ALL
        SELECT 'orders', o_orderkey, {_iso('o_orderdate')} FROM orders""",
    "iso_date": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS text FROM orders",
    "iso_time": """
        SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%H:%M:%S')
               ELSE strftime(ts, '%H:%M:%S.%f') END AS text FROM events""",
    "time_of_day": f"SELECT event_id, {_clock('epoch_us(ts)')} AS text FROM events",
    "interval_time_of_day": f"""
        WITH m AS (SELECT event_id, (epoch_us(ts) - epoch_us((SELECT min(ts) FROM events))) % 86400000000 AS us FROM events)
        SELECT event_id, {_clock('us')} AS text FROM m""",
    "decimal_text": """
        SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(19,0)) AS VARCHAR) AS l_quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(19,2)) AS VARCHAR) AS l_extendedprice,
               CAST(CAST(l_discount AS DECIMAL(19,4)) AS VARCHAR) AS l_discount,
               CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) || 'E-10' AS l_tax
        FROM lineitem""",
    "ascii_fold": f"SELECT doc_id, {_FOLD.format('text')} AS text FROM documents",
    "truncate_text": "SELECT doc_id, left(text, 1000) AS text FROM documents",
    "fit_to_width": """
        SELECT p_partkey, left(repeat(chr(65533), CAST(p_size % 2 + 1 AS BIGINT)) || p_name, 8) AS p_name FROM part""",
    "json_text": f"""
        SELECT event_id, '{{"event_id": ' || event_id || ', "type": "' || event_type || '", "raw": "'
          || replace(props, '"', '\\"') || '", "value": ' || CAST(value AS VARCHAR) || ', "users": [' || user_id
          || ', null], "big": {{"' || event_type || '": ' || CAST(value > 50 AS VARCHAR) || '}}, "at": "'
          || {_iso('ts')} || '"}}' AS json
        FROM events""",
    "json_array_text": "SELECT vec_id, CAST(embedding AS VARCHAR) AS json FROM embeddings",
    "binary_text": "SELECT doc_id, text FROM documents",
    "uuid_text": r"""
        SELECT doc_id, regexp_replace(md5(text), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS u
        FROM documents""",
    "normalize_row": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
               CAST(CAST(c_acctbal AS DECIMAL(19,2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
               'Zoe ' || c_name || '  cafe' AS c_note
        FROM customer""",
    "extract_metrics": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS row_count,
               CAST(sum({_bytes('event_id', 'user_id', 'event_type', 'props', 'CAST(ts AS DATE)')}) AS BIGINT) AS upload_size
        FROM events GROUP BY strftime(ts, '%Y-%m-%d')""",
    "extract_monitor": f"""
        SELECT 'SyncTable(alias=dw, database=sales, table=' || o_orderpriority || ')' AS task_id, 'SyncTable' AS class_name,
               count(*) > 0 AS output_exists, count(*) AS row_count,
               CAST(sum({_bytes('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_orderpriority')}) AS BIGINT) AS upload_size
        FROM orders GROUP BY o_orderpriority""",
    "load_monitor": _with(
        "orders_tgt orders_stg",
        """, c AS (SELECT o_orderpriority AS n, 1 AS del, 0 AS ins, 0 AS size FROM orders_tgt t
                   WHERE EXISTS (SELECT 1 FROM orders_stg s WHERE s.o_orderkey = t.o_orderkey) UNION ALL
                   SELECT o_orderpriority, 0, 1, strlen(o_orderpriority) FROM orders_stg)
           SELECT 'SyncTable(alias=dw, database=sales, table=' || n || ')' AS task_id, 'SyncTable' AS class_name,
                  'public.' || n AS target_table, false AS manifest_cleaned, CAST(sum(ins) AS BIGINT) AS rows_inserted,
                  CAST(sum(del) AS BIGINT) AS rows_deleted, CAST(sum(size) AS BIGINT) AS load_size
           FROM c GROUP BY n""",
    ),
    "state_append": _with(
        "idx_log",
        f"""SELECT * FROM idx_log UNION ALL
            SELECT 'dw', 'sales', 'orders', CAST(max(o_orderkey) AS VARCHAR), TIMESTAMP '2024-03-01 12:00:00' FROM orders
            UNION ALL
            SELECT 'dw', 'sales', 'lineitem', strftime(max(l_shipdate), {STAMP}), TIMESTAMP '2024-03-01 12:00:00'
            FROM lineitem""",
    ),
    "stage_roundtrip": _with("orders_stg", "SELECT * FROM orders_stg"),
    "acl_explode": _grants(),
    "acl_entries": _with(
        "acl_texts",
        """SELECT c_custkey, CAST(CASE c_nationkey WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 1 THEN NULL WHEN 3 THEN NULL
             WHEN 4 THEN NULL ELSE 3 END AS INTEGER) AS entries FROM acl_texts""",
    ),
    "spec_conflicts": _with(
        "settings",
        """SELECT p_partkey,
             CASE WHEN ao AND NOT (ic OR isql) THEN 'append_only without index'
                  WHEN ao AND fr THEN 'append_only with full_refresh'
                  WHEN NOT (ic OR isql) AND NOT fr THEN 'incremental without index'
                  WHEN ic AND fr THEN 'full_refresh with index_column'
                  WHEN isql AND fr THEN 'full_refresh with index_sql'
                  WHEN isql AND ic THEN 'index_sql with index_column'
                  WHEN qf AND NOT pk AND NOT ao AND NOT fr THEN 'incremental query_file without primary_key'
             END AS conflict,
             CASE WHEN rb AND tf THEN 'rebuild with truncate_file' WHEN rb AND sf THEN 'rebuild with schema_file'
                  WHEN rb AND NOT fr THEN 'rebuild without full_refresh' END AS runtime_conflict
           FROM settings""",
    ),
    "clustered_layout": "SELECT * FROM lineitem",
    "published_upsert": _with(
        "orders_tgt orders_stg orders_moved",
        """, first AS (SELECT * FROM orders_tgt WHERE o_orderdate <= (SELECT max(o_orderdate) FROM orders_tgt)),
           win AS (SELECT * FROM orders_moved WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders_tgt)) """
        + _upsert("first", "win", "o_orderkey"),
    ),
    "published_append": _with(
        "orders_tgt orders_stg orders_moved",
        """, win AS (SELECT * FROM orders_moved WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders_tgt))
           SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders_tgt UNION ALL
           SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM win""",
    ),
    "published_monitor": _with(
        "orders_tgt orders_stg orders_moved",
        """, runs AS (
             SELECT count(*) AS n, CAST(0 AS BIGINT) AS gone FROM orders_tgt UNION ALL
             SELECT count(*), (SELECT count(*) FROM orders_tgt t WHERE o_orderkey IN (SELECT o_orderkey FROM orders_stg))
             FROM orders_moved WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders_tgt)),
           named AS (SELECT *, 'SyncTable(alias=shop, database=sales, table=source_shared)' AS task_id FROM runs)
           SELECT 'extract' AS monitor, task_id, n > 0 AS output_exists, n AS rows, CAST(NULL AS BIGINT) AS rows_deleted FROM named
           UNION ALL SELECT 'load', task_id, NULL, n, gone FROM named""",
    ),
    "published_clean_up": _with(
        "orders_tgt orders_stg orders_moved",
        "SELECT CAST(1 AS INTEGER) AS folders_deleted, count(*) AS row_count FROM orders_moved",
    ),
    "published_comments": _with(
        "orders_tgt",
        " UNION ALL ".join(
            f"SELECT 'all orders' AS table_comment, '{c}' AS column_name, 'the {c[2:]}' AS comment, count({c}) AS value_count "
            "FROM orders_tgt"
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        ),
    ),
    "published_schema_file": _with(
        "orders_tgt orders_stg orders_moved",
        """, win AS (SELECT * FROM orders_moved WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders_tgt)),
           live AS ("""
        + _upsert("orders_tgt", "win", "o_orderkey")
        + """) SELECT CAST(o_orderkey AS DECIMAL(12,0)) AS o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
               CAST(o_totalprice AS DECIMAL(12,1)) AS o_totalprice, o_orderstatus FROM live""",
    ),
    "published_rebuild_result": _with(
        "orders_tgt orders_stg orders_moved",
        f"""SELECT 'source_rebuilt' AS source_table, 'loaded' AS status, 'rebuild' AS mode, 'rebuild' AS target_status,
               strftime(max(o_orderdate), {STAMP}) AS new_index_value, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_deleted
            FROM orders_moved""",
    ),
    "published_refresh": _with("orders_tgt orders_stg orders_moved", "SELECT * FROM orders_moved"),
    "published_scoped_refresh": _with(
        "orders_tgt orders_stg orders_moved",
        "SELECT * FROM orders_tgt WHERE o_orderpriority <> '1-URGENT' UNION ALL SELECT * FROM orders_moved",
    ),
    "published_rebuild": _with(
        "orders_tgt orders_stg orders_moved",
        "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders_moved",
    ),
    "published_lookback": _with(
        "orders_tgt orders_stg orders_moved",
        """, win AS (SELECT * REPLACE ('L' AS o_orderstatus) FROM orders_moved
                      WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders_tgt) AND o_orderstatus = 'U') """
        + _upsert("orders_tgt", "win", "o_orderkey"),
    ),
    "published_merge": """
        SELECT c_custkey AS account_id, c_acctbal AS balance, 'crm' AS source_alias FROM customer WHERE c_acctbal > 0
        UNION ALL SELECT s_suppkey, s_acctbal, 'erp' FROM supplier""",
    "plan_sync": _with(
        "orders_tgt orders_stg orders_moved",
        f"""SELECT 'source_shared' AS source_table, 'ok' AS status, 'upsert' AS mode,
               strftime(max(o_orderdate), {STAMP}) AS old_index_value, strftime(max(o_orderdate), {STAMP}) AS new_index_value,
               CAST(NULL AS VARCHAR) AS create_columns, CAST(NULL AS VARCHAR) AS layout, CAST(NULL AS VARCHAR) AS conflict
            FROM orders_moved UNION ALL
            SELECT 'events', 'non-existent', 'append', NULL, strftime(max(ts), {STAMP}),
               'event_id BIGINT,ts TIMESTAMP_NTZ,user_id BIGINT,event_type STRING,value DOUBLE,props STRING', 'sortkey(ts)', NULL
            FROM events UNION ALL
            SELECT 'part', NULL, 'upsert', NULL, NULL, NULL, NULL, 'incremental without index'
            FROM (SELECT max(p_partkey) FROM part)""",
    ),
    "published_state": _with(
        "orders_tgt orders_stg orders_moved",
        f"""SELECT 'shop' AS datastore_name, 'sales' AS database_name, strftime(max(o_orderdate), {STAMP}) AS index_value
            FROM orders_tgt UNION ALL SELECT 'shop', 'sales', strftime(max(o_orderdate), {STAMP}) FROM orders_moved""",
    ),
    "published_manifest": _with(
        "orders_tgt orders_stg orders_moved",
        """, win AS (SELECT * FROM orders_moved WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders_tgt)),
           live AS ("""
        + _upsert("orders_tgt", "win", "o_orderkey")
        + ") SELECT true AS mandatory, count(*) AS row_count FROM live",
    ),
    "sync_many": f"""
        SELECT 'orders' AS source_table, 'loaded' AS status, 'upsert' AS mode, 'non-existent' AS target_status,
               CAST(max(o_orderkey) AS VARCHAR) AS new_index_value, count(*) AS rows_extracted,
               count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_deleted FROM orders UNION ALL
        SELECT 'lineitem', 'skipped', 'upsert', NULL, NULL, NULL, NULL, NULL FROM (SELECT max(l_orderkey) FROM lineitem)
        UNION ALL
        SELECT 'events', 'loaded', 'append', 'non-existent', strftime(max(ts), {STAMP}), count(*), count(*), 0 FROM events
        UNION ALL
        SELECT 'customer', 'loaded', 'full_refresh', 'non-existent', NULL, count(*), count(*), 0 FROM customer""",
    "stream_upsert": _with("orders_tgt orders_stg", _upsert("orders_tgt", "orders_stg", "o_orderkey")),
}
