"""DuckDB SQL that computes what each registered plan computes, straight
from the Parquet tables (views named after the tables)."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["flagship_totals"] = """
SELECT l_returnflag, l_linestatus,
       count(*) AS count_order,
       round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_discount), 2) AS sum_discount,
       round(sum(l_tax), 2) AS sum_tax
FROM lineitem
GROUP BY l_returnflag, l_linestatus
"""

ORACLE_SQL["delimited_round_trip"] = """
SELECT CAST(doc_id AS VARCHAR) AS _c0,
       nullif(translate(text, chr(9) || chr(10) || chr(13), '   '), '') AS _c1,
       nullif(translate(lang, chr(9) || chr(10) || chr(13), '   '), '') AS _c2,
       nullif(translate(source, chr(9) || chr(10) || chr(13), '   '), '') AS _c3,
       CAST(n_chars AS VARCHAR) AS _c4
FROM documents
"""

ORACLE_SQL["compressed_round_trip"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders
"""

ORACLE_SQL["sequence_round_trip"] = """
SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2,
       c_acctbal AS _c3, c_mktsegment AS _c4
FROM customer
"""

ORACLE_SQL["sequence_typed"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders
"""

ORACLE_SQL["shared_folder"] = """
SELECT 'orders' AS prefix, concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority) AS line
FROM orders
UNION ALL
SELECT 'customer', concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)
FROM customer, range(2)
"""

ORACLE_SQL["parquet_as_text"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
       CAST(user_id AS VARCHAR) AS user_id, nullif(event_type, '') AS event_type,
       value, nullif(props, '') AS props
FROM events
"""

ORACLE_SQL["parquet_as_text_arrays"] = """
SELECT CAST(vec_id AS VARCHAR) AS vec_id, CAST(embedding[-1] AS DOUBLE) AS embedding_last
FROM embeddings
"""

ORACLE_SQL["col_filter"] = """
SELECT nullif(props, '') AS _c0, CAST(user_id AS VARCHAR) AS _c1, 'const' AS _c2, '' AS _c3,
       CAST(NULL AS VARCHAR) AS _c4
FROM events
"""

ORACLE_SQL["split_regex_trailing"] = """
WITH lines AS (
  SELECT url, regexp_split_to_array(regexp_replace(html, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') AS ls
  FROM pages WHERE html <> ''
), one AS (
  SELECT url, unnest(generate_series(1, len(ls))) AS i, ls FROM lines
), parts AS (
  SELECT url, i - 1 AS line_no, ls[i] AS line, regexp_split_to_array(ls[i], '<br>|</?p>') AS p FROM one
), kept AS (
  SELECT url, line_no, line, p,
         coalesce(list_max(list_transform(p, lambda x, j: CASE WHEN x <> '' THEN j ELSE 0 END)), 0) AS k
  FROM parts
), fields AS (
  SELECT url, line_no,
         CASE WHEN line = '' THEN [''] ELSE list_slice(p, 1, k) END AS f
  FROM kept
)
SELECT url, CAST(line_no AS INTEGER) AS line_no, CAST(len(f) AS INTEGER) AS n_fields,
       nullif(f[1], '') AS first_field,
       CASE WHEN len(f) = 0 THEN NULL ELSE nullif(f[len(f)], '') END AS last_field
FROM fields
"""

ORACLE_SQL["null_fit_arity"] = """
SELECT p_partkey,
       nullif(string_split(p_name, ' ')[1], 'ring') AS _c0,
       nullif(string_split(p_name, ' ')[2], 'ring') AS _c1,
       nullif(string_split(p_name, ' ')[3], 'ring') AS _c2
FROM part
"""

ORACLE_SQL["dates_to_text"] = """
SELECT o_orderkey,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d %H:%M:%S') AS d_oracle,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d_mysql,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_text
FROM orders
"""

_PARSE = """
CASE WHEN {t} IS NULL THEN NULL
     WHEN length({t}) > 11 THEN coalesce(
        CASE WHEN regexp_full_match(trim({t}), '\\d{{8}} \\d{{2}}:[0-5]\\d:[0-5]\\d')
             THEN try_strptime(trim({t}), '%Y%m%d %H:%M:%S') END,
        CASE WHEN regexp_full_match(trim({t}), '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:[0-5]\\d:[0-5]\\d')
             THEN try_strptime(trim({t}), '%Y-%m-%d %H:%M:%S') END)
     ELSE coalesce(
        CASE WHEN regexp_full_match(trim({t}), '\\d{{8}}') THEN try_strptime(trim({t}), '%Y%m%d') END,
        CASE WHEN regexp_full_match(trim({t}), '\\d{{4}}-\\d{{2}}-\\d{{2}}')
             THEN try_strptime(trim({t}), '%Y-%m-%d') END,
        CASE WHEN regexp_full_match(trim({t}), '\\d{{2}}:[0-5]\\d:[0-5]\\d')
                  AND try_strptime(trim({t}), '%H:%M:%S') IS NOT NULL
             THEN CAST('1970-01-01 ' || trim({t}) AS TIMESTAMP) END)
END"""

ORACLE_SQL["parse_dates"] = (
    "WITH t AS (SELECT o_orderkey,"
    " strftime(o_orderdate, '%Y%m%d') AS t1,"
    " ' ' || strftime(o_orderdate, '%Y-%m-%d') || ' ' AS t2,"
    " strftime(o_orderdate, '%Y%m%d %H:%M:%S') AS t3,"
    " '  ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS t4,"
    " strftime(o_orderdate + INTERVAL 7 HOUR + INTERVAL 5 MINUTE, '%H:%M:%S') AS t5,"
    " o_orderpriority AS t6,"
    " strftime(o_orderdate, '%Y') || '13' || strftime(o_orderdate, '%d') AS t7,"
    " CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t8"
    " FROM orders) SELECT o_orderkey, "
    + ", ".join(f"strftime({_PARSE.format(t=f't{i}')}, '%Y-%m-%d %H:%M:%S') AS p{i}"
                for i in range(1, 9))
    + " FROM t"
)

ORACLE_SQL["reformat_date"] = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y%m%d') END AS compact,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y/%m/%d') END AS day_only
FROM orders
"""

ORACLE_SQL["sanitize_escape"] = """
SELECT doc_id,
       coalesce(replace(replace(replace(text, '\\', '\\\\'), chr(1), ''), chr(2), ''), '\\N') AS esc_text,
       coalesce(replace(replace(replace(CASE WHEN lang = 'en' THEN NULL ELSE lang END, '\\', '\\\\'),
                chr(1), ''), chr(2), ''), '\\N') AS esc_lang,
       replace(replace(source, chr(1), ''), chr(2), '') AS clean_source
FROM documents
"""

ORACLE_SQL["map_columns_set"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS cust,
       o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS note
FROM orders
"""

ORACLE_SQL["typed_by_hive"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS INTEGER) AS user_id,
       event_type, value, TRY_CAST(props AS INTEGER) AS props
FROM events
"""

ORACLE_SQL["typed_parquet"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem
"""

ORACLE_SQL["partition_read"] = """
SELECT l_orderkey AS _c0, l_partkey AS _c1, l_suppkey AS _c2, l_linenumber AS _c3, l_quantity AS _c4,
       l_extendedprice AS _c5, l_discount AS _c6, l_tax AS _c7, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS _c8,
       l_returnflag, l_linestatus
FROM lineitem WHERE l_returnflag = 'R'
"""

ORACLE_SQL["sharded_union"] = """
SELECT *, 't_' || lpad(CAST(o_orderkey % 16 AS VARCHAR), 2, '0') AS _shard
FROM orders
"""

ORACLE_SQL["route_shards"] = """
SELECT 's_' || lower(regexp_replace(p_name || '_' || CAST(p_size AS VARCHAR), '[0-9_]+$', '')) AS target,
       count(*) AS rows
FROM part GROUP BY 1
"""

ORACLE_SQL["read_with_schema"] = "SELECT * FROM orders"

ORACLE_SQL["print_rows"] = """
SELECT '>> ' || CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || CAST(c_nationkey AS VARCHAR)
       || '|' || CAST(CAST(c_acctbal AS DECIMAL(15, 2)) AS VARCHAR)
       || '|' || coalesce(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END, 'NULL')
       AS line
FROM customer
"""

ORACLE_SQL["csv_files"] = """
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
       c_mktsegment AS segment FROM customer
"""

ORACLE_SQL["sql_query"] = """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus, o_orderpriority
"""

ORACLE_SQL["key_range_chunks"] = """
SELECT CAST(g - 1 AS INTEGER) AS chunk, min(o_orderkey) AS lo, max(o_orderkey) AS hi, count(*) AS rows
FROM (SELECT o_orderkey, ntile(200) OVER (ORDER BY o_orderkey) AS g FROM orders)
GROUP BY g
"""

ORACLE_SQL["key_range_select"] = ORACLE_SQL["key_range_chunks"]

ORACLE_SQL["extent_chunks"] = "SELECT * FROM lineitem"

ORACLE_SQL["extent_span"] = """
SELECT l_suppkey, min(block) AS first_block,
       max(block) + arg_max(l_linenumber, block) - 1 AS last_block,
       CAST(sum(l_linenumber) AS BIGINT) AS total_blocks
FROM (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS block, l_linenumber FROM lineitem)
GROUP BY l_suppkey
"""

ORACLE_SQL["clip_ranges"] = """
WITH r AS (
  SELECT n_nationkey AS region,
         CASE WHEN n_nationkey = 0 THEN NULL
              ELSE 'Customer#' || lpad(CAST(n_nationkey * 60 AS VARCHAR), 9, '0') END AS start,
         CASE WHEN n_nationkey = (SELECT max(n_nationkey) FROM nation) THEN NULL
              ELSE 'Customer#' || lpad(CAST((n_nationkey + 1) * 60 AS VARCHAR), 9, '0') END AS stop
  FROM nation
), c AS (
  SELECT region, greatest(start, 'Customer#000000100') AS clip_start,
         least(stop, 'Customer#000001000') AS clip_stop FROM r
)
SELECT region, clip_start, clip_stop FROM c
WHERE clip_start IS NULL OR clip_stop IS NULL OR clip_start < clip_stop
"""

ORACLE_SQL["key_range_scan"] = """
SELECT c_custkey, c_name FROM customer
WHERE c_name >= 'Customer#000000100' AND c_name < 'Customer#000001000'
"""

ORACLE_SQL["rows_to_cells"] = """
SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'info' AS family, 'name' AS qualifier, c_name AS value
FROM customer WHERE c_name IS NOT NULL
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'info', 'nation', CAST(c_nationkey AS VARCHAR)
FROM customer WHERE c_nationkey IS NOT NULL
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'info', 'segment', c_mktsegment
FROM customer WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> 'HOUSEHOLD'
"""

ORACLE_SQL["cells_to_rows"] = """
SELECT arg_max(props, event_id) FILTER (WHERE event_type = 'click') AS _c0,
       arg_max(props, event_id) FILTER (WHERE event_type = 'view') AS _c1,
       arg_max(props, event_id) FILTER (WHERE event_type = 'purchase') AS _c2
FROM events WHERE event_type IN ('click', 'view', 'purchase')
GROUP BY user_id
"""

_TARGET_INCOMING = """
WITH t AS (SELECT c_custkey AS id, c_name AS v, CAST(0 AS BIGINT) AS seq FROM customer),
i AS (SELECT CAST(CASE WHEN event_type = 'error' THEN NULL ELSE user_id * 13 END AS BIGINT) AS id,
             event_type AS v, event_id AS seq FROM events),
ranked AS (SELECT id, v, seq,
                  row_number() OVER (PARTITION BY id ORDER BY seq) AS first_rn,
                  row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS last_rn
           FROM i WHERE id IS NOT NULL)
"""

ORACLE_SQL["load_ignore"] = _TARGET_INCOMING + """
SELECT id, v, seq FROM t
UNION ALL
SELECT id, v, seq FROM ranked r WHERE first_rn = 1 AND NOT EXISTS (SELECT 1 FROM t WHERE t.id = r.id)
UNION ALL
SELECT id, v, seq FROM i WHERE id IS NULL
"""

ORACLE_SQL["load_replace"] = _TARGET_INCOMING + """
SELECT id, v, seq FROM t WHERE NOT EXISTS (SELECT 1 FROM ranked r WHERE r.id = t.id)
UNION ALL
SELECT id, v, seq FROM ranked WHERE last_rn = 1
UNION ALL
SELECT id, v, seq FROM i WHERE id IS NULL
"""

ORACLE_SQL["load_versions_replace"] = ORACLE_SQL["load_replace"]

_TWO_KEYS = """
WITH t AS (SELECT c_custkey AS id, c_name AS code, c_mktsegment AS v, CAST(0 AS BIGINT) AS seq FROM customer),
i AS (SELECT CAST(CASE WHEN event_type = 'error' THEN NULL ELSE user_id * 13 END AS BIGINT) AS id,
             CASE WHEN value < 5 THEN NULL
                  ELSE 'Customer#' || lpad(CAST((event_id * 7 + user_id) % 2000 AS VARCHAR), 9, '0') END AS code,
             event_type AS v, event_id AS seq FROM events)
"""

ORACLE_SQL["load_ignore_two_keys"] = _TWO_KEYS.replace("WITH t", "WITH RECURSIVE t") + """
, open_rows AS (
    SELECT id, code, v, seq, false AS taken FROM i
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = i.id) AND NOT EXISTS (SELECT 1 FROM t WHERE t.code = i.code)
    UNION ALL
    SELECT id, code, v, seq, first AS taken
    FROM (SELECT *, bool_or(first) OVER (PARTITION BY id) AS id_gone, bool_or(first) OVER (PARTITION BY code) AS code_gone
          FROM (SELECT *, (id IS NULL OR seq = min(seq) OVER (PARTITION BY id))
                      AND (code IS NULL OR seq = min(seq) OVER (PARTITION BY code)) AS first
                FROM open_rows WHERE NOT taken))
    WHERE first OR NOT ((id IS NOT NULL AND id_gone) OR (code IS NOT NULL AND code_gone)))
SELECT id, code, v, seq FROM t
UNION ALL
SELECT id, code, v, seq FROM open_rows WHERE taken
"""

ORACLE_SQL["load_replace_two_keys"] = _TWO_KEYS + """
SELECT id, code, v, seq FROM t
WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.id = t.id) AND NOT EXISTS (SELECT 1 FROM i WHERE i.code = t.code)
UNION ALL
SELECT id, code, v, seq FROM i
WHERE NOT EXISTS (SELECT 1 FROM i AS j WHERE j.id = i.id AND j.seq > i.seq)
  AND NOT EXISTS (SELECT 1 FROM i AS j WHERE j.code = i.code AND j.seq > i.seq)
"""

ORACLE_SQL["region_scan"] = """
SELECT CAST(user_id AS VARCHAR) AS rowkey, 'ev' AS family, event_type AS qualifier, max(event_id) AS ts,
       arg_max(props, event_id) AS value
FROM events WHERE CAST(user_id AS VARCHAR) >= '12' AND CAST(user_id AS VARCHAR) < '5' GROUP BY 1, 2, 3
"""

_REASON = """
CASE WHEN TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) > 90 THEN 'k_high'
     WHEN value < 2.0 THEN 'low_value' END
"""

ORACLE_SQL["split_dirty"] = f"""
SELECT coalesce({_REASON}, 'good') AS reason, count(*) AS rows FROM events GROUP BY 1
"""

ORACLE_SQL["check_limit"] = f"""
WITH a AS (SELECT count(*) AS rows, count(*) FILTER (WHERE {_REASON} IS NOT NULL) AS rejected
           FROM events),
l AS (SELECT * FROM (VALUES (0.0, false), (0.05, false), (0.5, false), (100.0, false), (5000.0, false),
                            (0.0, true), (0.05, true), (0.5, true), (100.0, true), (5000.0, true))
      AS v(lim, inc))
SELECT CAST(lim AS DOUBLE) AS "limit", inc AS inclusive, rows, rejected,
       CASE WHEN NOT inc THEN
              CASE WHEN rows = 0 THEN true WHEN lim = 0 THEN true
                   WHEN lim < 1 THEN rejected / rows <= lim ELSE rejected <= lim END
            ELSE
              CASE WHEN lim = 0 THEN true WHEN rows = 0 THEN true
                   WHEN lim < 1 THEN rejected / rows < lim ELSE rejected < lim END
       END AS ok
FROM a, l
"""

ORACLE_SQL["transfer_stats"] = """
WITH a AS (
  SELECT count(*) AS read_rows, count(*) FILTER (WHERE n_chars > 10000) AS discard_rows,
         CAST(sum(coalesce(length(CAST(doc_id AS VARCHAR)), 0) + coalesce(length(text), 0)
                  + coalesce(length(lang), 0) + coalesce(length(source), 0)
                  + coalesce(length(CAST(n_chars AS VARCHAR)), 0)) AS BIGINT) AS chars
  FROM documents
), b AS (
  SELECT read_rows, discard_rows, read_rows - discard_rows AS write_rows, chars,
         CASE WHEN read_rows <> 0 THEN CAST(chars // read_rows AS BIGINT) ELSE 0 END AS avg_len
  FROM a
)
SELECT read_rows, discard_rows, write_rows, chars, avg_len,
       read_rows * avg_len AS read_bytes, write_rows * avg_len - discard_rows AS write_bytes,
       discard_rows * avg_len AS discard_bytes
FROM b
"""

ORACLE_SQL["reconcile"] = """
SELECT s.sink, (SELECT count(*) FROM documents) AS rows, true AS ok
FROM (VALUES ('text'), ('gzip'), ('parquet')) AS s(sink)
"""

ORACLE_SQL["catalog_load"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal,
       c_mktsegment, '20240101' AS ds FROM customer
"""

_KEPT = "regexp_replace({}, '[' || chr(1) || chr(10) || chr(13) || ']', ' ', 'g')"

ORACLE_SQL["catalog_load_documents"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_KEPT.format("text")} AS text, lang, source,
       CAST(n_chars AS VARCHAR) AS n_chars FROM documents
"""

ORACLE_SQL["line_stream"] = """
SELECT nullif(unnest(string_split(text, chr(10))), '') AS _c0 FROM documents
"""

def _per_second(amount: str, units: str) -> str:
    rate = f"greatest(({amount}) // 3600, least({amount}, 1))"
    steps = [(1_000_000, "MB/s"), (1_000, "KB/s"), (1, "B/s")] if units == "B" else [(1, "L/s")]
    cases = " ".join(f"WHEN {rate} >= {n} THEN CAST({rate} // {n} AS VARCHAR) || '{name}'" for n, name in steps)
    return f"CASE {cases} ELSE CAST({rate} AS VARCHAR) || '{steps[-1][1]}' END"


ORACLE_SQL["windowed_stats"] = f"""
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS read_rows,
                  count(*) FILTER (value < 2.0) AS discard_rows,
                  CAST(coalesce(sum(coalesce(length(event_type), 0) + coalesce(length(props), 0)), 0) AS BIGINT) AS chars
           FROM events WHERE ts IS NOT NULL GROUP BY 1)
SELECT start, start + INTERVAL 1 HOUR AS "end", read_rows, discard_rows, read_rows - discard_rows AS write_rows, chars,
       {_per_second("chars", "B")} AS byte_speed, {_per_second("read_rows", "L")} AS line_speed
FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
"""

ORACLE_SQL["row_lengths"] = """
SELECT conv_id, turn,
       CAST(length(CAST(conv_id AS VARCHAR)) + length(CAST(turn AS VARCHAR))
            + coalesce(length(role), 0) + coalesce(length(text), 0) AS BIGINT) AS row_len
FROM conversations
"""

# The characters of U+0080..U+024F that GBK can encode; every
# other character of that block is written as "?".  (The test texts hold no
# character above U+024F.)
GBK_LATIN = "¤§¨°±·×àáèéêìíòó÷ùúüāēěīńňōūǎǐǒǔǖǘǚǜ"

ORACLE_SQL["gbk_round_trip"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS _c0,
       nullif(regexp_replace(translate(text, chr(1) || chr(10) || chr(13), '   '),
                             '[^\\x00-\\x7F{GBK_LATIN}]', '?', 'g'), '') AS _c1,
       lang AS _c2, source AS _c3, CAST(n_chars AS VARCHAR) AS _c4
FROM documents
"""

ORACLE_SQL["remote_text_header"] = """
SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, c_nationkey AS _c2, c_acctbal AS _c3,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS _c4
FROM customer
"""

ORACLE_SQL["partition_ranges"] = """
SELECT o_orderstatus AS partition, min(o_orderkey) AS lo, max(o_orderkey) AS hi, count(*) AS rows
FROM orders GROUP BY o_orderstatus
"""

ORACLE_SQL["checked_load"] = f"""
SELECT * FROM events WHERE ({_REASON}) IS NULL
"""

ORACLE_SQL["exchange_report"] = f"""
WITH a AS (
  SELECT count(*) AS read_rows,
         count(*) FILTER (WHERE ({_REASON}) IS NOT NULL) AS discard_rows,
         CAST(sum(length(CAST(event_id AS VARCHAR)) + coalesce(length(CAST(ts AS VARCHAR)), 0)
                  + coalesce(length(CAST(user_id AS VARCHAR)), 0) + coalesce(length(event_type), 0)
                  + coalesce(length(CAST(value AS VARCHAR)), 0) + coalesce(length(props), 0))
              AS BIGINT) AS chars
  FROM events
)
SELECT s.sink, read_rows - discard_rows AS rows, true AS ok, read_rows, discard_rows, chars,
       (discard_rows / read_rows <= 0.5) AS budget_ok, 0 AS code
FROM a, (VALUES ('text'), ('parquet')) AS s(sink)
"""

ORACLE_SQL["load_files_replace"] = ORACLE_SQL["load_replace"]

ORACLE_SQL["load_buckets_replace"] = ORACLE_SQL["load_replace"]

ORACLE_SQL["date_masks"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d %H:%M:%S') AS d,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.') || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS ts,
       o_orderpriority
FROM orders
"""

ORACLE_SQL["columns_where"] = """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
WHERE o_orderstatus <> 'P' AND o_totalprice > 1000
"""

ORACLE_SQL["expand_paths_glob"] = """
SELECT o_orderstatus AS status, 1::INTEGER AS depth, count(*) AS rows FROM orders GROUP BY o_orderstatus
"""

ORACLE_SQL["numbered_files"] = """
SELECT o_orderkey AS _c0, o_custkey AS _c1, o_orderstatus AS _c2, o_totalprice AS _c3,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS _c4, o_orderpriority AS _c5, 'orders' AS _file
FROM orders
"""

ORACLE_SQL["del_modes"] = """
SELECT f.folder, f.prefix, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys
FROM customer, (VALUES ('own', 'a'), ('own', 'b'), ('all', 'b')) AS f(folder, prefix)
GROUP BY f.folder, f.prefix
"""

ORACLE_SQL["write_modes"] = """
SELECT f.prefix, f.times * count(*) AS rows, CAST(f.times * sum(c_custkey) AS BIGINT) AS keys
FROM customer, (VALUES ('truncate', 1), ('append', 2), ('nonConflict', 1)) AS f(prefix, times)
GROUP BY f.prefix, f.times
"""

ORACLE_SQL["load_file_round_trip"] = """
SELECT CAST(doc_id AS VARCHAR) AS _c0,
       replace(replace(text, chr(1), ''), chr(2), '') AS _c1,
       CASE WHEN lang = 'en' THEN NULL ELSE lang END AS _c2, source AS _c3, CAST(n_chars AS VARCHAR) AS _c4
FROM documents
"""

ORACLE_SQL["detect_format"] = """
SELECT f.folder, f.kind, (SELECT count(*) FROM customer) AS rows,
       (SELECT count(c_name) FROM customer) AS names
FROM (VALUES ('txt', 'TXT'), ('gz', 'COMP_TXT'), ('pq', 'PARQUET'), ('seq', 'SEQ')) AS f(folder, kind)
"""
