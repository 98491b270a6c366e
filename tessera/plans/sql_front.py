"""The SQL front end over the tables: the dialect's types, functions, predicates and statements, each run through the Engine."""

from __future__ import annotations

from tessera.plans.registry import query
from tessera.sources.tables import views
from tessera.sql.engine import Engine


def _run(spark, sf, tables: str, text: str):
    """The result of a script over views of the tables."""
    views(spark, sf, *tables.split())
    kind = spark.conf.get("spark.sql.timestampType")
    try:
        return Engine(spark).sql(text)
    finally:
        spark.conf.set("spark.sql.timestampType", kind)


def _sql(name: str, tables: str, text: str, oracle: str) -> None:
    query(name, oracle)(lambda spark, sf: _run(spark, sf, tables, text))


_sql(
    "sql_types_arithmetic",
    "lineitem",
    """SELECT l_orderkey, l_linenumber, l_linenumber / 2 AS half, (l_linenumber + 1) * 1000000000 AS wide, l_orderkey % 7 - l_linenumber AS diff, -l_linenumber / 2 AS negative, CAST(l_quantity AS NUMERIC(10,2)) / 4 AS quarter,
    CAST(l_discount AS NUMERIC(4,2)) * CAST(l_tax AS NUMERIC(4,2)) AS product, abs(l_linenumber - 5) / 2 * 2 AS even, CAST(l_shipdate AS DATE) - DATE '1995-01-01' AS days FROM lineitem""",
    """SELECT l_orderkey, l_linenumber, (l_linenumber // 2)::BIGINT AS half, (l_linenumber::BIGINT + 1) * 1000000000 AS wide, (l_orderkey % 7 - l_linenumber)::BIGINT AS diff, -(l_linenumber // 2)::BIGINT AS negative, l_quantity::DECIMAL(10,2)::DOUBLE / 4 AS quarter,
    (l_discount::DECIMAL(4,2) * l_tax::DECIMAL(4,2))::DECIMAL(38,4) AS product, (abs(l_linenumber - 5) // 2 * 2)::BIGINT AS even, date_diff('day', DATE '1995-01-01', l_shipdate::DATE)::INTEGER AS days FROM lineitem""",
)
_sql(
    "sql_types_aggregates",
    "part",
    "SELECT p_brand, sum(p_size) / count(*) AS whole, avg(p_size) / 2 AS half, avg(CAST(p_size AS NUMERIC(8,2))) AS mean, sum(p_size * 2) AS twice, count(*) FILTER (WHERE p_size / 10 = 2) AS twenties FROM part GROUP BY p_brand HAVING sum(p_size) / 2 > 10",
    "SELECT p_brand, (sum(p_size) // count(*))::BIGINT AS whole, avg(p_size) / 2 AS half, avg(p_size) AS mean, sum(p_size * 2)::BIGINT AS twice, count(*) FILTER (WHERE p_size // 10 = 2) AS twenties FROM part GROUP BY p_brand HAVING sum(p_size) // 2 > 10",
)
_sql(
    "sql_math",
    "part",
    """SELECT p_partkey, round(p_retailprice / 3, 1) AS r, trunc(-p_retailprice / 7, 1) AS t, floor(-p_retailprice / 7) AS f, ceiling(p_retailprice / 7) AS c, floor(p_size) AS fi, sign(p_size - 25) AS s, mod(p_partkey, 7) AS m, power(p_size, 2) AS p2, sqrt(p_size * p_size) AS q,
    round(cbrt(p_size * p_size * p_size), 9) AS cb, round(ln(p_size), 9) AS l, log(100) AS ten, round(log(2, p_size), 9) AS two, log10(1000) AS kilo, round(exp(p_size / 10), 6) AS e, abs(25 - p_size) AS a, greatest(p_size) AS g FROM part""",
    """SELECT p_partkey, round(p_retailprice / 3, 1) AS r, (sign(-p_retailprice) * floor(abs(-p_retailprice / 7) * 10) / 10)::DOUBLE AS t, floor(-p_retailprice / 7) AS f, ceil(p_retailprice / 7) AS c, p_size AS fi, sign(p_size - 25)::INTEGER AS s, p_partkey % 7 AS m, p_size::DOUBLE ** 2 AS p2, p_size::DOUBLE AS q,
    p_size::DOUBLE AS cb, round(ln(p_size), 9) AS l, 2.0::DOUBLE AS ten, round(log2(p_size), 9) AS two, 3.0::DOUBLE AS kilo, round(exp(p_size // 10), 6) AS e, abs(25 - p_size)::BIGINT AS a, p_size AS g FROM part""",
)
_sql(
    "sql_trigonometry",
    "nation",
    """SELECT n_nationkey, round(sind(n_nationkey * 30), 9) + 0.0 AS s, round(cosd(n_nationkey * 60), 9) + 0.0 AS c, round(atan2d(n_nationkey, 1), 9) AS a2, round(asind(n_nationkey / 24.0), 9) AS ai, round(acosd(n_nationkey / 24.0), 9) AS ac, round(atand(n_nationkey), 9) AS at,
    tand(45) AS t45, tand(90) AS t90, cotd(45) AS c45, round(radians(n_nationkey), 9) AS r, round(degrees(pi()), 6) AS d, round(cot(n_nationkey + 1), 9) AS ct FROM nation""",
    """SELECT n_nationkey, round(sin(radians(n_nationkey * 30)), 9) + 0.0 AS s, round(cos(radians(n_nationkey * 60)), 9) + 0.0 AS c, round(degrees(atan2(n_nationkey, 1)), 9) AS a2, round(degrees(asin(n_nationkey / 24.0)), 9) AS ai, round(degrees(acos(n_nationkey / 24.0)), 9) AS ac, round(degrees(atan(n_nationkey)), 9) AS at,
    1.0::DOUBLE AS t45, 'Infinity'::DOUBLE AS t90, 1.0::DOUBLE AS c45, round(radians(n_nationkey), 9) AS r, 180.0::DOUBLE AS d, round(cot(n_nationkey + 1), 9) AS ct FROM nation""",
)
_sql(
    "sql_strings",
    "part",
    """SELECT p_partkey, initcap(p_type || '-x') AS i, left(p_brand, -3) AS l, right(p_brand, 2) AS r, length(p_name) AS n, strpos(p_name, 'e') AS p, position('#' IN p_brand) AS q, substring(p_brand FROM 2 FOR 3) AS s, substring(p_brand, 0, 3) AS z, substring(p_brand FROM '[0-9]+') AS d,
    split_part(p_type, ' ', -1) AS sp, concat(p_brand, NULL, p_size) AS c, concat_ws('/', p_brand, NULL, p_size) AS w, lpad(p_brand, 12, '*') AS lp, rpad(p_brand, 4) AS rp, btrim('  ' || p_brand || ' ') AS b, to_hex(CAST(p_brand AS VARBINARY)) AS h, replace(p_brand, 'Brand', 'B') AS e, reverse(p_brand) AS v, md5(p_brand) AS m,
    starts_with(p_type, 'S') AS st, upper(p_brand) AS u, repeat('ab', 2) AS rr, p_brand LIKE 'Brand#1_' AS lk, p_type NOT ILIKE '%steel%' AS nl FROM part""",
    """SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_type || '-x'), '[a-z0-9]+|[^a-z0-9]+'), lambda w: upper(w[1]) || w[2:]), '') AS i, p_brand[:-4] AS l, right(p_brand, 2) AS r, length(p_name) AS n, instr(p_name, 'e') AS p, instr(p_brand, '#') AS q, p_brand[2:4] AS s, p_brand[1:2] AS z, regexp_extract(p_brand, '[0-9]+') AS d,
    split_part(p_type, ' ', -1) AS sp, p_brand || p_size AS c, p_brand || '/' || p_size AS w, lpad(p_brand, 12, '*') AS lp, rpad(p_brand, 4, ' ') AS rp, p_brand AS b, lower(hex(p_brand)) AS h, replace(p_brand, 'Brand', 'B') AS e, reverse(p_brand) AS v, md5(p_brand) AS m,
    starts_with(p_type, 'S') AS st, upper(p_brand) AS u, 'abab' AS rr, p_brand LIKE 'Brand#1_' AS lk, p_type NOT ILIKE '%steel%' AS nl FROM part""",
)
_sql(
    "sql_regex",
    "part",
    r"""SELECT p_partkey, p_type ~ '^S' AS a, p_type !~* 'steel$' AS b, p_brand SIMILAR TO 'Brand#(1|2)[0-9]' AS s, regexp_like(p_type, 'brass', 'i') AS l, regexp_count(p_type, '[AEIOU]') AS c, regexp_instr(p_brand, '([a-z]+)#([0-9])', 1, 1, 0, '', 2) AS g, regexp_substr(p_type, '[A-Z]+', 1, 2) AS w,
    regexp_replace(p_type, '[AEIOU]', '_') AS one, regexp_replace(p_type, '([A-Z]+) ([A-Z]+)', '\2 \1', 'g') AS x, regexp_match(p_brand, '([a-z]+)#([0-9]+)') AS m FROM part""",
    r"""SELECT p_partkey, regexp_matches(p_type, '^S') AS a, NOT regexp_matches(p_type, '(?i)steel$') AS b, regexp_full_match(p_brand, 'Brand#(1|2)[0-9]') AS s, regexp_matches(p_type, '(?i)brass') AS l, len(regexp_extract_all(p_type, '[AEIOU]'))::BIGINT AS c, instr(p_brand, '#') + 1 AS g, regexp_extract_all(p_type, '[A-Z]+')[2] AS w,
    regexp_replace(p_type, '[AEIOU]', '_') AS one, regexp_replace(p_type, '([A-Z]+) ([A-Z]+)', '\2 \1', 'g') AS x, '{rand,' || regexp_extract(p_brand, '[0-9]+') || '}' AS m FROM part""",
)
_sql(
    "sql_dates",
    "orders",
    """SELECT o_orderkey, year(o_orderdate) AS y, extract(dow FROM o_orderdate) AS dow, date_part('isodow', o_orderdate) AS iso, date_trunc('month', CAST(o_orderdate AS DATE)) AS m, date_trunc('hour', o_orderdate) AS h, dateadd(month, 1, CAST(o_orderdate AS DATE)) AS later, dateadd('day', -1, o_orderdate) AS earlier,
    datediff(month, o_orderdate, TIMESTAMP '1999-01-01 00:00:00') AS months, datediff('week', o_orderdate, TIMESTAMP '1999-01-01 00:00:00') AS weeks, last_day(CAST(o_orderdate AS DATE)) AS l, epoch(o_orderdate) AS e, epoch_ms(o_orderdate) AS ms, CAST(o_orderdate AS DATE) + 3 AS d3,
    CAST(o_orderdate AS DATE) + INTERVAL '1 month' AS mi, date_bin(INTERVAL '5 days', o_orderdate, TIMESTAMP '1992-01-01 00:00:00') AS bin, make_date(year(o_orderdate), 2, 28) AS md, age(o_orderdate, TIMESTAMP '1990-01-01 00:00:00').months AS am FROM orders""",
    """SELECT o_orderkey, year(o_orderdate) AS y, extract(dow FROM o_orderdate) AS dow, isodow(o_orderdate) AS iso, date_trunc('month', o_orderdate)::DATE AS m, date_trunc('hour', o_orderdate) AS h, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE AS later, o_orderdate - INTERVAL 1 DAY AS earlier,
    date_diff('month', o_orderdate, TIMESTAMP '1999-01-01') AS months, ((date_trunc('week', TIMESTAMP '1999-01-01')::DATE - date_trunc('week', o_orderdate)::DATE) // 7)::BIGINT AS weeks, last_day(o_orderdate) AS l, epoch(o_orderdate) AS e, epoch_ms(o_orderdate) AS ms, o_orderdate::DATE + 3 AS d3,
    o_orderdate::DATE + INTERVAL 1 MONTH AS mi, time_bucket(INTERVAL 5 DAY, o_orderdate, TIMESTAMP '1992-01-01') AS bin, make_date(year(o_orderdate), 2, 28) AS md, (date_part('year', age(o_orderdate, TIMESTAMP '1990-01-01')) * 12 + date_part('month', age(o_orderdate, TIMESTAMP '1990-01-01')))::INTEGER AS am FROM orders""",
)
_sql(
    "sql_to_char",
    "events",
    "SELECT event_id, to_char(ts, 'YYYY-MM-DD HH24:MI:SS') AS a, to_char(ts, 'FMDD Mon YY, HH12:MI AM') AS b, to_char(ts, 'IYYY-IW-ID') AS c, to_char(ts, 'DDD Q') AS d, to_char(ts, 'FMDay FMMonth') AS e, to_timestamp(to_char(ts, 'DD/MM/YYYY'), 'DD/MM/YYYY') AS f, to_date(to_char(ts, 'YYYYMMDD'), 'YYYYMMDD') AS g FROM events",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS a, strftime(ts, '%-d %b %y, %I:%M %p') AS b, strftime(ts, '%G-%V-%u') AS c, strftime(ts, '%j ') || quarter(ts) AS d, strftime(ts, '%A %B') AS e, date_trunc('day', ts)::TIMESTAMP AS f, ts::DATE AS g FROM events",
)
_sql(
    "sql_time_zones",
    "orders",
    """SELECT o_orderkey, convert_timezone('UTC', 'America/New_York', o_orderdate + INTERVAL '12' HOUR) AS ny, CAST((o_orderdate + INTERVAL '12' HOUR) AT TIME ZONE 'Europe/Paris' AS TIMESTAMP) AS from_paris,
    (CAST(o_orderdate AS TIMESTAMP WITH TIME ZONE) AT TIME ZONE 'Asia/Tokyo') AS tokyo, timezone('Australia/Sydney', CAST(o_orderdate AS TIMESTAMP WITH TIME ZONE)) AS sydney FROM orders""",
    """SELECT o_orderkey, ((o_orderdate + INTERVAL 12 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS ny, ((o_orderdate + INTERVAL 12 HOUR) AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' AS from_paris,
    (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo' AS tokyo, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Sydney' AS sydney FROM orders""",
)
_sql(
    "sql_now",
    "region",
    "SELECT r_regionkey, CURRENT_DATE = CAST(CURRENT_TIMESTAMP AS DATE) AS d, extract(second FROM CURRENT_TIMESTAMP(0)) % 1 = 0 AS z, CURRENT_TIME(0) = LOCALTIME(0) AS t, CURRENT_TIME <= TIME '23:59:59.999999' AS late, LOCALTIMESTAMP(3) <= LOCALTIMESTAMP + INTERVAL '1' SECOND AS l, random() < 1 AS r FROM region",
    "SELECT r_regionkey, TRUE AS d, TRUE AS z, TRUE AS t, TRUE AS late, TRUE AS l, TRUE AS r FROM region",
)
_DOC = "'{\"id\": ' || n_nationkey || ', \"p\": 1.50, \"names\": [\"' || n_name || '\", {\"r\": ' || n_regionkey || '}], \"none\": null}'"
_sql(
    "sql_json_access",
    "nation",
    f"""SELECT n_nationkey, j -> 'p' AS p, j ->> 'id' AS id, j -> 'names' -> 0 AS n, j #> '{{names,1}}' AS o, j #>> '{{names,1,r}}' AS r, json_extract_path(j, 'names', '1', 'r') AS ep, jsonb_extract_path(j, 'names', '1') AS bp, jsonb_extract_path_text(j, 'names', '0') AS bt, json_extract_path_text(j, 'id') AS et,
    json_typeof(j -> 'names') AS t, jsonb_typeof(j -> 'none') AS tn, json_array_length(j -> 'names') AS l, jsonb_array_length(j -> 'names') AS bl, (j::jsonb) = (j::jsonb) AS same, (j::json) = j AS kept, json_value(j, '$.id' RETURNING BIGINT) AS v, json_value(j, '$.no' DEFAULT 'x' ON EMPTY) AS dv, json_exists(j, '$.names[*].r') AS e,
    json_query(j, '$.names[*]' WITH WRAPPER) AS q, json_query(j, '$.names[0]' OMIT QUOTES) AS oq, j IS JSON OBJECT AS ij, (j -> 'names') IS JSON ARRAY AS ia, j IS JSON WITH UNIQUE KEYS AS iu FROM (SELECT n_nationkey, {_DOC} AS j FROM nation)""",
    f"""SELECT n_nationkey, '1.50' AS p, n_nationkey::VARCHAR AS id, '"' || n_name || '"' AS n, '{{"r": ' || n_regionkey || '}}' AS o, n_regionkey::VARCHAR AS r, n_regionkey::VARCHAR AS ep, '{{"r": ' || n_regionkey || '}}' AS bp, n_name AS bt, n_nationkey::VARCHAR AS et, 'array' AS t, 'null' AS tn, 2::BIGINT AS l, 2::BIGINT AS bl,
    TRUE AS same, TRUE AS kept, (j ->> 'id')::BIGINT AS v, 'x' AS dv, TRUE AS e, '["' || n_name || '",{{"r":' || n_regionkey || '}}]' AS q, j ->> '$.names[0]' AS oq, json_type(j) = 'OBJECT' AS ij, TRUE AS ia, TRUE AS iu FROM (SELECT *, {_DOC} AS j FROM nation)""",
)
_sql(
    "sql_json_construction",
    "nation",
    """SELECT n_regionkey, json_agg(n_name ORDER BY n_nationkey DESC) AS a, jsonb_agg(n_nationkey ORDER BY n_nationkey) AS b, json_object_agg(n_name, n_nationkey ORDER BY n_nationkey) AS o, jsonb_object_agg(n_name, json_build_array(n_nationkey)) AS bo, max(json_build_object('k', n_nationkey, 'l', json_build_array(n_name, NULL))) AS m,
    max(jsonb_build_object('bb', n_regionkey, 'a', 'x')) AS jb, max(jsonb_build_array(n_regionkey, 'x')) AS ja, max(to_json(n_name)) AS tj, max(to_jsonb(n_nationkey)) AS tb, min(json_object('{a,' || n_regionkey || '}')) AS jo, min(jsonb_object('{bb,1,a,' || n_regionkey || '}')) AS bj,
    min(json_object('k' VALUE n_regionkey, 'n' VALUE NULL ABSENT ON NULL)) AS jc, min(json_array(n_regionkey, NULL NULL ON NULL)) AS jr FROM nation GROUP BY n_regionkey""",
    """SELECT n_regionkey, '[' || string_agg('"' || n_name || '"', ', ' ORDER BY n_nationkey DESC) || ']' AS a, '[' || string_agg(n_nationkey::VARCHAR, ', ' ORDER BY n_nationkey) || ']' AS b, '{ ' || string_agg('"' || n_name || '" : ' || n_nationkey, ', ' ORDER BY n_nationkey) || ' }' AS o,
    '{' || string_agg('"' || n_name || '": [' || n_nationkey || ']', ', ' ORDER BY length(n_name), n_name) || '}' AS bo, max('{"k" : ' || n_nationkey || ', "l" : ["' || n_name || '", null]}') AS m, '{"a": "x", "bb": ' || n_regionkey || '}' AS jb, '[' || n_regionkey || ', "x"]' AS ja, max('"' || n_name || '"') AS tj, max(n_nationkey::VARCHAR) AS tb,
    '{"a" : "' || n_regionkey || '"}' AS jo, '{"a": "' || n_regionkey || '", "bb": "1"}' AS bj, '{"k" : ' || n_regionkey || '}' AS jc, '[' || n_regionkey || ', null]' AS jr FROM nation GROUP BY n_regionkey""",
)
_sql(
    "sql_rows_and_quantifiers",
    "part supplier nation",
    """SELECT s_suppkey, s_nationkey > ALL (SELECT p_size FROM part WHERE p_size < 10) AS gt_all, s_nationkey < ANY (SELECT nullif(p_size, 50) FROM part WHERE p_size > 44) AS lt_any, s_nationkey = ALL (SELECT n_nationkey FROM nation WHERE n_nationkey = 3) AS eq_all, s_nationkey <> ANY (SELECT 3 UNION ALL SELECT 4) AS ne_any,
    s_nationkey >= ALL (SELECT p_size FROM part WHERE p_size < 0) AS none, (s_nationkey, s_suppkey) < (10, 5) AS lt, (s_nationkey, nullif(s_suppkey, 2)) = (s_nationkey, 2) AS eq, (s_nationkey, s_suppkey) IN ((1, 1), (2, 2), (3, 3)) AS listed, (nullif(s_nationkey, 3), NULL) IS NULL AS empty,
    (s_nationkey, s_suppkey) = (SELECT max(s_nationkey), max(s_suppkey) FROM supplier) AS top, (s_nationkey, 1) IS DISTINCT FROM (3, 1) AS d FROM supplier""",
    """SELECT s_suppkey, s_nationkey > ALL (SELECT p_size FROM part WHERE p_size < 10) AS gt_all, s_nationkey < ANY (SELECT nullif(p_size, 50) FROM part WHERE p_size > 44) AS lt_any, s_nationkey = 3 AS eq_all, TRUE AS ne_any, TRUE AS none, s_nationkey < 10 OR (s_nationkey = 10 AND s_suppkey < 5) AS lt, CASE WHEN s_suppkey = 2 THEN NULL ELSE FALSE END AS eq,
    s_nationkey = s_suppkey AND s_suppkey IN (1, 2, 3) AS listed, s_nationkey = 3 AS empty, s_nationkey = (SELECT max(s_nationkey) FROM supplier) AND s_suppkey = (SELECT max(s_suppkey) FROM supplier) AS top, s_nationkey <> 3 AS d FROM supplier""",
)
_FRAME = "(PARTITION BY p_brand ORDER BY p_size {})"
_sql(
    "sql_window_frames",
    "part",
    "SELECT p_partkey, "
    + ", ".join(f"{a} OVER {_FRAME.format(f)} AS {n}" for a, f, n in (("count(*)", "GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING", "g"), ("sum(p_size)", "GROUPS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP", "eg"), ("max(p_partkey)", "GROUPS BETWEEN CURRENT ROW AND 2 FOLLOWING EXCLUDE TIES", "et"), ("avg(p_size)", "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW", "ec"), ("min(p_partkey)", "RANGE BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE GROUP", "eu")))
    + f", count(*) FILTER (WHERE p_partkey / 2 * 2 = p_partkey) OVER {_FRAME.format('')} AS f FROM part",
    "SELECT p_partkey, "
    + ", ".join(f"({a} OVER {_FRAME.format(f)}){c} AS {n}" for a, f, n, c in (("count(*)", "GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING", "g", ""), ("sum(p_size)", "GROUPS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP", "eg", "::BIGINT"), ("max(p_partkey)", "GROUPS BETWEEN CURRENT ROW AND 2 FOLLOWING EXCLUDE TIES", "et", ""), ("avg(p_size)", "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW", "ec", ""), ("min(p_partkey)", "RANGE BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE GROUP", "eu", "")))
    + f", count(*) FILTER (WHERE p_partkey % 2 = 0) OVER {_FRAME.format('')} AS f FROM part",
)
_sql(
    "sql_ordered_aggregates",
    "orders",
    "SELECT o_orderpriority, mode() WITHIN GROUP (ORDER BY o_orderstatus) AS m, percentile_cont(0.25) WITHIN GROUP (ORDER BY o_orderkey) AS c, percentile_disc(0.5) WITHIN GROUP (ORDER BY o_orderkey) AS d, percentile_disc(0.3) WITHIN GROUP (ORDER BY o_orderstatus) AS ds, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus DESC) AS s FROM orders GROUP BY o_orderpriority",
    "SELECT o_orderpriority, (SELECT s FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders x WHERE x.o_orderpriority = o.o_orderpriority GROUP BY 1 ORDER BY n DESC, s LIMIT 1)) AS m, quantile_cont(o_orderkey, 0.25) AS c, quantile_disc(o_orderkey, 0.5) AS d, quantile_disc(o_orderstatus, 0.3) AS ds, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus DESC) AS s FROM orders o GROUP BY o_orderpriority",
)
_REACH = "SELECT n_nationkey AS a, (n_nationkey * 7 + 3) % 25 AS b FROM nation"
_sql(
    "sql_recursive_union",
    "nation",
    f"WITH RECURSIVE e AS ({_REACH}), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b) SELECT a, count(*) AS n, sum(b) AS s FROM r GROUP BY a",
    f"WITH RECURSIVE e AS ({_REACH}), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b) SELECT a, count(*) AS n, sum(b)::BIGINT AS s FROM r GROUP BY a",
)
_EDGES = "(VALUES (1, 4), (4, 7), (7, 9), (9, 4), (7, 2), (2, 8)) AS e(src, dst)"
_sql(
    "sql_search_and_cycle",
    "nation",
    f"""WITH RECURSIVE w(n) AS (SELECT 1 UNION ALL SELECT dst FROM w JOIN {_EDGES} ON src = n) SEARCH DEPTH FIRST BY n SET ord CYCLE n SET met USING path
    SELECT n, met, path, row_number() OVER (ORDER BY ord) AS place FROM w""",
    f"""WITH RECURSIVE w(n, path, met) AS (SELECT 1, [1], FALSE UNION ALL SELECT dst, path || [dst], list_contains(path, dst) FROM w JOIN {_EDGES} ON src = n WHERE NOT met)
    SELECT n::BIGINT AS n, met, '{{' || array_to_string(list_transform(path, lambda x: '(' || x || ')'), ',') || '}}' AS path, row_number() OVER (ORDER BY path) AS place FROM w""",
)
_sql(
    "sql_information_schema",
    "nation",
    """CREATE SCHEMA shop; CREATE TABLE shop.item (id BIGINT NOT NULL, name VARCHAR(9) DEFAULT 'n', price NUMERIC(8,2));
    SELECT t.table_type, c.column_name, c.ordinal_position, c.is_nullable, c.data_type, c.character_maximum_length FROM information_schema.tables t JOIN information_schema.columns c ON t.table_schema = c.table_schema AND t.table_name = c.table_name WHERE t.table_schema = 'shop'""",
    "SELECT * FROM (VALUES ('BASE TABLE', 'id', 1, 'NO', 'bigint', NULL), ('BASE TABLE', 'name', 2, 'YES', 'string', 9), ('BASE TABLE', 'price', 3, 'YES', 'decimal(8,2)', NULL)) t(table_type, column_name, ordinal_position, is_nullable, data_type, character_maximum_length)",
)
_sql(
    "sql_schemas_and_temporary_tables",
    "nation",
    """CREATE SCHEMA depot; CREATE TABLE depot.place AS SELECT n_nationkey AS id, n_name AS name FROM nation; CREATE TABLE place AS SELECT 1 AS id, 'p' AS name; CREATE TEMP TABLE place AS SELECT n_regionkey AS id, min(n_name) AS name FROM nation GROUP BY n_regionkey;
    CREATE TABLE seen AS SELECT 'temporary' AS kind, id, name FROM place; DROP TABLE place; INSERT INTO seen SELECT 'permanent', id, name FROM public.place; INSERT INTO seen SELECT 'schema', id, name FROM depot.place WHERE id < 3; DROP TABLE place; DROP SCHEMA depot CASCADE; SELECT * FROM seen""",
    "SELECT 'temporary' AS kind, n_regionkey AS id, min(n_name) AS name FROM nation GROUP BY n_regionkey UNION ALL SELECT 'permanent', 1, 'p' UNION ALL SELECT 'schema', n_nationkey, n_name FROM nation WHERE n_nationkey < 3",
)
_sql(
    "sql_changes",
    "customer supplier",
    """CREATE TABLE account (id BIGINT NOT NULL, name VARCHAR(25), cents BIGINT DEFAULT 0 CHECK (cents / 100 > -100000)); INSERT INTO account SELECT c_custkey, c_name, CAST(round(c_acctbal * 100) AS BIGINT) FROM customer; INSERT INTO account (id, name) SELECT s_suppkey + 1000000, s_name FROM supplier;
    UPDATE account SET cents = cents / 2, name = upper(name) WHERE id % 3 = 1; DELETE FROM account WHERE id / 2 * 2 = id AND id < 1000000;
    MERGE INTO account USING (SELECT s_suppkey * 5 AS k, s_nationkey AS n FROM supplier) AS s ON account.id = s.k WHEN MATCHED AND s.n / 2 = 3 THEN DELETE WHEN MATCHED THEN UPDATE SET cents = account.cents + s.n / 2 WHEN NOT MATCHED AND s.n / 2 = 5 THEN INSERT (id, cents) VALUES (s.k + 5000000, s.n);
    SELECT * FROM account""",
    """WITH a AS (SELECT c_custkey AS id, c_name AS name, round(c_acctbal * 100)::BIGINT AS cents FROM customer UNION ALL SELECT s_suppkey + 1000000, s_name, 0 FROM supplier),
    u AS (SELECT id, CASE WHEN id % 3 = 1 THEN upper(name) ELSE name END AS name, CASE WHEN id % 3 = 1 THEN (cents // 2) ELSE cents END AS cents FROM a WHERE NOT (id % 2 = 0 AND id < 1000000)),
    s AS (SELECT s_suppkey * 5 AS k, s_nationkey AS n FROM supplier)
    SELECT id, name, (cents + coalesce(n // 2, 0))::BIGINT AS cents FROM u LEFT JOIN s ON id = k WHERE n IS NULL OR n // 2 <> 3 UNION ALL SELECT k + 5000000, NULL, n FROM s WHERE n // 2 = 5 AND k NOT IN (SELECT id FROM u)""",
)
_sql(
    "sql_conditions",
    "part",
    "SELECT p_partkey, coalesce(nullif(p_size, 1), -1) AS c, iif(p_size / 2 > 12, 'big', 'small') AS i, least(p_size, 10, NULL) AS l, CASE p_size / 10 WHEN 0 THEN 'few' WHEN 1 THEN 'some' ELSE 'many' END AS w, TRY_CAST(p_brand AS INTEGER) AS t, CAST(substring(p_brand, 7) AS INTEGER DEFAULT -1 ON CONVERSION ERROR) AS d, p_size::VARCHAR(1) AS v, 'ab'::CHAR(3) || '.' AS h FROM part",
    "SELECT p_partkey, coalesce(nullif(p_size, 1), -1) AS c, if(p_size // 2 > 12, 'big', 'small') AS i, least(p_size, 10) AS l, CASE p_size // 10 WHEN 0 THEN 'few' WHEN 1 THEN 'some' ELSE 'many' END AS w, TRY_CAST(p_brand AS INTEGER) AS t, coalesce(TRY_CAST(p_brand[7:] AS INTEGER), -1) AS d, p_size::VARCHAR[1] AS v, 'ab .' AS h FROM part".replace("p_size::VARCHAR[1]", "left(p_size::VARCHAR, 1)"),
)
_sql(
    "sql_adbc_objects",
    "nation",
    "SELECT table_name, table_type FROM information_schema.tables WHERE table_name = 'nation'",
    "SELECT 'nation' AS table_name, 'VIEW' AS table_type",
)


@query("adbc_get_objects", "SELECT 'public' AS db_schema_name, 'nation' AS table_name, c AS column_name, p::INTEGER AS ordinal_position FROM (VALUES ('n_nationkey', 1), ('n_name', 2), ('n_regionkey', 3)) v(c, p)")
def adbc_get_objects(spark, sf):
    views(spark, sf, "nation")
    kind = spark.conf.get("spark.sql.timestampType")
    try:
        out = Engine(spark).get_objects(table="nation")
    finally:
        spark.conf.set("spark.sql.timestampType", kind)
    tables = out.selectExpr("inline(catalog_db_schemas)").selectExpr("db_schema_name", "inline(db_schema_tables)")
    return tables.selectExpr("db_schema_name", "table_name", "inline(table_columns)").select("db_schema_name", "table_name", "column_name", "ordinal_position")


@query("adbc_schemas", "SELECT * FROM (VALUES ('result', 'h', 'bigint'), ('result', 'n_name', 'string'), ('parameters', 'p1', 'void'), ('table', 'n_nationkey', 'int'), ('table', 'n_name', 'string'), ('table', 'n_regionkey', 'int')) t(what, name, type)")
def adbc_schemas(spark, sf):
    views(spark, sf, "nation")
    kind = spark.conf.get("spark.sql.timestampType")
    try:
        e = Engine(spark)
        found = [("result", e.schema("SELECT n_nationkey / 2 AS h, n_name FROM nation")), ("parameters", e.parameter_schema("SELECT * FROM nation WHERE n_name = $1")), ("table", e.table_schema("nation"))]
    finally:
        spark.conf.set("spark.sql.timestampType", kind)
    return spark.createDataFrame([(w, f.name, f.dataType.simpleString()) for w, s in found for f in s.fields], "what string, name string, type string")
