"""Date, time, interval and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import datetime as dt
from tessera.functions import interval as iv
from tessera.functions import json as js
from tessera.plans.registry import query
from tessera.sources.tables import load


def _events(spark, sf):
    return load(spark, sf, "events")


_FIELDS = ("year", "quarter", "month", "week", "day", "doy", "hour", "minute", "dow", "isodow", "isoyear", "decade", "century", "millennium")


@query("fn_date_part", f"SELECT event_id, {', '.join(f'extract({f} FROM ts)::BIGINT AS {f}' for f in _FIELDS)}, round(extract(second FROM ts), 6)::DOUBLE AS second, round(epoch(ts), 3) AS epoch, (epoch_us(ts) // 1000)::BIGINT AS ms FROM events")
def fn_date_part(spark, sf):
    t = F.col("ts")
    return _events(spark, sf).select("event_id", *[dt.date_part(f, t).alias(f) for f in _FIELDS], F.floor(dt.date_part("second", t)).cast("double").alias("second"), F.round(dt.epoch(t), 3).alias("epoch"), dt.epoch_ms(t).alias("ms"))


@query("fn_date_trunc", "SELECT event_id, date_trunc('hour', ts) AS h, date_trunc('week', ts)::TIMESTAMP AS w, date_trunc('month', ts::DATE)::DATE AS m, date_trunc('quarter', ts)::TIMESTAMP AS q, last_day(ts::DATE) AS l FROM events")
def fn_date_trunc(spark, sf):
    t, d = F.col("ts"), F.col("ts").cast("date")
    return _events(spark, sf).select("event_id", dt.date_trunc("hour", t).alias("h"), dt.date_trunc("week", t).alias("w"), dt.date_trunc("month", d, "date").alias("m"), dt.date_trunc("quarter", t).alias("q"), dt.last_day(d).alias("l"))


@query("fn_date_bin", "SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-15 00:05:00') AS b, time_bucket(INTERVAL 7 HOUR, ts, TIMESTAMP '2024-01-01 00:00:00') AS c FROM events")
def fn_date_bin(spark, sf):
    return _events(spark, sf).select("event_id", dt.date_bin(900_000_000, F.col("ts"), "2024-01-15 00:05:00").alias("b"), dt.date_bin(7 * 3_600_000_000, F.col("ts"), "2024-01-01").alias("c"))


@query("fn_dateadd", "SELECT event_id, ts + INTERVAL 1 MONTH AS m, ts - INTERVAL 90 MINUTE AS h, (ts::DATE + INTERVAL 13 MONTH)::DATE AS d, (ts::DATE - INTERVAL 2 WEEK)::DATE AS w, ts + INTERVAL 1 QUARTER AS q FROM events")
def fn_dateadd(spark, sf):
    t, d = F.col("ts"), F.col("ts").cast("date")
    return _events(spark, sf).select("event_id", dt.dateadd("month", 1, t).alias("m"), dt.date_sub("minute", 90, t).alias("h"), dt.dateadd("month", 13, d, "date").alias("d"), dt.date_sub("week", 2, d, "date").alias("w"), dt.dateadd("quarter", 1, t).alias("q"))


_PARTS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second", "millisecond", "microsecond")


@query("fn_datediff", f"SELECT event_id, (date_trunc('week', ts)::DATE - DATE '2023-11-27') // 7 AS week, {', '.join(f'''date_diff('{p}', TIMESTAMP '2023-11-30 23:59:59.5', ts) AS {p}''' for p in _PARTS if p != 'week')} FROM events")
def fn_datediff(spark, sf):
    return _events(spark, sf).select("event_id", *[dt.datediff(p, F.lit("2023-11-30 23:59:59.5").cast("timestamp_ntz"), F.col("ts")).alias(p) for p in _PARTS])


@query("fn_make", "SELECT n_nationkey, make_date(2000 + n_nationkey, 2, 28) AS d, make_timestamp(2000 + n_nationkey, 2, 28, 13, 30, 1.25) AS t, make_timestamp(1700000000000000 + n_nationkey * 1000000) AS e FROM nation")
def fn_make(spark, sf):
    y = F.col("n_nationkey") + 2000
    return load(spark, sf, "nation").select("n_nationkey", dt.make_date(y, 2, 28).alias("d"), dt.make_timestamp(y, 2, 28, 13, 30, 1.25).alias("t"), dt.from_micros((F.col("n_nationkey").cast("bigint") + 1_700_000_000) * 1_000_000).alias("e"))


@query("fn_make_time", "SELECT n_nationkey, lpad((n_nationkey % 24)::VARCHAR, 2, '0') || ':30:05' AS t FROM nation")
def fn_make_time(spark, sf):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    return load(spark, sf, "nation").select("n_nationkey", dt.make_time(F.col("n_nationkey") % 24, 30, 5).cast("string").alias("t"))


@query("fn_to_char", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(ts, '%d.%m.%y') AS de, strftime(ts, '%b %-d, %Y') AS us, strftime(ts, '%I:%M %p') AS half, strftime(ts, '%A') AS day, strftime(ts, '%j') AS doy, 'Q' || quarter(ts) AS q, rpad(upper(strftime(ts, '%B')), 9, ' ') AS mon FROM events")
def fn_to_char(spark, sf):
    t = F.col("ts")
    return _events(spark, sf).select("event_id", *[dt.to_char(t, f).alias(n) for n, f in (("iso", "YYYY-MM-DD HH24:MI:SS"), ("de", "DD.MM.YY"), ("us", "Mon FMDD, YYYY"), ("half", "HH12:MI AM"), ("day", "FMDay"), ("doy", "DDD"), ("q", '"Q"Q'), ("mon", "MONTH"))])


@query("fn_to_date", "SELECT event_id, ts::DATE AS d, date_trunc('second', ts) AS t FROM events")
def fn_to_date(spark, sf):
    t = F.col("ts")
    return _events(spark, sf).select("event_id", dt.to_date(dt.to_char(t, "DD/MM/YYYY"), "DD/MM/YYYY").alias("d"), dt.to_timestamp(dt.to_char(t, "YYYYMMDD HH24:MI:SS"), "YYYYMMDD HH24:MI:SS").alias("t"))


@query("fn_timezone", "SELECT event_id, ts - INTERVAL 5 HOUR AS ny, ts + INTERVAL 5 HOUR AS utc, ts + INTERVAL 1 HOUR AS paris FROM events")
def fn_timezone(spark, sf):
    t = F.col("ts")  # January: no daylight saving time
    return _events(spark, sf).select("event_id", dt.at_time_zone(t, "America/New_York", True).alias("ny"), dt.at_time_zone(t, "America/New_York", False).alias("utc"), dt.convert_timezone("Europe/Paris", t).alias("paris"))


@query("fn_now", "SELECT TRUE AS same_day, TRUE AS rounded, TRUE AS ntz")
def fn_now(spark, sf):
    return spark.range(1).select((F.abs(F.datediff(dt.current_date(), F.current_timestamp().cast("date"))) <= 1).alias("same_day"), (F.unix_micros(dt.rounded_now(0)) % 1_000_000 == 0).alias("rounded"), dt.localtimestamp().isNotNull().alias("ntz"))


@query("fn_interval", "SELECT event_id, ts + INTERVAL 1 MONTH + INTERVAL 2 DAY + INTERVAL 90 MINUTE AS p, ts - INTERVAL 1 YEAR AS m, date_diff('day', TIMESTAMP '2024-01-01 00:00:00', date_trunc('day', ts))::INTEGER AS days, (epoch_us(ts) - epoch_us(date_trunc('day', ts)))::BIGINT AS us FROM events")
def fn_interval(spark, sf):
    t = F.col("ts")
    diff = iv.between(t, F.lit("2024-01-01").cast("timestamp_ntz"))
    return _events(spark, sf).select("event_id", iv.plus(t, iv.add(iv.make(1, 2), iv.of(90, "minutes"))).alias("p"), iv.minus(t, iv.of(1, "year")).alias("m"), diff["days"].alias("days"), diff["micros"].alias("us"))


@query("fn_interval_compare", "SELECT TRUE AS month_is_30_days, TRUE AS less, '1 year 2 mons 3 days 04:05:06.5' AS text, '-00:00:01' AS negative, 15::INTEGER AS half")
def fn_interval_compare(spark, sf):
    t = iv.total
    return spark.range(1).select((t(iv.of(1, "month")) == t(iv.of(30, "day"))).alias("month_is_30_days"), (t(iv.of(23, "hour")) < t(iv.of(1, "day"))).alias("less"), iv.format_interval(iv.make(14, 3, 14_706_500_000)).alias("text"), iv.format_interval(iv.of(-1, "second")).alias("negative"), iv.scale(iv.of(1, "month"), 0.5)["days"].alias("half"))


@query("fn_age", "SELECT event_id, date_part('year', age(ts, TIMESTAMP '2020-02-29 12:00:00'))::INTEGER * 12 + date_part('month', age(ts, TIMESTAMP '2020-02-29 12:00:00'))::INTEGER AS months, date_part('day', age(ts, TIMESTAMP '2020-02-29 12:00:00'))::INTEGER AS days FROM events")
def fn_age(spark, sf):
    a = iv.age(F.col("ts"), F.lit("2020-02-29 12:00:00"))
    return _events(spark, sf).select("event_id", a["months"].alias("months"), a["days"].alias("days"))


@query(
    "fn_timezone_rules",
    """SELECT * FROM (VALUES (1, TIMESTAMP '2024-03-10 07:30:00', TIMESTAMP '2024-03-10 03:30:00', TIMESTAMP '2024-03-10 01:30:00'), (2, TIMESTAMP '2024-11-03 06:30:00', TIMESTAMP '2024-11-03 01:30:00', TIMESTAMP '2024-11-03 00:30:00'),
    (3, TIMESTAMP '2024-07-01 16:00:00', TIMESTAMP '2024-07-01 12:00:00', TIMESTAMP '2024-07-01 11:00:00'), (4, TIMESTAMP '2024-01-15 17:00:00', TIMESTAMP '2024-01-15 12:00:00', TIMESTAMP '2024-01-15 11:00:00')) t(k, utc, back, cet)""",
)
def fn_timezone_rules(spark, sf):
    """A local time in a gap, one in an overlap, one of summer and one of winter; and an abbreviation, which knows no summer."""
    t = spark.createDataFrame([(1, "2024-03-10 02:30:00"), (2, "2024-11-03 01:30:00"), (3, "2024-07-01 12:00:00"), (4, "2024-01-15 12:00:00")], "k int, x string").withColumn("x", F.col("x").cast("timestamp_ntz"))
    utc = dt.at_time_zone(F.col("x"), "America/New_York", False)
    return t.select("k", utc.alias("utc"), dt.at_time_zone(utc, "America/New_York", True).alias("back"), dt.at_time_zone(F.col("x"), "CET", False).alias("cet"))


@query("fn_json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS t, json_extract(props, '$.k')::VARCHAR AS j, json_type(props) = 'OBJECT' AS o, json_exists(props, '$.k') AS e, json_exists(props, '$.zz') AS n, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS v FROM events")
def fn_json_extract(spark, sf):
    p = F.col("props")
    return _events(spark, sf).select("event_id", js.get_text(p, "k").alias("t"), js.get(p, "k").alias("j"), (js.typeof(p) == "object").alias("o"), js.exists(p, "$.k").alias("e"), js.exists(p, "$.zz").alias("n"), js.value(p, "$.k", "bigint").alias("v"))


_DOCS = """(VALUES (1, '{"a": 1.50, "b": {"c": [10, "x"]}}'), (2, '[1, {"k": null}]'), (3, '"text"'), (4, 'not json'), (5, NULL)) t(k, d)"""


@query("fn_json_exact", """SELECT * FROM (VALUES (1, '1.50', '{"c": [10, "x"]}', '[10, "x"]', 'x', 'x'), (2, NULL, NULL, NULL, NULL, NULL), (3, NULL, NULL, NULL, NULL, NULL)) t(k, a, b, p, pt, q)""")
def fn_json_exact(spark, sf):
    d = F.col("d")
    t = spark.createDataFrame([(1, '{"a": 1.50, "b": {"c": [10, "x"]}}'), (2, '[1, {"k": null}]'), (3, '"text"')], "k int, d string")
    return t.select("k", js.get(d, "a").alias("a"), js.get(d, "b").alias("b"), js.get_path(d, "b", "c").alias("p"), js.get_text(d, "b", "c", 1).alias("pt"), F.regexp_replace(js.query(d, "$.b.c[1]"), '"', "").alias("q"))


@query("fn_json_predicates", f"SELECT k, json_valid(d) AS v, coalesce(json_valid(d) AND json_type(try_cast(CASE WHEN json_valid(d) THEN d END AS JSON)) = 'OBJECT', FALSE) AND d IS NOT NULL AS o, CASE WHEN json_valid(d) THEN lower(json_type(d)) END AS t FROM {_DOCS}")
def fn_json_predicates(spark, sf):
    d = F.col("d")
    t = spark.createDataFrame([(1, '{"a": 1.50, "b": {"c": [10, "x"]}}'), (2, '[1, {"k": null}]'), (3, '"text"'), (4, "not json"), (5, None)], "k int, d string")
    kind = js.typeof(F.when(js.is_json(d), d))
    return t.select("k", js.is_json(d).alias("v"), F.coalesce(js.is_json(d, "object"), F.lit(False)).alias("o"), F.when(kind == "string", "varchar").otherwise(kind).alias("t"))


@query("fn_json_build", """SELECT n_nationkey, '{"k" : ' || n_nationkey || ', "name" : "' || n_name || '", "none" : null}' AS o, '[' || n_nationkey || ', "' || n_name || '"]' AS a, '{"k" : ' || n_nationkey || '}' AS ab, '[' || n_nationkey || ']' AS arr, '{"k": ' || n_nationkey || ', "name": "' || n_name || '"}' AS b FROM nation""")
def fn_json_build(spark, sf):
    k, n = F.col("n_nationkey"), F.col("n_name")
    nothing = F.lit(None).cast("string")
    return load(spark, sf, "nation").select("n_nationkey", js.build_object("k", k, "name", n, "none", nothing).alias("o"), js.build_array(k, n).alias("a"), js.json_object([("k", k), ("x", nothing)], absent_on_null=True).alias("ab"), js.json_array([k, nothing]).alias("arr"), js.jsonb_build_object("name", n, "k", k).alias("b"))


@query("fn_json_array_length", "SELECT event_id, 2::BIGINT AS n FROM events")
def fn_json_array_length(spark, sf):
    return _events(spark, sf).select("event_id", js.array_length(js.build_array(F.col("event_id"), F.col("event_type"))).alias("n"))


@query("fn_json_construct", """SELECT '{"a" : "1", "b c" : "x"}' AS o, '{"k" : "v"}' AS kv, '{"b": 1.50, "aa": [1, 2]}' AS b, '{"z": 1,  "y": 2}' AS j, FALSE AS u, TRUE AS uu, '["x"]' AS w, -1::BIGINT AS empty, 7::BIGINT AS err""")
def fn_json_construct(spark, sf):
    odd = '{"z": 1,  "y": 2}'
    return spark.range(1).select(
        F.lit(js.object_from_text('{a,1,"b c",x}')).alias("o"), F.lit(js.object_from_text("{k}", "{v}")).alias("kv"), js.jsonb('{"aa":[1,2], "b":1.50}').alias("b"), js.json(odd).alias("j"), js.is_json_unique('{"a":1,"a":2}').alias("u"),
        js.is_json_unique('{"a":1}').alias("uu"), js.query('{"a":"x"}', "$.a", wrapper=True).alias("w"), js.value("{}", "$.a", "bigint", on_empty=-1).alias("empty"), js.value('{"a":"x"}', "$.a", "bigint", on_error=7).alias("err"),
    )


@query("fn_make_instants", "SELECT n_nationkey, make_timestamp(2024, 3, 1, 17, 0, 0) AS t, make_timestamp(1700000000000000 + n_nationkey * 1000000) AS e FROM nation")
def fn_make_instants(spark, sf):
    # instants as UTC wall time
    t = dt.make_timestamptz(2024, 3, 1, 12, 0, 0, "America/New_York")
    zone = spark.conf.get("spark.sql.session.timeZone")
    local = lambda c: dt.convert_timezone("UTC", c.cast("timestamp_ntz"), zone)
    return load(spark, sf, "nation").select("n_nationkey", local(t).alias("t"), local(dt.to_timestamp_epoch(F.lit(1_700_000_000) + F.col("n_nationkey"))).alias("e"))
