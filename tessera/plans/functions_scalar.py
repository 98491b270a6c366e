"""Mathematical, string, regular-expression and conditional functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import conditional as cond
from tessera.functions import math as m
from tessera.functions import regex as rx
from tessera.functions import strings as st
from tessera.plans.registry import query
from tessera.sources.tables import load


def _part(spark, sf):
    return load(spark, sf, "part")


@query(
    "fn_math",
    """SELECT p_partkey, round(p_retailprice / 3, 2) AS r2, round(p_size * 37, -2)::INTEGER AS rneg, trunc(p_retailprice) AS t, floor(p_retailprice / 7) AS f, ceil(p_retailprice / 7) AS c, p_size % 7 AS md,
    round(power(p_size, 1.5), 6) AS pw, round(sqrt(p_size), 9) AS sq, round(ln(p_size), 9) AS l, round(log10(p_size), 9) AS lg, round(ln(p_size) / ln(2), 9) AS lb, round(exp(p_size / 10.0), 6) AS e, round(cbrt(p_size), 9) AS cb,
    sign(p_size - 25)::INTEGER AS sg, abs(p_size - 25) AS ab, round(pi(), 9) AS pi FROM part""",
)
def fn_math(spark, sf):
    s, r = F.col("p_size"), F.col("p_retailprice")
    return _part(spark, sf).select(
        "p_partkey", m.round_half_away(r / 3, 2).alias("r2"), m.round_half_away(s * 37, -2).alias("rneg"), m.trunc(r).alias("t"), m.floor(r / 7).alias("f"), m.ceil(r / 7).alias("c"), m.mod(s, 7).alias("md"),
        F.round(m.power(s, 1.5), 6).alias("pw"), F.round(m.sqrt(s), 9).alias("sq"), F.round(m.ln(s), 9).alias("l"), F.round(m.log(s), 9).alias("lg"), F.round(m.log(s, 2), 9).alias("lb"), F.round(m.exp(s / 10.0), 6).alias("e"), F.round(m.cbrt(s), 9).alias("cb"),
        m.sign(s - 25, "int").alias("sg"), F.abs(s - 25).alias("ab"), F.round(F.pi(), 9).alias("pi"),
    )


@query("fn_trunc_digits", "SELECT p_partkey, (CASE WHEN x < 0 THEN -floor(-x * 100) ELSE floor(x * 100) END / 100)::DOUBLE AS t2 FROM (SELECT p_partkey, (p_retailprice - 1200) / 8 AS x FROM part)")
def fn_trunc_digits(spark, sf):
    return _part(spark, sf).select("p_partkey", m.trunc((F.col("p_retailprice") - 1200) / 8, 2).alias("t2"))


@query("fn_random", "SELECT p_partkey, TRUE AS inside FROM part")
def fn_random(spark, sf):
    x = m.random()
    return _part(spark, sf).select("p_partkey", x.alias("x")).select("p_partkey", ((F.col("x") >= 0) & (F.col("x") < 1)).alias("inside"))


@query(
    "fn_trig",
    """SELECT p_partkey, round(sin(p_size), 9) AS s, round(cos(p_size), 9) AS c, round(tan(p_size), 6) AS t, round(cot(p_size), 6) AS ct, round(asin(p_size / 60.0), 9) AS a_s, round(acos(p_size / 60.0), 9) AS a_c, round(atan(p_size), 9) AS a_t,
    round(atan2(p_size, 7), 9) AS a2, round(radians(p_size), 9) AS rd, round(degrees(p_size / 10.0), 9) AS dg FROM part""",
)
def fn_trig(spark, sf):
    s = F.col("p_size").cast("double")
    return _part(spark, sf).select(
        "p_partkey", F.round(F.sin(s), 9).alias("s"), F.round(F.cos(s), 9).alias("c"), F.round(F.tan(s), 6).alias("t"), F.round(F.cot(s), 6).alias("ct"), F.round(m.asin(s / 60), 9).alias("a_s"), F.round(m.acos(s / 60), 9).alias("a_c"),
        F.round(F.atan(s), 9).alias("a_t"), F.round(F.atan2(s, F.lit(7.0)), 9).alias("a2"), F.round(F.radians(s), 9).alias("rd"), F.round(F.degrees(s / 10), 9).alias("dg"),
    )


@query(
    "fn_trig_degrees",
    """SELECT p_partkey, round(sin(radians(d)), 9) + 0 AS s, round(cos(radians(d)), 9) + 0 AS c, CASE WHEN d % 180 = 90 THEN 'Infinity'::DOUBLE ELSE round(tan(radians(d)), 6) + 0 END AS t, CASE WHEN d % 180 = 0 THEN 'Infinity'::DOUBLE ELSE round(cos(radians(d)) / sin(radians(d)), 6) + 0 END AS ct,
    round(degrees(asin(p_size / 50.0)), 9) AS a_s, round(degrees(acos(p_size / 50.0)), 9) + 0 AS a_c, round(degrees(atan(p_size)), 9) AS a_t, round(degrees(atan2(p_size, 5)), 9) AS a2 FROM (SELECT *, p_size * 15 AS d FROM part)""",
)
def fn_trig_degrees(spark, sf):
    s = F.col("p_size").cast("double")
    d = s * 15
    return _part(spark, sf).select(
        "p_partkey", (F.round(m.sind(d), 9) + 0.0).alias("s"), (F.round(m.cosd(d), 9) + 0.0).alias("c"), (F.round(m.tand(d), 6) + 0.0).alias("t"), (F.round(m.cotd(d), 6) + 0.0).alias("ct"),
        F.round(m.asind(s / 50), 9).alias("a_s"), (F.round(m.acosd(s / 50), 9) + 0.0).alias("a_c"), F.round(m.atand(s), 9).alias("a_t"), F.round(m.atan2d(s, 5), 9).alias("a2"),
    )


@query("fn_trig_exact", "SELECT 0.5::DOUBLE AS s30, 0.5::DOUBLE AS c60, 1.0::DOUBLE AS t45, 'Infinity'::DOUBLE AS t90, 30.0::DOUBLE AS a, 60.0::DOUBLE AS ac, 45.0::DOUBLE AS at, 45.0::DOUBLE AS a2")
def fn_trig_exact(spark, sf):
    return spark.range(1).select(m.sind(30).alias("s30"), m.cosd(60).alias("c60"), m.tand(45).alias("t45"), m.tand(90).alias("t90"), m.asind(0.5).alias("a"), m.acosd(0.5).alias("ac"), m.atand(1).alias("at"), m.atan2d(1, 1).alias("a2"))


@query(
    "fn_string",
    """SELECT p_partkey, substring(p_name, 3, 4) AS sub, substring(p_name, -1::BIGINT + 2, 3) AS sub1, left(p_name, 3) AS l, left(p_name, -2) AS ln, right(p_name, 3) AS r, right(p_name, -2) AS rn, replace(p_name, 'a', '#') AS rep,
    trim(p_brand, 'B1') AS bt, ltrim(p_brand, 'Br') AS lt, rtrim(p_brand, '12') AS rt, position('a' IN p_name)::BIGINT AS pos, strpos(p_type, 'S')::BIGINT AS sp, split_part(p_type, ' ', 2) AS p2, split_part(p_type, ' ', -1) AS pl,
    lpad(p_brand, 12, '*') AS lp, rpad(p_brand, 5, '*') AS rp, reverse(p_name) AS rev, repeat(p_brand, 2) AS rpt, md5(p_name) AS md, starts_with(p_type, 'S') AS sw, lower(p_type) AS lo, upper(p_name) AS up, length(p_name)::BIGINT AS n FROM part""",
)
def fn_string(spark, sf):
    n, b, t = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return _part(spark, sf).select(
        "p_partkey", st.substring(n, 3, 4).alias("sub"), st.substring(n, 1, 3).alias("sub1"), st.left(n, 3).alias("l"), st.left(n, -2).alias("ln"), st.right(n, 3).alias("r"), st.right(n, -2).alias("rn"), F.replace(n, F.lit("a"), F.lit("#")).alias("rep"),
        F.btrim(b, F.lit("B1")).alias("bt"), F.ltrim(b, F.lit("Br")).alias("lt"), F.rtrim(b, F.lit("12")).alias("rt"), st.position("a", n).alias("pos"), st.position("S", t).alias("sp"), st.split_part(t, " ", 2).alias("p2"), st.split_part(t, " ", -1).alias("pl"),
        F.lpad(b, 12, "*").alias("lp"), F.rpad(b, 5, "*").alias("rp"), F.reverse(n).alias("rev"), F.repeat(b, F.lit(2)).alias("rpt"), F.md5(n).alias("md"), F.startswith(t, F.lit("S")).alias("sw"), F.lower(t).alias("lo"), F.upper(n).alias("up"), st.length(n).alias("n"),
    )


@query("fn_string_substring_edge", "SELECT * FROM (VALUES ('ab', '', 'abcdef', 'bcdef', 'a b')) t(a, b, c, d, e)")
def fn_string_substring_edge(spark, sf):
    s = F.lit("abcdef")
    return spark.range(1).select(st.substring(s, -1, 4).alias("a"), st.substring(s, -5, 3).alias("b"), st.substring(s, 0).alias("c"), st.substring(s, 2).alias("d"), F.rtrim(st.pad_char("a b", 6)).alias("e"))


@query("fn_string_concat", "SELECT n_nationkey, concat(nullif(n_name, 'NATION_3'), '-', n_regionkey) AS c, concat_ws('/', nullif(n_name, 'NATION_3'), n_regionkey, NULL) AS w, nullif(n_name, 'NATION_3') || 'x' AS o FROM nation")
def fn_string_concat(spark, sf):
    n = F.expr("nullif(n_name, 'NATION_3')")
    return load(spark, sf, "nation").select("n_nationkey", st.concat(n, "-", F.col("n_regionkey")).alias("c"), st.concat_ws("/", n, F.col("n_regionkey"), F.lit(None)).alias("w"), F.concat(n, F.lit("x")).alias("o"))


@query("fn_string_initcap_hex", "SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_type || '-x_y'), '[a-z0-9]+|[^a-z0-9]+'), lambda w: upper(w[1]) || w[2:]), '') AS i, lower(hex(p_brand)) AS h, p_brand AS u, substr(p_name, 1, 4) AS v FROM part")
def fn_string_initcap_hex(spark, sf):
    b = F.col("p_brand")
    return _part(spark, sf).select("p_partkey", st.initcap(F.concat("p_type", F.lit("-x_y"))).alias("i"), st.to_hex(b).alias("h"), st.from_hex(st.to_hex(b)).cast("string").alias("u"), st.fit_varchar(F.col("p_name"), 4).alias("v"))


@query(
    "fn_regex",
    """SELECT p_partkey, regexp_matches(p_type, '^S') AS l, len(regexp_extract_all(p_type, '[AEIOU]'))::BIGINT AS c, regexp_extract(p_type, '([A-Z]+) ([A-Z]+)', 2) AS g, regexp_replace(p_type, '[AEIOU]', '_') AS first, regexp_replace(p_type, '[AEIOU]', '_', 'g') AS every,
    regexp_replace(p_brand, '(\\w+)#(\\d+)', '\\2-\\1') AS swap FROM part""",
)
def fn_regex(spark, sf):
    t = F.col("p_type")
    return _part(spark, sf).select(
        "p_partkey", rx.matches(t, "^S").alias("l"), rx.regexp_count(t, "[AEIOU]").alias("c"), F.coalesce(rx.regexp_substr(t, "([A-Z]+) ([A-Z]+)", group=2), F.lit("")).alias("g"), rx.regexp_replace(t, "[AEIOU]", "_").alias("first"),
        rx.regexp_replace(t, "[AEIOU]", "_", flags="g").alias("every"), rx.regexp_replace(F.col("p_brand"), r"(\w+)#(\d+)", r"\2-\1").alias("swap"),
    )


@query(
    "fn_regex_occurrence",
    """SELECT * FROM (VALUES (1, 4::BIGINT, 8::BIGINT, 0::BIGINT, 'bb22', '22', '{a,1}', 'a1 <bb22> c3', 'a1 bb22 c#', 'a1 bb22 #'), (2, 0::BIGINT, 0::BIGINT, 0::BIGINT, NULL, NULL, NULL, 'none', 'none', 'none')) t(k, i2, e1, i9, s2, g2, m, r2, r0, ra)""",
)
def fn_regex_occurrence(spark, sf):
    t, s = spark.sql("SELECT * FROM VALUES (1, 'a1 bb22 c3'), (2, 'none') AS t(k, s)"), F.col("s")
    p = r"([a-z]+)([0-9]+)"
    return t.select("k", rx.regexp_instr(s, p, 1, 2).alias("i2"), rx.regexp_instr(s, p, 2, 1, 1).alias("e1"), rx.regexp_instr(s, p, 1, 9).alias("i9"), rx.regexp_substr(s, p, 1, 2).alias("s2"), rx.regexp_substr(s, p, 1, 2, group=2).alias("g2"), rx.regexp_match(s, p).alias("m"), rx.regexp_replace(s, p, r"<\&>", 1, 2).alias("r2"), rx.regexp_replace(s, r"[0-9](?!.*[0-9])", "#").alias("r0"), rx.regexp_replace(s, r"c[0-9]", "#", n=0).alias("ra"))


@query("fn_conditional", "SELECT p_partkey, coalesce(nullif(p_size, 1), -1) AS c, greatest(p_size, 10, nullif(p_size, 20)) AS g, least(p_size, 10, nullif(p_size, 5)) AS l, if(p_size > 25, 'big', 'small') AS i, nullif(p_brand, 'Brand#11') AS n FROM part")
def fn_conditional(spark, sf):
    s = F.col("p_size")
    return _part(spark, sf).select("p_partkey", cond.coalesce(cond.nullif(s, 1), -1).alias("c"), cond.greatest(s, 10, cond.nullif(s, 20)).alias("g"), cond.least(s, 10, cond.nullif(s, 5)).alias("l"), cond.iif(s > 25, "big", "small").alias("i"), cond.nullif(F.col("p_brand"), "Brand#11").alias("n"))


@query("fn_cast_try", "SELECT p_partkey, p_size::VARCHAR AS s, try_cast(p_brand AS INTEGER) AS t, coalesce(try_cast(substr(p_brand, 7) AS INTEGER), -1) AS d, p_retailprice::DECIMAL(12,1) AS n, '2024-02-29'::DATE AS day FROM part")
def fn_cast_try(spark, sf):
    b = F.col("p_brand")
    return _part(spark, sf).select("p_partkey", F.col("p_size").cast("string").alias("s"), cond.try_cast(b, "int").alias("t"), cond.cast_default(F.substr(b, F.lit(7)), "int", -1).alias("d"), F.col("p_retailprice").cast("decimal(12,1)").alias("n"), F.lit("2024-02-29").cast("date").alias("day"))
