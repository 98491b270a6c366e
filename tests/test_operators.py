"""Operators and functions on small frames: NULLs, ties, empty inputs and errors."""

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import datetime as dt
from tessera.functions import json as js
from tessera.functions import math as m
from tessera.functions import regex as rx
from tessera.functions import strings as st
from tessera.operators import aggregates as agg
from tessera.operators import catalog as cat
from tessera.operators import dml
from tessera.operators.recursive import recursive_union, walk
from tessera.operators.relational import quantified
from tessera.operators.series import generate_series
from tessera.sources import arrow, infer


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("column", [lambda: m.sqrt(-1), lambda: m.ln(0), lambda: m.log(-1), lambda: m.asin(2), lambda: m.power(0, -1), lambda: m.exp(1000), lambda: m.int_divide(1, 0)])
def test_domain_errors(spark, column):
    with pytest.raises(Exception, match="(?i)logarithm|root|range|zero"):
        one(spark, column())


def test_math_values(spark):
    assert float(one(spark, m.round_half_away(F.lit("2.675").cast("decimal(10,3)"), 2))) == 2.68
    assert one(spark, m.trunc(-2.7)) == -2.0
    assert float(one(spark, m.trunc_decimal(F.lit("-2.789").cast("decimal(10,3)"), 1))) == -2.7
    assert one(spark, m.log(100)) == pytest.approx(2)
    assert one(spark, m.tand(90)) == math.inf
    assert one(spark, m.sind(30)) == 0.5


def test_strings(spark):
    assert one(spark, st.initcap("foo-bar BAZ_x")) == "Foo-Bar Baz_X"
    assert one(spark, st.left("abc", -1)) == "ab"
    assert one(spark, st.right("abc", -1)) == "bc"
    assert one(spark, st.substring("abcdef", -1, 4)) == "ab"
    assert one(spark, st.concat("a", F.lit(None), 1)) == "a1"
    assert one(spark, st.length("ab  ", padded=True)) == 2
    with pytest.raises(Exception, match="too long"):
        one(spark, st.checked_length(F.lit("abcd"), 3, "c"))


def test_regex(spark):
    assert one(spark, rx.matches("a\nb", "a.b")) is True
    assert one(spark, rx.regexp_replace("abcabc", "b", "X")) == "aXcabc"
    assert one(spark, rx.regexp_replace("abcabc", "b", "X", n=2)) == "abcaXc"
    assert one(spark, rx.regexp_replace("abcabc", "(b)(c)", r"\2\1", flags="g")) == "acbacb"
    assert one(spark, rx.regexp_instr("abcabc", "b", 1, 2)) == 5
    assert one(spark, rx.regexp_instr("abcabc", "b", 1, 2, 1)) == 6
    assert one(spark, rx.regexp_match("foo bar", "(o+) (b)")) == "{oo,b}"
    assert one(spark, rx.regexp_match("x", "y")) is None
    assert one(spark, rx.similar_to("abc", "a(b|x)_")) is True


def test_dates(spark):
    d = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, dt.datediff("month", d("2024-01-31"), d("2024-02-01"))) == 1
    assert one(spark, dt.datediff("week", d("2024-01-07"), d("2024-01-08"))) == 1
    assert one(spark, dt.to_char(d("2024-02-03 15:04:05"), 'FMDDth "of" FMMonth HH12:MI PM')) == "3rd of February 03:04 PM"
    assert one(spark, dt.date_part("dow", d("2024-02-04"))) == 0
    assert str(one(spark, dt.date_bin(900_000_000, d("2023-12-31 23:59:00"), d("2024-01-01")))) == "2023-12-31 23:45:00"


def test_json_exact_text(spark):
    doc = '{"z":1.50, "y":[1e400, {"a":"q\\"x"}], "z":2}'
    assert one(spark, js.get(doc, "z")) == "2"
    assert one(spark, js.get_path(doc, "y", "0")) == "1e400"
    assert one(spark, js.get_path(doc, "y", "1", "a")) == '"q\\"x"'
    assert one(spark, js.jsonb(doc)) == '{"y": [1e400, {"a": "q\\"x"}], "z": 2}'
    assert one(spark, js.is_json_unique(doc)) is False
    assert js.text_array('{a,0,"b c"}') == ["a", "0", "b c"]
    with pytest.raises(Exception, match="non-array"):
        one(spark, js.array_length(F.lit("{}")))


def test_exact_sum_is_rounded_once(spark):
    values = [1e16, 1.0, -1e16, 2.5, 1.0, 1e-300, 0.1, 0.2, -0.3]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", float("inf")), ("b", 1.0)], "k string, v double")
    got = dict(agg.exact_sum(df, ["k"], "v", "s").collect())
    assert got["a"] == math.fsum(values)
    assert got["b"] == math.inf


def test_quantified_three_values(spark):
    t = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    sub = spark.createDataFrame([(3,), (None,)], "v int")
    assert [r[1] for r in quantified(t, F.col("x"), ">", "ANY", sub, "v", "q").orderBy("x").collect()] == [None, None, True]
    assert [r[1] for r in quantified(t, F.col("x"), ">", "ALL", sub, "v", "q").orderBy("x").collect()] == [None, False, None]
    assert [r[1] for r in quantified(t, F.col("x"), "<>", "ALL", sub, "v", "q").orderBy("x").collect()] == [None, None, None]
    assert [r[1] for r in quantified(t, F.col("x"), ">", "ALL", sub.limit(0), "v", "q").orderBy("x").collect()] == [True, True, True]


def test_recursion_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "s int, d int")
    reach = recursive_union(spark.createDataFrame([(1,)], "n int"), lambda new: new.join(edges, F.col("n") == F.col("s")).select("d"))
    assert sorted(r[0] for r in reach.collect()) == [1, 2, 3, 4]
    paths = walk(spark, spark.createDataFrame([(1,)], "n int"), edges, "s", "d", "n")
    assert paths.where("is_cycle").count() == 1


def test_series(spark):
    assert generate_series(spark, 5, 1).count() == 0
    assert generate_series(spark, None, 1).count() == 0
    with pytest.raises(ValueError):
        generate_series(spark, 1, 2, 0)


def _table(spark):
    rows = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "c", 30)], "id int, k string, v int")
    return dml.Table(rows, (cat.column("id", "INTEGER"), cat.column("k", "VARCHAR(2)"), cat.column("v", "INTEGER", default="7")), (("small", "v < 100"),))


def test_dml_checks(spark):
    t = _table(spark)
    with pytest.raises(Exception, match="check constraint"):
        dml.update(t, {"v": "v * 10"}).table.rows.collect()
    with pytest.raises(Exception, match="too long"):
        dml.insert(t, spark.createDataFrame([(9, "abc", 1)], "a int, b string, c int")).table.rows.collect()
    assert dml.insert(t, None).returning("v").first()[0] == 7


def test_merge_changes_a_row_once(spark):
    t = _table(spark)
    s = spark.createDataFrame([(1, 5), (1, 6), (7, 1), (None, 2)], "id int, x int")
    twice = dml.merge(t, s, {"id": "id"}, [dml.When("matched", "update", set={"v": "s.x"})])
    with pytest.raises(Exception, match="second time"):
        twice.table.rows.collect()
    once = dml.merge(t, s, {"id": "id"}, [dml.When("matched", "update", "s.x = 5", {"v": "s.x"}), dml.When("not_matched", "insert", set={"id": "s.id", "k": "'n'", "v": "s.x"})])
    assert sorted(map(tuple, once.table.rows.select("k", "v").collect())) == [("a", 5), ("b", 20), ("c", 30), ("n", 1), ("n", 2)]


def test_update_from_conflict(spark):
    t = _table(spark)
    s = spark.createDataFrame([(1, 5), (1, 6)], "id int, x int")
    with pytest.raises(Exception, match="more than one row"):
        dml.update_from(t, s, {"id": "id"}, {"v": "s.x"}).table.rows.collect()
    same = dml.update_from(t, s.where("x = 5").union(s.where("x = 5")), {"id": "id"}, {"v": "s.x"})
    assert same.count() == 1


def test_catalog(spark):
    assert cat.spark_type("NUMERIC(10, 2)") == "decimal(10,2)"
    assert cat.spark_type("timestamp(3) with time zone") == "timestamp"
    assert cat.script("SELECT ';'; SELECT $$a;b$$ -- c;d\n; ") == ["SELECT ';'", "SELECT $$a;b$$ -- c;d"]
    with pytest.raises(ValueError):
        cat.alter(_table(spark), cat.add_check("none", "v > 15"))
    s = cat.Settings(spark)
    s.set("statement_timeout", "5s")
    assert s.show("statement_timeout") == "5s"
    with pytest.raises(ValueError):
        s.set("nonsense", "1")


def test_arrow_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    for stream in (False, True):
        path = str(tmp_path / f"t{stream}")
        arrow.export_ipc(df, path, stream=stream, compression="zstd")
        assert sorted(map(tuple, arrow.import_ipc(spark, path).collect()), key=str) == [(1, "a"), (2, None)]
    assert sum(b.num_rows for b in arrow.record_batches(spark.range(10), 3)) == 10
    arrow.ingest(spark, pa.table({"x": [1, 2]}), str(tmp_path / "p"))
    with pytest.raises(Exception, match="(?i)exist"):
        arrow.ingest(spark, pa.table({"x": [1]}), str(tmp_path / "p"))


def test_infer(spark):
    t = spark.createDataFrame([("1", "1.5", "x", None), ("2", "1e3", "2", None)], "a string, b string, c string, d string")
    assert infer.infer(t) == {"a": "bigint", "b": "double", "c": "string", "d": "string"}


def test_streaming_windows(spark, tmp_path):
    from tessera.streaming.windows import tumbling

    src = spark.createDataFrame([("2024-01-01 00:01:00", "a", 1.0), ("2024-01-01 00:02:00", "a", 2.0)], "t string, k string, value double").withColumn("t", F.to_timestamp("t"))
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = tumbling(stream, "t", "10 minutes", "1 minute", "k").writeStream.format("memory").queryName("tumbled").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r)[1:] for r in spark.table("tumbled").collect()] == [("a", 2, 3.0)]
