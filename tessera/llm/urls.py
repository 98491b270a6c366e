"""URL filters as a sort-merge range join.

A host's canonical key is its labels in reverse order, each followed by a dot, so a rule's host and all its subdomains are
one interval of keys. Rules' hosts and the distinct hosts of the URLs are sorted together. At the start of an interval its event carries
the stack of what is active from there on, at the end the stack without it; a window that keeps the last stack is the sweep.
A stack holds the rules of hosts with up to INLINE rules themselves, and references to hosts with more: no list of rules is copied
down the hosts below it, whatever its length. Of the rules in the stack, longest first, the first whose path starts the URL's path
decides.

The rules of a host with many are swept once more, by their paths: a rule is the interval of all paths that start with it, intervals nest,
and an event carries the rule that is innermost from there on (at an interval's end the rule around it). All of it is built-in Spark functions.

The first sweep sees every host once and is dealt by the first two labels; rules of a top label alone are joined by it. The second sees
every path of a host once; a host with many of them is dealt by a salt, and each salt sweeps its own copy of the host's rules, EVENTS of
them in all at the most. URLs themselves are only joined by their host and path, which Spark splits where they are skewed.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule; rules with a null host or
path are ignored; of rules with the same host and path the verdict that sorts first counts; equally long rules on one
URL are decided by the longer host; repeated rows are judged one by one; long URLs are read whole; empty tables give
empty results, and without rules every URL gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import cut

#: The verdict of URLs that no rule fits.
DEFAULT = "allow"
#: Rules of a host that its stack holds; hosts with more are referred to.
INLINE = 64
#: Paths of a host in one task of the second sweep, and rows of the copies of a host's rules.
PATHS, EVENTS = 1_000_000, 50_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """example.org -> org.example."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _last() -> Column:
    """Sorts after every continuation of a text: a byte that no UTF-8 holds."""
    return F.lit(bytearray(b"\xff")).cast("string")


def _clean(rules: DataFrame) -> DataFrame:
    """(key, host, path, verdict) of the rules, one for each host and path."""
    named = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy(F.translate("host", _UPPER, _LOWER).alias("host"), "path").agg(F.min("verdict").alias("verdict"))
    return named.select(host_key(F.col("host")).alias("key"), "host", "path", "verdict")


def _rule() -> Column:
    """A rule so that the one that decides sorts first."""
    text = F.concat("host", "path")
    return F.struct((-F.length(text)).alias("short"), (-F.length("host")).alias("short_host"), text.alias("rule"), "path", "verdict", "key")


def nodes(clean: DataFrame) -> DataFrame:
    """(key, own, big): the hosts of rules, with their rules if there are INLINE at the most. No task sees more of a host's rules: a limit for
    each key holds in every map task before the shuffle."""
    some = clean.withColumn("at", F.row_number().over(W.partitionBy("key").orderBy("path"))).where(F.col("at") <= INLINE + 1)
    one = some.groupBy("key").agg(F.collect_list(_rule()).alias("own"))
    big = F.size("own") > INLINE
    return one.select("key", F.when(big, F.slice("own", 1, 0)).otherwise(F.col("own")).alias("own"), big.alias("big"))


def stacks(hosts: DataFrame) -> DataFrame:
    """(key, stack, bigs): of each host of rules what is active on it: rules, and the hosts with many rules that it is or lies below."""
    labels = F.split(F.col("key"), r"\.", -1)
    above = hosts.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))).alias("up"))
    joined = above.join(hosts.select(F.col("key").alias("up"), "own", "big"), "up")
    return joined.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("stack"), F.collect_list(F.when(F.col("big"), F.col("up"))).alias("bigs"))


def active(hosts: DataFrame, stacked: DataFrame) -> DataFrame:
    """(host, stack, bigs) of each host (host) of the URLs: the sweep."""
    one = F.col("key") == F.concat(F.substring_index("key", ".", 1), F.lit("."))
    own = F.col("key")
    ends = F.array(
        F.struct(own.alias("at"), F.struct("stack", "bigs").alias("s")),
        F.struct(F.concat(own, _last()).alias("at"), F.struct(F.filter("stack", lambda r: r["key"] != F.col("key")).alias("stack"), F.filter("bigs", lambda b: b != F.col("key")).alias("bigs")).alias("s")),
    )
    changes = stacked.where(~one).select(F.substring_index("key", ".", 2).alias("two"), F.explode(ends).alias("e")).select("two", F.col("e.at").alias("key"), F.lit(0).alias("kind"), "e.s", F.lit(None).cast("string").alias("host"))
    keyed = hosts.withColumn("key", host_key(F.col("host")))
    points = keyed.select(F.substring_index("key", ".", 2).alias("two"), "key", F.lit(1).alias("kind"), F.lit(None).cast(changes.schema["s"].dataType).alias("s"), "host")
    sweep = W.partitionBy("two").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    swept = points.unionAll(changes).withColumn("s", F.last("s", ignorenulls=True).over(sweep)).where("kind = 1")
    tops = stacked.where(one).select(F.substring_index("key", ".", 1).alias("top"), F.struct("stack", "bigs").alias("t"))
    joined = swept.withColumn("top", F.substring_index("key", ".", 1)).join(tops, "top", "left").withColumn("s", F.coalesce("s", "t"))
    return joined.select("host", "s.stack", "s.bigs")


def _around(rules: DataFrame) -> DataFrame:
    """(key, path, rule, outer): each rule with the innermost one around it on its host. A rule around it is a beginning of its path, as long as
    some rule of the host, so beginnings of these lengths are looked up."""
    lengths = rules.groupBy("key").agg(F.collect_set(F.length("path")).alias("lengths"))
    shorter = rules.join(lengths, "key").select("key", "path", F.explode(F.filter("lengths", lambda n: n < F.length("path"))).alias("n"))
    begun = shorter.select("key", "path", F.expr("substring(path, 1, n)").alias("begin"))
    outer = rules.select("key", F.col("path").alias("begin"), _rule().alias("outer"))
    nearest = begun.join(outer, ["key", "begin"]).groupBy("key", "path").agg(F.min("outer").alias("outer"))
    return rules.select("key", "path", _rule().alias("rule")).join(nearest, ["key", "path"], "left")


def innermost(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, path, rule): the longest rule of a host (key) that fits each path on it, by the second sweep. ``pairs`` are distinct."""
    counts = pairs.groupBy("key").agg(F.count("*").alias("paths")).join(rules.groupBy("key").agg(F.count("*").alias("rules")), "key")
    salts = counts.select("key", F.greatest(F.lit(1), F.least(F.ceil(F.col("paths") / PATHS), F.floor(F.lit(EVENTS) / (2 * F.col("rules"))))).cast("int").alias("salts"))
    salts = cut(salts, "salts")
    around = _around(rules).join(salts, "key")
    ends = F.array(F.struct(F.col("path").alias("at"), F.struct("rule").alias("s")), F.struct(F.concat("path", _last()).alias("at"), F.struct(F.col("outer").alias("rule")).alias("s")))
    changes = around.select("key", F.sequence(F.lit(0), F.col("salts") - 1).alias("salt"), F.explode(ends).alias("e")).select("key", F.explode("salt").alias("salt"), "e")
    changes = changes.select("key", "salt", F.col("e.at").alias("path"), F.lit(0).alias("kind"), "e.s")
    points = pairs.join(salts, "key").select("key", F.pmod(F.xxhash64("path"), F.col("salts")).cast("int").alias("salt"), "path", F.lit(1).alias("kind"), F.lit(None).cast(changes.schema["s"].dataType).alias("s"))
    sweep = W.partitionBy("key", "salt").orderBy("path", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    swept = points.unionAll(changes).withColumn("s", F.last("s", ignorenulls=True).over(sweep)).where("kind = 1")
    return swept.select("key", "path", "s.rule").where("rule IS NOT NULL")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url), by ``rules`` (host, path, verdict)."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    clean = cut(_clean(rules), "rules")
    hosts = cut(nodes(clean), "hosts")
    stacked = cut(stacks(hosts), "stacks")
    judged = urls.join(cut(active(urls.select("host").distinct(), stacked), "active"), "host", "left")
    best = F.try_element_at(F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(1))
    judged = judged.withColumn("best", best).select("page_id", "host", "path", "best", "bigs")
    big = hosts.where("big").select("key")
    if not big.isEmpty():
        pairs = judged.select("host", "path", F.explode("bigs").alias("key")).distinct()
        found = innermost(pairs.select("key", "path").distinct(), clean.join(big, "key", "left_semi"))
        of_url = cut(pairs.join(found, ["key", "path"]).groupBy("host", "path").agg(F.min("rule").alias("far")), "far")
        judged = judged.join(of_url, ["host", "path"], "left").withColumn("best", F.least("best", "far"))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
