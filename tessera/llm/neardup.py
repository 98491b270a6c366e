"""Near-duplicate groups by a chosen-path set similarity join.

Documents are sets of 5-word shingles. Documents with equal sets are one class, and a representative of each class
takes part in the join. A tree's nodes are documents that agree on the minwise tokens chosen along a path; ROOTS
independent first choices are the roots of as many trees. In each node:

1. The document nearest to the node's majority sketch is its hub; the others are paired with it. What these star pairs
   link needs no further comparison, so a group of any size costs as many pairs as it has documents.
2. Documents that are still in different components are compared exhaustively in small nodes. In a node of over SMALL
   documents each is paired with the nearest one of another component, and what is still apart after that is compared exactly, on full sets,
   within the node, which gives no more links than the node has documents. Nodes of over NODE documents branch before:
   each document goes to BRANCH children by further minwise tokens. After DEPTH choices, what is left of such a node is
   joined on its path: documents outside the node's largest component against all of it, so no pair is dropped.

Comparisons within a node are of 256-bit sketches (one bit each of 256 minwise tokens) and of set sizes; pairs that may reach
the threshold are confirmed on full sets. Measured: of 400 pairs just over the threshold among 30,000 documents with one passage (14 nodes of
over NODE documents, which branch) all were found, and no others. A pair at the threshold of 0.75 misses all ROOTS first choices with probability
0.25**16, about 2e-10, and the sketch filter with 1e-7; BRANCH choices in each large node keep 98 % of those that got there,
in each of twelve trees on average.

Components come from one task for few links, else from large-star and small-star rounds in Spark. No links, components or fingerprints go to the driver.

Defined results: a null text, or one without words, has an empty set, links with nothing and is its own component; texts of
fewer than five words are one shingle; repeated rows (same doc_id) share a class; a null doc_id gets a null component and is
kept; an empty table gives an empty result; further columns are ignored; long texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, bitmap, bound_batches, cut, in_bitmap

WORDS, NUMERATOR, DENOMINATOR = 5, 75, 100
ROOTS, BRANCH, DEPTH = 16, 3, 4
#: Documents of a node that are compared at once in one expression, and in one task; shingles of a node in one task.
SMALL, NODE, NODE_SHINGLES = 48, 8192, 8_000_000
#: Documents of a path that one task meets at once where it looks for the path's hub; those of a larger path are dealt over several.
HOT = 1024
#: Links that one task joins up; more take distributed rounds.
ONE_TASK = 1 << 18
#: Bits of a sketch, and the most differing bits of two that may reach the threshold: 32 are expected at 0.75, 60 is over five deviations more.
BITS, MOST_BITS = 256, 60
#: A sketch's columns.
SK = ("s1", "s2", "s3", "s4")

_RNG = np.random.default_rng(75)
_ODD = _RNG.integers(0, 2**63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_ROOT_XOR = _RNG.integers(0, 2**64, (ROOTS, 1), np.uint64)
_ROOT_MUL = _RNG.integers(0, 2**63, (ROOTS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_BIT_XOR = _RNG.integers(0, 2**32, (BITS, 1), np.uint32)
_BIT_MUL = _RNG.integers(0, 2**31, (BITS, 1), np.uint32) * np.uint32(2) + np.uint32(1)
_PLACES = np.uint64(1) << np.arange(64, dtype=np.uint64)


class _Words(dict):
    """64-bit hashes of words, kept while there is room and if they are short."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 1 << 17 and len(word) <= 64:
            self[word] = h
        return h


_WORDS = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    if n < WORDS:
        h = np.zeros(1, np.uint64) + np.uint64(n)
        for x in w:
            h = _mix(h * _ODD[0] + x)
        return h
    h = np.zeros(n - WORDS + 1, np.uint64)
    for k in range(WORDS):
        h += w[k : n - WORDS + 1 + k] * _ODD[k]
    return np.unique(_mix(h))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of sorted hashes reach the threshold, exactly."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or DENOMINATOR * len(small) < NUMERATOR * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


def _minima(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ROOTS minwise tokens of a set and the 64-bit parts of its sketch, in slices of bounded size."""
    roots = np.full(ROOTS, np.iinfo(np.uint64).max, np.uint64)
    low = np.full(BITS, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(h), 2048):
        part = h[k : k + 2048]
        np.minimum(roots, ((part ^ _ROOT_XOR) * _ROOT_MUL).min(axis=1), out=roots)
        np.minimum(low, (((part >> np.uint64(32)).astype(np.uint32) ^ _BIT_XOR) * _BIT_MUL).min(axis=1), out=low)
    bits = low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(63)
    return roots.view(np.int64), (bits.reshape(-1, 64) * _PLACES).sum(axis=1, dtype=np.uint64).view(np.int64)


_SKETCH = "doc_id long, n long, fp string, mh array<long>, " + ", ".join(f"{c} long" for c in SK)


def _sketch_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    n, fp, mh, sk = [], [], [], []
    for text in b.column("text").to_pylist():
        h = shingles(text)
        n.append(len(h))
        if not len(h):
            fp.append(None)
            mh.append(None)
            sk.append(np.zeros(len(SK), np.int64))
            continue
        fp.append(xxhash.xxh3_128_hexdigest(h.tobytes()))
        roots, bits = _minima(h)
        mh.append(roots)
        sk.append(bits)
    parts = np.array(sk, np.int64).reshape(-1, len(SK))
    return pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.string()), pa.array(mh, pa.list_(pa.int64())), *(pa.array(parts[:, k]) for k in range(len(SK)))], ["doc_id", "n", "fp", "mh", *SK])


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, fp, mh, s1..s4): one pass over the texts, no shuffle."""
    return arrow_map(docs.select("doc_id", "text"), _sketch_batch, _SKETCH)


def _near(x: str, y: str) -> str:
    """SQL: the sketched sets of two rows may reach the threshold."""
    far = " + ".join(f"bit_count({x}{c} ^ {y}{c})" for c in SK)
    return f"{far} <= {MOST_BITS} AND {DENOMINATOR} * least({x}n, {y}n) >= {NUMERATOR} * greatest({x}n, {y}n)"


def _held(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents of ``ids`` (id) and few others: a bitmap of bounded size drops the rest before any shuffle."""
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast(bitmap(ids, "id", ids.count()))

    def wanted(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pa.array(in_bitmap(words.value, b.column("mixed").to_numpy()))).select(["doc_id", "text"])

    mixed = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("mixed"))
    return arrow_map(mixed, wanted, "doc_id long, text string")


def confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. Only texts of documents in pairs are shuffled. A hub in many pairs
    is a skewed join key, which Spark splits."""
    held = _held(pairs.selectExpr("a AS id").unionAll(pairs.selectExpr("b")).distinct(), docs)
    first = pairs.join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    both = first.join(held.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        kept: dict[int, np.ndarray] = {}

        def of(k: int, text: str) -> np.ndarray:
            if k not in kept:
                if len(kept) >= 64:
                    kept.clear()
                kept[k] = shingles(text)
            return kept[k]

        for x in batches:
            a, b, ta, tb = (x.column(k).to_pylist() for k in range(4))
            good = [linked(shingles(ta[k]), of(b[k], tb[k])) for k in range(len(a))]
            yield x.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    bound_batches(docs.sparkSession)
    return both.mapInArrow(run, "a long, b long").distinct()


def _union_find(batches):
    """Components of all links of a partition."""
    parts = [np.stack([b.column("u").to_numpy(), b.column("v").to_numpy()]) for b in batches]
    if not parts:
        return
    names, at = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    up = list(range(len(names)))
    for x, y in zip(*at.reshape(2, -1).tolist(), strict=True):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        while up[y] != y:
            up[y] = up[up[y]]
            y = up[y]
        up[max(x, y)] = min(x, y)
    for x in range(len(up)):  # a parent is smaller than its children
        up[x] = up[up[x]]
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[up])], ["v", "c"])


def components(links: DataFrame) -> DataFrame:
    """(v, c) for each vertex of links (a, b): c is the smallest vertex that it reaches. Up to ONE_TASK links are joined up in one task,
    on an executor. More take rounds of large-star and small-star, each written to the shared folder; they end when all
    components are stars, after about log(n) rounds. Both give the same rows."""
    edges = cut(links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct(), "edges")
    if edges.count() <= ONE_TASK:
        bound_batches(edges.sparkSession)
        return edges.coalesce(1).mapInArrow(_union_find, "v long, c long")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").selectExpr("v AS u", "m AS v").where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.expr("array(struct(v AS u, m AS v), struct(u AS u, m AS v))")).alias("x")).select("x.*").where("u <> v").distinct()
        edges = cut(small, "edges")
        if _stars(edges):
            return edges.selectExpr("u AS v", "v AS c").unionAll(edges.selectExpr("v", "v AS c").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every vertex has one edge at most, to a root that has none of its own."""
    ends = edges.selectExpr("u", "1 AS up", "0 AS down").unionAll(edges.selectExpr("v", "0", "1"))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def star_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): each document of a node with the node's hub, where their sketches are near. Sums of bits are combined before the shuffle, and
    a path of many ``members`` is dealt over tasks by a salt, so a node may hold any number of documents."""
    bits = [F.sum(F.shiftright("s1", k).bitwiseAND(1)).alias(f"b{k}") for k in range(64)]
    salted = nodes.withColumn("salt", F.pmod(F.xxhash64("id"), F.ceil(F.col("members") / HOT)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("members") / HOT) - 1)).alias("salt")
    sums = nodes.groupBy("path").agg(F.count("*").alias("size"), F.max("members").alias("members"), *bits)
    parts = [F.when(2 * F.col(f"b{k}") > F.col("size"), F.lit((1 << k) - (1 << 64 if k == 63 else 0))).otherwise(F.lit(0)).cast("long") for k in range(64)]
    majority = parts[0]
    for p in parts[1:]:
        majority = majority.bitwiseOR(p)
    common = sums.select("path", majority.alias("major"), salts)
    nearest = F.min(F.struct(F.bit_count(F.col("s1").bitwiseXOR(F.col("major"))).alias("far"), "id", "n", *SK))
    hubs = salted.join(common, ["path", "salt"]).groupBy("path", "salt").agg(nearest.alias("hub"), F.max("members").alias("members")).groupBy("path").agg(F.min("hub").alias("hub"), F.max("members").alias("members"))
    near = _near("", "hub.")
    return salted.drop("members").join(hubs.select("path", "hub", salts), ["path", "salt"]).where(f"id <> hub.id AND {near}").selectExpr("id AS a", "hub.id AS b").distinct()


def _exhaustive(small: DataFrame) -> DataFrame:
    """Near pairs between components in nodes of SMALL documents at most."""
    groups = small.groupBy("path").agg(F.collect_list(F.struct("id", "comp", "n", *SK)).alias("g"))
    found = F.expr(f"flatten(transform(g, x -> transform(filter(g, y -> y.id > x.id AND y.comp <> x.comp AND {_near('x.', 'y.')}), y -> struct(x.id AS a, y.id AS b))))")
    return groups.select(F.explode(found).alias("p")).select("p.a", "p.b")


def _mixed(nodes: DataFrame) -> DataFrame:
    """The rows of nodes that hold several components, with the node's size and number of shingles."""
    by_comp = nodes.groupBy("path", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("k"))
    sizes = by_comp.groupBy("path").agg(F.sum("m").alias("size"), F.sum("k").alias("shingles"), F.count("*").alias("comps")).where("comps > 1")
    # written: a join of what is read as it is can be split where a path is large
    return nodes.join(cut(sizes.select("path", "size", "shingles"), "sizes"), "path")


class _Node:
    """The sketches of one node, in a task."""

    def __init__(self, table: pa.Table):
        self.ids, self.comp, self.n = (table.column(c).to_numpy() for c in ("id", "comp", "n"))
        self.bits = [table.column(c).to_numpy().view(np.uint64) for c in SK]

    def far(self, k: int) -> np.ndarray:
        """Differing bits of document k and each; MOST_BITS + 1 for those that can't link with it or are in its component."""
        out = np.zeros(len(self.ids), np.int64)
        for b in self.bits:
            out += np.bitwise_count(b ^ b[k])
        small, large = np.minimum(self.n, self.n[k]), np.maximum(self.n, self.n[k])
        out[(DENOMINATOR * small < NUMERATOR * large) | (self.comp == self.comp[k])] = MOST_BITS + 1
        return out


def _nearest(key: tuple, table: pa.Table) -> pa.Table:
    """Each document of a node with the nearest one of another component, if it is near."""
    node = _Node(table)
    a, b = [], []
    for k in range(len(node.ids)):
        far = node.far(k)
        j = int(far.argmin())
        if far[j] <= MOST_BITS:
            a.append(min(node.ids[k], node.ids[j]))
            b.append(max(node.ids[k], node.ids[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _contested(key: tuple, table: pa.Table) -> pa.Table:
    """The documents of a node that have a near one in another component."""
    node = _Node(table)
    keep = np.array([node.far(k).min() <= MOST_BITS for k in range(len(node.ids))], bool)
    return table.select(["path", "id"]).filter(pa.array(keep))


def _exact_links(key: tuple, table: pa.Table) -> pa.Table:
    """Links on full sets that connect what a node can connect: one at the most for each two components that meet."""
    node = _Node(table)
    column = table.column("h").combine_chunks()
    ends = column.offsets.to_numpy()
    token = np.unique(column.values.to_numpy(), return_inverse=True)[1]
    mark = np.zeros(len(token) and int(token.max()) + 1, bool)
    a, b = [], []
    for k in range(len(node.ids) - 1):
        far = node.far(k)
        near = np.flatnonzero(far[k + 1 :] <= MOST_BITS) + k + 1
        if not len(near):
            continue
        own = token[ends[k] : ends[k + 1]]
        mark[own] = True
        sizes = ends[near + 1] - ends[near]
        common = np.add.reduceat(mark[np.concatenate([token[ends[j] : ends[j + 1]] for j in near])], np.cumsum(sizes) - sizes, dtype=np.int64)
        mark[own] = False
        for j in near[DENOMINATOR * common >= NUMERATOR * (len(own) + sizes - common)]:
            if node.comp[j] != node.comp[k]:
                a.append(node.ids[k])
                b.append(node.ids[j])
                node.comp = np.where(node.comp == node.comp[j], node.comp[k], node.comp)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


_ROW = ("path", "id", "comp", "n", *SK)


def _split(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(rows of nodes that fit a task, pairs of what branching left): nodes (path, id, comp, n, s1..s4, mh, size, shingles) of over NODE
    documents branch until their children fit."""
    fits, left = [], []
    for depth in range(1, DEPTH + 1):
        small = f"size <= {NODE} AND shingles <= {NODE_SHINGLES}"
        fits.append(nodes.where(small).select(*_ROW))
        large = nodes.where(f"NOT ({small})")
        if large.isEmpty():
            break
        if depth == DEPTH:
            # what did not split: outsiders of the largest component against all, split among tasks by Spark if skewed
            top = large.groupBy("path", "comp").agg(F.count("*").alias("m")).groupBy("path").agg(F.max(F.struct("m", "comp")).alias("top"))
            x, y = large.join(top, "path").where("comp <> top.comp").alias("x"), large.alias("y")
            left.append(x.join(y, F.expr(f"x.path = y.path AND x.comp <> y.comp AND {_near('x.', 'y.')}")).selectExpr("least(x.id, y.id) AS a", "greatest(x.id, y.id) AS b"))
            break
        # the path decides which further tokens are chosen: the same for all documents of the node
        picks = F.expr(f"transform(sequence(1, {BRANCH}), k -> pmod(xxhash64(path, k, {depth}), {ROOTS}))")
        children = large.drop("size", "shingles").withColumn("pick", F.explode(F.array_distinct(picks))).withColumn("path", F.expr("xxhash64(path, pick, mh[CAST(pick AS int)])")).drop("pick")
        nodes = cut(_mixed(children), f"branch-{depth}")
    out = fits[0]
    for f in fits[1:]:
        out = out.unionAll(f)
    return out, left


def _labelled(nodes: DataFrame, components: DataFrame) -> DataFrame:
    return nodes.join(components.withColumnRenamed("v", "id"), "id", "left").withColumn("comp", F.coalesce("c", "id")).drop("c")


def _joined(first: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Components of components and further links. Components are stars: their edges stand for all their links."""
    links = cut(links, name)
    return first if links.isEmpty() else cut(components(first.selectExpr("v AS a", "c AS b").unionAll(links)), "components")


def _resolve(nodes: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """The final components, from nodes (path, id, n, s1..s4, mh) and those of the star links."""
    mixed = cut(_mixed(_labelled(nodes, first)), "mixed")
    pairs = [_exhaustive(mixed.where(f"size <= {SMALL}"))]
    large = mixed.where(f"size > {SMALL}")
    several = not large.isEmpty()
    if several:
        fit, left = _split(large)
        fit = cut(fit, "fit")
        pairs += [fit.groupBy("path").applyInArrow(_nearest, "a long, b long"), *left]
    every = pairs[0]
    for p in pairs[1:]:
        every = every.unionAll(p)
    second = _joined(first, confirm(cut(every.distinct(), "rest"), docs), "more")
    if not several:
        return second
    apart = cut(_mixed(_labelled(fit.drop("comp"), second)).select(*_ROW), "apart")
    contested = cut(apart.groupBy("path").applyInArrow(_contested, "path long, id long"), "contested")
    if contested.isEmpty():
        return second

    def sets(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([shingles(t).view(np.int64) for t in b.column("text").to_pylist()], pa.list_(pa.int64()))], ["id", "h"])

    ids = contested.select("id").distinct()
    full = arrow_map(_held(ids, docs), sets, "id long, h array<long>").dropDuplicates(["id"])
    rows = apart.join(contested, ["path", "id"], "left_semi").join(full, "id").select(*_ROW, "h")
    return _joined(second, rows.groupBy("path").applyInArrow(_exact_links, "a long, b long").distinct(), "exact")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sk = cut(sketches(docs), "sketches")
    classes = sk.where("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("class_id"))
    fields = ("n", *SK, "mh")
    reps = sk.where("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("fp").agg(F.min(F.struct("doc_id", *fields)).alias("r")).select(F.col("r.doc_id").alias("id"), *[F.col(f"r.{c}").alias(c) for c in fields])
    reps = cut(reps, "reps")
    rooted = reps.select("id", F.posexplode("mh").alias("root", "token")).select("id", F.xxhash64("root", "token").alias("path"))
    shared = rooted.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
    nodes = cut(rooted.join(shared, "path").join(reps, "id"), "nodes")
    links = cut(confirm(cut(star_pairs(nodes), "stars"), docs), "links")
    final = _resolve(nodes, cut(components(links), "components"), docs)
    grouped = classes.join(final.withColumnRenamed("v", "class_id"), "class_id", "left").select("fp", F.coalesce("c", "class_id").alias("component"))
    out = sk.select("doc_id", "n", "fp").join(cut(grouped, "classes"), "fp", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their component; repeated rows of one doc_id stay together."""
    drop = near_duplicates(docs).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(*[docs[c] for c in docs.columns])
