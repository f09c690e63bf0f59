"""MinHash near-duplicates with tensored banding (operator 7).

Two collections of ``HALF`` bands each, of ``ROWS`` minhashes a band, give
``HALF * HALF`` hash tables: the key of table (i, j) combines band i of the one
collection with band j of the other.  2 * HALF * ROWS minhashes stand in for the
HALF * HALF * 2 * ROWS that as many independent tables would need.  A link at
the threshold 0.8 is missed with probability 2 * (1 - 0.8^3)^12 < 0.0004.

Plan:

1. One Arrow pass turns a text into its set's size and fingerprint and the
   2 * HALF band values.  Equal sets are one class from here on, so exact copies
   cost one aggregate, however many.
2. A table key can only be shared where both its bands are.  So single bands are
   counted first (2 * HALF rows a class), and only the pairs of shared bands of
   a class become table keys.
3. Groups with a common key are linked by stars: each member is verified against
   one pivot, the member that shares most keys with others.  What is linked
   becomes a component.
4. Groups that still hold several components form clusters (connected by their
   keys).  In a cluster, the members outside its largest component meet all
   others in blocks: a task gets the sets of two blocks, skips pairs without a
   common table key, counts shared shingles of the rest and returns one link per
   member and component.  So no link between components is lost, and no list of
   pairs is ever written.
5. All verification is on the full sets, made anew from the whole texts of the
   classes concerned.

Cases: null ids are linked with nothing (component null, not kept); null and
empty texts and texts without words have an empty set and are linked with
nothing; texts with fewer than ``k`` words have their word sequence as the one
shingle; rows that share an id are one document; extra columns are ignored, or
passed through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldops.llm.common import WordHashes, documents, row_slices, staged
from fieldops.llm.graph import connected_components

ROWS = 3
HALF = 12
SEED = 7
LEFT_BLOCK, RIGHT_BLOCK = 128, 512  # members of a cluster that meet in one task
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, k: int, hashes: WordHashes, weights: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text, A-Z in
    lower case; with fewer words, of the whole sequence."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.array(hashes(words), dtype=np.uint64)
    span = min(n, k)
    keys = np.full(n - span + 1, np.uint64(span), dtype=np.uint64)
    for j in range(span):
        keys = (keys ^ h[j:j + n - span + 1]) * weights[j]
        keys ^= keys >> np.uint64(29)
    return np.unique(keys * MIX)


def _constants(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED)
    odd = lambda n: r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd(k), odd(2 * HALF * ROWS), r.integers(0, 1 << 63, 2 * HALF * ROWS, dtype=np.uint64)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        weights, a, b = _constants(k)
        for whole in batches:
            for rb in row_slices(whole, "text"):
                sizes, prints, bands = [], [], []
                for t in rb.column(1).to_pylist():
                    s = shingle_set(t, k, hashes, weights)
                    sizes.append(len(s))
                    prints.append(xxhash.xxh3_128_digest(s.tobytes()))
                    if not len(s):
                        bands.append(None)
                        continue
                    low = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
                    for i in range(0, len(s), 4096):
                        low = np.minimum(low, (s[i:i + 4096, None] * a + b).min(axis=0))
                    m = low.reshape(2 * HALF, ROWS)
                    x = m[:, 0].copy()
                    for j in range(1, ROWS):
                        x = (x ^ (x >> np.uint64(31))) * MIX + m[:, j]
                    x = (x ^ (x >> np.uint64(31))) * MIX + np.arange(2 * HALF, dtype=np.uint64)
                    bands.append(x.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [rb.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "fp", "bands"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        weights, _, _ = _constants(k)
        for whole in batches:
            for rb in row_slices(whole, "text", 2 << 20):
                sets = [shingle_set(t, k, hashes, weights).view(np.int64) for t in rb.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["cid", "shingles"])
    return run


def _shared(keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key more than one class has.  Counts are combined map-side,
    and the join back is one that Spark may split where a key is hot."""
    many = keys.groupBy(key).agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo <> hi").select(key)
    return keys.join(many, key, "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    x = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(x, "a").join(y, "b").withColumn("both", both)
            .where(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b").distinct())


def _meet(percent: int):
    """Two blocks of a cluster: one link per left member and component of the right ones."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            column = lambda t, c: t.column(c).to_numpy()
            bands = lambda t: t.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * HALF)
            lists = right.column("shingles").combine_chunks()
            flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            cid, root, n, late, rb = column(right, "cid"), column(right, "root"), column(right, "n"), column(right, "loose"), bands(right)
            own = left.column("shingles").combine_chunks()
            for x, (xc, xr, xn, xb) in enumerate(zip(column(left, "cid"), column(left, "root"), column(left, "n"), bands(left), strict=True)):
                same = rb == xb
                # Loose members meet twice, as left and as right; once is enough.
                ok = (root != xr) & (~late.astype(bool) | (cid > xc)) & (100 * np.minimum(n, xn) >= percent * np.maximum(n, xn))
                ok &= same[:, :HALF].any(axis=1) & same[:, HALF:].any(axis=1)
                mine = np.sort(own[x].values.to_numpy(zero_copy_only=False))
                done = set()
                for y in np.flatnonzero(ok):
                    if root[y] in done:
                        continue
                    s = flat[at[y]:at[y + 1]]
                    place = np.searchsorted(mine, s)
                    place[place == len(mine)] = 0
                    both = int((mine[place] == s).sum())
                    if 100 * both >= percent * (xn + n[y] - both):
                        done.add(root[y])
                        found.append((int(min(xc, cid[y])), int(max(xc, cid[y]))))
        return pa.table([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])
    return run


def _between(rest: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components inside the clusters of ``rest`` (cid, n, root, first)."""
    cluster = connected_components(rest.select(F.col("cid").alias("a"), F.col("first").alias("b")))
    cluster = cluster.withColumnRenamed("root", "cluster")
    who = rest.select("cid", "n", "root").distinct().join(cluster, F.col("cid") == F.col("node")).select("cid", "n", "root", "cluster")
    shares = who.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("c"))
    most = shares.groupBy("cluster").agg(F.max(F.struct("c", "root")).alias("m"), F.sum("c").alias("all")).select(
        "cluster", F.col("m.root").alias("main"), (F.ceil((F.col("all") - F.col("m.c")) / LEFT_BLOCK)).cast("int").alias("lefts"),
        F.ceil(F.col("all") / RIGHT_BLOCK).cast("int").alias("rights"))
    who = staged(who.join(most, "cluster").withColumn("loose", F.col("root") != F.col("main")), "minhash-clusters")
    full = who.join(classes.select("cid", "bands"), "cid").join(sets, "cid")
    block = lambda salt, count: F.pmod(F.xxhash64("cid", F.lit(salt)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["cid", "n", "root", "loose", "bands", "shingles", "cluster"]
    left = full.where("loose").select(*columns, block(1, "lefts").alias("l"), every("rights").alias("r"))
    right = full.select(*[F.col(c).alias(c) for c in columns], every("lefts").alias("l"), block(2, "rights").alias("r"))
    return left.groupBy("cluster", "l", "r").cogroup(right.groupBy("cluster", "l", "r")).applyInArrow(_meet(percent), "a long, b long").distinct()


def near_classes(docs: DataFrame, k: int = 2, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sig = staged(narrow.mapInArrow(_signatures(k), "doc_id long, n long, fp binary, bands array<long>"), "minhash-bands")
    classes = staged(sig.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("cid"), F.first("n").alias("n"), F.first("bands").alias("bands")), "minhash-classes")

    single = classes.select("cid", F.posexplode("bands").alias("i", "band"))
    live = _shared(single, "band").groupBy("cid").agg(F.collect_set("i").alias("live"))  # at most 2 * HALF a class
    cross = classes.join(live, "cid").select(
        "cid", "n", F.explode(F.filter("live", lambda i: i < HALF)).alias("i"), "live", "bands").select(
        "cid", "n", "i", F.explode(F.filter("live", lambda j: j >= HALF)).alias("j"), "bands").select(
        "cid", "n", F.xxhash64(F.expr("bands[i]"), F.expr("bands[j]")).alias("key"))
    groups = staged(_shared(cross, "key"), "minhash-groups")
    members = groups.select("cid").distinct()
    sets = staged(narrow.join(members, F.col("doc_id") == F.col("cid"), "left_semi")
                  .mapInArrow(_sets(k), "cid long, shingles array<long>"), "minhash-sets")

    # Stars.
    degree = groups.groupBy("key").agg(F.count(F.lit(1)).alias("c")).join(groups, "key").groupBy("cid").agg(F.sum("c").alias("degree"))
    ranked = groups.join(degree, "cid")
    pivot = ranked.groupBy("key").agg(F.max(F.struct("degree", -F.col("cid"), "cid", "n")).alias("p")).select(
        "key", F.col("p.cid").alias("pivot"), F.col("p.n").alias("pn"))
    pairs = (groups.join(pivot, "key").where((F.col("cid") != F.col("pivot")) & (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")))
             .select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct())
    links = staged(_verified(pairs, sets, percent), "minhash-links")
    roots = staged(connected_components(links), "minhash-roots")
    rooted = groups.join(roots, F.col("cid") == F.col("node"), "left").select("cid", "n", "key", F.coalesce("root", "cid").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("cid").alias("first")).where("lo <> hi").select("key", "first")
    rest = staged(rooted.join(mixed, "key").select("cid", "n", "root", "first").distinct(), "minhash-open")
    more = staged(_between(rest, classes, sets, percent), "minhash-more")
    if not more.isEmpty():
        roots = staged(connected_components(links.unionByName(more)), "minhash-roots")
    by_class = classes.select("fp", "cid")
    by_class = by_class.join(roots, F.col("cid") == F.col("node"), "left").select("fp", F.coalesce("root", "cid").alias("root"))
    member = sig.alias("s").join(by_class.alias("c"), (F.col("s.fp") == F.col("c.fp")) & (F.col("s.n") > 0) & F.col("s.doc_id").isNotNull(), "left")
    component = F.coalesce(F.col("c.root"), F.col("s.doc_id"))
    return member.select(F.col("s.doc_id").alias("doc_id"), F.col("s.n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("s.doc_id") == component, F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the near-duplicates: of each component the row with the
    smallest id stays (one row, should rows share it), and every row without an
    id or without words."""
    gone = near_classes(docs, k, percent, id_col, text).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_m_id")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.where(F.col(id_col).isNotNull()).join(gone, F.col(id_col) == F.col("_m_id"), "left_anti")
    # one row of an id: the limit on the rank works before the shuffle too
    turn = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(text)))
    one = named.withColumn("_m_turn", turn).where(F.col("_m_turn") == 1)
    return docs.where(F.col(id_col).isNull()).select(*columns).unionAll(one.select(*columns))


def op7_tensor_minhash(spark, sf_dir: str) -> DataFrame:
    return near_classes(documents(spark, sf_dir))


#: Exact: all pairs that share a shingle, counted; components by recursion over the links.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
        SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
               ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""
