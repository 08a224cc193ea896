"""N-gram Jaccard self-join by chosen paths.

Documents are sets of five-word shingles; two are linked if their Jaccard
similarity is at least ``THRESHOLD``.

1. Documents with equal sets form a class; only classes are joined.
2. Chosen paths: each set is embedded as its first shingles in 64 random orders.
   Every node of a tree samples ``BRANCHES`` of those orders (by a hash of its
   path, so alike for all sets) and a set goes down to the child named by its
   shingle there.  A similar pair stays together per branch with
   probability >= THRESHOLD, so with two branches the chance that it meets in some
   leaf stays above a positive limit at any depth; ``runs`` trees are grown,
   as many as the target recall needs at that limit.
3. A node of at most ``LIMIT`` sets is a leaf, compared by brute force.  Larger
   nodes split again, unless a child would keep half of the node: such a node
   holds sets that are truly alike, and splitting would not help.  It is
   compared by brute force too, in tiles of two blocks each.  No node is capped.
4. Leaves compare the embeddings only and connect pairs that agree in at least
   ``SKETCH`` of them (a pair at the threshold fails with odds of about 3 in
   100,000).  Their components contain every pair found.
5. Inside each component all pairs are compared exactly, on whole shingle sets,
   in tiles; a tile reports how many links each set has and a forest that
   spans them, never the pairs.

Work on a component grows with the square of its classes, as counting all
links requires, and is spread over tiles; rows grow with its size times its number of blocks.

Defined cases: a null text has no words, and documents without words are
linked to nothing; a text of one to four words has one shingle, all of its
words; shingles ignore case and the kind of white space; rows that repeat a doc_id count as
rows of their own; a null doc_id sorts before numbers; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import (components, may_occur, partitions, sorted_groups, stored,
                                  table)
from martspark.llm.shingles import (SAMPLES, WORDS, samples, set_key, shingle_set, word_hashes)

THRESHOLD = 0.8
RECALL = 0.999
BRANCHES = 2
LIMIT = 1024
MAX_DEPTH = 8
SKETCH = 38          # of 64 samples
LEAF_BLOCK = 8192    # sets per block of a leaf's tiles
BLOCK = 4096         # sets per block of an exact tile ...
BLOCK_TOKENS = 1 << 22  # ... and their shingles, on average


def runs_for(recall: float, threshold: float, branches: int = BRANCHES) -> int:
    """Trees needed so that a pair at the threshold shares a leaf of one with ``recall``."""
    q = 1.0
    for _ in range(200):
        q = 1 - (1 - threshold * q) ** branches
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - q)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    for batch in batches:
        sizes, keys, sigs = [], [], []
        for text in batch.column(2).to_pylist():
            s = shingle_set(text, hashes)
            sizes.append(len(s))
            keys.append(set_key(s) if len(s) else None)
            sigs.append(samples(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()),
             pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
            ["doc_id", "text_id", "n", "key", "sig"])


def _children(path: str, branches: int) -> str:
    """SQL: the paths of a set's children of node ``path``."""
    kids = []
    for b in range(branches):
        order = f"CAST(pmod(xxhash64({path}, {b}), {SAMPLES}) AS INT)"
        kids.append(f"xxhash64({path}, {order}, element_at(sig, {order} + 1))")
    return f"array_distinct(array({', '.join(kids)}))"


def _leaves(classes: DataFrame, runs: int, limit: int, max_depth: int) -> DataFrame:
    """Rows (path, n, key) of all leaves of two sets and more."""
    roots = [F.expr(_children(f"xxhash64('run', {r})", BRANCHES)) for r in range(runs)]
    nodes = classes.select("key", F.explode(F.array_distinct(F.concat(*roots))).alias("path"))
    leaves = []
    for depth in range(max_depth + 1):
        nodes = stored(nodes, "nodes")
        sizes = stored(nodes.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        sized = stored(may_occur(nodes, ["path"], sizes).join(sizes, "path")
                       .select("path", "n", "key"), "sized")
        heavy = sized.where(F.col("n") > limit)
        if depth == max_depth or heavy.isEmpty():
            leaves.append(sized)
            break
        kids = stored(
            heavy.join(may_occur(classes.select("key", "sig"), ["key"], heavy), "key")
            .select("key", F.col("path").alias("parent"), F.col("n").alias("parent_n"),
                    F.explode(F.expr(_children("path", BRANCHES))).alias("path")), "kids")
        dense = stored(
            kids.groupBy("parent", "parent_n", "path").agg(F.count("*").alias("n"))
            .groupBy("parent", "parent_n").agg(F.max("n").alias("n"))
            .where("n * 2 >= parent_n").select(F.col("parent").alias("path")), "dense")
        leaves.append(sized.where(F.col("n") <= limit))
        leaves.append(heavy.join(dense, "path", "left_semi"))
        nodes = (kids.join(dense.select(F.col("path").alias("parent")), "parent", "left_anti")
                 .select("key", "path"))
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def _tiles(rows: DataFrame, blocks: str) -> DataFrame:
    """Each row once per tile (i <= j) of its block; ``blocks`` is the group's number of blocks."""
    return (rows.withColumn("block", F.expr(f"CAST(pmod(xxhash64(key), {blocks}) AS INT)"))
            .withColumn("other", F.explode(F.expr(f"sequence(0, CAST({blocks} AS INT) - 1)")))
            .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
            .drop("other"))


def _sketch_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges of the pairs of a tile whose embeddings agree enough."""
    low, high, size = [], [], 0
    for t in sorted_groups(batches, ["path", "i", "j"]):
        if t.num_rows < 2:
            continue
        keys = t.column("key").to_pylist()
        sig = t.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, SAMPLES)
        label = np.arange(len(keys))
        for r in range(len(keys) - 1):
            open_ = r + 1 + np.flatnonzero(label[r + 1:] != label[r])
            near = open_[(sig[open_] == sig[r]).sum(axis=1) >= SKETCH]
            if len(near):
                label[np.isin(label, label[near])] = label[r]
        for r in np.flatnonzero(label != np.arange(len(keys))):
            low.append(keys[label[r]])
            high.append(keys[r])
        size += 1
        if len(low) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(low, pa.binary()),
                                              pa.array(high, pa.binary())], ["a", "b"])
            low, high = [], []
    yield pa.RecordBatch.from_arrays([pa.array(low, pa.binary()), pa.array(high, pa.binary())],
                                     ["a", "b"])


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the joined documents, once per tile."""
    hashes = word_hashes()
    names = ["root", "i", "j", "block", "key", "size", "tokens"]
    for batch in batches:
        rows = {k: [] for k in names}
        held = 0
        for root, blocks, block, key, size, text in zip(*(
                batch.column(c).to_pylist() for c in ("root", "blocks", "block", "key", "size",
                                                      "text"))):
            s = shingle_set(text, hashes)
            if set_key(s) != key:  # another text under a repeated doc_id
                continue
            data = s.tobytes()
            for other in range(blocks):
                for k, v in zip(names, (root, min(block, other), max(block, other), block, key,
                                        size, data)):
                    rows[k].append(v)
                held += len(data)
            if held > 1 << 25:
                yield _token_batch(rows, names)
                rows, held = {k: [] for k in names}, 0
        yield _token_batch(rows, names)


def _token_batch(rows: dict, names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(rows[n], k) for n, k in zip(names, kinds)], names)


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None,
             light: int = 16, width: int = 512) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``.

    Shingles of one set only are dropped; those of few sets add up their pairs
    directly, the others go through dense products of ``width`` columns.
    """
    sets = left + (right or [])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens, col, freq = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(col, kind="stable")
    row, first = row[order], np.cumsum(freq) - freq
    a, b = len(left), len(right) if right else len(left)
    shift = a if right else 0
    out = np.zeros((a, b), np.float32)
    flat = out.reshape(-1)
    for f in range(2, light + 1):
        at = first[freq == f]
        for lo in range(0, len(at), 1 << 16):
            r = row[at[lo:lo + (1 << 16), None] + np.arange(f)]
            x, y = np.broadcast_arrays(r[:, :, None], r[:, None, :])
            ok = (x < a) & (y >= shift) if right else np.ones(x.shape, bool)
            np.add.at(flat, x[ok] * b + (y[ok] - shift), 1)
    heavy = np.flatnonzero(freq > light)
    for lo in range(0, len(heavy), width):
        some = heavy[lo:lo + width]
        x = np.zeros((len(sets), len(some)), np.float32)
        n = freq[some]
        x[row[np.concatenate([np.arange(s, s + c) for s, c in zip(first[some], n)])],
          np.repeat(np.arange(len(some)), n)] = 1
        out += x[:a] @ x[shift:].T
    return out


def _forest(adj: np.ndarray, square: bool) -> tuple[np.ndarray, np.ndarray]:
    """Component labels of the rows and columns of a (bipartite) adjacency matrix."""
    a, b = adj.shape
    rows = np.arange(a)
    cols = rows if square else np.arange(a, a + b)
    for r in range(a):
        js = np.flatnonzero(adj[r])
        other = np.unique(cols[js])
        other = other[other != rows[r]]
        if len(other):
            low = min(rows[r], other[0])
            merged = np.append(other, rows[r])
            rows[np.isin(rows, merged)] = low
            if not square:
                cols[np.isin(cols, merged)] = low
    return rows, cols


def _exact_links(threshold: float):
    share = threshold / (1 + threshold)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["root", "i", "j"]):
            keys = t.column("key").to_pylist()
            keep = np.array(sorted({k: r for r, k in enumerate(keys)}.values()))
            if len(keep) < 2:
                continue
            block = t.column("block").to_numpy()[keep]
            size = t.column("size").to_numpy()[keep]
            tokens = t.column("tokens").to_pylist()
            sets = [np.frombuffer(tokens[r], np.uint64) for r in keep]
            keys = [keys[r] for r in keep]
            del tokens
            square = t.column("i")[0].as_py() == t.column("j")[0].as_py()
            if square:
                left = right = np.arange(len(keep))
                common = overlaps(sets, None)
            else:
                left, right = (np.flatnonzero(block == t.column(c)[0].as_py()) for c in ("i", "j"))
                if not len(left) or not len(right):
                    continue
                common = overlaps([sets[r] for r in left], [sets[r] for r in right])
            n = np.array([len(s) for s in sets])
            if square:
                np.fill_diagonal(common, -1)
            adj = np.empty(common.shape, bool)
            count = np.zeros(len(keep))
            for lo in range(0, len(left), 256):
                some = left[lo:lo + 256]
                hit = common[lo:lo + 256] >= share * (n[some][:, None] + n[right]) - 1e-6
                adj[lo:lo + 256] = hit
                count[some] += hit @ size[right].astype(float)
                if not square:
                    count[right] += size[some].astype(float) @ hit
            del common
            rows, cols = _forest(adj, square)
            count = count.astype(np.int64)
            label = np.zeros(len(keep), np.int64)
            label[left] = rows
            if not square:
                label[right] = cols
            at = {}  # any member names its component
            for r in range(len(keep)):
                at.setdefault(label[r], r)
            found = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[r] for r in found], pa.binary()), pa.array(count[found]),
                 pa.array([keys[at[label[r]]] for r in found], pa.binary())],
                ["key", "links", "tree"])

    return links


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                    limit: int = LIMIT, max_depth: int = MAX_DEPTH, leaf_block: int = LEAF_BLOCK,
                    block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, text_id, class_id, first_id, set_id, n_links, has_words), one per document.

    ``set_id`` names the documents with the same shingle set, ``class_id`` the
    connected documents (both by their smallest doc_id); ``n_links`` counts the
    other documents that are similar.  ``text_id`` is the text's xxhash64 and
    ``first_id`` that of the class's first document.
    """
    spark = docs.sparkSession
    p = partitions(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("text_id"), F.col("text").alias("text"))
    feats = stored(rows.mapInArrow(
        _features, "doc_id bigint, text_id bigint, n int, key binary, sig array<int>"), "sets")
    one = F.struct("doc_id", "text_id")
    classes = stored(feats.where("key IS NOT NULL").groupBy("key").agg(
        F.min(one).alias("first"), F.count("*").alias("size"), F.max("n").alias("n"),
        F.first("sig").alias("sig")), "classes")

    leaves = _leaves(classes, runs_for(recall, threshold), limit, max_depth)
    leaf_rows = leaves.join(may_occur(classes.select("key", "sig"), ["key"], leaves), "key")
    tiles = _tiles(leaf_rows, f"ceil(n / {leaf_block})").select("path", "i", "j", "key", "sig")
    edges = (tiles.repartition(p, "path", "i", "j").sortWithinPartitions("path", "i", "j")
             .mapInArrow(_sketch_edges, "a binary, b binary"))
    groups = components(edges).withColumnRenamed("node", "key")

    groups = stored(groups, "groups")
    members = stored(groups.join(may_occur(classes.drop("sig"), ["key"], groups), "key"), "members")
    blocks = members.groupBy("root").agg(F.expr(
        f"CAST(greatest(ceil(count(*) / {block}), ceil(sum(n) / {BLOCK_TOKENS})) AS INT)")
        .alias("blocks"))
    wanted = (members.join(blocks, "root")
              .select("root", "blocks", "key", "size", "first",
                      F.expr("CAST(pmod(xxhash64(key), blocks) AS INT)").alias("block")))
    # only documents that some component needs are shuffled with their text
    needed = may_occur(rows, ["doc_id", "text_id"], members.select("first.doc_id", "first.text_id"))
    fetched = needed.join(wanted, (F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
                          & (F.col("text_id") == F.col("first.text_id")))
    tokens = (fetched.select("root", "blocks", "block", "key", "size", "text")
              .mapInArrow(_token_rows, "root binary, i int, j int, block int, key binary,"
                          " size bigint, tokens binary"))
    found = stored(tokens.repartition(p, "root", "i", "j").sortWithinPartitions("root", "i", "j")
                   .mapInArrow(_exact_links(threshold), "key binary, links bigint, tree binary"),
                   "links")

    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("key").alias("a"), F.col("tree").alias("b")))
    named = (classes.select("key", "first", "size").join(links, "key", "left")
             .join(linked.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("root", F.coalesce("root", "key")))
    lowest = named.groupBy("root").agg(F.min("first").alias("lowest"))
    named = named.join(lowest, "root").select(
        "key", "first", "lowest", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = feats.select("doc_id", "text_id", "key").join(named, "key", "left")
    own = F.when(F.col("key").isNull(), F.struct("doc_id", "text_id"))
    return out.select(
        "doc_id", "text_id", F.coalesce(own, "lowest")["doc_id"].alias("class_id"),
        F.coalesce(own, "lowest")["text_id"].alias("first_id"),
        F.coalesce(own, "first")["doc_id"].alias("set_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), F.col("key").isNotNull().alias("has_words"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Documents without words are linked to nothing and all stay, repeated rows too."""
    found = stored(near_duplicates(docs, **options), "groups")
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))
                        & (F.col("text_id") == F.col("first_id")))
    stays = stays.groupBy(F.col("doc_id").alias("__id"), F.col("text_id").alias("__text")).agg(
        F.count("*").alias("__rows"), F.bool_or("has_words").alias("__words"))
    text_id = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    kept = docs.withColumn("__text_id", text_id).join(
        stays, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_id") == F.col("__text")))
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept.select(*docs.columns)
    again = F.col("__words") & (F.col("__rows") > 1)
    return (kept.where(~again).union(kept.where(again).dropDuplicates(["__id", "__text"]))
            .select(*docs.columns))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "set_id", "n_links")


# Shingles as here: texts in lower case, words between white space.
SQL = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(lower(coalesce(text, '')), '[^\s\x{{0B}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{A0}}]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT rid, doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS}
           THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - {WORDS} + 2),
                lambda i: array_to_string(w[i:i + {WORDS} - 1], ' '))) END) AS s
  FROM words),
classes AS MATERIALIZED (
  SELECT min(rid) AS cid, min(doc_id) AS set_id, s, len(s) AS n, count(*) AS size
  FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS MATERIALIZED (SELECT cid, n, unnest(s) AS t FROM classes),
links AS MATERIALIZED (
  SELECT a.cid AS x, b.cid AS y
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.cid < b.cid AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.cid, b.cid, a.n, b.n
  HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT cid AS x, cid AS y FROM classes
  UNION
  SELECT r.x, e.y FROM reach r JOIN both_ways e ON e.x = r.y),
roots AS (SELECT r.x AS cid, min(c.set_id) AS class_id FROM reach r JOIN classes c ON c.cid = r.y GROUP BY r.x),
partners AS (SELECT e.x AS cid, sum(c.size) AS n FROM both_ways e JOIN classes c ON c.cid = e.y GROUP BY e.x)
SELECT d.doc_id, coalesce(r.class_id, d.doc_id) AS class_id, coalesce(c.set_id, d.doc_id) AS set_id,
       CAST(coalesce(c.size - 1 + coalesce(p.n, 0), 0) AS BIGINT) AS n_links
FROM sets d LEFT JOIN classes c ON d.s = c.s LEFT JOIN roots r USING (cid) LEFT JOIN partners p USING (cid)
"""
