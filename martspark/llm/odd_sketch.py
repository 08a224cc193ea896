"""MinHash near-duplicates, checked by odd sketches.

Documents are sets of four-word shingles; two are linked if
100 * |intersection| >= 80 * |union|.  The result names connected documents.

1. Documents with equal sets form a class; only classes are compared.
2. A class has ``SAMPLES`` minhash samples.  ``BANDS`` bands of ``ROWS`` samples put
   it into buckets; a pair at the threshold misses all of them with odds of 3 in
   a million.
3. Odd sketch: every sample toggles one of ``BITS`` bits (its number and value
   choose it).  Equal samples toggle equal bits, so the XOR of two sketches
   holds the samples that differ, and its population count estimates how many
   do: BITS * (1 - (1 - 2 / BITS) ** (2 * differing)) / 2.  A pair is a candidate if
   that count is at most ``MOST_ODD``, its expectation where five standard
   deviations more samples differ than at the threshold.
4. Buckets are compared in blocks of at most ``BLOCK`` members, then, in larger buckets,
   members outside the bucket's largest component of candidate pairs against all of them, in
   tiles.  A tile reports a forest that spans its candidates, never the pairs.
   The components of these forests hold every candidate pair.
5. Candidates are confirmed on whole shingle sets.  A component of at most ``GROUP``
   classes and ``GROUP_TOKENS`` shingles is resolved by one task, closest pairs first and
   only between classes not connected yet.  Larger ones take rounds: each bucket
   proposes, for every component of confirmed links in it, its ``width``
   closest pairs with other components; confirmed pairs merge components; ``width`` grows eightfold
   until no bucket holds anything back.  Either way every candidate pair ends up confirmed,
   rejected or inside one component.  Nothing is capped, and a group
   of near copies costs its size, not the square of it, in exact checks.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.

Defined cases: a null text, or one without words, has an empty set, no links and is its
own component; with one to three words the set holds the whole sequence; rows
that repeat a doc_id count as rows of their own; a null doc_id never names a component
that holds a number, and is kept if its component is null; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import (BoundedCache, components, may_occur, partitions, sorted_groups,
                                  stored, table)
from martspark.llm.shingles import set_key

WORDS, PERCENT = 4, 80
BANDS, ROWS = 42, 6
SAMPLES = 256
BITS = 1024
BLOCK = 2048
GROUP, GROUP_TOKENS = 8192, 1 << 22
_U = np.uint64
_MULTIPLIERS = np.random.default_rng(13).integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)


def most_odd(percent: int = PERCENT, samples: int = SAMPLES, bits: int = BITS, sigmas: float = 5) -> int:
    """Population count up to which a pair is a candidate (step 3)."""
    p = 1 - percent / 100
    differing = samples * p + sigmas * (samples * p * (1 - p)) ** 0.5
    return int(np.ceil(bits * (1 - (1 - 2 / bits) ** (2 * differing)) / 2))


MOST_ODD = most_odd()


def shingle_set(text: str | None, hashes: BoundedCache) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles (bytes lower and split are ASCII's)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(hashes.__getitem__, words), _U, len(words))
    k = min(WORDS, len(h))
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        s = np.full(n, k, _U)
        for j in range(k):
            s = (s ^ h[j:j + n]) * _U(0x9E3779B97F4A7C15)
            s ^= s >> _U(29)
    return np.unique(s)


def byte_hashes() -> BoundedCache:
    return BoundedCache(xxhash.xxh64_intdigest)


def samples(shingles: np.ndarray) -> np.ndarray:
    """The smallest shingle of the set in each of ``SAMPLES`` random orders (uint64)."""
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, _U)
    with np.errstate(over="ignore"):
        for lo in range(0, len(shingles), 512):
            np.minimum(low, (shingles[lo:lo + 512, None] * _MULTIPLIERS).min(axis=0), out=low)
    return low


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_NUMBERS = _mix(np.arange(1, SAMPLES + 1, dtype=np.uint64))


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples: ``BITS`` bits as uint8."""
    place = _mix(low ^ _NUMBERS) % _U(BITS)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=BITS) & 1)


def estimated_share(odd: int, samples: int = SAMPLES, bits: int = BITS) -> float:
    """Similarity that a population count of the XOR stands for."""
    if 2 * odd >= bits:
        return 0.0
    return max(0.0, 1 - np.log(1 - 2 * odd / bits) / np.log(1 - 2 / bits) / 2 / samples)


def _band_hashes(low: np.ndarray) -> np.ndarray:
    h = np.arange(BANDS, dtype=np.uint64)
    rows = low[:BANDS * ROWS].reshape(BANDS, ROWS)
    for j in range(ROWS):
        h = _mix(h ^ rows[:, j])
    return h.view(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = byte_hashes()
    for batch in batches:
        n, keys, sketches, bands = [], [], [], []
        for text in batch.column("text"):
            s = shingle_set(text.as_py(), hashes)
            n.append(len(s))
            low = samples(s) if len(s) else None
            keys.append(set_key(s) if len(s) else None)
            sketches.append(odd_sketch(low).tobytes() if len(s) else None)
            bands.append(_band_hashes(low) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_id"), pa.array(n, pa.int64()),
             pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "text_id", "n_shingles", "key", "sketch", "bands"])


def _proposals(width: int, most: int, percent: int):
    """Closest candidate pairs between components, per tile (step 4).

    Rows: (a, b), and one with a null pair if a tile held candidates back.
    """
    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["bucket", "i", "j"]):
            if t.num_rows < 2:
                continue
            keys = t.column("key").to_pylist()
            left = np.flatnonzero(t.column("is_left").to_numpy(zero_copy_only=False))
            right = np.flatnonzero(t.column("is_right").to_numpy(zero_copy_only=False))
            if not len(left) or not len(right):
                continue
            comp = np.unique(np.array(t.column("comp").to_pylist(), dtype=object), return_inverse=True)[1]
            n, bits = t.column("n").to_numpy(), _sketches(t)
            a, b, odd = [], [], []
            for r in left:
                near, d = _near(bits, n, r, right[comp[right] != comp[r]], most, percent)
                a.append(np.full(len(near), r))
                b.append(near)
                odd.append(d)
            a, b, odd = np.concatenate(a), np.concatenate(b), np.concatenate(odd)
            if not len(a):
                continue
            order = np.lexsort((b, a, odd, comp[a]))
            first = np.r_[True, comp[a[order]][1:] != comp[a[order]][:-1]]
            starts = np.flatnonzero(first)
            rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
            some = order[rank < width]
            pairs = {(min(keys[x], keys[y]), max(keys[x], keys[y])) for x, y in zip(a[some], b[some])}
            out = sorted(pairs) + [(None, None)] * (len(some) < len(order))
            yield _pairs([p[0] for p in out], [p[1] for p in out])

    return propose


def _near(bits: np.ndarray, n: np.ndarray, r: int, others: np.ndarray, most: int,
          percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of row ``r`` among ``others``, and the counts of the XOR of their sketches."""
    d = np.bitwise_count(bits[others] ^ bits[r]).sum(axis=1, dtype=np.int32)
    small, large = np.minimum(n[others], n[r]), np.maximum(n[others], n[r])
    ok = (d <= most) & (100 * small >= percent * large)
    return others[ok], d[ok]


def _sketches(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sketch").to_pylist()), _U).reshape(t.num_rows, -1)


def _forests(most: int, percent: int):
    """Edges (a, b) that span the candidate pairs of a tile (step 4)."""
    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = [], []
        for t in sorted_groups(batches, ["bucket", "i", "j"]):
            left, right = (np.flatnonzero(t.column(c).to_numpy(zero_copy_only=False))
                           for c in ("is_left", "is_right"))
            if t.num_rows < 2 or not len(left) or not len(right):
                continue
            keys = t.column("key").to_pylist()
            label = np.unique(np.array(t.column("comp").to_pylist(), dtype=object), return_inverse=True)[1]
            n, bits = t.column("n").to_numpy(), _sketches(t)
            for r in left:
                apart = right[label[right] != label[r]]
                if not len(apart):
                    continue
                near, _ = _near(bits, n, r, apart, most, percent)
                if len(near):
                    others, at = np.unique(label[near], return_index=True)
                    low += [keys[r]] * len(at)
                    high += [keys[x] for x in near[at]]
                    label[np.isin(label, others)] = label[r]
            if len(low) > 10_000:
                yield _pairs(low, high)
                low, high = [], []
        yield _pairs(low, high)

    return forests


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _resolved(most: int, percent: int):
    """Rows (key, comp): the components of confirmed links of each group (step 5)."""
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = byte_hashes()
        for t in sorted_groups(batches, ["root"]):
            keys = t.column("key").to_pylist()
            sets = [shingle_set(x.as_py(), hashes) for x in t.column("text")]
            n, bits, label = t.column("n").to_numpy(), _sketches(t), np.arange(len(keys))
            for r in range(len(keys) - 1):
                later = r + 1 + np.flatnonzero(label[r + 1:] != label[r])
                near, odd = _near(bits, n, r, later, most, percent)
                for x in near[np.argsort(odd, kind="stable")]:
                    if label[x] != label[r] and _alike(sets[r], sets[x], percent):
                        label[label == label[x]] = label[r]
            low = {}
            for r, k in enumerate(keys):
                low[label[r]] = min(low.get(label[r], k), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([low[x] for x in label], pa.binary())],
                ["key", "comp"])

    return resolve


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = byte_hashes()
        sets, held = {}, 0  # those of the last texts, up to 32 MB
        for batch in batches:
            linked = []
            for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b"))):
                pair = []
                for key, text in ((a.as_py(), x), (b.as_py(), y)):
                    found = sets.get(key)
                    if found is None:
                        found = shingle_set(text.as_py(), hashes)
                        held += len(found)
                        if held > 1 << 22:
                            sets, held = {}, len(found)
                        sets[key] = found
                    pair.append(found)
                linked.append(_alike(*pair, percent))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep),
                                              batch.column("b").filter(keep)], ["a", "b"])

    return confirm


def _block(blocks: str):
    return F.expr(f"CAST(pmod(xxhash64(key, bucket), {blocks}) AS INT)")


TILE = ["bucket", "i", "j", "is_left", "is_right", "key", "comp", "n", "sketch"]


def _blocks(members: DataFrame) -> DataFrame:
    """Members (with their bucket's ``size``) dealt to blocks, each compared with itself."""
    both = F.lit(True)
    return members.withColumns({"i": _block(f"CAST(ceil(size / {BLOCK}) AS INT)"), "is_left": both,
                                "is_right": both}).withColumn("j", F.col("i")).select(*TILE)


def _tiles(members: DataFrame) -> DataFrame:
    """Members dealt to tiles (bucket, i, j), with their roles.

    Members outside the bucket's largest component (in blocks i) against all members (in blocks j).
    """
    per = (members.groupBy("bucket", "comp").agg(F.count("*").alias("c"))
           .groupBy("bucket").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("size"),
                                  F.count("*").alias("comps"))
           .where("comps > 1")
           .select("bucket", "size", F.col("top.comp").alias("major"),
                   (F.col("size") - F.col("top.c")).alias("minors")))
    rows = members.drop("size").join(per, "bucket")
    blocks, minor_blocks = (f"CAST(ceil({c} / {BLOCK}) AS INT)" for c in ("size", "minors"))
    rows = rows.withColumns({"minor": F.col("comp") != F.col("major"),
                             "mi": _block(minor_blocks), "mj": _block(blocks)})
    as_right = rows.withColumn("i", F.explode(F.expr(f"sequence(0, {minor_blocks} - 1)"))).withColumns(
        {"j": F.col("mj"), "is_right": F.lit(True), "is_left": F.col("minor") & (F.col("mi") == F.col("i"))})
    # a minor member also goes to the tiles of its own block that hold other blocks' members
    as_left = (rows.where("minor").withColumn("j", F.explode(F.expr(f"sequence(0, {blocks} - 1)")))
               .where("j <> mj").withColumns({"i": F.col("mi"), "is_left": F.lit(True),
                                              "is_right": F.lit(False)}))
    return as_right.unionByName(as_left).select(*TILE)


def _by_tile(tiles: DataFrame, fn, p: int) -> DataFrame:
    return (tiles.repartition(p, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(fn, "a binary, b binary"))


def _groups(seats: DataFrame, wide: DataFrame, most: int, percent: int, p: int) -> DataFrame | None:
    """Rows (key, root): components of the candidate pairs; None without any."""
    first = (seats.join(wide.select("key", "n", "sketch"), "key")
             .withColumn("comp", F.col("key")))
    edges = stored(_by_tile(_blocks(first), _forests(most, percent), p).distinct(), "forests")
    large = seats.where(F.col("size") > BLOCK)
    if large.isEmpty():
        return None if edges.isEmpty() else components(edges).withColumnRenamed("node", "key")
    comps = _labels(wide, None if edges.isEmpty() else components(edges))
    rest = large.join(wide.select("key", "n", "sketch").join(comps, "key"), "key")
    more = stored(_by_tile(_tiles(stored(rest, "members")), _forests(most, percent), p).distinct(), "forests")
    edges = edges.union(more)
    return None if edges.isEmpty() else components(edges).withColumnRenamed("node", "key")


def _labels(wide: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Rows (key, comp) of all classes; those without an edge are alone."""
    if roots is None:
        return wide.select("key", F.col("key").alias("comp"))
    roots = roots.withColumnsRenamed({"node": "key", "root": "comp"})
    return stored(wide.select("key").join(roots, "key", "left")
                  .withColumn("comp", F.coalesce("comp", "key")), "components")


def _rounds(seats: DataFrame, wide: DataFrame, texts: DataFrame, most: int, percent: int, p: int,
            start_width: int) -> DataFrame:
    """Rows (key, comp) of classes in groups too large for one task (step 5)."""
    comps, edges = _labels(wide, None), None
    width, early = 1, [3, 9]  # first inside the blocks of a few bands, to connect large groups
    one = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    while True:
        bands, whole = (early.pop(0), False) if early else (BANDS, True)
        members = seats.where(F.col("band") < bands).join(
            wide.select("key", "n", "sketch").join(comps, "key"), "key")
        tiles = _tiles(stored(members, "members")) if whole else _blocks(members)
        found = stored(_by_tile(tiles, _proposals(width, most, percent), p).distinct(), "proposed")
        held_back = whole and not found.where("a IS NULL").isEmpty()
        pairs = found.where("a IS NOT NULL")
        links = stored(pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
                       .mapInArrow(_confirmed(percent), "a binary, b binary"), "links")
        if not links.isEmpty():
            edges = links if edges is None else edges.union(links)
            comps = _labels(wide, components(edges))
        if whole:
            if not held_back:
                return comps
            width = width * 8 if width >= start_width else start_width


def near_duplicates(docs: DataFrame, percent: int = PERCENT, start_width: int = 4) -> DataFrame:
    """Rows (doc_id, text_id, n_shingles, component_id, kept), one per document."""
    spark = docs.sparkSession
    p = partitions(spark)
    most = MOST_ODD if percent == PERCENT else most_odd(percent)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_id"),
                       F.col("text").alias("text"))
    feats = stored(rows.mapInArrow(
        _features, "doc_id bigint, text_id bigint, n_shingles bigint, key binary, sketch binary,"
                   " bands array<bigint>"), "sketches")
    classes = stored(feats.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("low_id"), F.min(F.struct("doc_id", "text_id")).alias("first"),
        F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
        F.first("bands").alias("bands")), "classes")
    placed = classes.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(shared, "buckets")
    # members of buckets of two classes and more, without the sketches that make them wide
    seats = stored(may_occur(placed, ["bucket"], shared).join(shared, "bucket"), "seats")
    met = stored(seats.select("key").distinct(), "met")
    wide = classes.select("key", "n", "sketch", "first")
    wide = stored(may_occur(wide, ["key"], met).join(met, "key"), "met-classes")

    groups = _groups(seats, wide, most, percent, p)
    comps = spark.createDataFrame([], "key binary, comp binary")
    if groups is not None:
        groups = stored(groups.join(wide, "key"), "groups")
        sizes = groups.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("tokens"))
        fits = f"m <= {GROUP} AND tokens <= {GROUP_TOKENS}"
        sizes = stored(sizes.withColumn("fits", F.expr(fits)), "group-sizes")
        # only documents that some group needs are shuffled with their text
        texts = may_occur(rows, ["doc_id", "text_id"], groups.select("first.doc_id", "first.text_id"))
        texts = (texts.join(groups.join(sizes, "root"),
                            F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                            & (F.col("text_id") == F.col("first.text_id")))
                 # repeated rows of one id and text are one text
                 .groupBy("key").agg(F.first("root").alias("root"), F.first("fits").alias("fits"),
                                     F.first("n").alias("n"), F.first("sketch").alias("sketch"),
                                     F.first("text").alias("text")))
        texts = stored(texts, "texts")
        comps = stored(texts.where("fits").select("root", "key", "n", "sketch", "text")
                       .repartition(p, "root").sortWithinPartitions("root")
                       .mapInArrow(_resolved(most, percent), "key binary, comp binary"), "resolved")
        if not sizes.where(~F.col("fits")).isEmpty():
            large = texts.where(~F.col("fits"))
            own = stored(large.select("key", "n", "sketch"), "large")
            comps = comps.union(_rounds(seats.join(own.select("key"), "key"), own, large, most, percent, p,
                                        start_width))

    named = classes.select("key", "low_id").join(comps, "key", "left").withColumn(
        "comp", F.coalesce("comp", "key"))
    lowest = named.groupBy("comp").agg(F.min("low_id").alias("component_id"))
    named = named.join(lowest, "comp").select("key", "component_id")
    out = feats.select("doc_id", "text_id", "n_shingles", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op13_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_id")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS}
           THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - {WORDS} + 2),
                lambda i: array_to_string(w[i:i + {WORDS} - 1], ' '))) END AS s
  FROM words),
classes AS MATERIALIZED (
  SELECT min(rid) AS cid, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
tokens AS MATERIALIZED (SELECT cid, n, unnest(s) AS t FROM classes),
links AS MATERIALIZED (
  SELECT a.cid AS x, b.cid AS y
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.cid < b.cid
    AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.cid, b.cid, a.n, b.n
  HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT cid AS x, cid AS y FROM classes
  UNION
  SELECT r.x, e.y FROM reach r JOIN both_ways e ON e.x = r.y),
members AS (SELECT s.rid, s.doc_id, c.cid FROM sets s JOIN classes c ON list_sort(s.s) = c.s),
lowest AS (SELECT cid, min(doc_id) AS doc_id FROM members GROUP BY cid),
roots AS (SELECT r.x AS cid, min(l.doc_id) AS root FROM reach r JOIN lowest l ON l.cid = r.y GROUP BY r.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles,
       CASE WHEN m.rid IS NULL THEN s.doc_id ELSE r.root END AS component_id,
       s.doc_id IS NOT DISTINCT FROM
         CASE WHEN m.rid IS NULL THEN s.doc_id ELSE r.root END AS kept
FROM sets s LEFT JOIN members m USING (rid) LEFT JOIN roots r USING (cid)
"""
