"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions.  For each decision (named by the bits
already known) a context tree over the ``DEPTH`` preceding bytes mixes the
Krichevsky-Trofimov estimates of all depths:

    P_w(s) = 1/2 KT(zeros, ones at s) + 1/2 product of P_w(children of s)

After learning, the mixture gives each decision a probability along its
context path, and a text's score is the sum of their logarithms; the code length
per byte follows.  Learning counts the (context, byte) grams of all training
texts, so the model grows with the corpus and nothing is pruned.

Distribution: documents are dealt into batches of ``1 << BATCH_BITS`` rows.
Batches send their distinct words and grams with training counts, pre-summed;
the counts are added per word and per gram, gram subtrees below two bytes of context are
solved in parallel by those two bytes (at most 256**(DEPTH - 2) contexts each),
and what a batch needs is joined back to it.  Only the tree's
top, the decisions after no or one byte (65,280 nodes), passes through the driver.

A unigram word model with add-one smoothing is computed along with it.

Defined cases: a null text counts as '' and has one token, the end; A to Z
are lower-cased; a text ends in byte 0 and starts after ``DEPTH`` bytes 0;
without training rows every decision has probability 1/2; repeated rows
count and are scored each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from martspark.llm.common import crc_fold, partitions, sorted_groups, stored, table

DEPTH = 5
BATCH_BITS = 13
CHUNK = 1 << 20      # bytes handled at once inside a batch
HELD_OUT = (7, 2)    # held out: crc32 of the id modulo 7 is 2
_U = np.uint64


def gram_codes(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all (context, byte) grams of some texts, and each text's number of them."""
    pad = b"\0" * depth
    data = np.frombuffer(b"".join(pad + t + b"\0" for t in texts), np.uint8).astype(_U)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    code = np.zeros(len(data) - depth, _U)
    for i in range(depth + 1):
        code = code << _U(8) | data[i:len(data) - depth + i]
    # a text's grams start at its first byte; those that end in padding go
    keep = np.ones(len(code), bool)
    starts = np.cumsum(sizes + depth)[:-1]
    for i in range(depth):
        keep[starts - depth + i] = False
    return code[keep], sizes


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, inv = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inv, np.concatenate(counts), len(k)).astype(np.int64)


TEXTS = "doc_id bigint, text binary, train boolean, batch bigint"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress each text: it is shuffled once and read three times."""
    press = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([press(t) for t in b.column(1).to_pylist()], pa.binary()),
             b.column(2), b.column(3)], ["doc_id", "text", "train", "batch"])


def _unpack(texts: pa.ChunkedArray) -> list[bytes]:
    read = zstandard.ZstdDecompressor().decompress
    return [read(t) for t in texts.to_pylist()]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray]]:
    """Whole batches (number, texts as bytes, training flags) from (batch, train, text) rows."""
    for t in sorted_groups(batches, ["batch"]):
        yield t.column("batch")[0].as_py(), _unpack(t.column("text")), t.column("train").to_numpy()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, texts, train in _batches(batches):
        count: Counter = Counter()
        for text, learn in zip(texts, train):
            if learn:
                count.update(text.split())
            else:
                count.update(dict.fromkeys(text.split(), 0))
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(count), pa.int64()), pa.array(count.keys(), pa.binary()),
                 pa.array(count.values(), pa.int64())], ["batch", "word", "n"])


def _count_grams(depth: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, texts, train in _batches(batches):
            keys, counts = [], []
            for learn in (True, False):
                for some in _chunks([t for t, f in zip(texts, train) if bool(f) == learn]):
                    k, n = np.unique(gram_codes(some, depth)[0], return_counts=True)
                    keys.append(k)
                    counts.append(n if learn else np.zeros(len(k)))
            k, n = _summed(keys, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), number)), pa.array(k.astype(np.int64)), pa.array(n)],
                ["batch", "gram", "n"])

    return count


#: What a batch needs, in rows of many facts: words with their training
#: counts, grams (sorted, as differences) with their log probabilities.
FACTS = "batch bigint, words binary, counts binary, grams binary, logps binary"
PACKED_ROWS = 1 << 20


def _by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each batch, as far as a block of PACKED_ROWS rows holds them."""
    held, size = [], 0

    def cut() -> Iterator[tuple[int, pa.Table]]:
        t = pa.Table.from_batches(held).sort_by("batch")
        number = t.column("batch").to_numpy()
        first = np.flatnonzero(np.diff(number, prepend=number[0] - 1))
        for lo, hi in zip(first, [*first[1:], len(number)]):
            yield int(number[lo]), t.slice(lo, hi - lo)

    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.num_rows
        if size >= PACKED_ROWS:
            yield from cut()
            held, size = [], 0
    if held:
        yield from cut()


def _fact_row(number: int, words=None, counts=None, grams=None, logps=None) -> pa.RecordBatch:
    press = zstandard.ZstdCompressor(level=3).compress
    cells = [None if x is None else press(x) for x in (words, counts, grams, logps)]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()),
                                       *[pa.array([c], pa.binary()) for c in cells]],
                                      ["batch", "words", "counts", "grams", "logps"])


def _pack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, t in _by_batch(batches):
        t = t.sort_by("word")
        yield _fact_row(number, words=b"\n".join(t.column("word").to_pylist()),
                        counts=t.column("n").to_numpy().astype("<i8").tobytes())


def _pack_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, t in _by_batch(batches):
        t = t.sort_by("gram")
        yield _fact_row(number, grams=np.diff(t.column("gram").to_numpy(), prepend=0).tobytes(),
                        logps=t.column("logp").to_numpy().tobytes())


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 (Stirling's series after eight steps)."""
    y = x + 8
    steps = np.zeros_like(y)
    for i in range(8):
        steps += np.log(x + i)
    return ((y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi)
            + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
            + 1 / (1188 * y ** 9) - steps)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability the Krichevsky-Trofimov estimator gives such counts."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0)
            - np.log(np.pi))


class Subtree:
    """All decisions of some grams in the contexts of ``top`` to ``depth`` bytes.

    The grams must be complete for their last ``top`` context bytes.
    """

    def __init__(self, grams: np.ndarray, n: np.ndarray, depth: int, top: int):
        grams = grams.astype(_U)
        byte, context = grams & _U(255), grams >> _U(8)
        bit = np.arange(8)
        prefix = (1 << bit) | (byte.astype(np.int64)[:, None] >> (8 - bit))
        self.ones = (byte.astype(np.int64)[:, None] >> (7 - bit)) & 1
        weight = np.repeat(n.astype(float), 8)
        ones = self.ones.ravel()
        self.levels = {}
        child_path = child_weighted = None
        for d in range(depth, top - 1, -1):
            path = context & _U((1 << 8 * d) - 1)
            node = (path[:, None] << _U(8) | prefix.astype(_U)).ravel()
            name, at = np.unique(node, return_inverse=True)
            n1 = np.bincount(at, weight * ones, len(name))
            n0 = np.bincount(at, weight * (1 - ones), len(name))
            kt = log_kt(n0, n1)
            if child_path is None:
                weighted, share = kt, np.ones(len(name))
            else:
                up = ((child_path >> _U(8)) & _U((1 << 8 * d) - 1)) << _U(8) | child_path & _U(255)
                below = np.bincount(np.searchsorted(name, up), child_weighted, len(name))
                weighted = np.logaddexp(kt, below) - np.log(2)
                share = np.exp(kt - np.log(2) - weighted)
            self.levels[d] = (at, n0, n1, share)
            child_path, child_weighted = name, weighted
        self.top, self.depth = top, depth
        self.name, self.weighted = child_path, child_weighted

    def decisions(self) -> np.ndarray:
        """Probability of each gram's eight decisions, mixed over the subtree's depths."""
        out = None
        for d in range(self.depth, self.top - 1, -1):
            at, n0, n1, share = self.levels[d]
            p = ((np.where(self.ones.ravel(), n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1))
            out = p if out is None else share[at] * p + (1 - share[at]) * out
        return out.reshape(-1, 8)


def _tops(depth: int):
    """Per decision after two bytes: its last byte, prefix, counts and weighted probability."""
    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["suffix"]):
            tree = Subtree(t.column("gram").to_numpy(), t.column("n").to_numpy(), depth, 2)
            _, n0, n1, _ = tree.levels[2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(((tree.name >> _U(8)) & _U(255)).astype(np.int32)),
                 pa.array((tree.name & _U(255)).astype(np.int32)),
                 pa.array(n0), pa.array(n1), pa.array(tree.weighted)],
                ["byte", "prefix", "zeros", "ones", "weighted"])

    return tops


class Top:
    """The decisions in the contexts of no and one byte, as dense tables."""

    def __init__(self, rows: list):
        zeros, ones, below = (np.zeros((256, 256)) for _ in range(3))
        for r in rows:
            at = r["byte"], r["prefix"]
            zeros[at], ones[at], below[at] = r["zeros"], r["ones"], r["weighted"]
        kt = log_kt(zeros, ones)
        weighted = np.logaddexp(kt, below) - np.log(2)
        self.share1 = np.exp(kt - np.log(2) - weighted)
        self.p1 = (ones + 0.5) / (zeros + ones + 1)
        z0, o0 = zeros.sum(0), ones.sum(0)
        kt0 = log_kt(z0, o0)
        self.share0 = np.exp(kt0 - np.logaddexp(kt0, weighted.sum(0)))
        self.p0 = (o0 + 0.5) / (z0 + o0 + 1)

    def log10(self, grams: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's byte; ``below``: its decisions' mix from two bytes on."""
        byte = (grams & 255)[:, None]
        last = ((grams >> 8) & 255)[:, None]
        bit = np.arange(8)
        prefix, one = (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1
        p1, p0 = self.p1[last, prefix], self.p0[prefix]
        p1, p0 = np.where(one, p1, 1 - p1), np.where(one, p0, 1 - p0)
        s1, s0 = self.share1[last, prefix], self.share0[prefix]
        return np.log10(s0 * p0 + (1 - s0) * (s1 * p1 + (1 - s1) * below)).sum(1)


def gram_scores(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Rows (gram, logp) from rows (gram, n); n is 0 for grams only held-out texts have."""
    p = partitions(grams.sparkSession)
    placed = (grams.withColumn("suffix", F.expr("CAST((gram >> 8) & 65535 AS INT)"))
              .repartition(p, "suffix").sortWithinPartitions("suffix"))
    rows = (placed.mapInArrow(_tops(depth), "byte int, prefix int, zeros double, ones double,"
                              " weighted double")
            .groupBy("byte", "prefix").agg(*[F.sum(c).alias(c)
                                             for c in ("zeros", "ones", "weighted")])
            .collect())  # at most 256 x 255 rows
    top = grams.sparkSession.sparkContext.broadcast(Top(rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["suffix"]):
            codes = t.column("gram").to_numpy()
            tree = Subtree(codes, t.column("n").to_numpy(), depth, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes), pa.array(top.value.log10(codes, tree.decisions()))],
                ["gram", "logp"])

    return placed.mapInArrow(score, "gram bigint, logp double")


def _score_batch(denominator: float, end_count: int, depth: int):
    schema = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_bytes", pa.int64()),
                        ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def score(docs: pa.Table, facts: pa.Table) -> pa.Table:
        read = zstandard.ZstdDecompressor().decompress
        word_value: dict[bytes, complex] = {}
        code, logp = [], []
        for row in zip(*(facts.column(c).to_pylist() for c in ("words", "counts", "grams", "logps"))):
            if row[0] is not None:
                n = np.frombuffer(read(row[1]), "<i8")
                # a word's log probability and whether it is known, added up together
                value = np.log10((n + 1) / denominator) + 1j * (n > 0)
                word_value.update(zip(read(row[0]).split(b"\n"), value.tolist()))
            else:
                code.append(np.cumsum(np.frombuffer(read(row[2]), "<i8")))
                logp.append(np.frombuffer(read(row[3]), "<f8"))
        code = np.concatenate(code)
        order = np.argsort(code)
        code, logp = code[order].astype(_U), np.concatenate(logp)[order]

        texts = _unpack(docs.column("text"))
        end = np.log10((end_count + 1) / denominator) + 1j * (end_count > 0)
        counts, base, score_ = [], [], []
        for t in texts:
            found = t.split()
            counts.append(len(found) + 1)
            base.append(sum(map(word_value.__getitem__, found), end))
        for some in _chunks(texts):
            codes, sizes = gram_codes(some, depth)
            values = logp[np.searchsorted(code, codes)]
            score_.append(np.add.reduceat(values, np.cumsum(sizes) - sizes))
        base = np.array(base, complex)
        pa.default_memory_pool().release_unused()
        return pa.table([docs.column("doc_id"), docs.column("train"),
                         pa.array([len(t) for t in texts], pa.int64()),
                         pa.array(counts, pa.int64()),
                         pa.array(np.rint(base.imag).astype(np.int64)), pa.array(base.real),
                         pa.array(np.concatenate(score_))], schema=schema)

    return score, schema


def lm_scores(docs: DataFrame, fold: tuple[int, int] = HELD_OUT, depth: int = DEPTH,
              batch_bits: int = BATCH_BITS) -> DataFrame:
    """One row per document: scores of the tree and of the unigram model.

    Columns: doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.
    """
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), string.ascii_uppercase,
                          string.ascii_lowercase)
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), lowered.cast("binary").alias("text"),
        (crc_fold(F.col("doc_id"), fold[0]) != fold[1]).alias("train"),
        F.shiftright(F.monotonically_increasing_id(), batch_bits).alias("batch"))
        .mapInArrow(_pack, TEXTS), "texts")
    inputs = rows.select("batch", "train", "text")

    words = inputs.mapInArrow(_count_words, "batch bigint, word binary, n bigint")
    by_word = W.partitionBy("word")  # one row per batch and word
    words = stored(words.select("batch", "word", F.sum("n").over(by_word).alias("n"),
                                F.row_number().over(by_word.orderBy("batch")).alias("k")), "words")
    n_words, kinds = words.where("k = 1").agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    ends = rows.where("train").count()
    train_tokens = n_words + ends
    denominator = float(train_tokens + kinds + (ends > 0) + 1)

    grams = stored(inputs.mapInArrow(_count_grams(depth), "batch bigint, gram bigint, n bigint"),
                   "grams")
    scored = stored(gram_scores(grams.groupBy("gram").agg(F.sum("n").alias("n")), depth), "scored")

    facts = (words.select("batch", "word", "n").mapInArrow(_pack_words, FACTS)
             .union(grams.select("batch", "gram").join(scored, "gram")
                    .select("batch", "gram", "logp").mapInArrow(_pack_grams, FACTS)))
    fn, schema = _score_batch(denominator, ends, depth)
    out = (rows.groupBy("batch").cogroup(facts.groupBy("batch")).applyInArrow(
        fn, "doc_id bigint, train boolean, n_bytes bigint, n_tokens bigint, n_known bigint,"
        " base_score double, score double"))
    return out.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_bytes", "n_tokens", "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
