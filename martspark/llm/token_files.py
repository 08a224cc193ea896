"""Token ids in raw binary shards behind a minimal perfect hash index.

Layout under ``root``:

``data/shard-<n>.bin``   8-byte header (magic, bytes per id), then
                         little-endian ids, documents in doc_id order;
                         2 bytes per id if the vocabulary allows, else 4
``index/part-<n>.npz``   a minimal perfect hash over the keys of one hash
                         partition, with 32-bit fingerprints and, per slot,
                         shard, offset and length (in ids)
``shards``               Parquet: shard, ids, first (ids of all shards before)

A key is (doc_id, copy): copy numbers rows that repeat a doc_id, from 0.  A
lookup hashes the key to its index part and slot, compares the fingerprint and
reads the payload at its offset: constant time, whatever the number of
documents.

Documents are range-partitioned by doc_id, one shard per range, each streamed
to its file; nothing larger than a batch is held.  Files appear under their
names only when complete, so retried tasks leave whole files.

Defined cases: a null text counts as '' and yields the end id alone; a null
doc_id sorts first and has key (-1, copy) with a null mark; rows that repeat a
doc_id stay in the same shard, in order of their text's hash; an empty table writes no
file and reads back empty; other columns are ignored.
"""

from __future__ import annotations

import string
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from martspark.llm import perfect_hash
from martspark.llm.common import (BoundedCache, partitions, running_sums, scratch_path,
                                  sorted_groups, stored, table)
from martspark.llm.files import Draft, open_random, read_bytes

MAGIC = b"TOKS"
HEADER = "<4sI"
HEADER_SIZE = 8
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1

LOCATIONS = "doc_id bigint, copy bigint, shard int, at bigint, n bigint"


@dataclass(frozen=True)
class TokenFiles:
    root: str
    width: int   # bytes per id
    parts: int   # of the index


#: Texts on which a tokenizer must give the same ids whole and in pieces: case, blanks at
#: both ends and in runs, line ends, marks before and after words, digits, contractions,
#: accents, other scripts, special tokens.
_WORDS = ["the", "The", "THE", "hello", "World", "x", "I", "don't", "re-use", "3", "1984", "3rd", "caf\u00e9",
          "na\u00efve", "\u4f60\u597d", "\U0001F600", "a.b", "e.g.", "http://a.b/c?d=1", "<|endoftext|>", "_", "__init__"]
_MARKS = ["", ".", ",", "!", "?!", "...", ")", "\"", "'", "'s", ":", ";", "-", "$", "%", "#", "`", "~", "\\"]
PROBES = [f"{w}{m}{gap}{v}{m}" for i, w in enumerate(_WORDS) for m in _MARKS
          for gap, v in ((" ", _WORDS[i - 1]), ("\n", "next"), ("  ", "Next"), ("\t", "end"))]
PROBES += [f"{m}{w}" for w in _WORDS for m in _MARKS] + ["", " ", "  ", "\n", "\n\n", " a ", "\r\n", "a\r\nb", "\x00"]


class _Encoder:
    """Ids of whole texts, as bytes.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its pieces between spaces and line ends, in order.  It ignores
    the case of ASCII letters and never joins a letter or digit to a punctuation mark
    after it, so a piece's trailing marks are encoded apart.  What is encoded
    once is kept while it is in the cache.

    Whether a tokenizer does all this is tried on ``PROBES`` when it is loaded; one that
    differs on any of them encodes whole texts instead.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer
        tok, kind = Tokenizer.from_file(path), f"<u{width}"

        def encode(s: str) -> bytes:
            return np.array(tok.encode(s, add_special_tokens=False).ids, kind).tobytes()

        model = tok.model

        def encode_stem(s: str) -> bytes:
            # lower-case ASCII letters pass the other steps unchanged
            if s.isalpha():
                return np.array([t.id for t in model.tokenize(s)], kind).tobytes()
            return encode(s)

        stems = BoundedCache(encode_stem, 1 << 20)

        def piece(s: str) -> bytes:
            if s.isascii() and "<|" not in s:
                s = s.lower()
                stem = s.rstrip(string.punctuation)
                if not stem or stem[-1].isalnum():
                    return stems[stem] + stems[s[len(stem):]]
            return encode(s)

        self.pieces, self.whole = BoundedCache(piece), encode
        self.by_pieces = True
        self.by_pieces = all(self(s) == encode(s) for s in PROBES)

    def __call__(self, text: str | None) -> bytes:
        if not self.by_pieces:
            return self.whole(text or "")
        return b"".join(map(self.pieces.__getitem__, (text or "").replace("\n", " ").split(" ")))


_encoders: dict = {}  # one per worker process, kept across its tasks


def _encoder(path: str, width: int) -> _Encoder:
    if (path, width) not in _encoders:
        _encoders[path, width] = _Encoder(path, width)
    return _encoders[path, width]


def _id_width(tokenizer: str, end_id: int) -> int:
    from tokenizers import Tokenizer
    return 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def write_tokens(docs: DataFrame, root: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text",
                 shards: int | None = None) -> TokenFiles:
    """Encode all documents into shards and build the index."""
    spark = docs.sparkSession
    n = shards or partitions(spark)
    width = _id_width(tokenizer, end_id)
    end = np.array([end_id], f"<u{width}").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer, width)
        shard = TaskContext.get().partitionId()
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        at, last, copy = 0, object(), 0
        with Draft(f"{root}/data", f"shard-{shard:05d}.bin") as out:
            out.write(struct.pack(HEADER, MAGIC, width))
            batch = first
            while batch is not None:
                ids, copies, starts, sizes = batch.column(0).to_pylist(), [], [], []
                for doc, text in zip(ids, batch.column(1).to_pylist()):
                    data = encode(text) + end
                    out.write(data)
                    copy, last = (copy + 1 if doc == last else 0), doc
                    copies.append(copy)
                    starts.append(at)
                    sizes.append(len(data) // width)
                    at += sizes[-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(copies, pa.int64()),
                     pa.array([shard] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64())], ["doc_id", "copy", "shard", "at", "n"])
                batch = next(batches, None)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = (rows.repartitionByRange(n, "doc_id")
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    locations = stored(ordered.mapInArrow(write, LOCATIONS), "locations")
    totals = locations.groupBy("shard").agg(F.sum("n").alias("ids"))
    running_sums(totals, [F.col("shard")], {"first": F.col("ids")}).write.parquet(f"{root}/shards")
    parts = n
    _build_index(locations, root, parts)
    return TokenFiles(root, width, parts)


def _part(parts: int):
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(parts)).cast("int")


def _keys(table_: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A key's two numbers; a null doc_id is told apart by the second one."""
    doc = table_.column("doc_id").combine_chunks()
    null = np.asarray(doc.is_null())
    a = doc.fill_null(-1).to_numpy().astype(np.uint64)
    b = table_.column("copy").to_numpy().astype(np.uint64) | (null.astype(np.uint64) << np.uint64(63))
    return a, b


def _build_index(locations: DataFrame, root: str, parts: int) -> None:
    """Write one perfect hash per hash partition of the keys."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["part"]):
            part = t.column("part")[0].as_py()
            a, b = _keys(t)
            mph = perfect_hash.PerfectHash.build(a, b)
            slot = mph.lookup(a, b)
            columns = {}
            for c in ("shard", "at", "n"):
                v = t.column(c).to_numpy()
                columns[c] = np.empty_like(v)
                columns[c][slot] = v
            with Draft(f"{root}/index", f"part-{part:05d}.npz") as out:
                out.write(perfect_hash.dump(mph, **columns))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()),
                                              pa.array([t.num_rows], pa.int64())], ["part", "keys"])

    keyed = locations.withColumn("part", _part(parts))
    (keyed.repartition(parts, "part").sortWithinPartitions("part")
     .mapInArrow(build, "part int, keys bigint").agg(F.sum("keys")).collect())


def read_tokens(keys: DataFrame, files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """Look up (doc_id, copy) rows: their ids' place, number and checksum, optionally the ids.

    Keys that are not stored yield no row.
    """
    root, parts = files.root, files.parts
    spark = keys.sparkSession

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["part"]):
            part = t.column("part")[0].as_py()
            mph, columns = perfect_hash.load(read_bytes(f"{root}/index", f"part-{part:05d}.npz"))
            slot = mph.lookup(*_keys(t))
            known = slot >= 0
            t = t.filter(pa.array(known))
            slot = slot[known]
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id").combine_chunks(), t.column("copy").combine_chunks(),
                 *[pa.array(columns[c][slot]) for c in ("shard", "at", "n")]],
                ["doc_id", "copy", "shard", "at", "n"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, file, width = None, None, None
        for batch in batches:
            sums, payloads = [], []
            for shard, at, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "at", "n"))):
                if shard != current:
                    file, current = open_random(f"{root}/data", f"shard-{shard:05d}.bin"), shard
                    magic, width = struct.unpack(HEADER, file.read_at(HEADER_SIZE, 0))
                    if magic != MAGIC:
                        raise ValueError(f"shard {shard}: not a token file")
                raw = file.read_at(n * width, HEADER_SIZE + at * width)
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                sums.append(zlib.crc32(ids.tobytes()))
                payloads.append(ids.astype(np.int64) if with_ids else None)
            arrays = [batch.column(c) for c in ("doc_id", "copy", "shard", "at", "n")]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sums, pa.int64()), pa.array(payloads, pa.list_(pa.int64()))],
                ["doc_id", "copy", "shard", "at", "n", "ids_crc32", "ids"])

    found = (keys.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("copy").cast("long").alias("copy"))
             .withColumn("part", _part(parts)).repartition(parts, "part")
             .sortWithinPartitions("part").mapInArrow(locate, LOCATIONS))
    read = (found.repartition(partitions(spark), "shard").sortWithinPartitions("shard", "at")
            .mapInArrow(fetch, LOCATIONS + ", ids_crc32 bigint, ids array<bigint>"))
    first = spark.read.parquet(f"{root}/shards").select("shard", "first")
    out = read.join(first, "shard").withColumn("start", F.col("first") + F.col("at"))
    return out.select("doc_id", "copy", "start", F.col("n").alias("n_tokens"), "ids_crc32",
                      *(["ids"] if with_ids else []))


def document_keys(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The keys of all rows: (doc_id, copy)."""
    one = W.partitionBy("doc_id").orderBy("doc_id")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"))
            .withColumn("copy", F.row_number().over(one).cast("long") - 1))


def token_table(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write the documents' token files, look every document up and read it back."""
    spark = docs.sparkSession
    if docs.isEmpty():
        return spark.createDataFrame(
            [], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    files = write_tokens(docs, scratch_path(spark, "tokens"), tokenizer, end_id)
    return read_tokens(document_keys(docs), files).drop("copy")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"))
