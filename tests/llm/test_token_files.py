import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest_llm import texts_of
from martspark.llm import token_files as T
from martspark.llm.perfect_hash import PerfectHash, dump, load


def encoded(rows):
    tok = Tokenizer.from_file(T.TOKENIZER)
    return [(d, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows]


def test_perfect_hash_is_minimal_and_tells_foreign_keys():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 62, 20_000).astype(np.uint64)
    b = np.arange(20_000).astype(np.uint64) % np.uint64(3)
    h = PerfectHash.build(a, b)
    assert sorted(h.lookup(a, b)) == list(range(20_000))
    again, columns = load(dump(h, at=np.arange(20_000)))
    assert (again.lookup(a, b) == h.lookup(a, b)).all() and len(columns["at"]) == 20_000
    foreign = rng.integers(0, 1 << 62, 20_000).astype(np.uint64)
    assert (h.lookup(foreign, b) == -1).mean() > 0.999
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1], np.uint64), np.array([0, 0], np.uint64))


def test_pieces_encode_like_whole_texts(odd, make_docs):
    encode = T._Encoder(T.TOKENIZER, 2)
    rng = random.Random(1)
    parts = ["Don't", "it's", "'s", "A1!", "!!", "...", "\x00", "\x01!", "<|endoftext|>", "<|", "\n",
             "\t", "caf\u00e9", "e\u0301", "\u0301", "x\u00a0y", "\x1c", "12", "a_b", "\u4e2d", "\u03a3", "\r\n"]
    odd = odd.union(make_docs([(i, "".join(rng.choice(parts + [" "] * 9) for _ in range(40)))
                               for i in range(300)]))
    for (_, text), (_, ids) in zip(texts_of(odd), encoded(texts_of(odd))):
        assert np.frombuffer(encode(text), "<u2").tolist() + [1] == ids


@pytest.mark.parametrize("shards", [1, 5])
def test_round_trip(spark, odd, tmp_dir, shards):
    files = T.write_tokens(odd, f"{tmp_dir}/tokens", shards=shards)
    rows = T.read_tokens(T.document_keys(odd), files, with_ids=True).collect()
    want = encoded(texts_of(odd))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in rows) == sorted(
        (d is None, d or 0, ids) for d, ids in want)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows if r.doc_id is not None] == sorted(d for d, _ in want if d is not None)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    gone = spark.createDataFrame([(123456, 0), (6, 2), (6, 1)], "doc_id long, copy long")
    assert [(r.doc_id, r.copy) for r in T.read_tokens(gone, files).collect()] == [(6, 1)]


def test_a_tokenizer_that_differs_encodes_whole_texts(odd, tmp_dir):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")  # keeps case and blanks
    assert not T._Encoder(path, 2).by_pieces and T._Encoder(T.TOKENIZER, 2).by_pieces
    rows = T.read_tokens(T.document_keys(odd), T.write_tokens(odd, f"{tmp_dir}/t", tokenizer=path),
                         with_ids=True).collect()
    tok = Tokenizer.from_file(path)
    want = [(d is None, d or 0, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in texts_of(odd)]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in rows) == sorted(want)


def test_empty(empty):
    df = T.token_table(empty)
    assert df.collect() == [] and df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
