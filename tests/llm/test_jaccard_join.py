import itertools
import random

import numpy as np
import pytest

from conftest_llm import texts_of
from martspark.llm import jaccard_join as J
from martspark.llm.shingles import shingle_set, word_hashes


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(200)}" for _ in range(n)]


def edited(rng, base, k):
    out = list(base)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10_000)}"
    return " ".join(out)


def brute(rows, threshold=0.8):
    """Links, classes of connected documents and of equal sets, from all pairs."""
    h = word_hashes()
    sets = [set(shingle_set(t, h).tolist()) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and both >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min(low.get(r, (d is not None, d)), (d is not None, d), key=lambda x: (x[0], x[1] or 0))
    return sorted(((d, low[find(i)][1], links[i]) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    passage = " ".join(words(rng, 60))
    rows = [(i, " ".join(words(rng, rng.randrange(1, 120)))) for i in range(60)]
    rows += [(100 + i, f"{passage} {' '.join(words(rng, 90))}") for i in range(40)]  # share a passage
    base = words(rng, 120)
    rows += [(200 + i, edited(rng, base, i % 4)) for i in range(40)]                # a near group
    for g in range(15):                                                            # pairs near 0.8
        base = words(rng, 100)
        rows += [(300 + 2 * g, " ".join(base)), (301 + 2 * g, edited(rng, base, 1 + g % 4))]
    return rows


@pytest.mark.parametrize("limit,depth,leaf,block", [(1024, 8, 8192, 4096), (4, 3, 5, 7), (2, 0, 3, 2)])
def test_equals_all_pairs(make_docs, corpus, limit, depth, leaf, block):
    df = J.near_duplicates(make_docs(corpus), recall=0.999999, limit=limit, max_depth=depth,
                           leaf_block=leaf, block=block)
    assert got(df) == brute(corpus)


def test_odd_rows(odd):
    assert got(J.near_duplicates(odd)) == brute(texts_of(odd))


def test_empty(empty, make_docs):
    assert J.near_duplicates(empty).collect() == []
    assert got(J.near_duplicates(make_docs([(1, None), (2, "")]))) == [(1, 1, 0), (2, 2, 0)]


def test_keep_first_leaves_one_of_each_group(make_docs, odd, corpus):
    docs = make_docs(corpus)
    out = J.keep_first(docs)
    assert out.columns == docs.columns
    assert sorted(i for i, _ in texts_of(out)) == sorted({c for _, c, _ in brute(corpus)})
    kept = texts_of(J.keep_first(odd))
    assert sorted(kept, key=str) == sorted(
        [(1, None), (2, ""), (3, "  \n\t "), (4, odd.where("doc_id = 4").first().text),
         (5, "same text here"), (7, "one"), (8, "café \U0001F600 naïve"),
         (None, "no id at all"), (0, "zero\x00byte <|endoftext|> it's")], key=str)


def test_runs_reach_the_recall():
    assert J.runs_for(0.999, 0.8) == 3 and J.runs_for(0.9, 0.8) == 1
    assert J.runs_for(0.999999, 0.8) > 3


@pytest.mark.parametrize("split", [False, True])
def test_overlaps(split):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(50)]
    left, right = (sets[:20], sets[20:]) if split else (sets, None)
    found = J.overlaps(left, right, light=6, width=7)
    for i, a in enumerate(left):
        for j, b in enumerate(right or left):
            if split or i != j:
                assert found[i, j] == len(np.intersect1d(a, b))
