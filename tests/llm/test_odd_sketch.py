"""Near-duplicates by odd sketches (op13)."""

import itertools
import random

import numpy as np
import pytest

from conftest import LONG
from martspark.llm import odd_sketch as O


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in low:
        if c in " \t\n\x0b\x0c\r":
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out + [word] * bool(word)


def plain_set(text):
    w = words_of(text)
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}


def brute(rows):
    sets, parent = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)), d == low.get(find(i)))
                   for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(3)
    some = lambda n: [f"{rng.choice('abcdef')}{rng.randrange(300)}" for _ in range(n)]

    def edited(base, k):
        out = list(base)
        for _ in range(k):
            out[rng.randrange(len(out))] = f"Z{rng.randrange(9999)}"
        return " ".join(out)

    rows = [(i, " ".join(some(rng.randrange(1, 90)))) for i in range(50)]
    family = some(150)
    rows += [(100 + i, edited(family, i % 5)) for i in range(90)]      # one large near group
    chain = some(200)
    for i in range(25):                                               # each like the next only
        rows.append((300 + i, " ".join(chain)))
        chain = chain[6:] + some(6)
    for g in range(30):                                               # pairs near the threshold
        base = some(100)
        rows += [(400 + 2 * g, " ".join(base)), (401 + 2 * g, edited(base, 1 + g % 6))]
    rows += [(600 + i, rows[3][1]) for i in range(4)]
    return rows


@pytest.mark.parametrize("block,group", [(2048, 8192), (16, 8192), (2048, 1), (16, 1), (16, 20)])
def test_equals_brute_force(make_docs, monkeypatch, block, group):
    monkeypatch.setattr(O, "BLOCK", block)
    monkeypatch.setattr(O, "GROUP", group)  # larger groups take rounds
    rows = corpus()
    assert got(O.near_duplicates(make_docs(rows))) == brute(rows)


def test_narrow_proposals_hold_nothing_back_at_the_end(make_docs, monkeypatch):
    monkeypatch.setattr(O, "GROUP", 0)
    monkeypatch.setattr(O, "MOST_ODD", O.BITS)  # every pair that meets is a candidate, most are rejected
    rows = corpus()
    assert got(O.near_duplicates(make_docs(rows), start_width=1)) == brute(rows)


ODD = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, LONG), (5, "Same text here"), (6, "sAME text\there"),
       (6, "same text here"), (7, "one"), (8, "ONE"), (9, "Été a b c"), (10, "été a b c"),
       (11, " "), (12, " "), (13, "a b c d e"), (14, "a b c d e"), (15, LONG),
       (None, "no id at all"), (None, "no id at all"), (16, "no id at all"), (None, None), (None, "alone, no id"),
       (17, "a\x1cb c"), (18, "a b c")]


def test_odd_rows(make_docs):
    want = [(d, n, c, (d is None and c is None) or k) for d, n, c, k in brute(ODD)]
    assert got(O.near_duplicates(make_docs(ODD))) == sorted(want, key=str)


def test_empty_table(empty):
    out = O.near_duplicates(empty)
    assert out.columns == ["doc_id", "text_id", "n_shingles", "component_id", "kept"] and not out.collect()


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.75, 0.8, 0.9, 0.97):
        n = 4000
        same = int(2 * n * share / (1 + share))
        base = rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64)
        a, b = base[:n], np.concatenate([base[:same], base[n:2 * n - same]])
        x, y = (O.odd_sketch(O.samples(s)) for s in (a, b))
        odd = int(np.bitwise_count(x ^ y).sum())
        assert O.estimated_share(odd) == pytest.approx(share, abs=0.08)
        assert share < 0.8 or odd <= O.MOST_ODD
