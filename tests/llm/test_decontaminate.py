import random

import pytest

from martspark.llm import decontaminate as D

ITEM = "The quick brown fox jumps over the lazy dog while seven wizards quietly box the jury of sphinxes."


def distance(pattern, text):
    """Smallest edit distance to any substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        prev, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (p != t))
    return min(row)


def noisy(rng, text, k):
    out = list(text)
    for _ in range(k):
        i = rng.randrange(len(out))
        rng.choice([lambda: out.insert(i, "q"), lambda: out.pop(i),
                    lambda: out.__setitem__(i, "#")])()
    return "".join(out)


def test_myers_equals_the_table():
    rng = random.Random(2)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 120)))
        assert D.myers(p, t) == distance(p, t)


def test_pieces_cover_the_item():
    for n in (1, 2, 12, 13, 95, 400):
        spans = D.pieces(n)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a < b for a, b in spans)
        assert len(spans) == min(int(D.RATE * n), n - 1) + 1


@pytest.mark.parametrize("block", [D.BLOCK_CHARS, 60])
def test_equals_brute_force(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_CHARS", block)
    rng = random.Random(9)
    other = "Pack my box with five dozen liquor jugs, then sail to the island before winter comes again."
    fill = lambda n: " ".join(rng.choice(["the", "lazy", "sail", "fox", "winter", "box"])
                              for _ in range(n))
    rows = []
    for i in range(60):
        k = i % 12
        rows.append((i, f"{fill(20)} {noisy(rng, ITEM if i % 2 else other, k)} {fill(15)}"))
    rows += [(100, ITEM.upper().replace(" ", " \n ")), (101, fill(400)), (102, None), (103, ""),
             (104, ITEM[:60]), (104, ITEM[:60]), (105, fill(20_000) + other), (None, ITEM)]
    items = [(1, ITEM), (2, other), (3, None), (4, "  "), (5, ITEM), (None, fill(9))]
    docs = make_docs(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {}
    for r in D.with_matches(docs, bench, "items").collect():
        found.setdefault((r.doc_id, r.text), []).append([(h.item_id, h.distance) for h in r["items"]])
    assert sum(map(len, found.values())) == len(rows)
    for doc, text in rows:
        norm = D.normal(text)
        want = [] if len(norm) > 5000 else [
            (i, d) for i, t in items if t and t.strip() and i is not None and norm
            for d in [distance(D.normal(t), norm)] if d <= int(D.RATE * len(D.normal(t)))]
        want = [(2, 0)] if doc == 105 else want
        assert all(sorted(x) == sorted(want) for x in found[doc, text])
    clean = D.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} >= {101, 102, 103, 104}


def test_empty(spark, odd, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(odd, bench).count() == odd.count()
    some = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert D.with_matches(empty, some, "items").collect() == []


def test_short_items_match_whole_words_only(spark):
    items = [(1, "the"), (2, "a"), (3, "Art"), (4, "c++"), (5, "quick fox")]
    find = lambda text: [h["item_id"] for h in D.Matcher([(i, D.normal(t)) for i, t in items], D.RATE).find(text)]
    assert find("Weather and start, partial panther") == []
    assert find("The art of C++.") == [1, 3, 4]
    assert find("a") == [2] and find("quick foxes, a quick  FOX") == [2, 5]
    docs = spark.createDataFrame([(1, "a long text about the art of war"), (2, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.with_matches(docs, bench, "m", min_chars=3).collect()
    assert [[h.item_id for h in r.m] for r in rows] == [[1, 3], []]
