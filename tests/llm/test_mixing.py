import random

from conftest_llm import texts_of
from martspark.llm import mixing as M


def targets_by_rounds(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Reshare the excess by weight, round by round, until none is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > cap * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return out


def check(docs, rows):
    import re
    size = {}
    src = {}
    for r in docs.select("doc_id", "text", "source").collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        size[r.source] = size.get(r.source, 0) + n
        src[r.doc_id] = r.source
    want = targets_by_rounds(size)
    taken = {}
    for r in rows:
        s = src[r.doc_id]
        assert r.source_size == size[s] and abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s in taken:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6


def test_odd_rows(odd):
    rows = M.mix(M.sized(odd)).collect()
    assert len(rows) == odd.count()
    check(odd, rows)


def test_hot_source_and_reruns(make_docs):
    rng = random.Random(3)
    docs = make_docs([(i, "w " * rng.randrange(60), f"s{i % 9}" if i % 3 else "hot") for i in range(900)])
    rows = M.mix(M.sized(docs)).collect()
    check(docs, rows)
    assert sorted(rows) == sorted(M.mix(M.sized(docs)).collect())


def test_documents_of_the_mix(make_docs):
    docs = make_docs([(i, f"a b c {i}", f"s{i % 4}") for i in range(200)])
    plan = {r.doc_id: r for r in M.mix(M.sized(docs)).collect()}
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    count = {}
    for i, _ in texts_of(out):
        count[i] = count.get(i, 0) + 1
    assert count == {i: -(-r.taken // r.size) for i, r in plan.items() if r.taken}


def test_empty(empty):
    assert M.mix(M.sized(empty)).collect() == []
    assert M.mixed_documents(empty).collect() == []
