"""Benchmark decontamination by pigeonhole edit matching.

An item of ``n`` characters may occur with up to ``k = rate * n`` edits.  It is
split into ``k + 1`` pieces, of which any such occurrence contains at least
one unchanged.  An Aho-Corasick automaton finds the exact piece hits in whole
texts; each hit fixes a diagonal, and the windows around an item's diagonals
are verified with Myers' bit-parallel distance.  Texts and items are compared
in lower case with runs of white space as one space.

The benchmark is read in blocks of at most ``BLOCK_CHARS`` characters; each
block's items are broadcast and matched against all documents in one pass
without a shuffle, and the passes' hits are joined row by row.  So the
broadcast is bounded however large the benchmark is.

An item without an error budget (up to 12 characters at the usual rate) matches whole words
only, so that "art" is not found in "start".  Items of fewer than ``min_chars``
characters are left out (default 1: none); every other one counts, however common
its words are.

Defined cases: a null or empty text is clean; null or blank items match
nothing; repeated items are reported by each id; repeated rows are judged
alike; an empty documents or benchmark table gives an empty or all-clean
result; other columns of the documents are kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import stored, table

RATE = 0.08
BLOCK_CHARS = 1 << 20

HITS = "array<struct<item_id:bigint,distance:int>>"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(n: int, rate: float = RATE) -> list[tuple[int, int]]:
    """Spans of ``k + 1`` pieces of nearly equal length."""
    k = min(int(rate * n), max(0, n - 1))
    cuts = [i * n // (k + 1) for i in range(k + 2)]
    return list(zip(cuts[:-1], cuts[1:]))


def myers(pattern: str, text: str) -> int:
    """Smallest edit distance between ``pattern`` and any substring of ``text``."""
    m = len(pattern)
    if not m:
        return 0
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        plus = down | (full & ~(diag | up))
        minus = up & diag
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        vert = eq | down
        up = minus | (full & ~(vert | plus))
        down = plus & vert
        best = min(best, score)
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, int(rate * len(t))) for i, t in items]
        at = defaultdict(list)
        for j, (_, t, _) in enumerate(self.items):
            for lo, hi in pieces(len(t), rate):
                at[t[lo:hi]].append((j, lo))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    @staticmethod
    def _whole(text: str, pattern: str) -> bool:
        """Whether ``pattern`` occurs in ``text`` with no letter or digit running on at its ends."""
        at = text.find(pattern)
        while at >= 0:
            end = at + len(pattern)
            if not (at and text[at - 1].isalnum() and pattern[0].isalnum()) and not (
                    end < len(text) and text[end].isalnum() and pattern[-1].isalnum()):
                return True
            at = text.find(pattern, at + 1)
        return False

    def find(self, raw: str | None) -> list[dict]:
        text = normal(raw)
        if self.empty or not text:
            return []
        starts = defaultdict(list)
        for end, (size, places) in self.automaton.iter(text):
            for j, offset in places:
                starts[j].append(end + 1 - size - offset)
        found = []
        for j, diagonals in starts.items():
            item, pattern, k = self.items[j]
            if not k:
                best = 0 if self._whole(text, pattern) else 1
            else:
                best = 0 if pattern in text else self._verify(text, pattern, k, sorted(diagonals))
            if best <= k:
                found.append({"item_id": item, "distance": best})
        return sorted(found, key=lambda h: h["item_id"])

    @staticmethod
    def _verify(text: str, pattern: str, k: int, diagonals: list[int]) -> int:
        """Smallest distance in the merged windows around the diagonals."""
        best, m = k + 1, len(pattern)
        lo = hi = None
        for d in [*diagonals, None]:
            if lo is not None and (d is None or d - k > hi):
                best = min(best, myers(pattern, text[lo:hi]))
                lo = None
            if d is not None:
                lo = max(0, d - k) if lo is None else lo
                hi = d + m + k
        return best


def _blocks(benchmark: DataFrame, min_chars: int = 1) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if len(text) >= max(1, min_chars) and row["item_id"] is not None:
            if block and size + len(text) > BLOCK_CHARS:
                yield block
                block, size = [], 0
            block.append((row["item_id"], text))
            size += len(text)
    if block:
        yield block


def _matches(block: Broadcast, rate: float):
    @F.pandas_udf(HITS)
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block.value, rate)
        for texts in batches:
            yield pd.Series([matcher.find(t) for t in texts])

    return matches


def with_matches(docs: DataFrame, benchmark: DataFrame, name: str,
                 rate: float = RATE, min_chars: int = 1) -> DataFrame:
    """``docs`` with a column ``name``: the items found, with their distances."""
    sc, out = docs.sparkSession.sparkContext, None
    for block in _blocks(benchmark, min_chars):
        matches = _matches(sc.broadcast(block), rate)
        if out is None:
            out = docs.withColumn(name, matches(F.col("text")))
        else:  # one automaton at a time
            out = stored(out, "matches").withColumn(name, F.concat(name, matches(F.col("text"))))
    return docs.withColumn(name, F.array().cast(HITS)) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents that contain no item."""
    return (with_matches(docs, benchmark, "__items", rate)
            .where(F.size("__items") == 0).drop("__items"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"), "items")
    return found.select(
        "doc_id", (F.size("items") > 0).alias("contaminated"),
        F.transform("items", lambda i: i["item_id"]).alias("item_ids"),
        F.array_min(F.transform("items", lambda i: i["distance"])).alias("distance"))
