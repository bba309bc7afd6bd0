"""Source mixing against a plain version with exact fractions and a full sort."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from starling.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, taken string, hash string, need int, edge string"
CASES = {
    "plain": [(i, "w " * (i % 37), f"s{i % 5}") for i in range(200)],
    "hot source": [(i, "w " * (1 + i % 9), "hot" if i % 3 else f"s{i % 11}") for i in range(300)],
    "nulls": [(1, None, None), (2, "", "a"), (None, "x y z", None), (3, " \t\n", "é"), (4, "q\x0bw\x1cé 日本", "z"), (5, "p", "Z")],
    "long": [(0, "long " * 30000, "a"), *[(i, "b c", "a") for i in range(1, 50)], (90, "d " * 900, "b"), (91, "e", "c")],
    "equal rows": [(7, "same words here", "a")] * 40 + [(None, "null id", None)] * 40 + [(i, "t " * 50, "b") for i in range(30)],
    "caps": [(i, "w " * (1 if i % 50 else 2000), f"s{i % 100:03}") for i in range(300)],
    "wordless": [(1, None, "a"), (2, "", "b")],
    "none": [],
}


def targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = sum(sizes.values()), set()
    while True:
        rest = budget - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = {s: Fraction(rest * weight[s], sum(weight[x] for x in free)) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return share | {s: Fraction(most * sizes[s]) for s in capped}
        capped |= over


@pytest.mark.parametrize("case", list(CASES))
def test_mix_follows_targets(spark, case):
    rows = CASES[case]
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame([(a, b, c, "x", "y", "z", 1, "e") for a, b, c in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in mixing.mix_sources(docs).collect()]
    again = [tuple(r) for r in mixing.mix_sources(docs.repartition(5)).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(again, key=key)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    wanted = sorted([(a, c, size(b)) for a, b, c in rows], key=key)
    assert sorted([r[:3] for r in got], key=key) == wanted
    sizes: dict = defaultdict(int)
    for _, source, n in wanted:
        sizes[source] += n
    target = targets(sizes) if rows and sum(sizes.values()) else dict.fromkeys(sizes, 0)
    taken: dict = defaultdict(int)
    for _, source, n, source_size, aim, take in got:
        assert source_size == sizes[source]
        assert aim == pytest.approx(float(target[source]), rel=1e-12)
        assert take in (0, n, 2 * n, 3 * n)
        taken[source] += take
    for source in sizes:
        longest = max(n for _, s, n in wanted if s == source)
        assert abs(taken[source] - target[source]) <= Fraction(longest, 2) + Fraction(1, 2)


def test_thresholds_are_nested(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), f"s{i % 3}") for i in range(400)], "doc_id long, text string, source string")
    small = {r.doc_id: r.taken for r in mixing.mix_sources(docs, budget=600).collect()}
    large = {r.doc_id: r.taken for r in mixing.mix_sources(docs, budget=900).collect()}
    assert all(large[i] >= small[i] for i in small)
    assert sum(large.values()) > sum(small.values())
