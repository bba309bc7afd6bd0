"""Phrase mining against counts of all n-grams, and the graph's paths against a plain walk."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starling.llm import phrases

SCHEMA = "text string, lang string, gram string, f string, n int, phrase string, w array<int>, words string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def count(rows, longest):
    f = defaultdict(Counter)
    for text, lang in rows:
        for words in pieces(text):
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    f[lang or "und" if lang is None else lang][tuple(words[i : i + n])] += 1
    return f


def brute(rows, longest=3, min_count=10, percent=50, top=2000):
    out = []
    for lang, f in count(rows, longest).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        often = {g: a for g, a in f.items() if 2 <= len(g) and a >= min_count}
        best = Counter()
        for g, a in often.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    best[g[i : i + size]] = max(best[g[i : i + size]], a)
        kept = []
        for g, a in often.items():
            if 100 * best[g] >= percent * a:
                continue
            score, _, l, r = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["the", "The", "of", "é", "Ä", "日本", "\xa0x", "a'b", "_", "q\x1cz", *[f"w{i}" for i in range(25)]]
    out = [(None, "en"), ("", "en"), (" \t ,;.", "xx"), ("one", "yy"), ("same word " * 30, None), ("aa " * 4000, "zz")]
    chain = " ".join(f"c{i}" for i in range(300))
    for i in range(14):
        out.append((f"start{i % 3} {chain}, tail {chain[:40]}", "en"))
    for i in range(260):
        words = [rng.choice(vocabulary[: rng.choice([6, 35])]) for _ in range(rng.randrange(0, 40))]
        out.append(("".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", " ,"]) for w in words), "en" if i % 3 else rng.choice(["de", None, ""])))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(t, l, "g", "f", 1, "p", [1], "w") for t, l in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("longest,least,percent,top", [(3, 10, 50, 2000), (4, 4, 70, 15), (2, 10, 50, 2000)])
def test_phrases(spark, rows, longest, least, percent, top):
    got = phrases.mine_phrases(frame(spark, rows), longest, least, percent, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, longest, least, percent, top)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**12 + 7
    candidates = spark.createDataFrame([("en", "a b", big, False)], "lang string, gram string, f long, covered boolean")
    counts = {1: spark.createDataFrame([("en", "a", big + 11), ("en", "b", 5 * big + 3)], "lang string, gram string, f long")}
    row = phrases.scored(candidates, 2, counts).first()
    assert row.score == 10**6 * big * big // ((big + 11) * (5 * big + 3))


def test_empty_table(spark):
    assert phrases.mine_phrases(frame(spark, [])).collect() == []


def test_unary_paths(spark, rows):
    counts = phrases.gram_counts(phrases.longest_grams(frame(spark, rows)))
    plain = count(rows, 3)
    for n, table in counts.items():
        assert {(r.lang, r.gram): r.f for r in table.collect()} == {
            (lang, " ".join(g)): c for lang, f in plain.items() for g, c in f.items() if len(g) == n
        }
    edges = phrases._with_count(counts[3], phrases._first("gram", 2), counts[2], "out_f")
    edges = phrases._with_count(edges, phrases._last("gram", 2), counts[2], "in_f")
    paths = phrases.unary_paths(edges)
    got = {(r.lang, r.path): (r.f, r.edges) for r in paths.collect()}
    # Every edge is on one path, with the path's count, and no two paths could be joined.
    seen = Counter()
    for (lang, path), (f, n) in got.items():
        words = path.split(" ")
        assert len(words) == n + 2
        for i in range(n):
            assert plain[lang][tuple(words[i : i + 3])] == f
            seen[lang, " ".join(words[i : i + 3])] += 1
    assert seen == {(r.lang, r.gram): 1 for r in counts[3].collect()}
    begins = {(lang, tuple(p.split(" ")[:2])): (f, p) for (lang, p), (f, _) in got.items()}
    for (lang, path), (f, _) in got.items():
        node = tuple(path.split(" ")[-2:])
        follows = begins.get((lang, node))
        if follows and follows[0] == f == plain[lang][node]:
            assert follows[1] == path  # a path that returns to its own start
    longest = paths.orderBy(F.desc("edges")).first()
    assert longest.edges == 288 and longest.f == 14


def test_grams_are_shuffled_as_one_string(spark):
    """What the exchange carries: no gram in two parts."""
    grams = phrases.longest_grams(frame(spark, [("a b c d", "en")]))
    plan = grams._jdf.queryExecution().optimizedPlan().toString()
    sent = next(line for line in plan.splitlines() if "MapInArrow" in line)
    assert "gram#" in sent and "node#" not in sent and "next#" not in sent
    assert sorted((r.node, r.next, r.words, r.f) for r in grams.collect()) == [
        ("a b", "c", 3, 1), ("b c", "d", 3, 1), ("c d", None, 2, 1), ("d", None, 1, 1),
    ]
