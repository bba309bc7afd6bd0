"""Token alignment against a plain version that looks at every pair of tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from starling.llm import alignment
from starling.llm.alignment import Fragment, Tokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row string, code string, n_a string, chunk int, times array<int>"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["the", "tokenizer", "über", "naïve", "don't", "I'll", "x=1;", "日本語", "テキスト。", "\U0001f600", "1234567", "...", "http://a.b/c?d=e"]
    out = [
        None, "", " ", "  ", "\n", "a", " a", "a ", "a\n\nb", "\ta  b \t\n", "▁", "has ▁ mark", "<|endoftext|>", "<s> </s> <unk>", "<0x41>",
        "nul\x00byte", "a\u00a0b\u2003c\u3000d", "日本語の長い文章には空白がありません。" * 30, "x" * 700, "word " * 200, "   " * 150, "!?" * 300,
        "line\n" * 150, "\u0301e\u0301", "'s" * 100, "e=mc2,".join("abcde" * 20), "the same text", "the same text", "東京、" * 120,
    ]
    for _ in range(40):
        out.append("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "", ", ", "。"]) for _ in range(rng.randrange(1, 120))))
    return out


def plain(texts):
    """Rows of the contract by comparing all tokens of a document."""
    both = alignment.pair(A, B)
    documents, corpus = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = both.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = both.b.encode(text or "")
        sides = []
        for ids, names in ((a, both.a_bytes), (b, both.b_bytes)):
            ends = np.cumsum([len(names[i]) for i in ids]).tolist()
            sides.append(list(zip(ids, [0, *ends[:-1]], ends, strict=True)) if ids else [])
            if not text or b"".join(names[i] for i in ids) != whole:
                sides = None
                break
        if sides is None:
            documents.append(None)
            continue
        common = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
        groups, at = [], 0
        for c in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if at <= s and e <= c) for side in sides))
            at = c
        links = [(i, j) for i, s, e in sides[0] for j, t, f in sides[1] if s < f and t < e]
        corpus.update(links)
        documents.append((len(a), len(b), groups, links))
    top = Counter()
    for (_, j), n in corpus.items():
        top[j] = max(top[j], n)
    out = []
    for d in documents:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        best, total = sum(corpus[x] == top[x[1]] for x in links), sum(corpus[x] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, total, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunk", [alignment.CHUNK_BYTES, 40, 250])
def test_alignment(spark, texts, chunk):
    ids = [None if i % 9 == 4 else i // 2 for i in range(len(texts))]
    rows = [(i, t, "r", "c", "n", 1, [1]) for i, t in zip(ids, texts, strict=True)]
    got = alignment.align(spark.createDataFrame(rows, SCHEMA).repartition(3), A, B, chunk_bytes=chunk)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *row) for i, row in zip(ids, plain(texts), strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), A, B).collect() == []


def test_ranges_begin_where_tokens_begin(texts):
    both = alignment.pair(A, B)
    moved = 0
    for text in filter(None, texts):
        parts = alignment.ranges(both, " " + text, 30)
        assert "".join(p[1] for p in parts) == "".join(p[3] for p in parts) == " " + text
        a, b = both.a_encode([p[1] for p in parts]), both.b_encode([p[3] for p in parts])
        assert sum(a, []) == both.a_encode([" " + text])[0]
        if "▁" not in text:
            assert sum(b, []) == both.b_encode([" " + text])[0]
        moved += sum(p[0] != p[2] for p in parts)
    assert moved > 20  # the two tokenizers are cut at different places


def random_tokens(rng, total):
    ends = np.array(sorted(rng.sample(range(1, total), rng.randrange(0, total // 2)) + [total]), np.int64)
    return Tokens(np.array([rng.randrange(1, 10**rng.randrange(1, 6)) for _ in ends], np.int64), ends)


def fields(f):
    opens = [(t.ids.tolist(), t.ends.tolist()) for t in (f.a_head, f.b_head, f.a_tail, f.b_tail)]
    return f.valid, f.cut, opens, f.groups, f.n_a, f.n_b, f.n_groups, f.codes.tolist(), f.times.tolist()


def test_fragments_are_associative():
    rng = random.Random(2)
    for _ in range(300):
        total = rng.randrange(6, 60)
        whole = [random_tokens(rng, total) for _ in range(2)]
        cuts = sorted(rng.randrange(0, total) for _ in range(3))
        parts = []
        for k in range(4):
            sides = []
            for side in whole:
                # Tokens that begin in the range, as the tokenizers' own cuts leave them.
                starts = np.concatenate([[0], side.ends[:-1]])
                low, high = ([-1, *cuts][k], [*cuts, total][k])
                own = (starts > low) & (starts <= high)
                sides.append(Tokens(side.ids[own], side.ends[own]))
            parts.append(Fragment.of(*sides, k == 0))
        a, b, c, d = parts
        want = fields(Fragment.of(*whole, True))
        assert fields(((a * b) * c) * d) == fields(a * (b * (c * d))) == fields((a * b) * (c * d)) == want
