"""The numpy helpers against plain Python."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from starling.llm import exchange, words
from starling.llm.jaccard import jaccard_join
from starling.llm.letters import Words, code_values, gram_ends, padded
from starling.llm.lm_score import lm_scores
from starling.llm.substring import dedup_substrings

TEXTS = st.lists(st.none() | st.text("ab \n\té日\x00 ", max_size=30), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([1, 20, 1000]), st.sampled_from([pa.string(), pa.large_string()]))
def test_spans_and_hashes(texts, size, kind):
    seen = {}
    covered = 0
    for piece in words.pieces(pa.array(texts, kind), size):
        starts, ends, bounds = words.spans(piece, words.NOT_SPACE)
        hashes = words.hash_spans(piece.data, starts, ends)
        for i in range(len(piece)):
            want = (texts[piece.first + i] or "").encode().split()
            a, b = bounds[i], bounds[i + 1]
            assert [bytes(piece.data[x:y]) for x, y in zip(starts[a:b], ends[a:b], strict=True)] == want
            for word, value in zip(want, hashes[a:b], strict=True):
                assert seen.setdefault(word, value) == value
            covered += 1
    assert covered == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_place_or_segment(monkeypatch):
    text = ("word " * 50 + "x" * 300 + " word").encode()
    data = np.frombuffer(text, np.uint8)
    piece = words.Piece(data, np.array([0, len(data)]), 0)
    starts, ends, _ = words.spans(piece, words.NOT_SPACE)
    whole = words.hash_spans(data, starts, ends)
    assert len(set(whole.tolist())) == 2
    monkeypatch.setattr(words, "SEGMENT", 64)
    parts = words.hash_spans(data, starts, ends)
    assert len(set(parts.tolist())) == 2 and parts[0] == whole[0]


def test_run_starts():
    bounds = np.array([0, 3, 3, 4, 9])
    assert words.run_starts(bounds, 3).tolist() == [True] + [False] * 3 + [True, True, True, False, False]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=50), st.integers(1, 7))
def test_packing_round_trip(values, slices):
    keys = np.unique(np.array(values, dtype=np.uint64))
    assert (exchange.unpack(exchange.pack(keys)) == keys).all()
    numbers = np.array(values, dtype=np.uint64)
    assert (exchange.unpack_counts(exchange.pack_counts(numbers)) == numbers).all()
    edges = exchange.cut(keys, slices, 64)
    assert edges[0] == 0 and edges[-1] == len(keys) and (np.diff(edges) >= 0).all()


def test_letter_words_and_grams():
    random.seed(1)
    texts = ["Ünï code, x1y", None, "", "日本 ABC"]
    found = Words(texts)
    spelled = ["".join(map(chr, found.codes[a:b])) for a, b in zip(found.starts, found.ends, strict=True)]
    assert spelled == ["ünï", "code", "x", "y", "日本", "abc"]
    assert found.bounds.tolist() == [0, 4, 4, 4, 6]
    flat, bounds = padded(found.codes, found.starts, found.ends, 2, 1)
    assert np.diff(bounds).tolist() == [len(w) + 3 for w in spelled]
    grams = gram_ends(flat, 3)
    again = gram_ends(np.concatenate([[9, 9], flat]).astype(np.uint32), 3)
    assert (grams[2:] == again[4:]).all()


def thue_morse(length: int) -> str:
    return "".join("ab"[bin(i).count("1") % 2] for i in range(length))


def test_words_that_collide_in_polynomials_do_not_here():
    for length in (64, 1024, 4096, 1 << 19):
        word = thue_morse(length)
        other = word.translate(str.maketrans("ab", "ba"))
        data = np.frombuffer((word + other).encode(), np.uint8)
        starts, ends = np.array([0, length]), np.array([length, 2 * length])
        assert len(set(words.hash_spans(data, starts, ends).tolist())) == 2
        assert len(set(words.hash_spans(data.astype(np.uint32), starts, ends, code_values).tolist())) == 2


def test_no_window_or_shingle_is_shared_by_such_words(spark):
    word = thue_morse(1024)
    other = word.translate(str.maketrans("ab", "ba"))
    tail = "b c d e f g h i j k l m"
    docs = spark.createDataFrame([(1, f"{word} {tail}"), (2, f"{other} {tail}")], "doc_id long, text string")
    assert [r.n_removed for r in dedup_substrings(docs).collect()] == [0, 0]
    pair = spark.createDataFrame([(1, f"{word} x y"), (2, f"{other} x y")], "doc_id long, text string")
    found = jaccard_join(pair, n=3, num=90, den=100).select("doc_id", "component_id")
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1), (2, 2)]
    first = lm_scores(docs).filter("doc_id = 1").first()
    twice = lm_scores(docs.union(docs.filter("doc_id = 1"))).filter("doc_id = 1").first()
    assert first.log_score != twice.log_score
