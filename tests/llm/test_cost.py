"""What the operators spend: repeated work, and memory that a Python worker keeps."""

from __future__ import annotations

import gc
import os

import numpy as np
import psutil
import pyarrow as pa

from starling.llm import common, token_files


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_parts_of_texts_are_encoded_once():
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join(f"{a}{a},{b}{b}" for b in letters) for a in letters]
    own = token_files.Encoder(byte_tokenizer())
    plain = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [list(ids) for ids in own.encode(texts)] == [e.ids for e in plain]
    # "xx", " xx" and ",", not each of the 676 words between white space.
    assert len(own.places) == 2 * len(letters) + 1


def test_chunks_and_parts_share_what_is_remembered():
    texts = ["a's  b", "中 a's  b", " '", "''s 中", "  \n", "x<|endoftext|> a's", "é\x85é"]
    own = token_files.Encoder(byte_tokenizer())
    plain = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [list(ids) for ids in own.encode(texts)] == plain
    assert [list(ids) for ids in own.encode(texts[::-1])] == plain[::-1]


def test_symbols_that_repeat_are_expanded_once():
    rules = np.array([[1, 2], [100, 3], [101, 101]])
    symbols = np.array([102] * 50 + [7, 100, 101])
    want = [1, 2, 3, 1, 2, 3] * 50 + [7, 1, 2, 1, 2, 3]
    given, seen = rules, []

    class Rules(np.ndarray):
        def __getitem__(self, key):
            first = key[0] if isinstance(key, tuple) else key
            seen.append(np.size(first))
            return np.asarray(self)[key]

    assert token_files.expand(symbols, given.view(Rules), 100).tolist() == want
    assert sum(seen) < len(symbols)
    assert token_files.expand(symbols[:0], given, 100).tolist() == []
    assert token_files.expand(np.array([5, 6]), given[:0], 100).tolist() == [5, 6]


def test_freed_memory_leaves_the_worker():
    def resident() -> int:
        return psutil.Process(os.getpid()).memory_info().rss >> 20

    def run(table: pa.Table) -> pa.Table:
        held = [np.ones(8000, np.uint8) for _ in range(20_000)]  # 160 MB in blocks that malloc keeps
        kept.extend(held[::400])
        return table

    kept: list[np.ndarray] = []
    table = pa.table({"a": [1]})
    common.give_back()
    gc.collect()
    before = resident()
    run(table)
    held = resident()
    assert common.tidy(run)(table) is table
    assert held - before > 80 and resident() - before < 60
    assert common.tidy_pair(lambda left, right: right)(None, table) is table
