"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None, lower: bool = False) -> list[str]:
    found = WORDS.findall(text or "")
    return [w.translate(UPPER) for w in found] if lower else found


def shingles(text: str | None, n: int) -> frozenset:
    w = words(text, lower=True)
    if not w:
        return frozenset()
    if len(w) < n:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def jaccard_components(docs: dict[int, str | None], n: int, num: int, den: int) -> dict[int, tuple[int, int, int]]:
    """doc_id -> (set size, links, component)."""
    sets = {d: shingles(t, n) for d, t in docs.items()}
    ids = sorted(docs)
    links = {d: set() for d in ids}
    sizes = sorted((len(sets[d]), d) for d in ids if sets[d])
    for x, (small, a) in enumerate(sizes):
        for large, b in sizes[x + 1 :]:
            if small * den < num * large:
                break
            common = len(sets[a] & sets[b])
            if den * common >= num * (small + large - common):
                links[a].add(b)
                links[b].add(a)
    name: dict[int, int] = {}
    for d in ids:
        if d in name:
            continue
        stack = [d]
        while stack:
            x = stack.pop()
            if x not in name:
                name[x] = d
                stack += links[x]
    return {d: (len(sets[d]), len(links[d]), name[d]) for d in ids}


def substring_dedup(docs: list[tuple[int | None, str | None]], window: int) -> list[tuple[int, int, str]]:
    """(words, removed, kept words joined) of each row."""
    first: dict[tuple, int] = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text: str | None) -> list[str]:
    return ITEM_WORDS.findall((text or "").translate(UPPER))


def decontaminate(docs: list[tuple], items: list[tuple], window: int) -> list[tuple[int, int, list[str]]]:
    """(words, hit words, items) of each row."""
    wanted: dict[tuple, set] = {}
    for item, text in items:
        w = item_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    lengths = {len(k) for k in wanted}
    out = []
    for _, text in docs:
        w = item_words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                key = tuple(w[i : i + n])
                if key in wanted:
                    hit |= set(range(i, i + n))
                    found |= wanted[key]
        out.append((len(w), len(hit), sorted(found)))
    return out


def quality_signals(text: str | None) -> tuple[int, int, int, int, int]:
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    grams: dict[tuple, list[int]] = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def least_capacity(sizes: list[int], shards: int) -> int:
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, filled = (low + high) // 2, 1, 0
        for size in sizes:
            if filled + size > middle:
                used, filled = used + 1, 0
            filled += size
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def lm_scores(texts: list[str | None], order: int, backoff: float, least: int) -> list[float]:
    import math
    from collections import Counter

    split = [words(t, lower=True) for t in texts]
    counts = Counter(tuple(w[i : i + n]) for w in split for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, split))
    out = []
    for w in split:
        score = 0.0
        for k in range(len(w)):
            factor, value = 1.0, None
            for n in range(min(order, k + 1), 1, -1):
                gram = tuple(w[k - n + 1 : k + 1])
                if counts[gram] >= least:
                    value = counts[gram] / counts[gram[:-1]]
                    break
                factor *= backoff
            score += math.log(factor * (counts[(w[k],)] / total if value is None else value))
        out.append(score)
    return out


def best_path(text: str | None, table: dict[str, tuple[int, float]], byte_zero: int) -> tuple[list[int], float]:
    """Ids and score of the best segmentation of a whole text."""
    if not text:
        return [], 0.0
    worst, longest = min(s for _, s in table.values()), max(map(len, table))
    text = " " + text
    best, back = [0.0], [(0, [])]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            if piece in table:
                options.append((best[start] + table[piece][1], -start, [table[piece][0]]))
            elif end == start + 1:
                raw = piece.encode()
                options.append((best[start] + len(raw) * (worst - 10), -start, [byte_zero + b for b in raw]))
        score, start, ids = max(options, key=lambda o: o[:2])
        best.append(score)
        back.append((-start, ids))
    out, at = [], len(text)
    while at:
        at, ids = back[at]
        out = ids + out
    return out, best[-1]
