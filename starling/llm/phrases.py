"""Phrase collocations from a weighted de Bruijn graph of the corpus.

The longest n-grams are the edges of the graph, the (n-1)-grams its nodes. Tasks count the edges of
their texts and, at the end of every piece, the shorter suffixes that no longer n-gram starts with; one
exchange by node adds them up. All shorter counts follow from the flow: a node occurs as often as the edges leaving it, plus the pieces
that end in it; and so on down to words. No shorter n-gram is counted in the texts.

Where a node has one edge in and one out and no piece starts or ends in it, both edges occur
equally often; such unary paths are compacted by pointer doubling (about log2 of the longest path
rounds) to one row each. Every phrase inside a path but its border nodes has the path's count, so
whether a longer candidate covers a shorter one is read from the paths.

Scores are whole numbers of up to 38 digits. Defined results: texts and pieces without a word count
nothing; a missing language is `und`; repeated rows count each time; other columns are not
looked at; an empty table has no phrases. A frequent word or phrase is one row per map task before
the shuffle, and one row after it. A phrase is its words joined by one space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.ranking import top_n
from starling.llm.common import discard, saved
from starling.llm.registry import query
from starling.llm.words import LOWER, byte_table, pieces, spans

#: Bytes that end a piece, and those of words.
BREAK = byte_table(b".,;:!?\n\x0b\x0c\r")
WORD = byte_table(b" \t.,;:!?\n\x0b\x0c\r", inverse=True)
#: Distinct grams that a task counts before it hands them on.
TASK_GRAMS = 6_000_000
LANG, GRAM = "lang", "gram"


def _first(gram: str, words: int) -> Column:
    return F.substring_index(gram, " ", words)


def _last(gram: str, words: int) -> Column:
    return F.substring_index(gram, " ", -words)


class _Tally:
    """Counts of one language's longest n-grams and piece ends, for one task.

    A word has a number from 1 on; a gram is its numbers side by side in one 64-bit key, 0 past its end.
    """

    def __init__(self, longest: int):
        self.longest, self.bits = longest, 62 // longest
        self.numbers: dict[bytes, int] = {}
        self.keys, self.counts = [], []

    def full(self) -> bool:
        return len(self.numbers) > (1 << self.bits) * 3 // 4 or sum(map(len, self.keys)) > TASK_GRAMS

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, follows: np.ndarray) -> Iterator[None]:
        """Words given by their bytes; `follows` says which words stand in the piece of the word before.

        Goes on in stretches that bring few new words; the caller empties the tally between them.
        """
        step = (1 << self.bits) // 8
        tail = self.longest - 1
        for at in range(0, len(starts), step):
            end = min(at + step + tail, len(starts))
            a, b = starts[at:end], ends[at:end]
            sizes = b - a
            edges = np.concatenate([[0], np.cumsum(sizes)])
            body = data[np.arange(edges[-1]) + np.repeat(a - edges[:-1], sizes)]
            buffers = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(body)]
            kinds = pa.Array.from_buffers(pa.binary(), len(a), buffers).dictionary_encode()
            numbers = self.numbers
            own = np.array([numbers.setdefault(w, len(numbers) + 1) for w in kinds.dictionary.to_pylist()], np.int64)
            codes = np.concatenate([own[kinds.indices.to_numpy()], np.zeros(tail, np.int64)])
            inside = np.concatenate([follows[at:end], np.zeros(tail, bool)])
            own_places = min(step, len(starts) - at)
            key, open_ = codes[:own_places].copy(), np.ones(own_places, bool)
            for k in range(1, self.longest):
                open_ &= inside[k : k + own_places]
                key = key << self.bits | np.where(open_, codes[k : k + own_places], 0)
            kinds, times = np.unique(key, return_counts=True)
            self.keys.append(kinds)
            self.counts.append(times)
            if len(self.keys) > 8:
                self._merge()
            yield

    def _merge(self) -> None:
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        self.keys, self.counts = [keys], [np.bincount(place, np.concatenate(self.counts)).astype(np.int64)]

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        """(lang, words, f, gram) of everything counted, which is then forgotten."""
        if not self.keys:
            return
        self._merge()
        names = pa.array([None, *self.numbers], pa.binary()).cast(pa.string())
        keys, counts = self.keys[0], self.counts[0]
        self.numbers, self.keys, self.counts = {}, [], []
        for at in range(0, len(keys), 100_000):
            key, mask = keys[at : at + 100_000], (1 << self.bits) - 1
            codes = [key >> self.bits * (self.longest - 1 - k) & mask for k in range(self.longest)]
            parts = [names.take(pa.array(c)) for c in codes]
            gram = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
            words = sum((c > 0).astype(np.int32) for c in codes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(key)), pa.array(words), pa.array(counts[at : at + 100_000]), gram],
                ["lang", "words", "f", "gram"],
            )


def longest_grams(docs: DataFrame, longest: int = 3, text: str = "text") -> DataFrame:
    """(lang, node, next, words, f): every `longest`-gram as its first words and its last, and of every
    piece the shorter suffixes, which have no `next`; counted by task.

    The rows of a node are in one partition. A gram goes there as one string, which is smaller than its parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, _Tally] = {}
        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                tally = tallies.setdefault(lang, _Tally(longest))
                own = batch.column("text").filter(pc.equal(langs, lang))
                for piece in pieces(own):
                    data = LOWER[piece.data]
                    starts, ends, bounds = spans(piece, WORD)
                    breaks = np.cumsum(BREAK[data], dtype=np.int32)
                    at = breaks[starts] if len(starts) else np.zeros(0, np.int32)
                    follows = np.append(False, at[1:] == at[:-1]) if len(at) else np.zeros(0, bool)
                    follows[bounds[:-1][bounds[:-1] < len(starts)]] = False
                    for _ in tally.add(data, starts, ends, follows):
                        if tally.full():
                            yield from tally.rows(lang)
            if sum(sum(map(len, t.keys)) for t in tallies.values()) > TASK_GRAMS:
                for lang, tally in tallies.items():
                    yield from tally.rows(lang)
                tallies = {}
        for lang, tally in tallies.items():
            yield from tally.rows(lang)

    texts = docs.select(F.coalesce(F.col(LANG).cast("string"), F.lit("und")).alias(LANG), F.col(f"`{text}`").alias("text"))
    counted = texts.mapInArrow(run, "lang string, words int, f long, gram string")
    node = _first(GRAM, longest - 1)
    after = F.when(F.col("words") == longest, _last(GRAM, 1))
    return counted.repartition(F.col(LANG), node).select(LANG, node.alias("node"), after.alias("next"), "words", "f")


def gram_counts(grams: DataFrame, longest: int = 3, min_count: int = 1) -> dict[int, DataFrame]:
    """Tables (lang, gram, f) by number of words, each from the flow of the longer one.

    Of the longest only those of `min_count`; one written table comes from one exchange of `grams`.
    """
    whole = grams.groupBy(LANG, "node", "next", "words").agg(F.sum("f").alias("f"))
    # Conditions on the sums stay above the exchange, so both branches read the same one.
    kept = F.when(F.col("words") == longest, F.col("f") >= min_count).otherwise((F.col("words") < longest - 1) & (F.col("f") > 0))
    edges = whole.filter(kept).select(LANG, F.concat_ws(" ", "node", "next").alias(GRAM), "words", "f")
    leaving = F.sum(F.when(F.col("words") >= longest - 1, F.col("f"))).alias("f")
    flow = grams.groupBy(LANG, "node").agg(leaving).filter(F.col("f").isNotNull())
    flow = flow.select(LANG, F.col("node").alias(GRAM), F.lit(longest - 1).alias("words"), "f")
    table = saved(edges.unionByName(flow), "phrases-longest")
    counts = {n: table.filter(F.col("words") == n).drop("words") for n in (longest, longest - 1)}
    for words in range(longest - 2, 0, -1):
        ends = table.filter(F.col("words") == words).drop("words")
        flow = counts[words + 1].select(LANG, _first(GRAM, words).alias(GRAM), "f").unionByName(ends)
        counts[words] = saved(flow.groupBy(LANG, GRAM).agg(F.sum("f").alias("f")), f"phrases-{words}")
    return counts


def _with_count(rows: DataFrame, part: Column, counts: DataFrame, out: str) -> DataFrame:
    """`out`: the count of the phrase `part` of each row; every part of a phrase is in `counts`."""
    named = counts.select(F.col(LANG).alias("_lang"), F.col(GRAM).alias("_gram"), F.col("f").alias(out))
    return rows.join(named, (F.col(LANG) == F.col("_lang")) & (part == F.col("_gram"))).drop("_lang", "_gram")


def unary_paths(edges: DataFrame, longest: int = 3) -> DataFrame:
    """(lang, path, f, edges): maximal paths of edges that occur only one after the other.

    `edges` has lang, gram, f and the counts `out_f` and `in_f` of the node before and after.
    """
    inner = longest - 1
    rows = saved(edges.select(LANG, GRAM, "f", "out_f", "in_f").withColumn("id", F.monotonically_increasing_id()), "phrase-edges")
    ahead = rows.filter("f = in_f").select(F.col(LANG).alias("_lang"), _last(GRAM, inner).alias("_node"), F.col("id").alias("before"))
    behind = rows.filter("f = out_f").select(LANG, _first(GRAM, inner).alias("_node2"), "id")
    links = behind.join(ahead, (F.col(LANG) == F.col("_lang")) & (F.col("_node2") == F.col("_node"))).select("id", "before")
    links = saved(links, "phrase-links")
    # Only edges of longer paths take part; a path's first edge points at itself.
    heads = links.select(F.col("before").alias("id")).join(links.select("id"), "id", "left_anti")
    state = saved(
        heads.select("id", F.col("id").alias("to"), F.lit(0).cast("bigint").alias("steps"), F.lit(True).alias("done")).unionByName(
            links.select("id", F.col("before").alias("to"), F.lit(1).cast("bigint").alias("steps"), F.lit(False).alias("done"))
        ),
        "phrase-steps",
    )
    while state.filter(~F.col("done")).limit(1).count():
        target = state.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("done").alias("_done"))
        moved = state.filter(~F.col("done")).join(target, "to")
        moved = moved.select("id", F.col("_to").alias("to"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_done").alias("done"))
        before, state = state, saved(state.filter("done").unionByName(moved), "phrase-steps")
        discard(before)
    placed = rows.join(state.select("id", "to", "steps"), "id", "left")
    single = placed.filter("to is null").select(LANG, F.col(GRAM).alias("path"), "f", F.lit(1).cast("bigint").alias("edges"))
    # A path is a stretch of text that repeats as a whole, so it is no longer than a text.
    whole = placed.filter("to is not null").groupBy("to").agg(
        F.min(LANG).alias(LANG), F.min("f").alias("f"), F.count("*").alias("edges"),
        F.sort_array(F.collect_list(F.struct("steps", F.when(F.col("steps") == 0, F.col(GRAM)).otherwise(_last(GRAM, 1)).alias("more")))).alias("parts"),
    )
    return single.unionByName(whole.select(LANG, F.array_join(F.col("parts.more"), " ").alias("path"), "f", "edges"))


def covering(paths: DataFrame, words: int) -> DataFrame:
    """(lang, gram, longer): of every `words`-gram on a path the largest count of a path it is on."""
    split = paths.select(LANG, F.split("path", " ").alias("w"), F.col("f"))
    columns = [F.slice("w", F.lit(k + 1), F.size("w") - words + 1).alias(f"w{k}") for k in range(words)]
    grams = split.select(LANG, "f", F.inline(F.arrays_zip(*columns)).alias(*[f"w{k}" for k in range(words)]))
    grams = grams.select(LANG, F.concat_ws(" ", *[f"w{k}" for k in range(words)]).alias(GRAM), "f")
    return grams.groupBy(LANG, GRAM).agg(F.max("f").alias("longer"))


def scored(candidates: DataFrame, words: int, counts: dict[int, DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score, covered): the lowest-scoring cut of every candidate."""
    rows, cuts = candidates, []
    for k in range(1, words):
        rows = _with_count(rows, _first(GRAM, k), counts[k], f"l{k}") if f"l{k}" not in rows.columns else rows
        rows = _with_count(rows, _last(GRAM, words - k), counts[words - k], f"r{k}") if f"r{k}" not in rows.columns else rows
        # Exact in 38 digits; at most a million, as no phrase is more frequent than its parts.
        score = F.expr(f"(cast(1000000 as decimal(38,0)) * f * f) div (cast(l{k} as decimal(38,0)) * r{k})")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.array_min(F.array(*cuts))
    rows = rows.select(LANG, F.col(GRAM).alias("phrase"), F.col("f").alias("a"), best.alias("c"), "covered")
    return rows.select(LANG, "phrase", "a", "c.l", "c.r", "c.score", "covered")


def mine_phrases(docs: DataFrame, longest: int = 3, min_count: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to `longest` words per language.

    A candidate occurs `min_count` times; one is left out if a longer candidate that contains it
    occurs at least `percent` in a hundred times as often.
    """
    counts = gram_counts(longest_grams(docs, longest), longest, min_count)
    totals = counts[1].groupBy(LANG).agg(F.sum("f").alias("n"))
    often = {k: saved(table.filter(F.col("f") >= min_count), f"phrases-often-{k}") for k, table in counts.items()}
    none = F.lit(None).cast("bigint")
    found = []
    longer: DataFrame | None = None
    for words in range(longest, 1, -1):
        edges = often[words]
        rows = edges if longer is None else edges.join(longer, [LANG, GRAM], "left")
        covered = F.coalesce(100 * (none if longer is None else F.col("longer")) >= percent * F.col("f"), F.lit(False))
        rows = rows.withColumn("covered", covered).drop("longer")
        if words > 2:
            # The nodes at both ends of an edge are the first and last cut's long parts.
            rows = _with_count(rows, _first(GRAM, words - 1), often[words - 1], f"l{words - 1}")
            rows = saved(_with_count(rows, _last(GRAM, words - 1), often[words - 1], "r1"), "phrase-edges-flow")
            flow = rows.select(LANG, GRAM, "f", F.col(f"l{words - 1}").alias("out_f"), F.col("r1").alias("in_f"))
            paths = unary_paths(flow, words)
            own = covering(paths, words - 1)
            if longer is not None:
                inside = [f(GRAM, words - 1) for f in (_first, _last)]
                own = reduce(DataFrame.unionByName, [own, *[longer.select(LANG, g.alias(GRAM), "longer") for g in inside]])
                own = own.groupBy(LANG, GRAM).agg(F.max("longer").alias("longer"))
            longer = saved(own, f"phrase-cover-{words - 1}")
        found.append(scored(rows, words, often))
    kept = saved(reduce(DataFrame.unionByName, found).filter(~F.col("covered")).drop("covered"), "phrases-kept")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = top_n(kept, [LANG], order, top, "rank")
    return ranked.join(totals, LANG).select(LANG, F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k))
), f AS (
  SELECT lang, phrase, k, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), halves AS (
  SELECT lang, phrase, k, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp
  FROM (SELECT c.*, unnest(range(1, k)) AS j FROM c)
), cuts AS (
  SELECT h.lang, h.phrase, h.k, a, j, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM halves h
  JOIN f x ON x.lang = h.lang AND x.phrase = lp
  JOIN f y ON y.lang = h.lang AND y.phrase = rp
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS top FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3)
  GROUP BY lang, phrase
), kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE top IS NULL OR 100 * top < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""


@query("op11_phrases", OP11_SQL)
def op11_phrases(spark, sf_dir):
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))
