"""Quality rules: a threshold table compiled into one Spark projection.

Every signal is a column expression over the text and every rule a range on a signal, so a
rule set is one projection: no shuffle, no Python.

Defined results: a null text counts as an empty one (no words; the base rules fail, so it is
not kept). Repeated rows are judged row by row. Signal columns replace input columns of the same
name. Texts of any length are read whole; the work per text is n log n in its words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.plan import settle
from starling.llm.common import SPACES, names, replace_columns, shifted
from starling.llm.registry import query

WORD = r"[^\x20\x09-\x0D]"
#: Frequent function words of the languages that the rules are meant for.
STOP_WORDS = (
    "the of and to a in is for on that with as be by it this are was or an from at "
    "der die das und von zu den mit ein eine des nicht sich auf "
    "le la les de et un une du que en qui dans pour par sur au "
    "el los las y con es se una por para como su"
).split()

SIGNALS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_bullet_lines",
    "n_open_lines",
    "n_stop_words",
    "n_repeat_words",
)


@dataclass(frozen=True)
class Rule:
    """`low <= part / whole <= high`; `whole` None compares `part` itself. 0 / 0 counts as 0."""

    name: str
    part: str
    whole: str | None = None
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        value = F.col(self.part).cast("double")
        if self.whole is not None:
            value = F.when(F.col(self.whole) > 0, value / F.col(self.whole)).otherwise(0.0)
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return ok


#: The production table. Ratios are mild: they reject symbol noise, word lists without
#: function words, and texts made of repeated lines; ordinary prose passes.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("open_lines", "n_open_lines", "n_lines", high=0.3),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
)


def quality_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the columns of SIGNALS (long).

    n_repeat_words counts the words inside three-word windows that occur twice or more in the
    text: windows are hashed, sorted with their places, and equal neighbours give the places.
    """
    keep = [c for c in docs.columns if c not in SIGNALS]
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Columns that later steps use several times stay in projections of their own.
    split = docs.select(
        *names(keep),
        F.array_remove(F.split(content, SPACES), "").alias("__q_words"),
        F.filter(F.split(content, "\n"), lambda line: line.rlike(WORD)).alias("__q_lines"),
        F.regexp_count(content, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )
    counted = split.select(
        *names(keep),
        F.size("__q_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__q_words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        F.size("__q_lines").cast("bigint").alias("n_lines"),
        (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("__q_lines", lambda x: x.rlike(r"^\s*[-•‣▪◦]"))).cast("bigint").alias("n_bullet_lines"),
        F.size(F.filter("__q_lines", lambda x: x.rlike(r"(…|\.\.\.)\s*$"))).cast("bigint").alias("n_open_lines"),
        F.size(F.filter("__q_words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        F.transform("__q_words", lambda w: F.xxhash64(w)).alias("__q_hashes"),
    )
    pairs = F.zip_with(
        "__q_hashes",
        shifted("__q_hashes", 1),
        lambda a, b: F.shiftleft(a, 13).bitwiseXOR(F.shiftrightunsigned(a, 51)).bitwiseXOR(b),
    )
    hashed = counted.withColumn(
        "__q_windows",
        F.slice(
            F.zip_with(pairs, shifted("__q_hashes", 2), lambda a, b: F.xxhash64(a, b)),
            F.lit(1),
            F.greatest(F.size("__q_hashes") - 2, F.lit(0)),
        ),
    ).drop("__q_hashes")
    # Sorted only where some window occurs twice.
    repeated = F.size(F.array_distinct("__q_windows")) < F.size("__q_windows")
    placed = F.sort_array(F.transform("__q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_windows = hashed.withColumn("__q_placed", F.when(repeated, placed)).drop("__q_windows")
    twins = F.filter(
        F.zip_with(
            "__q_placed",
            shifted("__q_placed", 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        ),
        lambda pair: pair.isNotNull(),
    )
    covered = F.aggregate(
        F.sort_array(F.array_distinct(F.flatten(twins))),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, i: F.struct(
            i.alias("last"),
            (acc["n"] + F.least(F.lit(3), i - acc["last"])).cast("bigint").alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return sorted_windows.select(
        *names(keep),
        *[c for c in SIGNALS if c != "n_repeat_words"],
        F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )


def apply_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    min_words: int = 50,
    max_repeat: float = 0.5,
    text: str = "text",
) -> DataFrame:
    """`docs` with the signals, `base_failed`, `failed_rules` (names) and `kept`.

    Too few words or too many repeated words fail the base; what passes it is kept if every
    rule of the table passes.
    """
    signals = quality_signals(docs, text)
    base = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words").cast("double") > max_repeat * F.col("n_words")
    )
    failed = F.array_compact(
        F.array(*[F.when(~rule.passes(), F.lit(rule.name)) for rule in rules])
    ) if rules else F.array().cast("array<string>")
    judged = replace_columns(signals, {"base_failed": base, "failed_rules": failed})
    return replace_columns(judged, {"kept": ~F.col("base_failed") & (F.size("failed_rules") == 0)})


def kept_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of `docs` that the rules keep, as they came.

    The verdict is settled in a row of its own: a filter on it would otherwise be pushed below the
    projections, and every signal computed again for each of its uses.
    """
    verdict = "__qverdict"
    judged = apply_rules(docs.withColumns({f"__q{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}), rules, text=text)
    own = [F.col(f"__q{i}").alias(c) for i, c in enumerate(docs.columns)]
    return settle(judged, {verdict: F.col("kept")}, own).filter(verdict).drop(verdict)


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), h AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c FROM g
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE c > 1) GROUP BY doc_id
), s AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-•‣▪◦]')))::BIGINT AS n_bullet,
         len(list_filter(lines, lambda x: regexp_matches(x, '(…|\.\.\.)\s*$')))::BIGINT AS n_open,
         len(list_filter(words, lambda x: list_contains(STOPS, lower(x))))::BIGINT AS n_stop,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars / n_words BETWEEN 2.0 AND 15.0
       AND n_symbols / n_words <= 0.1
       AND n_dup_lines / n_lines <= 0.3
       AND n_bullet / n_lines <= 0.9
       AND n_open / n_lines <= 0.3
       AND n_stop / n_words >= 0.02 AS kept
FROM b
""".replace("STOPS", "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]")


@query("op7_quality_rules", OP7_SQL)
def op7_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return apply_rules(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )
