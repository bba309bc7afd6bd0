"""Text predicates and measures as Column -> Column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starling import constants as C

# White space as Unicode defines it, spelled so that Java and RE2 read it alike.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
# Java's \d, \w and \b are ASCII unless asked otherwise.
UNICODE = "(?U)"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def split_words(text: Column) -> Column:
    """White-space tokens; no empty tokens."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda token: token != "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


# -- validators -------------------------------------------------------------


def not_phone(text: Column) -> Column:
    return ~text.rlike(UNICODE + C.PHONE_PATTERN)


def valid_length(text: Column, low: int, high: int) -> Column:
    return F.length(text).between(low, high)


def no_urls(text: Column) -> Column:
    return ~text.rlike(C.URL_PATTERN)


def strip_tco(text: Column) -> Column:
    return F.regexp_replace(text, UNICODE + C.TCO_PATTERN, "")


def has_tco(text: Column) -> Column:
    return text.rlike(UNICODE + C.TCO_PATTERN)


def no_external_urls(text: Column) -> Column:
    return no_urls(strip_tco(text))


def body_not_removed(text: Column) -> Column:
    return ~F.lower(strip(text)).isin(*C.REMOVED_BODIES)


def no_mentions(text: Column) -> Column:
    return ~text.rlike(C.MENTION_PATTERN)


def no_markdown_links(text: Column) -> Column:
    return ~text.rlike(C.MARKDOWN_LINK_PATTERN)


def no_media_hosts(text: Column) -> Column:
    return ~text.rlike(UNICODE + C.MEDIA_HOST_PATTERN)


def not_automoderator(author: Column) -> Column:
    return F.lower(strip(author)) != C.AUTOMODERATOR


# Function words of the languages told apart by is_english.
STOP_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "and", "of", "to", "in", "is", "that", "for", "it", "was", "with", "you", "are", "this"),
    "fr": ("le", "la", "les", "et", "des", "un", "une", "que", "qui", "dans", "est", "pour", "pas", "elle"),
    "de": ("der", "die", "das", "und", "den", "ein", "eine", "ist", "nicht", "mit", "von", "zu", "sich", "ich"),
    "es": ("el", "los", "las", "y", "una", "en", "por", "con", "para", "del", "se", "no", "es", "como"),
}


def stop_word_hits(text: Column, language: str) -> Column:
    words: Sequence[str] = STOP_WORDS[language]
    tokens = F.filter(F.split(F.lower(text), f"[^\\p{{L}}\\p{{N}}_]+"), lambda token: token.isin(*words))
    return F.size(tokens)


def is_english(text: Column) -> Column:
    """The English profile has hits and more of them than any other profile."""
    english = stop_word_hits(text, "en")
    others = F.greatest(*[stop_word_hits(text, name) for name in STOP_WORDS if name != "en"])
    return F.coalesce(~is_blank(text) & (english > 0) & (english > others), F.lit(False))


# -- readability ------------------------------------------------------------


def syllables(word: Column) -> Column:
    letters = F.regexp_replace(F.lower(word), "[^a-z]", "")
    groups = F.size(F.regexp_extract_all(letters, F.lit("[aeiouy]+"), F.lit(0)))
    silent = F.when(letters.endswith("e") & (groups > 1), 1).otherwise(0)
    return F.when(letters == "", 0).otherwise(F.greatest(F.lit(1), groups - silent))


def alphabetic_words(text: Column) -> Column:
    """Maximal runs of letters: stands in for a tokenizer's alphabetic tokens."""
    return F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))


def sentence_count(text: Column) -> Column:
    """Pieces between sentence ends that hold more than white space; at least 1."""
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(f"[^.!?{SPACE[1:-1]}][^.!?]*")))


def syllable_count(text: Column) -> Column:
    """The sum of `syllables` over the words, from four passes over the whole text.

    Every vowel group counts; words of consonants only count 1; a final e after another group does not.
    """
    words = F.regexp_replace(text, r"\P{L}+", " ")
    letters = F.regexp_replace(F.lower(words), "[^a-z ]+", "")
    groups = F.regexp_count(letters, F.lit("[aeiouy]+"))
    bare = F.regexp_count(letters, F.lit("(?<![a-z])[b-df-hj-np-tv-xz]++(?![a-z])"))
    silent = F.regexp_count(letters, F.lit("[aeiouy][b-df-hj-np-tv-xz]++[aeiouy]*e(?![a-z])"))
    return groups + bare - silent


def readability(words: Column, sentences: Column, syllable_total: Column) -> tuple[Column, Column]:
    """(grade level, reading ease) from the three counts; 0 where there are no words."""
    per_sentence = words / sentences
    per_word = syllable_total / F.nullif(words, F.lit(0))
    grade = 0.39 * per_sentence + 11.8 * per_word - 15.59
    ease = 206.835 - 1.015 * per_sentence - 84.6 * per_word
    return F.coalesce(grade, F.lit(0.0)), F.coalesce(ease, F.lit(0.0))


# -- structural completeness -------------------------------------------------

THREAD_MARKER = r"(?i)[\[(]\s*\d+\s*/\s*\d+\s*[\])]|to be continued"
OPEN_ENDINGS = ("and", "or", "but", "if", "you", "the", "a", "to", "of", "because", "that", "with")


def is_structurally_complete(text: Column) -> Column:
    """No thread marker, and no ending that plainly breaks off."""
    last = F.lower(F.regexp_extract(strip(text), r"(\p{L}+)$", 1))
    return ~(text.rlike(THREAD_MARKER) | last.isin(*OPEN_ENDINGS))
