"""Importing this module registers the query of every operator."""

from starling.llm import (  # noqa: F401
    alignment,
    decontaminate,
    jaccard,
    language,
    lm_score,
    mixing,
    phrases,
    quality,
    sentencepiece,
    sharding,
    substring,
    token_files,
    toxicity,
)
from starling.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
