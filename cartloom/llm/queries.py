"""Registered queries of this subpackage: name to (run, SQL that states the same rows or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartloom.llm import (
    alignment, chat, collocations, decontaminate, jaccard, langid, licenses, line_dedup, packing, quality, sentencepiece_fst, token_files, topk,
)

Run = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, tuple[Run, str | None]]:
    merged: dict[str, tuple[Run, str | None]] = {}
    for module in (sentencepiece_fst, chat, topk, langid, token_files, line_dedup, decontaminate, quality, jaccard, licenses, packing, alignment, collocations):
        merged.update(module.QUERIES)
    return merged
