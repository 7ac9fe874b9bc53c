"""Queries of this subpackage, and the SQL each must equal where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetwatt.llm import (
    chat,
    langid,
    line_dedup,
    lm,
    manifest,
    packing,
    phrases,
    quality,
    sentencepiece,
    sharding,
    simhash,
    substring_dedup,
    topk,
)
from fleetwatt.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _ready(build: Query) -> Query:
    return lambda spark, sf_dir: build(configure(spark), sf_dir)


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": _ready(sentencepiece.op1_sentencepiece),
    "op2_packing": _ready(packing.op2_packing),
    "op3_langid": _ready(langid.op3_langid),
    "op4_topk": _ready(topk.op4_topk),
    "op5_simhash": _ready(simhash.op5_simhash),
    "op6_sharding": _ready(sharding.op6_sharding),
    "op7_line_dedup": _ready(line_dedup.op7_line_dedup),
    "op8_quality_rules": _ready(quality.op8_quality_rules),
    "op9_substring_dedup": _ready(substring_dedup.op9_substring_dedup),
    "op10_lm_scoring": _ready(lm.op10_lm_scoring),
    "op11_phrase_collocations": _ready(phrases.op11_phrase_collocations),
    "op12_merkle_manifest": _ready(manifest.op12_merkle_manifest),
    "op13_chat_formatting": _ready(chat.op13_chat_formatting),
}

ORACLES: dict[str, str] = {
    "op4_topk": topk.OP4_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op8_quality_rules": quality.OP8_SQL,
    "op9_substring_dedup": substring_dedup.OP9_SQL,
    "op11_phrase_collocations": phrases.OP11_SQL,
    "op12_merkle_manifest": manifest.OP12_SQL,
    "op13_chat_formatting": chat.OP13_SQL,
}
