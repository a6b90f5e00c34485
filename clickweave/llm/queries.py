"""The operators of this folder as queries over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickweave.llm import (
    bpe,
    decontamination,
    html_text,
    importance,
    language,
    lexical_search,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
    warc,
)
from clickweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def _over(report: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: report(*[table(spark, sf_dir, name) for name in names])


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_dedup": _over(suffix_dedup.report, "documents"),
        "op2_decontamination": _over(decontamination.report, "documents", "benchmark"),
        "op3_warc": _over(warc.report, "pages"),
        "op4_language": _over(language.report, "documents"),
        "op5_url_filter": _over(url_filter.report, "pages"),
        "op6_sharding": _over(sharding.report, "documents"),
        "op7_bpe": lambda spark, sf_dir: bpe.report(
            table(spark, sf_dir, "documents"), tokenizer_path()),
        "op8_quality_rules": _over(quality.report, "documents", "labels"),
        "op9_simhash": _over(simhash.report, "documents"),
        "op10_html_text": _over(html_text.report, "pages"),
        "op11_importance": _over(importance.report, "documents", "benchmark"),
        "op12_lexical_search": _over(lexical_search.report, "documents", "benchmark"),
        "op13_toxicity": _over(toxicity.report, "documents", "labels"),
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_url_filter": url_filter.ORACLE_SQL,
            "op12_lexical_search": lexical_search.ORACLE_SQL}
