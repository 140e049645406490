"""The queries of this package by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bm25pack, chatformat, decontaminate, htmlextract, loglm, orderminhash, suffixdedup, syncmers, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_log_frequency_lm": loglm.query,
    "op2_chat_format": chatformat.query,
    "op3_bm25_packing": bm25pack.query,
    "op4_toxicity": toxicity.query,
    "op5_decontaminate": decontaminate.query,
    "op6_suffix_dedup": suffixdedup.query,
    "op7_html_extract": htmlextract.query,
    "op8_closed_syncmers": syncmers.query,
    "op9_url_filter": urlfilter.query,
    "op10_order_minhash": orderminhash.query,
}
ORACLES: dict[str, str] = {}
