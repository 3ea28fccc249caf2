"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quaywise.llm import (
    chat,
    clusters,
    html,
    langid,
    lines,
    neighbours,
    ngrams,
    notices,
    packing,
    pieces,
    quality,
    repair,
    simhash,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_mcd_outliers": quality.op1_mcd_outliers,
        "op2_chat_tokens": chat.op2_chat_tokens,
        "op3_line_windows": lines.op3_line_windows,
        "op4_piece_transducer": pieces.op4_piece_transducer,
        "op5_byte_birnn": langid.op5_byte_birnn,
        "op6_html_layout": html.op6_html_layout,
        "op7_simhash_grid": simhash.op7_simhash_grid,
        "op8_pack_ffd": packing.op8_pack_ffd,
        "op9_kneser_ney": ngrams.op9_kneser_ney,
        "op10_posting_lists": neighbours.op10_posting_lists,
        "op11_repair_agenda": repair.op11_repair_agenda,
        "op12_subvector_dictionary": clusters.op12_subvector_dictionary,
        "op13_fuzzy_notices": notices.op13_fuzzy_notices,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {
        "op2_chat_tokens": chat.ORACLE,
        "op3_line_windows": lines.ORACLE,
        "op11_repair_agenda": repair.ORACLE,
        "op12_subvector_dictionary": clusters.ORACLE,
    }
