"""The named queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchledger.llm.bestfit import op12_best_fit
from matchledger.llm.collocations import op11_collocations, op11_sql
from matchledger.llm.html_text import op1_html_text
from matchledger.llm.language import op8_language
from matchledger.llm.licenses import op5_licenses, op5_sql
from matchledger.llm.mixing import op7_mixing, op7_sql
from matchledger.llm.nearest import op3_nearest, op3_sql
from matchledger.llm.packing import op2_packing
from matchledger.llm.repair import op13_repair, op13_sql
from matchledger.llm.repeats import op4_repeats, op4_sql
from matchledger.llm.simhash import op9_simhash
from matchledger.llm.topk import op10_sql, op10_topk
from matchledger.llm.warc import op6_sql, op6_warc

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {
        "op1_html_text": op1_html_text,
        "op2_packing": op2_packing,
        "op3_nearest": op3_nearest,
        "op4_repeats": op4_repeats,
        "op5_licenses": op5_licenses,
        "op6_warc": op6_warc,
        "op7_mixing": op7_mixing,
        "op8_language": op8_language,
        "op9_simhash": op9_simhash,
        "op10_topk": op10_topk,
        "op11_collocations": op11_collocations,
        "op12_best_fit": op12_best_fit,
        "op13_repair": op13_repair,
    }


def llm_statements() -> dict[str, str]:
    return {
        "op3_nearest": op3_sql(),
        "op4_repeats": op4_sql(),
        "op5_licenses": op5_sql(),
        "op6_warc": op6_sql(),
        "op7_mixing": op7_sql(),
        "op10_topk": op10_sql(),
        "op11_collocations": op11_sql(),
        "op13_repair": op13_sql(),
    }
