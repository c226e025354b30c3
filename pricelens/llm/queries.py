"""The queries of this folder by name, and DuckDB SQL where SQL can say them."""

from __future__ import annotations

from pricelens.llm.ann import op3_ann_search
from pricelens.llm.bpe import op8_bpe_codec
from pricelens.llm.chat_format import OP1_SQL, op1_chat_format
from pricelens.llm.collocations import OP11_SQL, op11_collocations
from pricelens.llm.embedding_dedup import op5_embedding_dedup
from pricelens.llm.html_extract import op13_html_extract
from pricelens.llm.language_id import op10_language_id
from pricelens.llm.line_dedup import OP7_SQL, op7_line_dedup
from pricelens.llm.packing import op9_best_fit_packing
from pricelens.llm.runs import op12_periodic_runs
from pricelens.llm.simhash import op2_simhash_dedup
from pricelens.llm.toxicity import op4_toxicity
from pricelens.llm.url_filter import ALIASES_SQL, OP6_SQL, op6_url_filter, url_aliases


def llm_queries() -> dict:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_simhash_dedup": op2_simhash_dedup,
        "op3_ann_search": op3_ann_search,
        "op4_toxicity": op4_toxicity,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op6_url_filter": op6_url_filter,
        "url_aliases": url_aliases,
        "op7_line_dedup": op7_line_dedup,
        "op8_bpe_codec": op8_bpe_codec,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_language_id": op10_language_id,
        "op11_collocations": op11_collocations,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_html_extract": op13_html_extract,
    }


def llm_oracles() -> dict[str, str]:
    return {"op1_chat_format": OP1_SQL, "op6_url_filter": OP6_SQL, "url_aliases": ALIASES_SQL, "op7_line_dedup": OP7_SQL, "op11_collocations": OP11_SQL}
