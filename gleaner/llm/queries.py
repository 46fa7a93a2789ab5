"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import lines, mixing, spelling, urls
from gleaner.llm.bagminhash import op3_bagminhash
from gleaner.llm.conversations import op13_conversation_repair
from gleaner.llm.decontaminate import op6_decontaminate
from gleaner.llm.embeddings import op8_embedding_links
from gleaner.llm.lines import op11_line_dedup
from gleaner.llm.mixing import op2_mix_sources
from gleaner.llm.pages import op5_main_text
from gleaner.llm.pseudonyms import op7_pseudonyms
from gleaner.llm.repeats import op1_repeats
from gleaner.llm.spelling import op12_spelling_variants
from gleaner.llm.tokens import op10_token_ids
from gleaner.llm.toxicity import op9_toxicity
from gleaner.llm.urls import op4_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_mix_sources": op2_mix_sources,
    "op3_bagminhash": op3_bagminhash,
    "op4_url_filter": op4_url_filter,
    "op5_main_text": op5_main_text,
    "op6_decontaminate": op6_decontaminate,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_embedding_links": op8_embedding_links,
    "op9_toxicity": op9_toxicity,
    "op10_token_ids": op10_token_ids,
    "op11_line_dedup": op11_line_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}
SQL: dict[str, str] = {
    "op2_mix_sources": mixing.SQL.strip(), "op4_url_filter": urls.SQL.strip(), "op11_line_dedup": lines.SQL.strip(),
    "op12_spelling_variants": spelling.SQL.strip(),
}
