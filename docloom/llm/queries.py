"""Registered queries of this subpackage, with DuckDB SQL where it can state them."""

from __future__ import annotations

from docloom.llm import (
    alignment, bpe, collocations, extraction, jaccard, language, mixing, neardup, pii, quality, repeats,
    search, warc,
)

QUERIES = {
    "op1_quality": quality.quality_query,
    "op2_warc": warc.warc_query,
    "op3_language": language.language_query,
    "op4_bpe": bpe.bpe_query,
    "op5_neardup": neardup.neardup_query,
    "op6_mixing": mixing.mix_query,
    "op7_jaccard": jaccard.jaccard_query,
    "op8_repeats": repeats.repeats_query,
    "op9_pii": pii.pii_query,
    "op10_search": search.search_query,
    "op11_alignment": alignment.alignment_query,
    "op12_collocations": collocations.collocation_query,
    "op13_extraction": extraction.extraction_query,
}

ORACLES = {
    "op2_warc": warc.WARC_SQL,
    "op6_mixing": mixing.MIX_SQL,
    "op12_collocations": collocations.COLLOCATION_SQL,
}
