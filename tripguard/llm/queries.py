"""The registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from tripguard.llm import (
    decontaminate,
    divergence,
    exact_dedup,
    licenses,
    lines,
    packing,
    quality,
    simhash,
    substring,
    surrogates,
    urls,
    variants,
    warc,
)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_substring": substring.op2_substring,
    "op3_pack": packing.op3_pack,
    "op4_lines": lines.op4_lines,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_licenses": licenses.op6_licenses,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_warc": warc.op8_warc,
    "op9_surrogates": surrogates.op9_surrogates,
    "op10_quality": quality.op10_quality,
    "op11_urls": urls.op11_urls,
    "op12_divergence": divergence.op12_divergence,
    "op13_variants": variants.op13_variants,
}
ORACLES = {
    "op2_substring": substring.OP2_SQL,
    "op6_licenses": licenses.OP6_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op8_warc": warc.OP8_SQL,
    "op12_divergence": divergence.OP12_SQL,
    "op13_variants": variants.OP13_SQL,
}
