"""The subpackage's registered queries, and their SQL where SQL can express them."""

from . import additive, audit, graph, html_text, licenses, oracles, packing, pieces, pii, quality, secrets, simhash, suffixes

QUERIES = {
    "op1_sentencepiece": pieces.query,
    "op2_simhash": simhash.query,
    "op3_suffixes": suffixes.query,
    "op4_graph": graph.query,
    "op5_html": html_text.query,
    "op6_secrets": secrets.query,
    "op7_packing": packing.query,
    "op8_quality": quality.query,
    "op9_additive": additive.query,
    "op10_licenses": licenses.query,
    "op11_pii": pii.query,
    "op12_audit": audit.query,
}

ORACLE_SQL: dict[str, str] = {"op3_suffixes": oracles.SUFFIXES, "op4_graph": oracles.GRAPH, "op9_additive": oracles.ADDITIVE, "op12_audit": oracles.AUDIT}
