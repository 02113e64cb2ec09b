"""The training-data operators' queries, and SQL for those that it can express."""

from __future__ import annotations

from . import bpe, fingerprints, jaccard, language, licenses, lines, media, packing, secrets, suffixes

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_secrets": secrets.op2_secrets,
    "op3_licenses": licenses.op3_licenses,
    "op4_media": media.op4_media,
    "op5_packing": packing.op5_packing,
    "op6_line_dedup": lines.op6_line_dedup,
    "op7_jaccard": jaccard.op7_jaccard,
    "op8_suffixes": suffixes.op8_suffixes,
    "op9_language": language.op9_language,
    "op10_bpe": bpe.op10_bpe,
}

ORACLES = {
    "op2_secrets": secrets.ORACLE_SQL,
    "op3_licenses": licenses.ORACLE_SQL,
    "op6_line_dedup": lines.ORACLE_SQL,
}
