"""The training-data queries by name, and the SQL that gives the same rows where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import decontaminate, licenses, line_dedup, pii, preferences, quality, secrets
from .bpe import op9_bpe
from .decontaminate import op5_decontaminate
from .language import op4_language
from .licenses import op10_licenses
from .line_dedup import op2_line_dedup
from .near_dedup import op8_bagminhash
from .pii import op6_pii, op6_pii_base
from .preferences import op7_preferences
from .quality import op3_quality
from .secrets import op1_secrets, op1_secrets_base

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_language": op4_language,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii": op6_pii,
    "op7_preferences": op7_preferences,
    "op8_bagminhash": op8_bagminhash,
    "op9_bpe": op9_bpe,
    "op10_licenses": op10_licenses,
    "pipeline": corpus_pipeline.run,
    "op1_secrets_base": op1_secrets_base,
    "op6_pii_base": op6_pii_base,
}

#: DuckDB SQL by query. The others are iterative, model-based or need a tokenizer; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op1_secrets_base": secrets.BASE_SQL,
    "op6_pii_base": pii.BASE_SQL,
    "op2_line_dedup": line_dedup.ORACLE_SQL,
    "op3_quality": quality.ORACLE_SQL,
    "op5_decontaminate": decontaminate.ORACLE_SQL,
    "op7_preferences": preferences.ORACLE_SQL,
    "op10_licenses": licenses.ORACLE_SQL,
}
