"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import decontamination, line_dedup, minhash_dedup, periodic_runs, spelling_variants, warc
from .decontamination import op8_decontamination
from .line_dedup import op7_line_dedup
from .lm_scoring import op5_lm_scoring
from .minhash_dedup import op1_near_duplicates
from .nearest_vectors import op10_nearest_vectors
from .packing import op6_packing
from .periodic_runs import op11_periodic_runs
from .quality import op4_quality
from .secrets_scan import op2_secrets
from .simhash_dedup import op12_simhash
from .spelling_variants import op13_spelling_variants
from .toxicity import op3_toxicity
from .warc import op9_warc

QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_secrets": op2_secrets,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_packing": op6_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_nearest_vectors": op10_nearest_vectors,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_simhash": op12_simhash,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_near_duplicates": minhash_dedup.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op8_decontamination": decontamination.SQL,
    "op9_warc": warc.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op13_spelling_variants": spelling_variants.SQL,
}

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
