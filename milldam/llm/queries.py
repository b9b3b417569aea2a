"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import codes, jaccard
from .bpe import op1_bpe_encode
from .codes import op11_vector_codes
from .decontaminate import op8_decontamination
from .jaccard import op13_jaccard_join
from .lattice import op7_lattice_score
from .licenses import op3_license_scan
from .ogg import op5_ogg_columns
from .pii import op6_pii_pseudonyms
from .runs import op12_periodic_runs
from .shards import op4_sharding
from .simhash import op9_simhash_near_dedup
from .tokens import op2_token_counts
from .toxicity import op10_toxicity

QUERIES = {
    "op1_bpe_encode": op1_bpe_encode,
    "op2_token_counts": op2_token_counts,
    "op4_sharding": op4_sharding,
    "op5_ogg_columns": op5_ogg_columns,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_toxicity": op10_toxicity,
    "op7_lattice_score": op7_lattice_score,
    "op8_decontamination": op8_decontamination,
    "op6_pii_pseudonyms": op6_pii_pseudonyms,
    "op3_license_scan": op3_license_scan,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLE_SQL: dict[str, str] = {"op11_vector_codes": codes.ORACLE, "op13_jaccard_join": jaccard.ORACLE}
