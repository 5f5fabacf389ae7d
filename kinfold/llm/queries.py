"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontaminate, jaccard, lattice, licenses, mix, pii, quality, repeats, secrets, shard

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_repeats": repeats.op2_repeats,
    "op3_jaccard": jaccard.op3_jaccard,
    "op4_secrets": secrets.op4_secrets,
    "op5_pii": pii.op5_pii,
    "op6_mix": mix.op6_mix,
    "op7_quality": quality.op7_quality,
    "op8_lattice": lattice.op8_lattice,
    "op9_shard": shard.op9_shard,
    "op10_licenses": licenses.op10_licenses,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op2_repeats": repeats.OP2_SQL,
    "op3_jaccard": jaccard.OP3_SQL,
    "op5_pii": pii.OP5_SQL,
    "op7_quality": quality.OP7_SQL,
}
