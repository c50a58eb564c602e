"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from driftwell.llm.block_topk import OP7_SQL, op7_block_topk
from driftwell.llm.licences import OP8_SQL, op8_license_scan
from driftwell.llm.line_dedup import OP10_SQL, op10_site_line_dedup
from driftwell.llm.mixing import OP3_SQL, op3_hierarchical_mix
from driftwell.llm.packing import op1_best_fit_packing
from driftwell.llm.permutation_index import op5_permutation_index
from driftwell.llm.ppm import op2_ppm_scoring
from driftwell.llm.simhash import op9_simhash_gray
from driftwell.llm.toxicity import op4_nnpu_toxicity
from driftwell.llm.warc import op6_warc_derivatives


def queries() -> dict:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_ppm_scoring": op2_ppm_scoring,
        "op3_hierarchical_mix": op3_hierarchical_mix,
        "op4_nnpu_toxicity": op4_nnpu_toxicity,
        "op5_permutation_index": op5_permutation_index,
        "op6_warc_derivatives": op6_warc_derivatives,
        "op7_block_topk": op7_block_topk,
        "op8_license_scan": op8_license_scan,
        "op9_simhash_gray": op9_simhash_gray,
        "op10_site_line_dedup": op10_site_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_hierarchical_mix": OP3_SQL, "op7_block_topk": OP7_SQL, "op8_license_scan": OP8_SQL, "op10_site_line_dedup": OP10_SQL}
