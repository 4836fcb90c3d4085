"""The operators of this folder as named queries over the test tables."""

from __future__ import annotations

import corpus_pipeline

from .alignment import op13_alignment
from .bpe import op10_bpe
from .decontaminate import op9_decontaminate
from .langid import op3_language
from .licenses import op4_licenses
from .neardup import op6_superminhash
from .packing import op12_packing
from .passages import op1_passages
from .quality import op7_quality
from .runs import op11_runs
from .secrets import op2_secrets
from .topk import ORACLE as TOPK_SQL
from .topk import op8_topk
from .token_files import op5_token_files

QUERIES = {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_passages, op2_secrets, op3_language, op4_licenses, op5_token_files, op6_superminhash, op7_quality, op8_topk, op9_decontaminate, op10_bpe, op11_runs, op12_packing, op13_alignment)}
#: Check SQL, where DuckDB can express the operator.
ORACLES: dict[str, str] = {"op8_topk": TOPK_SQL}
