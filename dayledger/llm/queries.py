"""The queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe import op1_byte_bpe
from .chat import OP11_SQL, op11_chat_format
from .clusters import OP13_SQL, op13_centroids
from .counts import op6_token_counts
from .decontaminate import OP10_SQL, op10_decontamination
from .langid import op9_language
from .lm import op2_log_bilinear
from .phrases import OP12_SQL, op12_collocations
from .pii import op5_pii
from .simhash import op7_simhash
from .tokenfile import op3_token_file
from .topk import OP4_SQL, op4_top_k
from .urls import op8_url_filter

QUERIES = {
    q.__name__: q
    for q in (
        op1_byte_bpe,
        op2_log_bilinear,
        op3_token_file,
        op4_top_k,
        op5_pii,
        op6_token_counts,
        op7_simhash,
        op8_url_filter,
        op9_language,
        op10_decontamination,
        op11_chat_format,
        op12_collocations,
        op13_centroids,
    )
}
SQL = {
    "op4_top_k": OP4_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_chat_format": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_centroids": OP13_SQL,
}
