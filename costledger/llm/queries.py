"""Registered queries of the operators, and their SQL where SQL can say it."""
from __future__ import annotations

from .chat import OP8_SQL, op8_chat
from .decontam import OP9_SQL, op9_decontamination
from .exactdup import OP10_SQL, op10_exact_dedup
from .fim import OP12_SQL, op12_fill_in_middle
from .hardneg import OP11_SQL, op11_hard_negatives
from .langid import op3_language_id
from .packing import op5_packing
from .pieces import op13_sentencepiece
from .pii import op4_personal_data
from .sharding import op6_sharding
from .simhash import op1_simhash
from .tokencount import op2_token_counts
from .tokenfile import op7_token_file

QUERIES = {"op1_simhash": op1_simhash, "op2_token_counts": op2_token_counts,
           "op3_language_id": op3_language_id, "op4_personal_data": op4_personal_data,
           "op5_packing": op5_packing,
           "op6_sharding": op6_sharding, "op7_token_file": op7_token_file, "op8_chat": op8_chat,
           "op9_decontamination": op9_decontamination, "op10_exact_dedup": op10_exact_dedup,
           "op11_hard_negatives": op11_hard_negatives, "op12_fill_in_middle": op12_fill_in_middle,
           "op13_sentencepiece": op13_sentencepiece}

SQL: dict[str, str] = {"op8_chat": OP8_SQL, "op9_decontamination": OP9_SQL, "op10_exact_dedup": OP10_SQL,
                       "op11_hard_negatives": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
