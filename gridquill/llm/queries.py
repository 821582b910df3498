"""Queries of the corpus operators and the SQL that some of them equal."""

from __future__ import annotations

from .chat import OP1_SQL, op1_chat_format
from .decontam import op2_decontamination
from .langid import op6_language_id
from .media import op5_media
from .mixing import OP3_SQL, op3_mixing
from .neardup import OP9_SQL, op9_near_duplicates
from .quality import op4_quality
from .sharding import OP10_SQL, op10_sharding
from .suffix import OP8_SQL, op8_suffix_dedup
from .toxicity import op7_toxicity

QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_media": op5_media,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_sharding": op10_sharding,
}

#: The others train models, read sound, or canonicalise by rules that SQL has no words for; tests hold them against plain versions.
ORACLE_SQL = {
    "op1_chat_format": OP1_SQL,
    "op3_mixing": OP3_SQL,
    "op8_suffix_dedup": OP8_SQL,
    "op9_near_duplicates": OP9_SQL,
    "op10_sharding": OP10_SQL,
}
