"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, substrings, suffix
from .bpe import op9_bpe
from .decontaminate import op1_decontaminate
from .embeddings import op6_embeddings
from .langid import op4_langid
from .licences import op7_licences
from .quality import op2_quality
from .sharding import op8_sharding
from .simhash import op10_simhash
from .substrings import op5_substring_dedup
from .suffix import op3_suffix_dedup

QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_quality, op3_suffix_dedup, op4_langid, op5_substring_dedup, op6_embeddings, op7_licences, op8_sharding, op9_bpe, op10_simhash)}
SQL: dict[str, str] = {"op1_decontaminate": decontaminate.SQL, "op3_suffix_dedup": suffix.SQL, "op5_substring_dedup": substrings.SQL}
