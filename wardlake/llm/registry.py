"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from wardlake.llm.binary import op11_token_files
from wardlake.llm.language import op5_language
from wardlake.llm.media import op10_media
from wardlake.llm.mixing import op2_mixing
from wardlake.llm.neighbours import op1_neighbours
from wardlake.llm.packing import op6_packing
from wardlake.llm.prefixes import op13_prefixes, trie_sql
from wardlake.llm.quality import op4_quality
from wardlake.llm.simhash import op8_simhash
from wardlake.llm.spelling import op12_spelling, variants_sql
from wardlake.llm.tokens import op3_token_counts
from wardlake.llm.toxicity import op7_toxicity
from wardlake.llm.urls import op9_urls, verdicts_sql

QUERIES = {f.__name__: f for f in (op1_neighbours, op2_mixing, op3_token_counts, op4_quality, op5_language, op6_packing, op7_toxicity, op8_simhash, op9_urls, op10_media, op11_token_files, op12_spelling, op13_prefixes)}

#: The others cannot be put in SQL as they are: they hash with functions that DuckDB lacks, tokenise, or fit models.
ORACLE_SQL: dict[str, str] = {"op9_urls": verdicts_sql(), "op12_spelling": variants_sql(), "op13_prefixes": trie_sql()}
