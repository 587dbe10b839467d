"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from diagarc.llm import jaccard, prefix_trie, repeats, topk, turn_repair
from diagarc.llm.html_main import op1_main_text
from diagarc.llm.jaccard import op9_jaccard_join
from diagarc.llm.langid import op4_language_id
from diagarc.llm.mixing import op2_mix_sources
from diagarc.llm.packing import op6_pack_best_fit
from diagarc.llm.prefix_trie import op13_prefix_trie
from diagarc.llm.quality import op12_quality
from diagarc.llm.repeats import op8_remove_repeats
from diagarc.llm.secrets import op3_secrets
from diagarc.llm.sketches import op5_fingerprints
from diagarc.llm.token_counts import op10_token_counts
from diagarc.llm.topk import op7_pivot_top_k
from diagarc.llm.turn_repair import op11_turn_repair

QUERIES = {f.__name__: f for f in (
    op1_main_text, op2_mix_sources, op3_secrets, op4_language_id, op5_fingerprints, op6_pack_best_fit, op7_pivot_top_k,
    op8_remove_repeats, op9_jaccard_join, op10_token_counts)}
#: Those that came after the first ten.
LATER_QUERIES = {f.__name__: f for f in (op11_turn_repair, op12_quality, op13_prefix_trie)}

ORACLES = {"op7_pivot_top_k": topk.SQL, "op8_remove_repeats": repeats.SQL, "op9_jaccard_join": jaccard.SQL}
LATER_ORACLES = {"op11_turn_repair": turn_repair.SQL, "op13_prefix_trie": prefix_trie.SQL}
