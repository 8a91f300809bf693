"""The queries of this subpackage, by the names under which they are registered."""

from __future__ import annotations

from netload.llm import twins
from netload.llm.byte_bpe import op7_byte_level_bpe
from netload.llm.lattice_lm import op2_lattice_score
from netload.llm.license_scan import op5_license_scan
from netload.llm.merkle import op13_merkle_manifest
from netload.llm.ngram_join import op4_ngram_jaccard_join
from netload.llm.packing import op10_harmonic_packing
from netload.llm.pivot_search import OP1_SQL, op1_pivot_top_k
from netload.llm.planes import op9_bit_plane_output
from netload.llm.prefix_trie import op12_prefix_trie
from netload.llm.quality_net import op11_quality_classifier
from netload.llm.quality_rules import op3_quality_rules
from netload.llm.sharding import op8_sharding
from netload.llm.substring_dedup import op6_substring_dedup

_ALL = [
    op1_pivot_top_k, op2_lattice_score, op3_quality_rules, op4_ngram_jaccard_join, op5_license_scan,
    op6_substring_dedup, op7_byte_level_bpe, op8_sharding, op9_bit_plane_output, op10_harmonic_packing,
    op11_quality_classifier, op12_prefix_trie, op13_merkle_manifest,
]

QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {
    "op1_pivot_top_k": OP1_SQL, "op4_ngram_jaccard_join": twins.OP4_SQL, "op6_substring_dedup": twins.OP6_SQL,
    "op12_prefix_trie": twins.OP12_SQL, "op13_merkle_manifest": twins.OP13_SQL,
}
