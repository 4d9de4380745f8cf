"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from tillroll.llm.block_neighbours import op8_block_neighbours
from tillroll.llm import oracles
from tillroll.llm.mean_order_clusters import op13_mean_order_clusters
from tillroll.llm.minimax_shards import op3_minimax_shards
from tillroll.llm.order_minhash import op12_order_minhash
from tillroll.llm.packing import op6_window_packing
from tillroll.llm.page_crf import op7_page_crf
from tillroll.llm.secret_ledger import op10_secret_ledger
from tillroll.llm.shingle_join import op5_shingle_join
from tillroll.llm.spelling_variants import op11_spelling_variants
from tillroll.llm.string_tiling import op9_string_tiling
from tillroll.llm.suffix_dedup import op1_suffix_dedup
from tillroll.llm.surrogates import op4_surrogates
from tillroll.llm.toxic_grammar import op2_toxic_grammar

QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_toxic_grammar,
        op3_minimax_shards,
        op4_surrogates,
        op5_shingle_join,
        op6_window_packing,
        op7_page_crf,
        op8_block_neighbours,
        op9_string_tiling,
        op10_secret_ledger,
        op11_spelling_variants,
        op12_order_minhash,
        op13_mean_order_clusters,
    )
}
ORACLE: dict[str, str] = dict(oracles.SQL)
