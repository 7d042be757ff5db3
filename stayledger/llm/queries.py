"""The queries of this subpackage, and DuckDB SQL where SQL can state them.

``pipeline`` is registered by ``__spark_entry__.py`` from ``corpus_pipeline.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayledger.llm.alignment import op13_tokenizer_spans
from stayledger.llm.decontaminate import OP2_SQL, op2_suffix_automaton
from stayledger.llm.langid import op1_nearest_centroid
from stayledger.llm.licenses import op10_license_rules
from stayledger.llm.lines import op8_minhash_lines
from stayledger.llm.passages import op9_collinear_chains
from stayledger.llm.prefix_trie import OP12_SQL, op12_time_forward_trie
from stayledger.llm.quality_rules import OP11_SQL, op11_rule_ledger
from stayledger.llm.secrets import op4_secret_randomness
from stayledger.llm.sharding import op3_rendezvous_sharding
from stayledger.llm.simhash import op6_simhash_covering
from stayledger.llm.subwords import op7_gumbel_segmentations
from stayledger.llm.vector_search import op5_permutation_index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_nearest_centroid,
        op2_suffix_automaton,
        op3_rendezvous_sharding,
        op4_secret_randomness,
        op5_permutation_index,
        op6_simhash_covering,
        op7_gumbel_segmentations,
        op8_minhash_lines,
        op9_collinear_chains,
        op10_license_rules,
        op11_rule_ledger,
        op12_time_forward_trie,
        op13_tokenizer_spans,
    )
}

ORACLES: dict[str, str] = {"op2_suffix_automaton": OP2_SQL, "op11_rule_ledger": OP11_SQL, "op12_time_forward_trie": OP12_SQL}
