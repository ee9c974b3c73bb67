"""The registered queries of this package: one per operator, and the pipeline's SQL where it has any."""

from tavola.llm import (
    byte_bpe,
    collocations,
    lexical_search,
    merkle,
    mixing,
    near_duplicates,
    permutation_index,
    personal_data,
    quote_linking,
    rule_quality,
    sentence_pieces,
    sharding,
    token_files,
)
from tavola.llm.oracle import ORACLE_SQL  # noqa: F401

QUERIES = {
    "op1_permutation_index": permutation_index.query,
    "op2_minhash": near_duplicates.query,
    "op3_merkle": merkle.query,
    "op4_bin_packing": sharding.query,
    "op5_token_files": token_files.query,
    "op6_personal_data": personal_data.query,
    "op7_quote_linking": quote_linking.query,
    "op8_byte_bpe": byte_bpe.query,
    "op9_rule_quality": rule_quality.query,
    "op10_fair_queueing": mixing.query,
    "op11_collocations": collocations.query,
    "op12_lexical_search": lexical_search.query,
    "op13_sentence_pieces": sentence_pieces.query,
}
