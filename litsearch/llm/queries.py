"""Queries of the text operators, and their SQL where SQL can say the same."""

from litsearch.llm.op10_context_tree import op10_context_tree
from litsearch.llm.op11_vector_codes import OP11_SQL, op11_vector_codes
from litsearch.llm.op12_packing import op12_packing
from litsearch.llm.op13_centroid_clusters import OP13_SQL, op13_centroid_clusters
from litsearch.llm.op1_token_counts import op1_token_counts
from litsearch.llm.op2_html_text import op2_html_text
from litsearch.llm.op3_language import op3_language
from litsearch.llm.op4_embedding_dedup import OP4_SQL, op4_embedding_dedup
from litsearch.llm.op5_decontamination import op5_decontamination
from litsearch.llm.op6_pii import op6_pii
from litsearch.llm.op7_byte_bpe import op7_byte_bpe
from litsearch.llm.op8_substring_dedup import OP8_SQL, op8_substring_dedup
from litsearch.llm.op9_simhash import op9_simhash

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_html_text": op2_html_text,
    "op3_language": op3_language,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_pii": op6_pii,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash": op9_simhash,
    "op10_context_tree": op10_context_tree,
    "op11_vector_codes": op11_vector_codes,
    "op12_packing": op12_packing,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLE_SQL = {
    "op4_embedding_dedup": OP4_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op11_vector_codes": OP11_SQL,
    "op13_centroid_clusters": OP13_SQL,
}
