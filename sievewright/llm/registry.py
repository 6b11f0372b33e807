"""Names of the queries of this subpackage, and the SQL of those that it can express."""

from . import digests, embedding_dups, minhash_dups, mixing, packing, quality, repeats, resharding, secret_scan, token_output

QUERIES = {
    "op1_token_output": token_output.op1_token_output,
    "op2_minhash_dups": minhash_dups.op2_minhash_dups,
    "op3_embedding_dups": embedding_dups.op3_embedding_dups,
    "op4_source_mixing": mixing.op4_source_mixing,
    "op5_repeated_strings": repeats.op5_repeated_strings,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_resharding": resharding.op9_resharding,
    "op10_document_digests": digests.op10_document_digests,
}
SQL = {"op4_source_mixing": mixing.SQL}
