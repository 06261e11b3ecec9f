from rankforge.functions.features import (  # noqa: F401
    bucketize, bucketize_vector, hash_bucket, hash_self, vocab_index, identity_id,
    cross_hash, cross_list, indicator_counts, normalise, numeric, vector, parse_list,
    calendar_features, date_shift, compile_features, input_layer,
)
