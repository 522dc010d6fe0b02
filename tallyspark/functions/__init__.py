from tallyspark.functions.hashing import (
    DEFAULT_PRIME,
    bucket_hash,
    edge_bucket,
    low32,
    mod_hash,
    node_color,
    sign_hash,
    sorted3,
)
from tallyspark.functions.text import lines, words

__all__ = [
    "DEFAULT_PRIME", "bucket_hash", "edge_bucket", "low32", "mod_hash",
    "node_color", "sign_hash", "sorted3", "lines", "words",
]
