"""Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""

from .columns import (euclidean, key_bucket, key_hash, squared_distance, with_rank,
                      with_row_index)

__all__ = ["euclidean", "key_bucket", "key_hash", "squared_distance", "with_rank",
           "with_row_index"]
