from blockmill.functions.hashing import unit_hash
from blockmill.functions.ids import (
    append_eos, attention_mask, block_slice, file_digest, ids_digest, lm_labels,
    resolve_pad, shard_name, to_long_ids,
)
from blockmill.functions.tokenizers import ByteTokenizer, FileTokenizer, WordTokenizer

__all__ = [
    "ByteTokenizer", "FileTokenizer", "WordTokenizer", "append_eos", "attention_mask",
    "block_slice", "file_digest", "ids_digest", "lm_labels", "resolve_pad",
    "shard_name", "to_long_ids", "unit_hash",
]
