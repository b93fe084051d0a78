"""Column builders: hash keys, rule predicates, protection."""

from vaultline.functions.checks import (accepted, any_null, blank, hash_key_format, in_range,
                                        is_true, length_between, matches, max_length, min_length,
                                        not_null)
from vaultline.functions.hashing import as_text, hash_diff, surrogate_key
from vaultline.functions.protect import decrypt_value, encrypt_value, mask_value

__all__ = [
    "accepted", "any_null", "as_text", "blank", "decrypt_value", "encrypt_value",
    "hash_diff", "hash_key_format", "in_range", "is_true", "length_between", "mask_value",
    "matches", "max_length", "min_length", "not_null", "surrogate_key",
]
