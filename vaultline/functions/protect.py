"""Column protection expressions (P1 masking, P2 encryption)."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK_MODES = ("mask", "hash", "hmac", "last4", "null")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    """The inner and outer block of an HMAC-SHA256 key (RFC 2104)."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def hmac_sha256(c, key: bytes) -> Column:
    """HMAC-SHA256 of the text, lower-case hex: equal values stay equal, so it can
    be joined on, but without the key no value can be tried. NULL stays NULL. The key is a
    literal of the plan, like the key of ``encrypt_value``."""
    inner, outer = hmac_pads(key)
    text = F.encode(_col(c).cast("string"), "UTF-8")
    return F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), text), 256))), 256)


def mask_value(c, how: str = "mask", secret: bytes | None = None) -> Column:
    """P1. ``mask``: upper -> X, lower -> x, digit -> n (others kept);
    ``hash``: SHA-256 hex of the text, which anyone can compute for values that they
    guess; ``hmac``: the same keyed by ``secret``, for personal data that is joined on;
    ``last4``: all but the last four characters become '*', and all of a value of four or
    fewer; ``null``: drop the value."""
    col = _col(c).cast("string")
    if how == "mask":
        return F.mask(col)
    if how == "hash":
        return F.sha2(col, 256)
    if how == "hmac":
        if not secret:
            raise ValueError("hmac needs a secret")
        return hmac_sha256(col, secret)
    if how == "last4":
        n = F.length(col)
        return F.when(n <= 4, F.repeat(F.lit("*"), n)).otherwise(
            F.concat(F.repeat(F.lit("*"), n - 4), F.substring(col, -4, 4)))
    if how == "null":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown mask mode {how!r}; expected one of {MASK_MODES}")


def encrypt_value(c, key: Column) -> Column:
    """AES-GCM with a random IV per value, base64 text out. ``key`` is a
    Column (e.g. ``F.lit(secret)`` built from config, 16/24/32 bytes)."""
    return F.base64(F.aes_encrypt(_col(c).cast("string").cast("binary"), key, F.lit("GCM")))


def decrypt_value(c, key: Column) -> Column:
    """Inverse of ``encrypt_value``; NULL stays NULL."""
    return F.aes_decrypt(F.unbase64(_col(c)), key, F.lit("GCM")).cast("string")
