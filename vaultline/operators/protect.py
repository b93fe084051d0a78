"""Masking and encryption of flagged columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.protect import encrypt_value, mask_value


def mask_columns(df: DataFrame, cols: Iterable[str], how: str = "mask", secret: bytes | None = None) -> DataFrame:
    """Replace each listed column by its masked text."""
    return df.withColumns({c: mask_value(c, how, secret) for c in cols})


def encrypt_columns(df: DataFrame, cols: Iterable[str], key: Column) -> DataFrame:
    """Replace each listed column by base64(AES-GCM(text)). Pass the key
    as a Column built from configuration, e.g. ``F.lit(conf_secret)``."""
    return df.withColumns({c: encrypt_value(c, key) for c in cols})


def flagged(protection: DataFrame, table: str) -> dict[str, list[str]]:
    """Read the (small) protection sheet for one table:
    ``{"mask": [...], "encrypt": [...]}``. PII columns without an explicit
    flag are masked."""
    rows = protection.filter(F.col("table_name") == table).collect()
    out = {"mask": [], "encrypt": []}
    for r in rows:
        if r["encrypt"]:
            out["encrypt"].append(r["column_name"])
        elif r["mask"] or r["pii"]:
            out["mask"].append(r["column_name"])
    return out


def protect(df: DataFrame, protection: DataFrame, table: str, key: Column | None = None,
            how: str = "mask", secret: bytes | None = None) -> DataFrame:
    """Apply P1/P2 as the protection sheet says."""
    f = flagged(protection, table)
    out = mask_columns(df, [c for c in f["mask"] if c in df.columns], how, secret)
    enc = [c for c in f["encrypt"] if c in df.columns]
    if enc:
        if key is None:
            raise ValueError(f"columns {enc} need encryption but no key was given")
        out = encrypt_columns(out, enc, key)
    return out
