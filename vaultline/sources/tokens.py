"""Tokens for personal data (P1): joined on, not guessed, and read back by
whoever holds the secrets.

A token is a keyed hash (HMAC-SHA256) of the value under a key drawn from the
domain's current secret, with the secret's version in front. Equal values of a
domain have equal tokens in every table, so joins and counts survive. A stored
map holds the value of each token, encrypted (AES-GCM); no output and no stored
row holds a value or an unkeyed digest of one. Rotation adds a secret: new
tokens take it, old ones stay readable, and ``rotate`` carries a table over.
A secret that is withdrawn leaves its tokens unreadable for good.

The map is a ``keyed.Bucketed`` table: a load reads the buckets that its tokens
fall into and appends the new ones.

Defined results: NULL stays NULL; the empty text has a token; a token that the
map lacks, or whose secret is withdrawn, reads back as NULL; other columns pass
through. Values are handled as text.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.protect import decrypt_value, encrypt_value, hmac_sha256
from vaultline.operators.ordered import union_all_by_name
from vaultline.sources.keyed import Bucketed
from vaultline.sources.snapshots import Snapshots


class TokenVault:
    """``secrets``: {version: secret}; the highest version is the current one."""

    def __init__(self, store: Snapshots, domain: str, secrets: Mapping[int, bytes], n: int = 64):
        if not secrets or any(len(s) < 16 for s in secrets.values()):
            raise ValueError("secrets of at least 16 bytes are needed")
        self.domain, self.secrets, self.current = domain, dict(secrets), max(secrets)
        self.map = Bucketed(store, f"tokens_{domain}", "token", n)

    def key(self, use: str, version: int) -> bytes:
        """The domain's key for ``use`` (token, map): one secret never keys two jobs."""
        return hmac.new(self.secrets[version], f"{use}:{self.domain}".encode(), hashlib.sha256).digest()

    def token(self, c: Column, version: int | None = None) -> Column:
        v = version or self.current
        return F.concat(F.lit(f"v{v}_"), hmac_sha256(c, self.key("token", v)))

    def tokenize(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """(action) ``df`` with tokens in ``cols``; their values are stored first."""
        values = union_all_by_name([df.select(F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
        values = values.filter("value IS NOT NULL").distinct()
        cipher = encrypt_value("value", F.lit(self.key("map", self.current)))
        self.map.insert(values.select(self.token(F.col("value")).alias("token"), cipher.alias("cipher")))
        return df.withColumns({c: self.token(F.col(f"`{c}`")) for c in cols})

    def detokenize(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """``df`` with the values of the tokens in ``cols``, of any version."""
        value = F.lit(None).cast("string")
        for v in self.secrets:
            value = F.when(F.col("token").startswith(f"v{v}_"),
                           decrypt_value("cipher", F.lit(self.key("map", v)))).otherwise(value)
        out, names = df, df.columns
        for i, c in enumerate(cols):
            # One row per token: a value that fills the table is split on the side of ``df`` only.
            held = self.map.read().select(F.col("token").alias(f"_token{i}"), value.alias(f"_value{i}"))
            out = out.join(held, out[f"`{c}`"] == held[f"_token{i}"], "left")
        return out.select(*[F.col(f"_value{list(cols).index(c)}").alias(c) if c in cols else F.col(f"`{c}`") for c in names])

    def rotate(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """(action) ``df`` with tokens of the current version for those of any."""
        return self.tokenize(self.detokenize(df, cols), cols)
