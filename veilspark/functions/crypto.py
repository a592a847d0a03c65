"""AES-GCM wrapping of key material and random key generation.

Wrapping binds each wrapped key to its attribute and KEK version through
the GCM additional authenticated data (AAD), so a key unwrapped with the
wrong version or for the wrong attribute comes back NULL instead of as
garbage. Keys always arrive as table columns; a key given as a literal
would be printed (as hex) in every query plan.
"""

from __future__ import annotations

import secrets

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_BYTES = 32
GCM_OVERHEAD = 28  # 12-byte IV + 16-byte tag


def key_aad(attribute: Column, kek_version: Column) -> Column:
    return F.concat(attribute, F.lit(":"), kek_version).cast("binary")


def wrap(plain: Column, kek: Column, aad: Column) -> Column:
    """AES-256-GCM with a random IV; output = IV || ciphertext || tag."""
    return F.aes_encrypt(plain, kek, F.lit("GCM"), F.lit("DEFAULT"), F.lit("").cast("binary"), aad)


def unwrap(wrapped: Column, kek: Column, aad: Column) -> Column:
    """Inverse of :func:`wrap`; NULL if key, AAD or ciphertext do not match."""
    return F.try_aes_decrypt(wrapped, kek, F.lit("GCM"), F.lit("DEFAULT"), aad)


@F.pandas_udf(T.BinaryType())
def _random_bytes(n: pd.Series) -> pd.Series:
    return pd.Series([secrets.token_bytes(int(k)) for k in n], dtype=object)


_random_bytes = _random_bytes.asNondeterministic()


def random_key(num_bytes: int = KEY_BYTES) -> Column:
    """Cryptographically random bytes per row (Arrow-batched Python UDF).

    Non-deterministic: materialise the frame (write or checkpoint) before
    using it twice, or each use draws new keys.
    """
    return _random_bytes(F.lit(num_bytes))


def from_urlsafe_base64(text: Column) -> Column:
    """BINARY from URL-safe base64 text whose ``=`` padding may be stripped.

    For key material that arrives as text. ``unbase64`` alone rejects the
    URL-safe alphabet; the padding is restored from the length.
    """
    std = F.translate(text, "-_", "+/")
    return F.unbase64(F.concat(std, F.repeat(F.lit("="), F.pmod(-F.length(std), F.lit(4)))))


def to_urlsafe_base64(data: Column) -> Column:
    """URL-safe base64 text without padding (inverse of :func:`from_urlsafe_base64`)."""
    return F.regexp_replace(F.translate(F.base64(data), "+/", "-_"), "=+$", "")
