"""Salted hashing of sensitive values.

``<col>_hash = SHA2(salt || value, bits)``: the salt (data salt key, DSK)
of the column's sensitivity type goes first, with no separator (all salts
of one type have the same length). Equal values of the same type hash
equally in every table, so hash columns stay joinable after the clear
values are masked; different types use different salts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUPPORTED_BITS = (224, 256, 384, 512)


def salted_hash(value: Column | str, salt: Column, num_bits: int = 512) -> Column:
    """Hex SHA-2 of ``salt || value``. NULL value -> NULL hash.

    Non-string values are hashed through their STRING form, as an
    implicit cast in SQL would do.
    """
    if num_bits not in SUPPORTED_BITS:
        raise ValueError(f"num_bits must be one of {SUPPORTED_BITS}, got {num_bits}")
    v = F.col(value) if isinstance(value, str) else value
    return F.sha2(F.concat(salt, v.cast("string").cast("binary")), num_bits)


def hash_column_name(column: str) -> str:
    from veilspark.schemas import HASH_SUFFIX

    return f"{column}{HASH_SUFFIX}"
