"""Keyed pseudonyms: equal values stay equal, so tables still join, and nobody without the key can test a guess.

A pseudonym is HMAC-SHA-256 of the value under a secret, put together from built-in functions. A plain
hash would not do: tax ids and card numbers are few enough to be hashed one by one. The secret comes
from a session setting whose name Spark hides in its listings, and reaches the job as the value of
a subquery, so neither plans nor event logs show it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.tallylake.pseudonymSecret"
SHORTEST = 16  # bytes
_BLOCK = 64  # bytes of a SHA-256 block

# Personal columns by kind; columns of the same kind share their pseudonyms.
KINDS = {
    "cpf": "cpf",
    "email": "email",
    "num_cartao": "cartao",
    "numero_cartao": "cartao",
    "nom_impresso": "nome_impresso",
    "nome_impresso_cartao": "nome_impresso",
}


def secret_of(spark: SparkSession) -> bytes:
    """The session's secret; without a long enough one there are no pseudonyms."""
    secret = (spark.conf.get(SETTING, None) or "").encode()
    if len(secret) < SHORTEST:
        raise ValueError(f"{SETTING} must hold a secret of {SHORTEST} bytes or more")
    return secret


def pads(spark: SparkSession, secret: bytes, kind: str) -> tuple[Column, Column]:
    """The inner and outer key of a kind, as columns that no plan prints."""
    own = hashlib.sha256(kind.encode() + b"\0" + secret).digest().ljust(_BLOCK, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in own), bytes(b ^ 0x5C for b in own)
    keys = spark.createDataFrame([(bytearray(inner), bytearray(outer))], "inner binary, outer binary")
    return keys.select("inner").scalar(), keys.select("outer").scalar()


def pseudonym(value: Column, keys: tuple[Column, Column]) -> Column:
    """64 hex digits; NULL stays NULL and empty text is a value like any other."""
    inner, outer = keys
    first = F.unhex(F.sha2(F.concat(inner, value.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(outer, first), 256)


def mask_keyed(df: DataFrame, secret: bytes | None = None) -> DataFrame:
    """``df`` with pseudonyms in its personal columns; the session's secret unless one is given."""
    spark = df.sparkSession
    secret = secret_of(spark) if secret is None else secret
    return df.withColumns(
        {c: pseudonym(F.col(c), pads(spark, secret, kind)) for c, kind in KINDS.items() if c in df.columns}
    )
