"""Personal columns at rest: encrypted on write, readable only with the right key.

The key is an argument; keeping it in a key store is the caller's part. In a plan it is a binary
literal, so sessions redact those in plan texts (REDACTED, see `hide_keys`).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PERSONAL = ("nombre", "apellido", "email", "telefono")
SUFFIX = "_encrypted"
#: Binary literals of a key's length, as plans and SQL print them.
REDACTED = r"(?:0x|X')(?:[0-9A-Fa-f]{2}){16,32}'?"


class WrongKeyError(ValueError):
    """Stored rows do not open under this key."""


def hide_keys(spark: SparkSession) -> None:
    """Plan texts of the session show no key from now on."""
    spark.conf.set("spark.sql.redaction.string.regex", REDACTED)


def assert_key(df: DataFrame, key: str, columns: Iterable[str] = PERSONAL) -> None:
    """An error where a stored value does not open under the key."""
    secret = F.lit(key.encode())
    sealed = [F.col(c + SUFFIX) for c in columns]
    shut = reduce(lambda a, b: a | b, [c.isNotNull() & F.try_aes_decrypt(c, secret).isNull() for c in sealed])
    if not df.where(shut).isEmpty():
        raise WrongKeyError("stored personal data does not open under this key")


def encrypt_columns(df: DataFrame, key: str, columns: Iterable[str] = PERSONAL) -> DataFrame:
    """Replace each text column by its encrypted form `<name>_encrypted`."""
    names = set(columns)
    secret = F.lit(key.encode())
    return df.select(
        *[
            F.aes_encrypt(F.col(c).cast("binary"), secret).alias(c + SUFFIX) if c in names else F.col(c)
            for c in df.columns
        ]
    )


def decrypt_columns(df: DataFrame, key: str, columns: Iterable[str] = PERSONAL) -> DataFrame:
    """The readable columns again; all NULL under a wrong key."""
    names = {c + SUFFIX: c for c in columns}
    secret = F.lit(key.encode())
    return df.select(
        *[
            F.try_aes_decrypt(F.col(c), secret).cast("string").alias(names[c])
            if c in names
            else F.col(c)
            for c in df.columns
        ]
    )
