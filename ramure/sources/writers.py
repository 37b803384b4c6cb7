"""Writers, and encryption of sensitive columns."""

from __future__ import annotations

import secrets
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_output(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write parquet, or semicolon-separated CSV, by suffix; returns the rows written, counted during the write."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if path.endswith(".parquet"):
        counted.write.mode(mode).parquet(path)
    elif path.endswith(".csv"):
        counted.write.mode(mode).csv(path, header=True, sep=";")
    else:
        raise ValueError(f"unsupported file format: {path}; use .parquet or .csv")
    return int(seen.get["rows"])


def new_key() -> str:
    """A random key of 32 characters."""
    return secrets.token_hex(16)


def _key(df: DataFrame, key: str) -> Column:
    """The key as the value of a one-row table, so that no plan text shows it."""
    if len(key) not in (16, 24, 32):
        raise ValueError("the key must have 16, 24 or 32 characters")
    return df.sparkSession.createDataFrame([(bytearray(key.encode()),)], "key binary").scalar()


def protect_columns(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """AES-GCM encrypt text columns; NULL stays NULL."""
    secret = _key(df, key)
    return df.withColumns({
        name: F.aes_encrypt(F.col(name).cast("string").cast("binary"), secret, F.lit("GCM")) for name in columns})


def reveal_columns(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Undo `protect_columns`; a wrong key is an error."""
    secret = _key(df, key)
    return df.withColumns({name: F.aes_decrypt(F.col(name), secret, F.lit("GCM")).cast("string") for name in columns})
