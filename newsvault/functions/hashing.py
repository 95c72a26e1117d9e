"""Hash keys and change hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from newsvault.constants import HASH_SEPARATOR


def hash_key(business_key: Column) -> Column:
    """MD5 of one business key in its text form."""
    return F.md5(business_key.cast("string"))


def composite_key(*hash_keys: Column) -> Column:
    """MD5 over already hashed keys; NULL parts are skipped."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *hash_keys))


def number_text(c: Column) -> Column:
    """Double as text in plain notation where Spark would switch to exponents.

    Spark writes 1.0E-4 and 1.2345678E7; stored change hashes were made from 0.0001 and
    12345678.0. Outside 1e-4..1e15 both sides use exponents and Spark's form stays.
    """
    size = F.abs(c)
    plain = F.rtrim(F.btrim(c.try_cast("decimal(38,20)").cast("string")), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    odd = ((size >= 1e-4) & (size < 1e-2)) | ((size >= 1e7) & (size < 1e15))
    return F.when(odd, plain).otherwise(c.cast("string"))


def change_hash(df: DataFrame, columns: list[str]) -> Column:
    """MD5 over the text of the columns, NULL as empty text, in the order given."""
    parts = []
    for name in columns:
        dtype = df.schema[name].dataType
        text = (number_text(F.col(name)) if isinstance(dtype, (DoubleType, FloatType))
                else F.col(name).cast("string"))
        parts.append(F.coalesce(text, F.lit("")))
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))
