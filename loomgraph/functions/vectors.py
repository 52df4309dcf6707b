"""Expressions over vectors."""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Null if empty, of different lengths or of zero length."""
    scale = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0) & (scale > 0), dot(a, b) / scale)


def clamp(x: Column | str, low: float, high: float) -> Column:
    """As a double within the bounds; null if it isn't a number."""
    number = (F.col(x) if isinstance(x, str) else x).try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number), F.least(F.greatest(number, F.lit(low)), F.lit(high)))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def decode_vector(blobs: pd.Series) -> pd.Series:
    """Base64 of zlib of little-endian float16 values; null if it can't be decoded."""

    def decode(b):
        if b is None:
            return None
        try:
            return np.frombuffer(zlib.decompress(base64.b64decode(b)), "<f2").astype(np.float32)
        except (ValueError, zlib.error):
            return None

    return blobs.map(decode)
