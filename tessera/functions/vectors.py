"""Vector arithmetic on array columns, and a deterministic embedding of text."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 if either vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def normalise(a: Column) -> Column:
    n = norm(a)
    return F.when(n == 0, a).otherwise(F.transform(a, lambda x: x.cast("double") / n))


def quantise(a: Column) -> Column:
    """Signed bytes of a unit vector."""
    return F.transform(a, lambda x: F.round(x * 127).cast("tinyint"))


def hashed(texts: list[str], size: int = 64) -> np.ndarray:
    """Unit vectors: signed hashes of each text's words and word pairs."""
    out = np.zeros((len(texts), size), np.float32)
    for i, t in enumerate(texts):
        words = (t or "").lower().split()
        for gram in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            h = xxhash.xxh64_intdigest(gram)
            out[i, h % size] += 1 if h >> 63 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embedder(size: int = 64):
    """An Arrow UDF from text to a unit vector, by ``hashed``."""
    return F.pandas_udf(lambda texts: pd.Series(list(hashed(texts.tolist(), size))), ArrayType(FloatType()))


def term_weights(words: Column) -> Column:
    """Sparse weights by word: 1 + ln of its count."""
    distinct = F.array_sort(F.array_distinct(words))
    return F.map_from_arrays(distinct, F.transform(distinct, lambda w: 1 + F.log(F.size(F.filter(words, lambda x: x == w)).cast("double"))))
