"""Vector expressions: hashed term vectors and cosine scores as Spark built-ins."""



from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the default (model-free) embedding.
DEFAULT_DIM = 128
TERM_SPLIT = r"[^\p{L}\p{N}]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def terms(text: Column | str) -> Column:
    """Lower-cased letter/digit runs."""
    return F.filter(F.split(F.lower(_c(text)), TERM_SPLIT), lambda t: t != "")


def term_bucket(term: Column, dim: int = DEFAULT_DIM) -> Column:
    """Bucket of a term: first 32 bits of its md5, modulo ``dim``."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint") % dim


def term_buckets(text: Column | str, dim: int = DEFAULT_DIM) -> Column:
    """Bucket id of every term (``array<bigint>``), computed JVM-side."""
    return F.transform(terms(text), lambda t: term_bucket(t, dim))


def bucket_counts(buckets: Column, dim: int = DEFAULT_DIM) -> Column:
    """Dense count vector of a bucket list (Arrow-batched ``np.bincount``)."""
    import numpy as np
    import pandas as pd

    @F.pandas_udf("array<float>")
    def _dense(s: pd.Series) -> pd.Series:
        return s.map(lambda b: np.bincount(np.asarray(b if b is not None else [], dtype=np.int64),
                                           minlength=dim).astype(np.float32))

    return _dense(buckets)


def hashed_term_vector(text: Column | str, dim: int = DEFAULT_DIM) -> Column:
    """Term counts hashed into ``dim`` buckets, as ``array<float>``.

    Counts stay integers (exact in float), so cosine scores computed from them
    are reproducible bit for bit by any engine.  Hashing runs in built-in
    expressions; only the final count per bucket is a vectorized pandas step
    (nested higher-order functions would be interpreted per element).
    """
    return bucket_counts(term_buckets(text, dim), dim)


def dot(a: Column | str, b: Column | str) -> Column:
    prod = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """dot(a,b) / sqrt(|a|^2 |b|^2); 0 when either vector is zero."""
    den = dot(a, a) * dot(b, b)
    return F.when(den > 0, dot(a, b) / F.sqrt(den)).otherwise(F.lit(0.0))
