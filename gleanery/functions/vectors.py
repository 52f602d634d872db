"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def norm(v: Column) -> Column:
    squares = F.transform(v, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def unit(v: Column) -> Column:
    """Scale to length one, as floats; a zero vector stays as it is."""
    # The one-element array makes the length a variable, computed once per vector.
    scaled = F.transform(
        F.array(norm(v)),
        lambda length: F.transform(
            v, lambda x: F.coalesce(F.try_divide(x.cast("double"), length), F.lit(0.0)).cast("float")
        ),
    )
    return scaled[0]


def _rows(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype("float64").reshape(len(lists), -1)


# Products of pairs of vectors run on Arrow batches: summing up arrays with SQL
# lambdas took several times as long, see the README.


def pair_dot(a: Column, b: Column) -> Column:
    """Inner product of two vector columns, row by row."""

    def dots(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(np.einsum("ij,ij->i", _rows(a), _rows(b)))

    return F.arrow_udf(dots, DoubleType())(a, b)


def pair_cosine(a: Column, b: Column) -> Column:
    """Cosine of two vector columns, row by row; zero for a vector without length."""

    def cosines(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = _rows(a), _rows(b)
        size = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
        dots = np.einsum("ij,ij->i", x, y)
        return pa.array(np.divide(dots, size, out=np.zeros_like(dots), where=size > 0))

    return F.arrow_udf(cosines, DoubleType())(a, b)


def rounded(score: Column, digits: int | None) -> Column:
    """Scores are rounded before ranking so that equal texts tie exactly.

    Adding zero turns a negative zero into a plain one.
    """
    return score if digits is None else F.round(score, digits) + F.lit(0.0)
