"""Helpers of the operators on embeddings: which vectors count, and Arrow lists as matrices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector of at least one component, none of them null or non-finite; never null."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def matrix(lists):
    """An Arrow list column without nulls and with lists of one length, as float64 rows."""
    import numpy as np

    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(lists), -1)
