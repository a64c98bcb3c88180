"""Helpers for operators on vectors: which rows are whole, and their integer components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key that holds at least one row in so many is hot; there are never more hot keys than that.
HOT_SHARE = 1000


def whole(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is neither NULL nor empty and has only finite components."""
    finite = f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    return rows.filter(f"{vector} IS NOT NULL AND size({vector}) > 0 AND {finite}")


def of_one_length(rows: DataFrame, key: str, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows whose vector is as long as that of the row with the smallest key, and this length (0: no rows)."""
    first = rows.agg(F.min(F.struct(F.col(key).isNull().alias("last"), key, F.size(vector).alias("size"))).alias("x")).first().x
    length = first["size"] if first else 0
    return rows.filter(F.size(vector) == length), length


def scaled(column: pa.Array, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) of every component, a row for each vector; the vectors are whole and of one length.

    Integers over `limit` raise, as sums of their products would not be exact any more.
    """
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(values * scale)
    if len(out) and np.abs(out).max() > limit:
        raise ValueError(f"a component times {scale} exceeds {limit}")
    return out.astype(np.int64).reshape(len(column), -1)


def with_group_sum(rows: DataFrame, sums: DataFrame, key: str, name: str) -> DataFrame:
    """`rows` with the column `name` of `sums` (key, name, n: the rows of the key), NULL keys together.

    Keys that hold a large share of all rows are looked up in a broadcast of at most HOT_SHARE rows;
    only the others are shuffled.
    """
    total = sums.agg(F.sum("n")).first()[0] or 0
    named = sums.select(F.col(key).alias("key_"), name, (F.col("n") * HOT_SHARE >= total).alias("hot_"))
    hot, cold = named.filter("hot_"), named.filter("NOT hot_").drop("hot_")
    seen = rows.join(F.broadcast(hot), rows[key].eqNullSafe(hot["key_"]), "left")
    found = seen.filter("hot_").drop("hot_", "key_")
    rest = seen.filter("hot_ IS NULL").drop("hot_", "key_", name)
    return found.unionByName(rest.join(cold, rest[key].eqNullSafe(cold["key_"])).drop("key_"))
