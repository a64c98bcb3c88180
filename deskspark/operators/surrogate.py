"""Target ids for rows that are new to the target.

Numbers depend on the data alone, never on partition ids, so a task that is run again
gives the same ids. Each new key falls into one of 16**DIGITS buckets by its md5; a bucket's
ids start where the counts of the buckets before it end. Only the table of bucket counts,
whose size is fixed, goes through one task or a broadcast.

Where the buckets would be too large for a task, the same order (bucket, then key) is cut into
as many ranges as the rows need, on a written copy, and the counts are those of the ranges. A key
gets the same id either way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 3
COPIES_PER_CHUNK = 65536
ROWS_PER_PART = 1 << 22
PART_DIGITS = 12
_POSITION_BITS = 33  # of monotonically_increasing_id; the bits above hold the part


@dataclass(frozen=True)
class Ranges:
    """Numbering by ranges: how many, and what writes a table to shared storage and reads it back."""

    parts: int
    stage: Callable[[str, DataFrame], DataFrame]

    @classmethod
    def needed(cls, rows: int, stage: Callable[[str, DataFrame], DataFrame], digits: int = DIGITS,
               rows_per_part: int = ROWS_PER_PART) -> "Ranges | None":
        """None while buckets of `rows` rows in all are no larger than a part should be."""
        return cls(-(-rows // rows_per_part), stage) if rows > rows_per_part * 16**digits else None


def place_keys(keys: DataFrame, key: str, digits: int = DIGITS) -> DataFrame:
    """(key, bucket, last): 1, 2, … within each bucket. Keys are distinct and not NULL.

    The bucket is declared never NULL so that the join and the count read one shuffle.
    """
    return keys.sparkSession.sql(
        f"""SELECT {key}, bucket,
                   CAST(row_number() OVER (PARTITION BY bucket ORDER BY {key}) AS BIGINT) AS last
            FROM (SELECT {key}, coalesce(substr(md5(CAST({key} AS STRING)), 1, {digits}), '') AS bucket FROM {{keys}})""",
        keys=keys,
    )


def _ranged(rows: DataFrame, order: list[str], ranges: Ranges, label: str) -> DataFrame:
    """`rows` with `part` and `place` (from 0) in the order of `order`, written so that both stay as they are.

    The rows are written before, as finding the ranges reads them a second time.
    """
    written = ranges.stage(f"{label}_rows", rows)
    dealt = written.repartitionByRange(ranges.parts, *order).sortWithinPartitions(*order)
    placed = ranges.stage(f"{label}_placed", dealt.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", _POSITION_BITS)
    return placed.withColumn("part", F.lpad(part.cast("string"), PART_DIGITS, "0")).withColumn(
        "place", F.col("place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))


def place_keys_by_ranges(keys: DataFrame, key: str, ranges: Ranges, digits: int = DIGITS) -> DataFrame:
    """As `place_keys`, with ranges of the same order as buckets."""
    ordered = keys.selectExpr(key, f"coalesce(substr(md5(CAST({key} AS STRING)), 1, {digits}), '') AS bucket")
    placed = _ranged(ordered, ["bucket", key], ranges, "keys")
    return placed.selectExpr(key, "part AS bucket", "place + 1 AS last")


def place_copies_by_ranges(rows: DataFrame, ranges: Ranges, digits: int = DIGITS) -> DataFrame:
    """As `place_copies`, with ranges of the same order as buckets."""
    columns = ", ".join(rows.columns)
    counted = rows.sparkSession.sql(
        f"""SELECT *, coalesce(substr(md5(to_json(struct({columns}))), 1, {digits}), '') AS bucket_
            FROM (SELECT {columns}, count(1) AS copies_ FROM {{rows}} GROUP BY {columns})""", rows=rows)
    placed = _ranged(counted, ["bucket_", *rows.columns], ranges, "copies")
    return rows.sparkSession.sql(
        f"""SELECT {columns}, copies_, concat('z', part) AS bucket,
                   sum(copies_) OVER (PARTITION BY part ORDER BY place
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
            FROM {{placed}}""", placed=placed)


def place_copies(rows: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(the row, copies_, bucket, last): equal rows counted, with the running count per bucket.
    The count combines before the shuffle, so no task receives all copies of a row."""
    columns = ", ".join(rows.columns)
    return rows.sparkSession.sql(
        f"""SELECT *, sum(copies_) OVER (PARTITION BY bucket ORDER BY {columns}
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
            FROM (SELECT *, concat('z', coalesce(substr(md5(to_json(struct({columns}))), 1, {digits}), '')) AS bucket
                  FROM (SELECT {columns}, count(1) AS copies_ FROM {{rows}} GROUP BY {columns}))""",
        rows=rows,
    )


def bucket_starts(target: DataFrame, surrogate: str, *placed: DataFrame, top: int | None = None) -> DataFrame:
    """(bucket, start): the target's highest id (or `top`) plus all counts of the buckets before.

    A bucket's count is its highest place, read off the shuffle that the places were given on.
    At most 16**DIGITS rows per placed table, or one per ROWS_PER_PART of its rows, so one task adds them up.
    """
    tables = {f"p{i}": table for i, table in enumerate(placed)}
    sizes = [f"SELECT bucket, max(last) AS n FROM {{{name}}} GROUP BY bucket" for name in tables]
    highest = f"SELECT '' AS bucket, coalesce(CAST(max({surrogate}) AS BIGINT), 0) AS n FROM {{target}}"
    if top is not None:
        highest = f"SELECT '' AS bucket, {top}L AS n"
    return target.sparkSession.sql(
        f"""SELECT bucket, coalesce(sum(n) OVER (ORDER BY bucket
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM ({' UNION ALL '.join([highest, *sizes])})""",
        **({} if top is not None else {"target": target}), **tables,
    )


def key_ids(placed: DataFrame, starts: DataFrame, key: str, surrogate: str) -> DataFrame:
    """(key, surrogate) for placed keys."""
    return placed.sparkSession.sql(
        f"""SELECT /*+ BROADCAST(s) */ p.{key}, s.start + p.last AS {surrogate}
            FROM {{placed}} p JOIN {{starts}} s ON p.bucket = s.bucket""",
        placed=placed, starts=starts,
    )


def copy_ids(placed: DataFrame, starts: DataFrame, columns: list[str], surrogate: str) -> DataFrame:
    """Placed copies written out again, each with its id, in chunks that any task may take."""
    names = ", ".join(columns)
    return placed.sparkSession.sql(
        f"""SELECT first_ + copy_ AS {surrogate}, {names}
            FROM (SELECT /*+ REPARTITION(first_, chunk_) */ *
                  FROM (SELECT *, explode(sequence(0L, (copies_ - 1) DIV {COPIES_PER_CHUNK})) AS chunk_
                        FROM (SELECT /*+ BROADCAST(s) */ p.*, s.start + p.last - p.copies_ + 1 AS first_
                              FROM {{placed}} p JOIN {{starts}} s ON p.bucket = s.bucket)))
            LATERAL VIEW explode(sequence(chunk_ * {COPIES_PER_CHUNK},
                                          least((chunk_ + 1) * {COPIES_PER_CHUNK}, copies_) - 1)) AS copy_""",
        placed=placed, starts=starts,
    )


def new_key_ids(keys: DataFrame, key: str, target: DataFrame, surrogate: str, digits: int = DIGITS) -> DataFrame:
    """(key, surrogate) for keys that are distinct, not NULL and absent from the target."""
    placed = place_keys(keys, key, digits)
    return key_ids(placed, bucket_starts(target, surrogate, placed), key, surrogate)
