"""Vectors as short codes: a codebook for each part of the vector, fitted by active-entry Lloyd rounds.

A round assigns every part to its nearest entry and moves each entry to the mean of its parts. Each
row keeps, for every part, its entry and the exact distance to it. If that entry did not move, the
distance still holds and no entry that stayed can have become better, so only the moved entries are
compared; a part whose entry moved is compared with the whole codebook. All numbers are integers, so
results depend neither on the order of rows nor on how they are split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.llm.common import Staged, checkpoint
from deskspark.llm.vectors import of_one_length, scaled, whole, with_group_sum

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row of x, the lowest of equals, and its squared distance."""
    apart = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    code = apart.argmin(axis=1)
    return code, apart[np.arange(len(x)), code]


def reassign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries and distances of one part's rows after the entries marked in `moved` have moved.

    `code` and `apart` are those of before; a code of -1 has never been assigned.
    """
    code, apart = code.copy(), apart.copy()
    again = (code < 0) | moved[code]
    if again.any():
        code[again], apart[again] = nearest(x[again], book)
    fixed = np.flatnonzero(~again)
    if len(fixed):
        own, at_least, still = code[fixed], apart[fixed], x[fixed]
        for e in np.flatnonzero(moved):
            d = ((still - book[e]) ** 2).sum(axis=1)
            better = (d < at_least) | ((d == at_least) & (e < own))
            own[better], at_least[better] = e, d[better]
        code[fixed], apart[fixed] = own, at_least
    return code, apart


class Round:
    """One pass over the rows: assigns the parts and adds up, for the task, the parts of every entry.

    Takes rows of (id, label, ints, code, apart) or, in the first round, (id, label, vector); yields
    rows of the former kind and then the task's sums as rows of (cell, total).
    """

    def __init__(self, books, moved, names: list[str], schema, limit: int, scale: int):
        self.books, self.moved, self.names, self.schema, self.limit, self.scale = books, moved, names, schema, limit, scale

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = self.books
        parts, entries, width = books.shape
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if "ints" in self.names:
                x = np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<i4").astype(np.int64)
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                apart = np.frombuffer(b"".join(batch.column("apart").to_pylist()), "<i8").reshape(n, parts)
            else:
                x = scaled(batch.column(2), self.scale, self.limit)
                code, apart = np.full((n, parts), -1), np.zeros((n, parts), np.int64)
            x = x.reshape(n, parts, width)
            new, far = np.empty((n, parts), np.uint8), np.empty((n, parts), "<i8")
            for p in range(parts):
                own, far[:, p] = reassign(x[:, p], books[p], self.moved[p], code[:, p], apart[:, p])
                new[:, p] = own
                for w in range(width):
                    np.add.at(sums[p, :, w], own, x[:, p, w])
                sums[p, :, width] += np.bincount(own, minlength=entries)
            ints = x.reshape(n, -1).astype("<i4")
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array([r.tobytes() for r in a], pa.binary()) for a in (ints, new, far)]
            columns += [pa.array(far.sum(axis=1)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        cells = sums.reshape(-1)
        used = np.flatnonzero(cells)
        if len(used):
            columns = [pa.nulls(len(used), f.type) for f in self.schema]
            columns[-2:] = [pa.array(used.astype(np.int32)), pa.array(cells[used])]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def replaced(books: np.ndarray, state: DataFrame) -> np.ndarray:
    """The codebooks after every entry moved to the floor of its parts' mean; at most one row a cell is collected."""
    sums = state.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    parts, entries, width = books.shape
    cells = [0] * (parts * entries * (width + 1))
    for r in sums.collect():
        cells[r.cell] = int(r.total)
    out = books.copy()
    for k in range(parts * entries):
        own = cells[k * (width + 1):(k + 1) * (width + 1)]
        if own[-1]:
            out[k // entries, k % entries] = [s // own[-1] for s in own[:-1]]
    return out


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(key, label, code, error, label_error) of every row with a usable vector, and the codebooks (part, entry, position).

    Components become floor(scale * x). Each codebook starts as that part of the `entries` smallest
    keys' vectors (fewer if there are fewer rows; equal keys by vector). `code` holds an index for each
    part, two hex digits each; `error` the squared distances, `label_error` their sum over equal labels.

    Rows whose vector is NULL or empty or has NULL or infinite components take no part, nor do rows
    whose vector has another length than that of the smallest key, nor any if that length is not a
    multiple of `parts`. A NULL key comes last and stays NULL. Repeated rows count and come out each;
    NULL labels form one group; other columns are ignored; without rows the result is empty.
    """
    spark = rows.sparkSession
    kept, length = of_one_length(whole(rows.select(key, label, vector), vector), key, vector)
    kinds = dict((f.name, f.dataType) for f in rows.select(key, label).schema)
    if not length or length % parts:
        schema = T.StructType([T.StructField(key, kinds[key]), T.StructField(label, kinds[label]), T.StructField("code", T.StringType()),
                               T.StructField("error", T.LongType()), T.StructField("label_error", T.LongType())])
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    limit = min(int((2**61 // length) ** 0.5) // 2, 2**31 - 1)
    first = kept.orderBy(F.col(key).asc_nulls_last(), vector).limit(entries).select(vector).collect()
    books = scaled(pa.array([list(r[0]) for r in first]), scale, limit).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()

    schema = T.StructType([
        T.StructField(key, kinds[key]), T.StructField(label, kinds[label]), T.StructField("ints", T.BinaryType()), T.StructField("code", T.BinaryType()),
        T.StructField("apart", T.BinaryType()), T.StructField("error", T.LongType()), T.StructField("cell", T.IntegerType()), T.StructField("total", T.LongType())])
    arrow = pa.schema([pa.field(f.name, t) for f, t in zip(schema, [*arrow_kinds(kept, key, label), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64()])])
    moved, state = np.ones(books.shape[:2], bool), None
    for k in range(rounds + 1):
        source = kept.select(key, label, vector) if state is None else state.df.filter("cell IS NULL").select(key, label, "ints", "code", "apart")
        step = Round(books, moved, source.columns, arrow, limit, scale)
        after = Staged(source.mapInArrow(step, schema), f"codes-{k}")
        if state is not None:
            state.drop()
        state = after
        if k < rounds:
            new = replaced(books, state.df)
            moved, books = (new != books).any(axis=2), new
    done = state.df.filter("cell IS NULL").select(key, label, F.lower(F.hex("code")).alias("code"), "error")
    sums = checkpoint(done.groupBy(label).agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    return with_group_sum(done, sums, label, "label_error").select(key, label, "code", "error", "label_error"), books


def arrow_kinds(rows: DataFrame, *names: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(rows.schema[n].dataType) for n in names]


def digest(books: np.ndarray) -> str:
    """sha256 of all components as decimal numbers, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
