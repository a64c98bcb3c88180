"""Byte strings that occur twice anywhere in a corpus, from sorted buckets of suffixes.

A string of `length` bytes is the beginning of a suffix, and it is repeated if the suffix beside it
in sorted order begins with the same bytes. Sorting every suffix of a corpus with its first bytes
would move each byte `length` times. So suffixes travel together: every window of `length` bytes is
led by the gram (a third of its bytes) with the smallest hash in it. Equal windows have the same
leading gram, and neighbouring windows mostly share theirs, so one run of windows with one leading
gram is one entry: its bytes once, for some hundred suffixes. Equal entries are counted into one before
any bytes move, and an entry whose leading gram occurs nowhere else is left out.

Entries are dealt into buckets by ranges of their leading bytes, with splitters from a sample. In a
bucket a multikey quicksort orders the suffixes of each leading gram: it splits a group by the next
eight bytes in which its members differ, and neighbours are compared over all bytes. Splitters never
part entries of one gram, so equal suffixes do not lie on both sides of a boundary. A gram with more
than HOT different entries, such as the edge of a passage that much of the corpus shares, does not
go to one bucket: its suffixes are counted one by one by their digests, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import Staged, bucketed, shuffle_width

LENGTH = 400
#: Windows of one entry at most, and of a long text at a time.
ENTRY, CHUNK = 512, 1 << 18
#: Leading bytes by which entries are dealt out; different entries of one gram that one bucket sorts.
LEAD, HOT = 32, 4096
#: Suffixes sorted, and neighbours compared, at a time.
SORTED, COMPARED = 1 << 18, 1 << 13
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Grams:
    """Hashes of all grams of some bytes, by differences of a running sum."""

    def __init__(self, size: int, most: int):
        self.size = size
        base = int(_STEP)
        self.up, self.down = powers(base, most), powers(pow(base, -1, 1 << 64), most)
        self.of_byte = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.of_byte[raw] * self.up[:len(raw)], out=total[1:])
        n = len(raw) - self.size + 1
        return mixed((total[self.size:] - total[:n]) * self.down[:n])


def sliding(best: np.ufunc, values: np.ndarray, width: int, least: int) -> np.ndarray:
    """`best` over every `width` values in a row; `least` fills up the last block."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, least, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).reshape(-1)
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(behind[:n - width + 1], ahead[width - 1:n])


class Entries(NamedTuple):
    at: np.ndarray
    n: np.ndarray
    gram: np.ndarray
    lead: np.ndarray
    times: np.ndarray


def entries_of(raw: np.ndarray, grams: Grams, length: int) -> Entries:
    """The runs of windows with one leading gram: first window, windows, the gram's hash, its place
    after the first window's, and how often it leads within the run."""
    h = grams(raw)
    width = length - grams.size + 1
    least = sliding(np.minimum, h, width, 2**64 - 1)
    first = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1]
    n = np.diff(np.r_[first, len(least)])
    pieces = -(-n // ENTRY)
    run = np.repeat(np.arange(len(n)), pieces)
    past = (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * ENTRY
    at, n = first[run] + past, np.minimum(n[run] - past, ENTRY)
    gram = least[at]
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    leads = np.flatnonzero(h == sliding(np.maximum, around, width, 0))
    kinds, kind = np.unique(h[leads], return_inverse=True)
    places = np.sort((kind << 32) + leads)
    own = np.searchsorted(kinds, gram) << 32
    low, high = np.searchsorted(places, own + at), np.searchsorted(places, own + at + n + width - 1)
    return Entries(at, n, gram, (places[low] & 0xFFFFFFFF) - at, high - low)


class Finder:
    """Every text's entries: row, at, n, gram, same (a digest of the entry's bytes), lead, times."""

    def __init__(self, length: int):
        self.length = length

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, grams = self.length, Grams(self.length // 3, CHUNK + self.length)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                raw = text.as_py()
                if raw is None or len(raw) < length:
                    continue
                view = memoryview(raw)
                values = np.frombuffer(raw, np.uint8)
                for start in range(0, len(raw) - length + 1, CHUNK):
                    e = entries_of(values[start:start + CHUNK + length - 1], grams, length)
                    at = e.at + start
                    same = [xxhash.xxh3_64_intdigest(view[a:a + n + length - 1]) for a, n in zip(at.tolist(), e.n.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), row)), pa.array(at), pa.array(e.n.astype(np.int32)), pa.array(e.gram.view(np.int64)),
                         pa.array(np.array(same, np.uint64).view(np.int64)), pa.array(e.lead.astype(np.int32)), pa.array(e.times.astype(np.int32))],
                        names=["row", "at", "n", "gram", "same", "lead", "times"])


def cut(length: int):
    """The bytes of the entries listed beside each text, and the first bytes of their leading grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, wanted in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist()):
                raw = text.as_py()
                parts = [raw[w["at"]:w["at"] + w["n"] + length - 1] for w in wanted]
                leads = [p[w["lead"]:w["lead"] + LEAD] for p, w in zip(parts, wanted)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(wanted), pa.int64()), *(pa.array([w[c] for w in wanted], pa.int64()) for c in ("at", "gram", "copies")),
                     pa.array(leads, pa.binary()), pa.array(parts, pa.binary())], names=["row", "at", "gram", "copies", "lead", "bytes"])

    return run


def singled(length: int):
    """Every suffix of the entries by itself, with a digest of its beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, wanted in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist()):
                view = memoryview(text.as_py())
                for w in wanted:
                    at, n = w["at"], w["n"]
                    digests = [xxhash.xxh3_128_digest(view[a:a + length]) for a in range(at, at + n)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, row)), pa.array(np.arange(at, at + n)), pa.array(np.full(n, w["copies"])), pa.array(digests, pa.binary())],
                        names=["row", "at", "copies", "digest"])

    return run


def repeated(text: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes (places in `text`) begin like another one of their group; a vectorised multikey quicksort.

    Every pass splits the groups by the eight bytes at the place where some neighbours of the group
    first differ, drops groups of one, and compares neighbours over `length` bytes. A group in which all
    neighbours agree is done.
    """
    found = np.zeros(len(starts), bool)
    eights = np.lib.stride_tricks.sliding_window_view(text, 8)
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    active, depth = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    while len(active):
        word = np.ascontiguousarray(eights[starts[active] + depth]).view(np.uint64)[:, 0]
        order = np.lexsort((word, group))
        active, group, word = active[order], group[order], word[order]
        new = np.r_[True, (group[1:] != group[:-1]) | (word[1:] != word[:-1])]
        alone = new & np.r_[new[1:], True]
        active, new = active[~alone], new[~alone]
        if not len(active):
            break
        group = np.cumsum(new)
        alike = np.full(len(active), length)  # how many bytes each shares with the one before
        pairs = np.flatnonzero(~new)
        for a in range(0, len(pairs), COMPARED):
            p = pairs[a:a + COMPARED]
            differ = windows[starts[active[p - 1]]] != windows[starts[active[p]]]
            alike[p] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        same = pairs[alike[pairs] == length]
        found[active[same]] = found[active[same - 1]] = True
        common = np.minimum.reduceat(alike, np.flatnonzero(new))[group - 1]
        going = common < length
        active, group, depth = active[going], group[going], np.minimum(common[going], length - 8)
    return found


class Buckets:
    """Takes a bucket's entries in the order of lead and gram; yields the repeated stretches of those without copies."""

    def __init__(self, length: int):
        self.length = length

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, last = [], 0, None
        for batch in batches:
            for entry in zip(*(batch.column(c).to_pylist() for c in ("lead", "gram", "row", "at", "copies", "bytes"))):
                if size >= SORTED and entry[:2] != last:
                    yield self.sort(waiting)
                    waiting, size = [], 0
                last = entry[:2]
                waiting.append(entry)
                size += len(entry[5]) - self.length + 1
        if waiting:
            yield self.sort(waiting)

    def sort(self, entries: list) -> pa.RecordBatch:
        leads, grams, rows, ats, copies, parts = zip(*entries)
        text = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts])
        n = size - self.length + 1
        owner = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        group = np.r_[0, np.cumsum([a != b for a, b in zip(zip(leads[1:], grams[1:]), zip(leads, grams))])].astype(np.int64)
        marks = repeated(text, (np.cumsum(size) - size)[owner] + within, group[owner], self.length)
        marks &= np.array(copies)[owner] == 1
        hit = np.flatnonzero(marks)
        first = np.r_[True, (np.diff(hit) > 1) | (np.diff(owner[hit]) > 0)] if len(hit) else np.zeros(0, bool)
        start, end = hit[first], hit[np.r_[first[1:], True]] if len(hit) else hit
        at = np.array(ats)[owner[start]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(rows)[owner[start]], pa.int64()), pa.array(at + within[start], pa.int64()), pa.array(at + within[end] + 1, pa.int64())],
            names=["row", "low", "high"])


def beside(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """The texts of which entries are wanted, with the list of these."""
    wanted = entries.groupBy("row").agg(F.collect_list(F.struct("at", "n", "gram", "lead", "copies")).alias("wanted"))
    return texts.select("row", "text").join(wanted, "row")


def repeats(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """row, low, high: the stretches of starts of repeated strings in texts (row, text as bytes).

    A stretch's strings start from `low` to before `high`. Stretches of one text may touch, not overlap.
    """
    spark = texts.sparkSession
    entries = Staged(texts.select("row", "text").mapInArrow(Finder(length), "row long, at long, n int, gram long, same long, lead int, times int"), "entries")
    kinds = Staged(entries.df.groupBy("gram", "same").agg(
        F.count("*").alias("copies"), F.sum("times").alias("times"), F.min(F.struct("row", "at", "n", "lead")).alias("one")), "kinds")
    grams = kinds.df.groupBy("gram").agg(F.sum("times").alias("all_times"), F.count("*").alias("n_kinds")).filter("all_times > 1")
    # Of a gram with one kind of entry, copies are all that can be found, unless the gram leads twice in an entry.
    open_kinds = kinds.df.join(grams, "gram").filter("n_kinds > 1 OR copies = 1").select("gram", "copies", "n_kinds", "one.*")
    open_kinds = Staged(open_kinds, "open")
    parts = Staged(beside(texts, open_kinds.df.filter(F.col("n_kinds") <= HOT)).mapInArrow(
        cut(length), "row long, at long, gram long, copies long, lead binary, bytes binary"), "parts")
    buckets = parts.df.repartitionByRange(shuffle_width(spark), "lead", "gram").sortWithinPartitions("lead", "gram")
    sorted_out = buckets.mapInArrow(Buckets(length), "row long, low long, high long")

    single = beside(texts, open_kinds.df.filter(F.col("n_kinds") > HOT)).mapInArrow(singled(length), "row long, at long, copies long, digest binary")
    several = single.groupBy("digest").agg(F.sum("copies").alias("all_copies")).filter("all_copies > 1")
    counted = single.filter("copies = 1").join(several, "digest").select("row", F.col("at").alias("low"), (F.col("at") + 1).alias("high"))

    copied = entries.df.join(kinds.df.filter("copies > 1").select("gram", "same"), ["gram", "same"], "left_semi")
    whole = copied.select("row", F.col("at").alias("low"), (F.col("at") + F.col("n")).alias("high"))
    return sorted_out.unionByName(counted).unionByName(whole)


def stripped(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                raw, removed, runs, kept, end = text.as_py() or b"", 0, 0, [], 0
                lows, highs = (np.array([s[k] for s in spans.as_py() or []], np.int64) for k in ("low", "high"))
                order = np.argsort(lows, kind="stable")
                for low, high in zip(lows[order].tolist(), (highs[order] + length - 1).tolist()):
                    if low > end or not runs:
                        kept.append(raw[end:low])
                        runs, removed, end = runs + 1, removed + high - low, high
                    elif high > end:
                        removed, end = removed + high - end, high
                kept.append(raw[end:])
                rest = b"".join(kept)
                out.append((len(raw), removed, runs, hashlib.sha256(rest).hexdigest(), rest))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept of every row of `docs` (doc_id, text).

    Each UTF-8 byte covered by a string of `length` bytes (24 or more) that starts anywhere else too, in
    the same text or another, is removed; `n_spans` counts the removed runs, `kept` is what is left, as
    bytes, since a run may begin or end within a character. Strings do not cross texts. A NULL text is
    empty; texts shorter than `length` stay whole. Repeated rows are texts of their own, so both lose
    what they share; a NULL doc_id stays NULL; other columns are ignored; no rows give an empty result.
    """
    if length < 24:
        raise ValueError("length must be 24 or more")
    # The numbers of rows hold for the written copy, whatever is run again later.
    texts = bucketed(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text")), "row", "texts")
    spans = repeats(texts, length).groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(
        stripped(length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
