"""Benchmark decontamination by spaced seeds.

Words are runs of letters, digits and non-ASCII signs, in lower case. A seed is a hash of the words
of a window at the positions that a fixed mask marks with 1; the positions marked 0 may differ.
The two masks of span 8 have together a seed without a difference in every 13 words with at most
two of them replaced. Shorter items have masks of their own, by length, with a seed for every choice
of as many replaced words as SHARE allows. Seeds of documents are looked up among those of the benchmark, first in a
bitmap of fixed size, then by an exact join. Around every hit the item is laid beside the document:
the document leaks the item where, of OVERLAP consecutive words (all words of a shorter item), at
least SHARE are equal in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import checkpoint, giving_back

MASKS = ("11110011", "11010111")
OVERLAP, SHARE = 13, 0.8
#: Items of fewer words are no evidence.
SHORTEST = 5
#: Masks for items of fewer than OVERLAP words, from this many words on: one word may differ, from 10 on two.
SHORT_MASKS = {5: ("1111", "10111", "11011", "11101"), 8: ("1011111", "1110111", "1111101"), 10: ("11111", "111011", "11010011")}
#: The bitmap has 2**BITMAP_BITS bits, however large the benchmark is.
BITMAP_BITS = 24
CHUNK_WORDS, KNOWN_WORDS = 500_000, 500_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return h


def hashed_words(text: str | None, known: WordHashes) -> np.ndarray:
    words = (text or "").lower().encode("utf-8", "replace").translate(_LOWER).split()
    if len(known) > KNOWN_WORDS:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """A hash for every window of the length of `mask`."""
    n = max(0, len(words) - len(mask) + 1)
    h = np.full(n, len(mask) * 1_000_003 + int(mask, 2), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h = (h ^ words[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def bits_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a hash in the bitmap."""
    mask = np.uint64((1 << BITMAP_BITS) - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def masks_for(length: int) -> tuple[str, ...]:
    return MASKS if length >= OVERLAP else SHORT_MASKS[max(n for n in SHORT_MASKS if n <= length)]


def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every item its words, and its seeds with their places."""
    known = WordHashes()
    for batch in batches:
        rows = []
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            words = hashed_words(text, known)
            if len(words) >= SHORTEST:
                found = [(h, q) for m in masks_for(len(words)) for q, h in enumerate(seeds(words, m).view(np.int64).tolist())]
                rows.append((item, words.view(np.int64).tolist(), [{"h": h, "q": q} for h, q in found]))
        if rows:
            item, words, found = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(words, pa.list_(pa.int64())),
                 pa.array(found, pa.list_(pa.struct([("h", pa.int64()), ("q", pa.int32())])))],
                names=["item_id", "item", "seeds"])


def hit_finder(bitmap, short: list[int]):
    """A function from documents to those with a seed in the bitmap: their words and such seeds."""
    masks = sorted({*MASKS, *(m for n in short for m in masks_for(n))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = WordHashes(), bitmap.value

        def among(places: np.ndarray) -> np.ndarray:
            return bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1 > 0

        def search(held: list[tuple]) -> list[tuple]:
            words = np.concatenate([w for _, w in held])
            ends = np.cumsum([len(w) for _, w in held])
            hits: dict[int, list] = {}
            for mask in masks:
                h = seeds(words, mask)
                one, two = bits_of(h)
                at = np.flatnonzero(among(one))
                at = at[among(two[at])]
                doc = np.searchsorted(ends, at, "right")
                inside = at + len(mask) <= ends[doc]
                for p, k in zip(at[inside].tolist(), doc[inside].tolist()):
                    hits.setdefault(k, []).append({"h": int(h[p].view(np.int64)), "p": p - int(ends[k]) + len(held[k][1])})
            return [(*held[k][0], held[k][1].view(np.int64).tolist(), found) for k, found in hits.items()]

        for batch in batches:
            held, size, out = [], 0, []
            for *key, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text_hash", "text"))):
                words = hashed_words(text.as_py(), known)
                if len(words) >= SHORTEST:
                    held.append(([k.as_py() for k in key], words))
                    size += len(words)
                if size >= CHUNK_WORDS:
                    out += search(held)
                    held, size = [], 0
            if held:
                out += search(held)
            if out:
                *key, words, found = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(k, pa.int64()) for k in key), pa.array(words, pa.list_(pa.int64())),
                     pa.array(found, pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int32())])))],
                    names=["row", "doc_id", "text_hash", "words", "hits"])

    return run


def overlap(words: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """First word in the document, length and equal words of the best stretch, if it is a leak."""
    low, high = max(0, -shift), min(len(item), len(words) - shift)
    need = min(OVERLAP, len(item))
    if high - low < need:
        return None
    equal = words[low + shift:high + shift] == item[low:high]
    sums = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(sums[need:] - sums[:-need] >= SHARE * need)
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + need
    return low + shift + first, last - first, int(equal[first:last].sum())


_KEY = ("row", "doc_id", "text_hash", "item_id")


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for *key, shift, words, item in zip(*(batch.column(c) for c in (*_KEY, "shift", "words", "item"))):
            found = overlap(words.values.to_numpy(), item.values.to_numpy(), shift.as_py())
            if found:
                out.append((*(k.as_py() for k in key), *found))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)],
                names=[*_KEY, "word_start", "n_words", "n_equal"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, word_start, n_words, n_equal: a row for each document row and item it leaks.

    Of several places of an item in a document the first is given. Repeated rows and rows with a
    NULL id are found each. NULL or short texts, on either side, leak nothing; other columns are
    ignored; with an empty table the result is empty.
    """
    spark = docs.sparkSession
    items = checkpoint(benchmark.select("item_id", "text").mapInArrow(
        item_seeds, "item_id long, item array<long>, seeds array<struct<h:long,q:int>>"))
    short = [r[0] for r in items.filter(F.size("item") < OVERLAP).select(F.size("item")).distinct().collect()]  # OVERLAP lengths
    listed = items.select("item_id", F.size("item").alias("m"), F.explode("seeds").alias("s")).select("item_id", "m", "s.h", "s.q")

    mask = (1 << BITMAP_BITS) - 1
    places = listed.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftright("h", 32).bitwiseAND(mask))).alias("b"))
    bytes_set = (places.groupBy(F.shiftright("b", 3).alias("at"))
                 .agg(F.bit_or(F.expr("shiftleft(1, int(b & 7))")).alias("bits")))
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for at, bits in bytes_set.toLocalIterator():  # at most as many rows as the bitmap has bytes
        bitmap[at] = bits

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = checkpoint(rows.mapInArrow(
        giving_back(hit_finder(spark.sparkContext.broadcast(bitmap), short)),
        "row long, doc_id long, text_hash long, words array<long>, hits array<struct<h:long,p:int>>"))
    pairs = (found.select("row", F.explode("hits").alias("x")).select("row", "x.h", "x.p").join(listed, "h")
             .select("row", "item_id", (F.col("p") - F.col("q")).alias("shift")).distinct())
    laid = (pairs.join(items.select("item_id", "item"), "item_id")
            .join(found.select("row", "doc_id", "text_hash", "words"), "row"))
    each = laid.mapInArrow(verified, "row long, doc_id long, text_hash long, item_id long, word_start long, n_words long, n_equal long")
    first = F.min(F.struct("word_start", (-F.col("n_equal")).alias("unequal"), "n_words")).alias("x")
    return each.groupBy("row", "doc_id", "text_hash", "item_id").agg(first).select(
        "doc_id", "text_hash", "item_id", "x.word_start", "x.n_words", (-F.col("x.unequal")).alias("n_equal"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that leak no item, with all their columns."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), "text_hash").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["text_hash"]), "left_anti")
