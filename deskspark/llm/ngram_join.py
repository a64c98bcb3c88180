"""Jaccard join on word shingles with adaptive multi-match prefixes, and the groups it links.

Shingles are ordered by a sketch of their document frequency, rare ones first, then by their hash.
If two documents share enough shingles for the threshold, then for every l their first
size - ceil(threshold * size) + l shingles have l in common. Every document chooses its own l: a
longer prefix meets more others but asks for more matches, so l is where the estimated cost, taken
from the frequencies of its prefix, is least. Two documents are compared if they share min(l, l')
prefix shingles.

Where a shingle stands in a document's order says more: all before it are rarer, and of the first l
that two documents share, fewer than l are before it. So a document with r rarer shingles (less
l - 1) of its own leaves a partner no more than `slack` of its own, and only entries of a list
whose r and slack allow each other are paired; lists are looked up by classes of r.

Copies of a shingle set stand for one node. Groups of many near copies would make all pairs, most
of which say nothing new once their documents are linked. So before the full comparison a few
rounds compare only each node with the most central node of a prefix shingle, and what is linked
is merged; the full comparison then covers all remaining pairs of nodes not yet in one group. So
no link between groups is missed, whatever the rounds found.

Groups of copies that are just not near enough stay apart, and their lists would still make all
pairs. Each set has a signature, the parity of its shingles in every one of SIGNS * 64 cells. Two
sets differ in at least as many shingles as their signatures differ in bits, so pairs whose
signatures are too different leave the join where they meet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskspark.llm.common import checkpoint, giving_back, unused


@dataclass(frozen=True)
class Law:
    """Words of a shingle, and the percentage of the union that two sets have to share to be linked."""

    words: int = 4
    percent: int = 85


LAW = Law()
#: Cells of the frequency sketch; it is broadcast (4 bytes a cell), whatever the input's size.
SKETCH_BITS, SKETCH_PARTS = 20, 64
MATCHES = 4
#: Cost of a compared pair against that of an entry met in a prefix shingle's list.
COMPARE = 1.0
#: Rounds before the full comparison, after the first one only while it would meet more pairs than this times the entries.
ROUNDS, ENOUGH = 6, 2
#: Rounds also end with one that links fewer than this part of the nodes.
FRUITLESS = 100
#: Lists of at most this many entries are paired whole, without classes.
SHORT = 8
#: Whole numbers of 64 parities in a set's signature.
SIGNS = 8
BITS = [f"bits{k}" for k in range(SIGNS)]
#: Places in a word whose numbers are kept in a table, bytes of a text whose words are hashed at a time, and documents
#: whose shingles a task holds at a time.
PLACES, PIECE, HELD = 64, 1 << 18, 512
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Classes of ids by which texts are left out before they are shuffled.
BUCKETS = 1 << 19
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


def scrambled(x: np.ndarray) -> np.ndarray:
    """A 64-bit number for every number, without visible relation to it (the finalizer of splitmix64)."""
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class WordHashes:
    """64-bit hashes of a text's words: the sum of a number for each byte and its place in the word.

    The numbers of the first PLACES places are kept in a table; those of later ones are worked out.
    """

    def __init__(self):
        self.numbers = scrambled(np.arange(PLACES * 256, dtype=np.uint64))
        self.is_blank = np.zeros(256, bool)
        self.is_blank[list(b" \t\n\r\x0b\f")] = True

    def of(self, text: bytes) -> np.ndarray:
        """Of every word, in order. A long text is cut at blanks, so that what is held at a time depends on PIECE."""
        parts, at = [], 0
        while at < len(text):
            cut = BLANK.search(text, at + PIECE)
            end = cut.start() if cut else len(text)
            parts.append(self._of_piece(text[at:end]))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def _of_piece(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        word = ~self.is_blank[data]
        before = np.empty(len(data), bool)
        before[:1], before[1:] = False, word[:-1]
        starts = np.flatnonzero(word & ~before)
        if not len(starts):
            return np.zeros(0, np.uint64)
        at = np.flatnonzero(word)
        first = np.searchsorted(at, starts)
        place = at - np.repeat(starts, np.diff(first, append=len(at)))
        code = (place << 8) + data[at]
        if code.max() < len(self.numbers):
            numbers = self.numbers[code]
        else:
            numbers = scrambled(code.astype(np.uint64))
        return np.add.reduceat(numbers, first)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * _MIX[0]
    return h ^ h >> np.uint64(29)


def shingle_set(text: str | None, known: WordHashes, size: int = LAW.words) -> np.ndarray:
    """Sorted hashes of the different shingles of a whole text, as signed numbers.

    Words are runs of anything but ASCII blanks, with A-Z in lower case. A text with fewer words
    than a shingle has one, the whole sequence; without words it has none.
    """
    h = known.of((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(h):
        return np.zeros(0, np.int64)
    if len(h) < size:
        h = np.concatenate([h, np.full(size - len(h), 7 + len(h), np.uint64)])
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mixed(out + h[k:k + n] * _MIX[k % 4] + np.uint64(k))
    out = np.sort(out.view(np.int64))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most HELD."""
    for batch in batches:
        for at in range(0, batch.num_rows, HELD):
            yield batch.slice(at, HELD)


def cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def set_keys(shingles: np.ndarray) -> tuple[int, int]:
    """Two numbers that stand for a set."""
    h = shingles.view(np.uint64)
    one, two = mixed(h).sum(dtype=np.uint64), mixed(h ^ _MIX[1]).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def signature(shingles: np.ndarray) -> list[int]:
    """Of every cell, whether an odd number of the set's shingles falls into it."""
    cell = (mixed(shingles.view(np.uint64)) >> np.uint64(40)) % np.uint64(64 * SIGNS)
    odd = np.bincount(cell.astype(np.int64), minlength=64 * SIGNS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


MEASURED = f"doc_id long, n long, h1 long, h2 long, {', '.join(f'{b} long' for b in BITS)}, part int, cells binary"


def measurer(law: Law):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every document (part NULL), then the task's share of the sketch."""
        known, sketch = WordHashes(), np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "n", "h1", "h2", *BITS, "part", "cells"]
        types = [pa.int64()] * (4 + SIGNS) + [pa.int32(), pa.binary()]
        for batch in few(batches):
            rows, waiting = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                s = shingle_set(text.as_py(), known, law.words)
                rows.append((doc, len(s), *(set_keys(s) if len(s) else (0, 0)), *signature(s), None, None))
                waiting.append(cells(s))
            sketch += np.bincount(np.concatenate(waiting), minlength=len(sketch)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        share = np.minimum(sketch, 65_535).astype("<u2").reshape(SKETCH_PARTS, -1)
        parts = [[None] * SKETCH_PARTS] * (4 + SIGNS) + [list(range(SKETCH_PARTS)), [x.tobytes() for x in share]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(parts, types)], names=names)

    return run


def added_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the tasks' shares, one row for each part of the sketch in this task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("cells")):
            values = np.frombuffer(raw.as_py(), f"<u{2 if len(raw.as_py()) == 2 << SKETCH_BITS >> 6 else 4}").astype(np.uint64)
            sums[part] = sums.get(part, 0) + values
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([np.minimum(v, 2**32 - 1).astype("<u4").tobytes() for v in sums.values()], pa.binary())],
            names=["part", "cells"])


def frequency_sketch(shares: DataFrame) -> np.ndarray:
    """The sketch of all documents: the shares are added in Spark, so the driver gets SKETCH_PARTS rows."""
    half = shares.withColumn("some", F.spark_partition_id() % 16).repartition("part", "some").select("part", "cells")
    sums = half.mapInArrow(added_cells, "part int, cells binary").repartition(SKETCH_PARTS, "part").mapInArrow(added_cells, "part int, cells binary")
    sketch = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint32)
    for r in sums.collect():
        sketch[r.part] = np.frombuffer(r.cells, "<u4")
    return sketch.reshape(-1)


def chosen_prefix(shingles: np.ndarray, frequency: np.ndarray, percent: int = LAW.percent) -> tuple[np.ndarray, int]:
    """The prefix of a set, rarest first, and how many matches it asks for.

    With l matches, the entries met are the sum of the frequencies in the prefix, and at most a
    part 1/l of them are compared.
    """
    n = len(shingles)
    order = np.lexsort((shingles, frequency))
    spare = n - (percent * n + 99) // 100
    met = np.cumsum(frequency[order][:spare + MATCHES].astype(float))
    best, cost = 1, np.inf
    for matches in range(1, MATCHES + 1):
        length = spare + matches
        if length > n:
            break
        estimate = met[length - 1] * (1 + COMPARE / matches)
        if estimate < cost:
            best, cost = matches, estimate
    return shingles[order[:spare + best]], best


def prefix_finder(sketch, law: Law):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequency = WordHashes(), sketch.value
        for batch in few(batches):
            docs = batch.column("doc_id")
            tokens, owners, places = [], [], []
            for k, text in enumerate(batch.column("text")):
                s = shingle_set(text.as_py(), known, law.words)
                if len(s):
                    prefix, m = chosen_prefix(s, frequency[cells(s)], law.percent)
                    tokens.append(prefix)
                    owners.append(np.full(len(prefix), k))
                    places.append((np.int64(len(s)) << 34) + (np.arange(len(prefix)) << 4) + m)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), docs.take(pa.array(np.concatenate(owners))), pa.array(np.concatenate(places))],
                    names=["token", "doc_id", "place"])

    return run


def verifier(law: Law):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs whose whole texts' shingle sets overlap enough."""
        known = WordHashes()
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("text_a"), batch.column("text_b")):
                a, b = shingle_set(one.as_py(), known, law.words), shingle_set(two.as_py(), known, law.words)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both > 0 and 100 * both >= law.percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, label: for every node of `edges` (a, b) the smallest node it is connected with.

    Labels fall to the smallest among the neighbours' and then to their labels' label, until
    nothing changes.
    """
    both = checkpoint(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("jumped"))
        moved = checkpoint(lower.join(jump, lower["next"] == jump["via"], "left")
                           .select("node", F.least("next", F.coalesce("jumped", "next")).alias("new"), "label"))
        changed = moved.filter("new <> label").limit(1).count()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def linked(pairs: DataFrame, docs: DataFrame, law: Law) -> DataFrame:
    """The pairs (a, b) of documents that overlap enough.

    Most texts in no pair are left out before the shuffle, by the bucket of their id's hash; there
    are BUCKETS buckets, so what is broadcast is bounded.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    buckets = ends.select(F.pmod(F.xxhash64("node"), F.lit(BUCKETS)).alias("bucket")).distinct()
    near = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))).join(F.broadcast(buckets), "bucket", "left_semi")
    left = near.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = near.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(giving_back(verifier(law)), "a long, b long")


def relabelled(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """`labels` (node, label) after the groups of the ends of each edge are merged."""
    of = labels.select(F.col("node").alias("n"), F.col("label").alias("l"))
    between = (edges.join(of.withColumnsRenamed({"n": "a", "l": "la"}), "a").join(of.withColumnsRenamed({"n": "b", "l": "lb"}), "b")
               .select(F.col("la").alias("a"), F.col("lb").alias("b")).filter("a <> b").distinct())
    merged = components(between).withColumnsRenamed({"node": "old", "label": "new"})
    return checkpoint(labels.join(merged, labels["label"] == merged["old"], "left")
                      .select("node", F.coalesce("new", "label").alias("label")))


def may_link(a: str, b: str, percent: int) -> str:
    """Whether sizes, and places of a shared prefix shingle, allow the threshold."""
    return (f"100 * least(size{a}, size{b}) >= {percent} * greatest(size{a}, size{b}) AND own{a} <= slack{b} AND own{b} <= slack{a} "
            f"AND {100 + percent} * least(size{a} - own{a}, size{b} - own{b}) >= {percent} * (size{a} + size{b})")


def like_signatures(a: str, b: str, percent: int) -> str:
    """Whether the signatures, if there are any, differ in no more bits than two linked sets of these sizes can differ in shingles."""
    apart = " + ".join(f"bit_count({c}{a} ^ {c}{b})" for c in BITS)
    both = f"((size{a} + size{b}) * {percent} + {99 + percent}) div {100 + percent}"  # the shared shingles that the threshold asks for
    return f"coalesce({apart} <= size{a} + size{b} - 2 * ({both}), true)"


def class_of(column: str) -> str:
    """0 for 0, then one more for every doubling."""
    return f"int(ceil(log2({column} + 1)))"


def suffixed(entries: DataFrame, suffix: str) -> DataFrame:
    return entries.select(*[F.col(c).alias(c if c in ("token", "slot") else c + suffix) for c in entries.columns])


def fields(percent: int, suffix: str = "") -> dict[str, str]:
    """What an entry's packed place says, as SQL. Entries are shuffled packed and unpacked where they meet."""
    place = f"place{suffix}"
    size, matches, at = f"({place} >> 34)", f"({place} & 15)", f"(({place} >> 4) & 1073741823)"
    named = {"size": size, "matches": matches, "own": f"greatest({at} - {matches} + 1, 0)",
             "slack": f"(100 * ({size} - {at} + {matches} - 1) div {percent} - {size})"}
    return {name + suffix: sql for name, sql in named.items()}


def candidates(met: DataFrame, percent: int) -> DataFrame:
    """Pairs of entries that met in a list, of different groups, whose sizes and places allow a link."""
    both = met.filter("label_a <> label_b").withColumns({c: F.expr(e) for c, e in (fields(percent, "_a") | fields(percent, "_b")).items()})
    return both.filter(may_link("_a", "_b", percent))


def central_pairs(entries: DataFrame, spin: int, percent: int) -> DataFrame:
    """For every node the node it shares most prefix shingles with, among one chosen for each shingle.

    First the node with the fewest rarer shingles is chosen, later one by a hash of `spin`.
    """
    entries = entries.select("token", "node", "label", "place")
    rank = F.xxhash64("node", F.lit(spin)) if spin else F.expr(fields(percent)["own"])
    centre = (entries.groupBy("token").agg(F.min(F.struct(rank.alias("rank"), "node", "label", "place")).alias("c"))
              .select("token", "c.node", "c.label", "c.place"))
    pairs = (candidates(suffixed(entries, "_a").join(suffixed(centre, "_b"), "token"), percent)
             .groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(F.count("*").alias("met")))
    return pairs.groupBy("a").agg(F.max(F.struct("met", (-F.col("b")).alias("b"))).alias("x")).select("a", (-F.col("x.b")).alias("b"))


def kept_in(entries: DataFrame, percent: int) -> DataFrame:
    """Every entry with the slot it is found in: its shingle and the class of its `own`; a short list has one class, -1."""
    return entries.withColumn("slot", F.expr(f"token ^ IF(n <= {SHORT}, -1, {class_of(fields(percent)['own'])})"))


def lookups(entries: DataFrame, percent: int) -> DataFrame:
    """Every entry with each slot where a partner with no more rarer shingles can be."""
    of = fields(percent)
    most = class_of(f"least({of['own']}, {of['slack']})")
    classes = f"IF(n <= {SHORT}, sequence(-1, -1), sequence(0, {most}))"
    return entries.withColumn("class", F.explode(F.expr(classes))).withColumn("slot", F.expr("token ^ class")).drop("class")


def open_pairs(entries: DataFrame, percent: int) -> float:
    """How many pairs of entries of different groups the lookups will meet."""
    wants = lookups(entries, percent).groupBy("slot", "label").agg(F.count("*").cast("double").alias("w"))
    has = kept_in(entries, percent).groupBy("slot", "label").agg(F.count("*").cast("double").alias("same"))
    every = has.groupBy("slot").agg(F.sum("same").alias("n"))
    met = wants.join(every, "slot").join(has, ["slot", "label"], "left")
    return met.agg(F.sum(F.col("w") * (F.col("n") - F.coalesce("same", F.lit(0.0))))).first()[0] or 0.0


def all_pairs(entries: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes of different groups that share as many prefix shingles as they need.

    `signatures` (node, BITS) has every node once. Two shingles that fall into one slot by accident can
    add a pair, which the texts then refuse.
    """
    packed = ("slot", "node", "label", "place", *BITS)
    signed = entries.join(signatures, "node")
    met = suffixed(lookups(signed, percent).select(*packed), "_a").join(suffixed(kept_in(signed, percent).select(*packed), "_b"), "slot")
    found = candidates(met, percent).filter("own_a > own_b OR own_a = own_b AND node_a > node_b").filter(like_signatures("_a", "_b", percent))
    return (found.groupBy(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
            .agg(F.count("*").alias("met"), F.min(F.least("matches_a", "matches_b")).alias("need"))
            .filter("met >= need").select("a", "b"))


def open_entries(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of the shingles that several groups have, with labels and the length `n` of their list.

    Groups only grow, so what is left out here is not needed again.
    """
    now = entries.select("token", "node", "place").join(labels, "node")
    lists = now.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"), F.max("place").alias("last"))
    several = lists.filter("low < high AND last >= 0")  # all columns, so that the shuffle by node is the same one
    return now.join(several.select("token", "n"), "token")


def same_ids(each: DataFrame, nodes: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (a, b) of the nodes of different sets that rows of one id have; such ids have no signature."""
    several = signatures.filter(f"{BITS[0]} IS NULL").select(F.col("node").alias("doc_id"))
    held = each.select("doc_id", "h1", "h2", "n").filter("n > 0").join(several, "doc_id").join(nodes, ["h1", "h2"]).filter("node IS NOT NULL")
    first = held.groupBy("doc_id").agg(F.min("node").alias("a"))
    return held.select("doc_id", F.col("node").alias("b")).join(first, "doc_id").filter("a <> b").select("a", "b").distinct()


def link_groups(docs: DataFrame, law: Law = LAW) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text).

    The component's id is the smallest doc_id reachable by links, the document's own included. NULL
    and blank texts have no shingles and are linked with nothing. Rows of one doc_id count as one
    document when links are followed; a NULL id is linked as a copy of a set is, and is never the
    smallest. Repeated rows come out each; other columns are ignored; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    seen = checkpoint(rows.mapInArrow(giving_back(measurer(law)), MEASURED))
    sketch = spark.sparkContext.broadcast(frequency_sketch(seen.filter("part IS NOT NULL").select("part", "cells")))
    each = seen.filter("part IS NULL").select("doc_id", "n", "h1", "h2", *BITS)
    nodes = each.filter("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    # Rows of one id may have different sets; the signature of one would not do for the others, so such an id has none.
    alike = (F.min("h1") == F.max("h1")) & (F.min("h2") == F.max("h2"))
    signatures = (each.filter("n > 0 AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("node"))
                  .agg(*(F.when(alike, F.min(b)).alias(b) for b in BITS)))

    prefixes = (rows.filter("doc_id IS NOT NULL").mapInArrow(giving_back(prefix_finder(sketch, law)), "token long, doc_id long, place long"))
    shared = Window.partitionBy("token")
    met_twice = (prefixes.withColumns({"low": F.min("doc_id").over(shared), "high": F.max("doc_id").over(shared)})
                 .filter("low < high").select("token", "doc_id", "place"))
    entries = checkpoint(
        met_twice.join(nodes.filter("node IS NOT NULL").select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .select("token", F.col("doc_id").alias("node"), "place").distinct())
    ties = checkpoint(same_ids(each, nodes, signatures))
    every = entries.select("node").union(ties.select("a")).union(ties.select("b")).distinct()
    labels = checkpoint(every.select("node", F.col("node").alias("label")))
    if not ties.isEmpty():
        labels = relabelled(labels, ties)

    limit = ENOUGH * entries.count()
    now = entries.join(labels, "node")
    for spin in range(ROUNDS):
        if spin:
            now = checkpoint(open_entries(now, labels))
            if open_pairs(now, law.percent) <= limit:
                break
        edges = checkpoint(linked(checkpoint(central_pairs(now, spin, law.percent)), rows, law))
        labels = relabelled(labels, edges)
        if edges.count() * FRUITLESS < now.select("node").distinct().count():
            break
    now = checkpoint(open_entries(now, labels))
    labels = relabelled(labels, checkpoint(linked(checkpoint(all_pairs(now, signatures, law.percent)), rows, law)))

    ids = nodes.join(labels, "node", "left").select("h1", "h2", F.coalesce("label", "node").alias("of_set"))
    of_row = each.drop(*BITS).join(ids.withColumnsRenamed({"h1": "g1", "h2": "g2"}), (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("n") > 0), "left")
    return of_row.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("of_set", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, law: Law = LAW) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its group, with all columns.

    Of rows with one id and one text the first in the order of their JSON form stays; rows of one id whose
    texts differ all stay, as none stands for the other. Rows with a NULL id cannot be told apart and stay.
    """
    times = unused("times", docs.columns)
    first = link_groups(docs, law).filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias(times))
    kept = docs.filter("doc_id IS NOT NULL").join(first, "doc_id").select(*docs.columns, times)
    once, several = kept.filter(f"{times} = 1").drop(times), kept.filter(f"{times} > 1").drop(times)
    row = F.struct(*docs.columns)
    chosen = several.groupBy("doc_id", "text").agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return once.unionByName(chosen).unionByName(docs.filter("doc_id IS NULL"))
