"""Hard negatives by inner product, from cover trees over norm-augmented candidates.

One more component gives all candidates of a block the same norm and leaves inner products with an
anchor as they are (the anchor's own component is 0). A cover tree holds them level by level: the
rows of a node are split around centres chosen farthest-first, so centres stand apart and every row
lies within its centre's covering radius r. With an anchor q, a node's inner products then lie within
|q| r of its centre's. Descending level by level, nodes whose interval misses what an anchor looks
for are skipped; what is left is visited best bound first, while the bound can still improve the
anchor's list, and leaves are compared exactly, in whole numbers.

Candidates are dealt into blocks of bounded size by a hash of their row, each with a tree of its
own; anchors pass by every block as a stream, so that a task holds one block and some anchors. A
first pass finds each anchor's positives, a second the negatives within the windows that the
positives' scores open.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.llm.common import Staged, shuffle_width
from deskspark.llm.vectors import of_one_length, scaled, whole

#: Rows of a block at most on average, and at least where there are more tasks than such blocks.
BLOCK_ROWS, LEAST_ROWS = 262_144, 4096
LEAF, FANOUT = 128, 16
#: Anchors compared at a time.
ANCHORS = 256
#: What rounding may take from a bound, as a part of the largest norm.
SLACK = 1e-6
POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 3, 50, 95, 256


@dataclass
class Level:
    """Nodes of one depth: centres (without the added component), radii, rows from-to, place of the parent, smallest and largest label."""

    centres: np.ndarray
    radii: np.ndarray
    rows: np.ndarray
    parents: np.ndarray
    labels: np.ndarray
    leaf: np.ndarray


class CoverTree:
    def __init__(self, points: np.ndarray, labels: np.ndarray, uids: np.ndarray, ids: np.ndarray):
        norms = (points ** 2).sum(axis=1)
        self.largest = float(np.sqrt(norms.max()))
        whole_points = np.concatenate([points, np.sqrt(norms.max() - norms)[:, None]], axis=1)
        self.levels, order = self._split(whole_points, labels)
        self.points, self.labels, self.uids, self.ids = points[order], labels[order], uids[order], ids[order]

    def _split(self, points: np.ndarray, labels: np.ndarray) -> tuple[list[Level], np.ndarray]:
        """The levels, and the rows in the order in which nodes refer to them."""
        levels, order = [], np.arange(len(points))
        # The nodes of a level that are still to be split: rows, row of the centre, distances to it, place of the parent, first place in `order`.
        waiting = [(order.copy(), 0, self._apart(points, points[0]), 0, 0)]
        while waiting:
            nodes, below = [], []
            for rows, centre, far, parent, start in waiting:
                order[start:start + len(rows)] = rows
                ends = len(rows) <= LEAF or far.max() <= SLACK * self.largest
                if not ends:
                    at = start
                    for child, middle, away in self._children(points, rows, centre, far):
                        below.append((child, middle, away, len(nodes), at))
                        at += len(child)
                for a in range(0, len(rows), LEAF if ends else len(rows)):
                    b = min(a + LEAF, len(rows)) if ends else len(rows)
                    own = labels[rows[a:b]]
                    nodes.append((points[centre, :-1], far[a:b].max() + SLACK * self.largest, (start + a, start + b), parent, (own.min(), own.max()), ends))
            levels.append(Level(*map(np.array, zip(*nodes))))
            waiting = below
        return levels, order

    @staticmethod
    def _apart(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(((points - centre) ** 2).sum(axis=1))

    def _children(self, points: np.ndarray, rows: np.ndarray, centre: int, far: np.ndarray):
        """(rows, centre, distances) of parts around centres that are each the farthest row from those before.

        A part with over half of the rows is cut into an inner and an outer shell, so the depth is logarithmic.
        """
        own, nearest, middles, best = points[rows], far.copy(), [centre], np.zeros(len(rows), np.int64)
        for k in range(1, FANOUT):
            at = int(nearest.argmax())
            if nearest[at] <= SLACK * self.largest:
                break
            away = self._apart(own, own[at])
            closer = away < nearest
            nearest[closer], best[closer] = away[closer], k
            middles.append(int(rows[at]))
        for k, middle in enumerate(middles):
            mine = np.flatnonzero(best == k)
            mine = mine[np.argsort(nearest[mine], kind="stable")]
            cuts = np.array_split(mine, 2) if 2 * len(mine) > len(rows) else [mine]
            yield from ((rows[c], middle, nearest[c]) for c in cuts if len(c))

    def best(self, anchors: np.ndarray, labels: np.ndarray, uids: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray,
             same: bool, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For every search its k best rows, higher scores first, then smaller ids: (search, score, id, uid).

        Search s looks, for the anchor of[s], among rows of the anchor's own label or (`same` False)
        of other labels for scores from low[s] to high[s]. The anchor's own row is left out.
        """
        reach = np.sqrt((anchors ** 2).sum(axis=1))
        alive, bounds, spans = np.ones((len(of), 1), bool), [], []
        for level in self.levels:
            middle, spread = anchors @ level.centres.T, reach[:, None] * level.radii
            most, least = (middle + spread)[of], (middle - spread)[of]
            own, first, last = labels[of][:, None], level.labels[:, 0], level.labels[:, 1]
            kind = (own >= first) & (own <= last) if same else (own != first) | (own != last)
            alive = alive[:, level.parents] & kind & (most >= low[:, None]) & (least <= high[:, None])
            bounds.append(np.where(alive, np.minimum(most, high[:, None]), -np.inf)[:, level.leaf])
            spans.append(level.rows[level.leaf])
        bound, span = np.concatenate(bounds, axis=1), np.concatenate(spans)
        order = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, axis=1)
        enough, found, taken, width = low.copy(), [np.zeros(0, np.int64)] * 4, 0, 1
        while taken < bound.shape[1]:
            now = bound[:, taken:taken + width]
            search, place = np.nonzero((now > -np.inf) & (now >= enough[:, None]))
            if not len(search):
                break
            found = self._visit(found, search, order[search, taken + place], span, anchors, labels, uids, of, enough, high, same)
            found, enough = self._kept(found, enough, k)
            taken, width = taken + width, 2 * width
        return tuple(found)

    def _visit(self, found, search, leaves, span, anchors, labels, uids, of, enough, high, same):
        """`found` and what the leaves add: pairs of a search and a leaf, one comparison of all of a leaf's anchors with its rows."""
        by_leaf = np.argsort(leaves, kind="stable")
        search, leaves = search[by_leaf], leaves[by_leaf]
        starts = np.flatnonzero(np.r_[True, leaves[1:] != leaves[:-1]])
        hits = [found]
        for a, b in zip(starts, np.r_[starts[1:], len(leaves)]):
            who, (lo, hi) = search[a:b], span[leaves[a]]
            asked, back = np.unique(of[who], return_inverse=True)
            score = (anchors[asked] @ self.points[lo:hi].T)[back]
            alike = labels[of[who]][:, None] == self.labels[lo:hi]
            fits = (score >= enough[who][:, None]) & (score <= high[who][:, None]) & (alike if same else ~alike)
            fits &= uids[of[who]][:, None] != self.uids[lo:hi]
            s, r = np.nonzero(fits)
            if len(s):
                hits.append([who[s], score[s, r].astype(np.int64), self.ids[lo + r], self.uids[lo + r]])
        return [np.concatenate(c) for c in zip(*hits)]

    @staticmethod
    def _kept(found, enough, k):
        """The k best of each search, and the score that a further row has to reach."""
        search, score, ids, uids = found
        order = np.lexsort((uids, ids, -score, search))
        search = search[order]
        first = np.searchsorted(search, search)
        place = np.arange(len(search)) - first
        order, search, place = order[place < k], search[place < k], place[place < k]
        last = place == k - 1
        enough = enough.copy()
        enough[search[last]] = np.maximum(enough[search[last]], score[order][last])
        return [search, score[order], ids[order], uids[order]], enough


def grid(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), -1).astype(np.float64)


class Searcher:
    """Takes a block's candidates, then its anchors, block after block; yields each anchor's best rows in the block.

    Without windows these are the best of the anchor's label, else for each window the best of other labels.
    """

    def __init__(self, k: int, windows: bool):
        self.k, self.windows = k, windows

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, tree = None, [], None
        for batch in batches:
            blocks, kinds = (batch.column(n).to_numpy() for n in ("block", "kind"))
            edges = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])]) if len(blocks) else []
            for a, b in zip(edges, np.r_[edges[1:], len(blocks)].astype(int)):
                part = batch.slice(a, b - a)
                if blocks[a] != block:
                    block, rows, tree = blocks[a], [], None
                if kinds[a] == 0:
                    rows.append(part)
                elif rows or tree:
                    if tree is None:
                        tree = CoverTree(np.concatenate([grid(r.column("ints")) for r in rows]),
                                         *(np.concatenate([r.column(n).to_numpy() for r in rows]) for n in ("label", "uid", "vec_id")))
                        rows = []
                    for at in range(0, part.num_rows, ANCHORS):
                        yield self.search(tree, part.slice(at, ANCHORS))

    def search(self, tree: CoverTree, anchors: pa.RecordBatch) -> pa.RecordBatch:
        n, uids = anchors.num_rows, anchors.column("uid").to_numpy()
        of, place, low, high = np.arange(n), np.zeros(n, np.int64), np.full(n, -np.inf), np.full(n, np.inf)
        if self.windows:
            lows, highs = anchors.column("lows"), anchors.column("highs")
            size = lows.value_lengths().to_numpy()
            of = np.repeat(of, size)
            place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            low, high = lows.flatten().to_numpy().astype(float), highs.flatten().to_numpy().astype(float)
        search, score, ids, cand = tree.best(grid(anchors.column("ints")), anchors.column("label").to_numpy(), uids, of, low, high, not self.windows, self.k)
        columns = [uids[of[search]], place[search], score, ids, cand]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["anchor", "place", "score", "vec_id", "uid"])


FOUND = "anchor long, place long, score long, vec_id long, uid long"


def best_of_blocks(rows: DataFrame, anchors: DataFrame, blocks: int, k: int, windows: bool) -> DataFrame:
    """FOUND and `rank`: the k best rows of all blocks for every anchor, or for every window of every anchor."""
    columns = ["uid", "vec_id", "label", "ints", "lows", "highs"]
    none = F.lit(None).cast("array<long>")
    held = rows.withColumns({"lows": none, "highs": none}).select(
        F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), *columns)
    if not windows:
        anchors = anchors.withColumns({"lows": none, "highs": none})
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *columns)
    dealt = held.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind")
    found = dealt.mapInArrow(Searcher(k, windows), FOUND)
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from rows (vec_id, label, embedding).

    A score is the inner product of the components floor(scale * x). An anchor's positives are its best
    `positives` other rows of the same label; for each, the best `negatives` rows of other labels with
    low % to high % of the positive's score come out, ranked from 1. Ties go to the smaller vec_id.

    Rows with a NULL vec_id, label or vector, an empty vector, or NULL or infinite components take no
    part, nor do rows whose vector has another length than that of the smallest vec_id. Repeated rows are
    rows of their own: each can be anchor, positive and negative. A NULL condition is no anchor; other
    columns are ignored; without rows the result is empty.
    """
    spark = rows.sparkSession
    named = rows.select("vec_id", "label", "embedding", F.coalesce(is_anchor, F.lit(False)).alias("asks")).filter("vec_id IS NOT NULL AND label IS NOT NULL")
    kept, length = of_one_length(whole(named), "vec_id")
    limit = min(int((2**52 // max(length, 1)) ** 0.5), 2**31 - 1)

    def whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = [r.tobytes() for r in scaled(batch.column("embedding"), scale, limit).astype("<i4")] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("uid", "vec_id", "label", "asks")] + [pa.array(ints, pa.binary())],
                                             names=["uid", "vec_id", "label", "asks", "ints"])

    numbered = kept.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long"), F.col("label").cast("long"), "asks", "embedding")
    # The ids of rows hold for the written copy, whatever is run again later.
    held = Staged(numbered.mapInArrow(whole_numbers, "uid long, vec_id long, label long, asks boolean, ints binary"), "negatives").df
    n = held.count()
    blocks = max(-(-n // BLOCK_ROWS), min(shuffle_width(spark), -(-n // LEAST_ROWS)), 1)
    anchors = held.filter("asks")
    found = best_of_blocks(held.drop("asks"), anchors, blocks, positives, False)
    windows = (found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
               .withColumn("lows", F.expr(f"transform(found, p -> (p.score * {low} + pmod(-p.score * {low}, 100L)) div 100)"))
               .withColumn("highs", F.expr(f"transform(found, p -> (p.score * {high} - pmod(p.score * {high}, 100L)) div 100)")))
    opened = Staged(windows.join(anchors.withColumnRenamed("uid", "anchor"), "anchor"), "windows").df
    hits = best_of_blocks(held.drop("asks"), opened.withColumnRenamed("anchor", "uid"), blocks, negatives, True)
    ends = opened.select("anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("found").alias("place", "positive"))
    return hits.join(ends.withColumn("place", F.col("place").cast("long")), ["anchor", "place"]).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))
