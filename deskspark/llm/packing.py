"""Packing documents into sequences of at most WINDOW tokens, in order, by dynamic programming.

Documents in the order of their ids form one stream of tokens. A sequence is a window of the
stream; windows end at document ends (free), sentence ends (a small penalty) or, inside sentences
longer than LONG_SENTENCE, at a grid of positions (a larger one). A window of n tokens costs
WINDOW - n for padding, nothing if n is a power of two, and its end's penalty. The cheapest cuts
are best[j] = penalty(j) + min over i of (best[i] + padding(j - i)); the minimum of best[i] + i over
the sliding range of starts is kept in a monotone queue; the two largest powers of two below WINDOW are
looked up, at the end of a block all of them.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from deskspark.llm.common import giving_back, shuffle_width

WINDOW, END_ID = 2048, 1
SENTENCE_PENALTY, INSIDE_PENALTY = 4, 24
LONG_SENTENCE, GRID = 256, 64
#: Of the sentence ends in a stretch of this many tokens the first is a place to cut.
NEAR = 8
#: A start has to be worse than its neighbour by this much before powers of two are looked up for it.
SLACK = 16
#: Bytes of text that are cut into sequences at once, about; a chunk ends at a document end.
CHUNK_BYTES = 16 << 20
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Words with these signs are left in their text, as what counts as blank there is in doubt.
DOUBTFUL = r"[\x1c-\x1f]"
#: Words that are empty or start with a blank are, too: the spaces before and behind them belong together.
STAYS = rf"^$|^[\t-\r\x{{85}}\pZ]|{DOUBTFUL}"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


class Encoder:
    """Token ids of many whole texts at once.

    A token never reaches over a space that a visible character follows, unless it starts there.
    So texts are taken apart at spaces and every different word of a chunk is encoded once: all of
    them together, joined by spaces, and taken apart where a token starts with a space. Literals of
    added tokens are cut out of their text first, as the tokenizer does; such a text is encoded whole.
    """

    def __init__(self, path: str):
        import tiktoken

        spelled = {c: b for b, c in byte_letters().items()}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, self.added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        literals = "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True))
        self.literal = re.compile(f"({literals})") if literals else None
        self.stays_apart = "|".join(x for x in (DOUBTFUL, literals) if x)
        ranks = {bytes(spelled[c] for c in token): i for token, i in vocabulary.items() if all(c in spelled for c in token)}
        for content in self.added:
            ranks.pop(content.encode(), None)
        self.encoding = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max(*vocabulary.values(), *self.added.values()) + 1
        self.starts, self.stops = np.zeros(size, bool), np.zeros(size, bool)
        for token, i in ranks.items():
            self.starts[i] = token.startswith(b" ")
            self.stops[i] = token.endswith((b".", b"!", b"?", b"\n"))

    def whole(self, text: str) -> np.ndarray:
        parts = self.literal.split(text) if self.literal else [text]
        ids = [[self.added[x]] if k % 2 else self.encoding.encode_ordinary(x) for k, x in enumerate(parts)]
        return np.array([i for part in ids for i in part], np.uint32)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each ended by END_ID, and where each text begins."""
        n = len(texts)
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = split.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        stays = pc.match_substring_regex(words, f"{STAYS}|{self.stays_apart}").to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~stays)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(plain)], words.take(pa.array(plain))), " ")[0].as_py()
        ids = np.array(self.encoding.encode_ordinary(f" {joined}" if len(plain) else ""), np.uint32)
        begins = np.flatnonzero(self.starts[ids])
        begin, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begin[plain], length[plain] = begins, np.diff(np.append(begins, len(ids)))

        # A slot for every word, and one after each text for its end. The first word has no space
        # before it; a text with a word that has to stay in its text is encoded whole there.
        owner = np.repeat(np.arange(n), np.diff(bounds))
        slot = np.arange(len(index)) + owner
        first, last = bounds[:-1] + np.arange(n), bounds[1:] + np.arange(n)
        begin_at, length_at = np.zeros(len(index) + n, np.int64), np.zeros(len(index) + n, np.int64)
        begin_at[slot], length_at[slot] = begin[index], length[index]
        odd = stays[index]
        openings = words.take(pa.array(index[bounds[:-1]]))
        odd[bounds[:-1]] = pc.match_substring_regex(openings, self.stays_apart).to_numpy(zero_copy_only=False)
        openings = openings.to_pylist()
        whole = np.zeros(n, bool)
        whole[owner[odd]] = True
        more, size = [ids], len(ids)
        for k in range(n):
            if whole[k]:
                own = self.whole(texts[k].as_py())
                length_at[first[k]:last[k]] = 0
            else:
                own = self.whole(openings[k])
            begin_at[first[k]], length_at[first[k]] = size, len(own)
            more.append(own)
            size += len(own)
        begin_at[last], length_at[last] = size, 1
        source = np.concatenate([*more, [np.uint32(END_ID)]]).astype(np.uint32)
        out_at = np.concatenate([[0], np.cumsum(length_at)])
        out = source[np.repeat(begin_at - out_at[:-1], length_at) + np.arange(out_at[-1])]
        return out, np.append(out_at[first], out_at[-1])

    def encode_all(self, blocks: Iterable[pa.StringArray]) -> tuple[np.ndarray, np.ndarray]:
        """`encode` of all blocks together. Only one block's words are held at a time."""
        ids, begins, size = [], [np.zeros(1, np.int64)], 0
        for texts in blocks:
            own, at = self.encode(texts)
            ids.append(own)
            begins.append(at[1:] + size)
            size += len(own)
        return np.concatenate(ids), np.concatenate(begins)


def byte_letters() -> dict[int, str]:
    """How the vocabulary file spells bytes: visible Latin-1 letters as such, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def cut_positions(ids: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> tuple[list[int], list[int]]:
    """Positions where a window may end, from 0 to the end of the stream, and what each costs."""
    sentences = np.flatnonzero(stops[ids]) + 1
    sentences = sentences[np.diff(sentences // NEAR, prepend=-1) > 0]
    edges = np.union1d(sentences, begins)
    cost = np.full(len(edges), SENTENCE_PENALTY)
    cost[np.searchsorted(edges, begins)] = 0
    long = np.flatnonzero(np.diff(edges) > LONG_SENTENCE)
    if len(long):
        inside = np.concatenate([np.arange(edges[k] + GRID, edges[k + 1], GRID) for k in long])
        order = np.argsort(np.concatenate([edges, inside]), kind="stable")
        cost = np.concatenate([cost, np.full(len(inside), INSIDE_PENALTY)])[order]
        edges = np.concatenate([edges, inside])[order]
    return edges.tolist(), cost.tolist()


def cheapest_cuts(positions: list[int], penalties: list[int], window: int = WINDOW) -> list[int]:
    """Ends of the cheapest windows: positions[0] is 0, the last one is where the stream ends.

    Neighbouring positions are at most `window` apart.
    """
    best, back, value = (array("q", bytes(8 * len(positions))) for _ in range(3))  # value: best[i] + positions[i]
    index, oldest = {positions[0]: 0}, 0  # the positions in reach
    powers = [1 << k for k in range(window.bit_length())]
    queue: deque[int] = deque([0])
    for j in range(1, len(positions)):
        p = positions[j]
        while positions[queue[0]] < p - window:
            queue.popleft()
        while positions[oldest] < p - window:
            del index[positions[oldest]]
            oldest += 1
        i = queue[0]
        cost = window - p + value[i]
        if cost >= best[j - 1] and (cost > best[j - 1] + SLACK or j == len(positions) - 1):
            for w in powers:
                k = index.get(p - w)
                if k is not None and best[k] < cost:
                    cost, i = best[k], k
        best[j], back[j] = cost + penalties[j], i
        v = value[j] = best[j] + p
        index[p] = j
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    ends, j = [], len(positions) - 1
    while j:
        ends.append(positions[j])
        j = back[j]
    return ends[::-1]


def packed(keys: list, ids: np.ndarray, begins: np.ndarray, stops: np.ndarray, first: int) -> tuple[list[np.ndarray], int]:
    """Columns of the pieces of a chunk, and the number of the sequence after its last."""
    windows = np.array([0, *cheapest_cuts(*cut_positions(ids, begins, stops))])
    edges = np.union1d(windows, begins)
    at, length = edges[:-1], np.diff(edges)
    doc = np.searchsorted(begins, at, "right") - 1
    window = np.searchsorted(windows, at, "right") - 1
    raw = memoryview(ids.astype("<u4").tobytes())
    own = [raw[4 * a:4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    columns = [
        pa.array([keys[k] for k in doc.tolist()], pa.int64()), at - begins[doc], length,
        np.array([zlib.crc32(x) for x in own], np.int64), np.diff(begins)[doc], first + window, at - windows[window],
        pa.array([bytes(x) for x in own], pa.binary()),
    ]
    return columns, first + len(windows) - 1


def packer(path: str, with_ids: bool):
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, size = Encoder(path), [], 0
        sequence = TaskContext.get().partitionId() << 33

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            keys = [k for rows in held for k in rows.column("doc_id").to_pylist()]
            texts = (pc.fill_null(rows.column("text").cast(pa.string()), "") for rows in held)
            columns, sequence = packed(keys, *encoder.encode_all(texts), encoder.stops, sequence)
            arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + columns[-1:]
            n = len(names) if with_ids else len(names) - 1
            return pa.RecordBatch.from_arrays(arrays[:n], names=names[:n])

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                held.append(batch.slice(at, 1000))
                size += sum(b.size for b in pa.concat_batches([held[-1]]).column("text").buffers() if b)
                if size >= CHUNK_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def pack_documents(docs: DataFrame, with_ids: bool = False, tokenizer: str = TOKENIZER, partitions: int | None = None) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `with_ids` adds the pieces' tokens as little-endian 32-bit numbers. Documents are dealt out by
    ranges of the id, so a range is packed in one task, block by block. A NULL text counts as an
    empty one and gives one piece, the end token; a NULL id sorts first and stays NULL; repeated
    rows are packed each; other columns are ignored; an empty table gives no pieces. Numbers of
    sequences are unique but have gaps.
    """
    n = partitions or shuffle_width(docs.sparkSession)
    ordered = (docs.select("doc_id", "text").repartitionByRange(n, "doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    schema = PIECES if with_ids else PIECES.rpartition(",")[0]
    return ordered.mapInArrow(giving_back(packer(tokenizer, with_ids)), schema)
