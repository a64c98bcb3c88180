"""What Python workers hold at a time."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from deskspark.llm import packing
from deskspark.llm.common import BATCH_ROWS, BATCH_SETTING


def test_stages_hand_texts_to_python_in_short_batches(spark):
    def batch_sizes(batches):  # within the test, as workers cannot import this file
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows for b in batches], pa.int64())], names=["n"])

    docs = spark.range(0, 2 * BATCH_ROWS + 10, 1, 1).selectExpr("id AS doc_id", "'some text' AS text")
    before = spark.conf.get(BATCH_SETTING)
    try:
        for setting, most in ((10_000, BATCH_ROWS), (0, BATCH_ROWS), (7, 7)):
            spark.conf.set(BATCH_SETTING, setting)
            corpus_pipeline.packed(spark, docs, "")
            sizes = [r.n for r in docs.mapInArrow(batch_sizes, "n long").collect()]
            assert sum(sizes) == 2 * BATCH_ROWS + 10 and max(sizes) == most
    finally:
        spark.conf.set(BATCH_SETTING, before)


def test_texts_encoded_in_blocks_have_the_same_ids():
    texts = ["one two  three", "", " lead", "tail ", "a\x1cb c", "two two\n\nfour", "<|endoftext|> x", "é ü 漢字"] * 3
    encoder = packing.Encoder(packing.TOKENIZER)
    ids, begins = encoder.encode(pa.array(texts))
    for size in (1, 5, len(texts)):
        blocks = (pa.array(texts[k:k + size]) for k in range(0, len(texts), size))
        own_ids, own_begins = encoder.encode_all(blocks)
        assert np.array_equal(own_ids, ids) and np.array_equal(own_begins, begins)


def test_cuts_hold_little_for_each_position():
    rng = random.Random(5)
    positions, penalties = [0], [0]
    while len(positions) < 100_000:
        positions.append(positions[-1] + rng.randrange(4, 20))
        penalties.append(rng.choice((0, 4)))
    tracemalloc.start()
    ends = packing.cheapest_cuts(positions, penalties)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ends[-1] == positions[-1] and max(np.diff([0, *ends])) <= packing.WINDOW
    assert most < 60 * len(positions)
