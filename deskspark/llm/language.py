"""Language identification by hyperdimensional profiles.

Every letter class has a random vector of +1 and -1. A trigram's vector binds (multiplies) its
letters' vectors, permuted (rotated) by their place. A text's vector bundles (adds) those of all its
trigrams, a language's prototype those of its training texts. A text gets the language whose
prototype has the largest cosine with it, after the mean of the prototypes' directions is taken
from both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS, CLASSES, SEED = 1024, 64, 7
#: Characters, texts and different trigrams that are worked on at once; longer texts are taken whole.
CHUNK_CHARS, CHUNK_TEXTS, BLOCK = 1_000_000, 256, 16_384
UNKNOWN = "und"


def letter_classes() -> np.ndarray:
    """Class of each code point below 2**16: 0 for what is no letter, a to z their own, others share the rest."""
    table = np.zeros(1 << 16, np.int32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            table[c] = c - 96 if 97 <= c <= 122 else 27 + c % (CLASSES - 27)
    return table


def letter_vectors() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.float32), (CLASSES, DIMENSIONS))


def trigrams(text: str | None, table: np.ndarray) -> np.ndarray:
    """Trigram numbers of a whole text; runs of other characters count as one boundary."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if codes.size and codes.max() >= 1 << 16:
        high = {int(c): 27 + int(c) % (CLASSES - 27) if chr(int(c)).isalpha() else 0 for c in set(codes[codes >= 1 << 16].tolist())}
        classes = np.array([high[c] if c in high else table[c] for c in codes.tolist()], np.int32)
    else:
        classes = table[codes]
    if not classes.any():
        return np.zeros(0, np.int64)
    x = np.concatenate([[0], classes, [0]])
    x = x[np.concatenate([[True], (x[1:] > 0) | (x[:-1] > 0)])]
    return ((x[:-2] * CLASSES + x[1:-1]) * CLASSES + x[2:]).astype(np.int64)


def bundle(counts: np.ndarray, grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Vectors of texts whose trigrams are counted in the rows of `counts`."""
    out = np.zeros((len(counts), DIMENSIONS), np.float32)
    first, second = np.roll(letters, 2, 1), np.roll(letters, 1, 1)
    for i in range(0, len(grams), BLOCK):
        g = grams[i:i + BLOCK]
        out += counts[:, i:i + BLOCK] @ (first[g // CLASSES**2] * second[g // CLASSES % CLASSES] * letters[g % CLASSES])
    return out


def counted(found: list[np.ndarray], groups: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each trigram (a column) in each of n groups (a row), and the trigrams."""
    codes = np.concatenate(found)
    grams = np.flatnonzero(np.bincount(codes, minlength=1))
    column = np.zeros(int(grams[-1]) + 1 if grams.size else 1, np.int64)
    column[grams] = np.arange(grams.size)
    rows = np.repeat(groups, [len(f) for f in found])
    counts = np.bincount(rows * max(1, grams.size) + column[codes], minlength=n * grams.size)
    return counts.reshape(n, grams.size).astype(np.float32), grams


def chunks(batch: pa.RecordBatch, table: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Consecutive rows' trigrams, with the number of the first row."""
    start, chars, found = 0, 0, []
    for i, text in enumerate(batch.column("text")):
        found.append(trigrams(text.as_py(), table))
        chars += len(found[-1])
        if chars >= CHUNK_CHARS or len(found) >= CHUNK_TEXTS:
            yield start, found
            start, chars, found = i + 1, 0, []
    if found:
        yield start, found


def language_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every language the sum of its texts' vectors: a row for each dimension."""
    table, letters, sums = letter_classes(), letter_vectors(), {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for start, found in chunks(batch, table):
            own = langs[start:start + len(found)]
            names = sorted(set(own))
            counts, grams = counted(found, np.array([names.index(x) for x in own]), len(names))
            for name, v in zip(names, bundle(counts, grams, letters).astype(np.float64)):
                sums[name] = sums.get(name, 0) + v
    for name, v in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * DIMENSIONS, pa.string()), pa.array(np.arange(DIMENSIONS), pa.int32()), pa.array(v)], names=["lang", "i", "v"])


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes from all rows of `docs` (text, lang) with a language."""
    rows = docs.filter("lang IS NOT NULL").select("text", "lang").mapInArrow(language_sums, "lang string, i int, v double")
    sums: dict[str, np.ndarray] = {}
    for r in rows.groupBy("lang", "i").agg(F.sum("v").alias("v")).collect():  # DIMENSIONS rows a language
        sums.setdefault(r.lang, np.zeros(DIMENSIONS))[r.i] = r.v
    names = sorted(k for k, v in sums.items() if np.any(v))
    vectors = np.array([sums[k] / np.linalg.norm(sums[k]) for k in names]).reshape(len(names), DIMENSIONS)
    return names, vectors


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """`docs` with lang_pred and score.

    NULL texts and texts without a letter get `und` and 0, as do all texts if no language was
    learned. Ties go to the first language by name. Repeated rows get equal results; columns of
    the input with these names are replaced; an empty table gives an empty result.
    """
    names, prototypes = model
    centre = prototypes.mean(0) if len(names) > 1 else np.zeros(DIMENSIONS)
    directions = prototypes - centre
    directions = (directions / np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, letters = letter_classes(), letter_vectors()
        for batch in batches:
            langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for start, found in chunks(batch, table) if names else ():
                counts, grams = counted(found, np.arange(len(found)), len(found))
                vectors = bundle(counts, grams, letters)
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                vectors -= np.outer(vectors @ centre / max(1e-12, centre @ centre), centre)
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                cosines = vectors @ directions.T
                best = cosines.argmax(1)
                for k, own in enumerate(found):
                    if len(own):
                        langs[start + k] = names[best[k]]
                        scores[start + k] = np.clip((1 + cosines[k, best[k]]) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores)], names=[*batch.schema.names, "lang_pred", "score"])

    rows = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double")
