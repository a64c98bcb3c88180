"""Secret scan: a wide pattern finds candidates, a random forest removes false positives.

Features of a candidate: its length, how often the class of its characters and how often vowels and
consonants change, shares of digits, capitals and different characters, the share of its four-letter
pieces that are pieces of the corpus's most frequent words, signs around it, and hashes of the path
it was found on and of the words beside it. DataFrame functions and the forest of spark.ml.
"""

from __future__ import annotations

import dataclasses
import functools
import uuid

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import checkpoint, unused, words_of
from deskspark.session import shared_folder

#: A sign of equality before a value assigns it, one or two behind it are padding unless a value follows.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_-])"
SHORTEST = 16
CONTEXT_CHARS = 64
PIECE, DICTIONARY_WORDS, DICTIONARY_LETTERS = 4, 5_000, 5
#: The forest is fitted on at most this many findings of each label, chosen by a hash; their weights stand for all of the label.
LABELLED_ROWS = 10_000
TREES, DEPTH, SEED, HASHED = 20, 6, 11, 64
CREDENTIAL = r"(?i)(?:token|secret|passwd|password|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?[\"']?\s*(?:=|:|=>)\s*[\"']?$"
NUMERIC = ("length", "changes", "vowel_changes", "digit_share", "upper_share", "distinct_share", "coverage", "assigned", "quoted", "pathlike")
KEY = ["doc_id", "text_hash", "ordinal"]


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def runs(value: Column) -> Column:
    """Number of runs of equal characters."""
    return F.length(F.regexp_replace(value, r"(.)\1*", "x"))


def in_context(value: Column, i: Column) -> Column:
    """The value with CONTEXT_CHARS of the text on both sides, other candidates in there included."""
    near = CONTEXT_CHARS // SHORTEST  # no more candidates fit into the context
    part = lambda name, k: F.coalesce(F.get(F.col(name), k), F.lit(""))
    left = F.concat(*(x for k in range(near, 0, -1) for x in (part("rest", i - k), part("values", i - k))), part("rest", i))
    right = F.concat(part("rest", i + 1), *(x for k in range(1, near + 1) for x in (part("values", i + k), part("rest", i + k + 1))))
    return F.struct(value.alias("value"), F.substring(left, -CONTEXT_CHARS, CONTEXT_CHARS).alias("left"),
                    F.substring(right, 1, CONTEXT_CHARS).alias("right"))


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """A row for every candidate: doc_id, text_hash, ordinal (from 0 in its text), value, path and features.

    Copies of a row give equal candidates once. NULL and empty texts give none.
    """
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    found = docs.filter(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), where.alias("path"),
        F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), F.lit(1)).alias("values"), F.split("text", CANDIDATE, -1).alias("rest"))
    each = found.select("doc_id", "text_hash", "path", F.posexplode(F.transform("values", in_context)).alias("ordinal", "c"))
    rows = each.select("doc_id", "text_hash", "ordinal", "path", "c.value", "c.left", "c.right")
    rows = rows.dropDuplicates([*KEY])
    value, n = F.col("value"), F.length("value")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    letters = F.regexp_replace(F.lower(value), "[^a-z]", "")
    vowels = F.regexp_replace(F.regexp_replace(letters, "[^aeiouy]", "0"), "[aeiouy]", "1")
    before = F.regexp_replace(F.lower(F.regexp_extract("left", r"(\S+)[\s\"'=:>]*$", 1)), r"[^\p{L}\p{N}]", "")
    after = F.regexp_replace(F.lower(F.regexp_extract("right", r"^[\s\"']*(\S+)", 1)), r"[^\p{L}\p{N}]", "")
    return rows.select(
        *KEY, "value", "path", before.alias("before"), after.alias("after"),
        F.col("left").rlike(CREDENTIAL).alias("credential"),
        F.least(n, F.lit(200)).cast("double").alias("length"),
        share(runs(classes) - 1, n - 1).alias("changes"),
        share(F.greatest(runs(vowels) - 1, F.lit(0)), F.length(letters) - 1).alias("vowel_changes"),
        share(n - F.length(F.regexp_replace(value, "[0-9]", "")), n).alias("digit_share"),
        share(n - F.length(F.regexp_replace(value, "[A-Z]", "")), n).alias("upper_share"),
        share(F.size(F.array_distinct(F.split(value, ""))), n).alias("distinct_share"),
        F.col("left").rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        (F.col("left").rlike("[\"']$") & F.col("right").rlike("^[\"']")).cast("double").alias("quoted"),
        (F.col("path").rlike(r"(?i)test|example|fixture|sample") | F.col("left").rlike(r"[/\\]$") | (F.instr(value, "/") > 0))
        .cast("double").alias("pathlike"))


def pieces(value: Column) -> Column:
    """The runs of PIECE lower-case characters of a value, as an array; found in one pass, however long the value is."""
    every = F.regexp_extract_all(F.lower(value), F.lit(f"(?s)(?=(.{{{PIECE}}}))."), F.lit(1))
    return F.when(F.length(value) < PIECE, F.array(F.lower(value))).otherwise(every)


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> DataFrame:
    """`piece`: the four-letter pieces of the `words` most frequent words of letters in all texts."""
    each = docs.select(F.explode_outer(words_of(F.col("text"))).alias("w"))
    frequent = (each.filter((F.length("w") >= DICTIONARY_LETTERS) & F.col("w").rlike(r"^\p{L}+$")).groupBy("w")
                .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(words))
    return frequent.select(F.explode(pieces(F.col("w"))).alias("piece")).distinct()


def covered(found: DataFrame, known: DataFrame) -> DataFrame:
    """`found` with `coverage`, the share of a value's pieces that are in the dictionary."""
    each = found.select(*KEY, F.explode(pieces(F.col("value"))).alias("piece"))
    # A bounded dictionary: DICTIONARY_WORDS words of at most a text's length, cut into pieces.
    hits = each.join(F.broadcast(known.withColumn("hit", F.lit(1.0))), "piece", "left")
    shares = hits.groupBy(*KEY).agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("coverage"))
    shares = shares.withColumnsRenamed({k: f"_of_{k}" for k in KEY})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in KEY]
    return found.join(shares, same).drop(*[f"_of_{k}" for k in KEY])


def clear_label() -> Column:
    """1: a value with letters and digits, assigned to a name of a credential; 0: letters only or
    digits only, not so assigned; NULL: all others."""
    mixed = F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]")
    return F.when(F.col("credential") & mixed, 1.0).when(~F.col("credential") & ~mixed, 0.0)


def labelled(found: DataFrame) -> DataFrame:
    """Findings whose label follows from what stands before them or from what they are made of.

    All others are left to the forest.
    """
    return found.withColumn("label", clear_label()).filter("label IS NOT NULL")


@dataclasses.dataclass
class SecretModel:
    hasher: FeatureHasher
    assembler: VectorAssembler
    forest: RandomForestClassificationModel | None

    def features(self, found: DataFrame) -> DataFrame:
        named = found.withColumns({f"{c}_word": F.concat(F.lit(f"{c}:"), c) for c in ("path", "before", "after")})
        return self.assembler.transform(self.hasher.transform(named))

    def score(self, found: DataFrame) -> DataFrame:
        """`found` with `score`, the forest's probability of a secret; without a forest 1 for clear secrets, else 0."""
        if self.forest is None:
            return found.withColumn("score", F.coalesce(clear_label(), F.lit(0.0)))
        scored = self.forest.transform(self.features(found)).withColumn("score", vector_to_array("probability")[1])
        return scored.select(*found.columns, "score")


def fit(findings: DataFrame) -> SecretModel:
    """A forest of labelled findings (label, and the columns of `covered`).

    With findings of one label only, or none, there is no forest and each row is judged by `clear_label`.
    """
    words = [f"{c}_word" for c in ("path", "before", "after")]
    model = SecretModel(
        FeatureHasher(inputCols=words, outputCol="words", numFeatures=HASHED),
        VectorAssembler(inputCols=[*NUMERIC, "words"], outputCol="features"), None)
    counts = {r["label"]: r["n"] for r in findings.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two labels
    if counts.get(0.0) and counts.get(1.0):
        of_each = [findings.filter(F.col("label") == label).orderBy(F.xxhash64(*KEY), *KEY).limit(LABELLED_ROWS)
                   .withColumn("weight", F.lit(max(1.0, n / LABELLED_ROWS))) for label, n in sorted(counts.items()) if label is not None]
        rows = checkpoint(functools.reduce(DataFrame.unionByName, of_each))
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label", weightCol="weight")
        fitted = forest.fit(model.features(rows).select("features", "label", "weight"))
        # A fitted model's summary holds the session, which cannot be sent to tasks once anything was observed in it.
        path = f"{shared_folder(findings.sparkSession)}/llm/forest-{uuid.uuid4().hex[:12]}"
        fitted.save(path)
        model.forest = RandomForestClassificationModel.load(path)
    return model


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """All candidates of `docs` (doc_id, text, source) with `score` and `is_secret` (from `threshold` on).

    `findings` are labelled findings to learn from; without them `labelled` makes some from the
    candidates. NULL and empty texts have no candidates; copies of a row have theirs once; a NULL
    id stays NULL; a missing path counts as empty; an empty table gives an empty result.
    """
    found = checkpoint(covered(candidates(docs), dictionary(docs)))
    model = fit(labelled(found) if findings is None else findings)
    return model.score(found).withColumn("is_secret", F.col("score") >= threshold)


def redact(docs: DataFrame, scanned: DataFrame, mark: str = "<secret>") -> DataFrame:
    """`docs` with every secret in `text` replaced by `mark`; all rows and other columns stay."""
    own, digest, at = (unused(n, docs.columns) for n in ("secret_id", "secret_hash", "secret_at"))
    secrets = (scanned.filter("is_secret").groupBy(F.col("doc_id").alias(own), F.col("text_hash").alias(digest))
               .agg(F.collect_set("ordinal").alias(at)))
    same = docs["doc_id"].eqNullSafe(secrets[own]) & (F.xxhash64(docs["text"]) == secrets[digest])
    joined = docs.join(secrets, same, "left")
    values = F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), F.lit(1))
    secret = F.transform(values, lambda v, i: F.when(F.array_contains(at, i), mark).otherwise(v))
    text = F.array_join(F.zip_with(F.split("text", CANDIDATE, -1), secret, lambda s, v: F.concat(s, F.coalesce(v, F.lit("")))), "")
    return joined.withColumn("text", F.when(F.col(at).isNotNull(), text).otherwise(F.col("text"))).select(*docs.columns)
