"""Quality classifier by importance resampling: hashed n-gram models of target and raw text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table, written
from .words import Words, mix, slices

BUCKETS = 1 << 16
#: The model is fitted and its cut is set on this many labelled rows at most, those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
SEED = 17

_CLASS = np.zeros((4, 256), np.int64)  # lower-case, upper-case, digit, other ASCII
_CLASS[0, 97:123] = _CLASS[1, 65:91] = _CLASS[2, 48:58] = 1
_CLASS[3, 33:127] = 1 - _CLASS[:3, 33:127].sum(axis=0)


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text index and bucket of each n-gram: words, pairs of words, word shapes and pairs of shapes.

    A shape is the case of a word's letters, its punctuation at both ends, whether it has digits and
    whether it repeats the word before; so words never seen have familiar n-grams too.
    """
    words = Words(column, lower=True)
    n = len(words.hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = []
    for own in _CLASS:
        sums = np.append(0, np.cumsum(own[words.data], dtype=np.int32))
        counts.append(sums[words.ends] - sums[words.starts])
    lower, upper, digit, _ = counts
    mark = _CLASS[3].astype(bool)
    begin, end = words.data[words.starts], words.data[words.ends - 1]
    before_end = words.data[np.maximum(words.ends - 2, words.starts)]
    case = np.where(lower + upper == 0, 0, np.where(upper == 0, 1, np.where(lower == 0, np.where(upper > 1, 2, 3), np.where((_CLASS[1][begin] == 1) & (upper == 1), 3, 4))))
    again = np.append(False, (words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1]))
    shape = case + 8 * (digit > 0) + 16 * again
    for k, edge in enumerate((begin, end, before_end)):
        shape = shape + (np.where(mark[edge], edge, 0).astype(np.int64) << (8 + 8 * k))
    shape = mix(shape.astype(np.uint64) + np.uint64(1 << 40))
    same = words.text[1:] == words.text[:-1]
    pairs = [mix(x[:-1] * np.uint64(3) + x[1:])[same] for x in (words.hashes, shape)]
    text = np.concatenate([words.text, words.text, *[words.text[1:][same]] * 2])
    return text, (np.concatenate([words.hashes, shape, *pairs]) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    """Log ratio of target to raw for each bucket, and the least average that is accepted."""

    ratios: np.ndarray
    cut: float = float("-inf")

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """n-grams and the average log ratio of each text; NaN for a text without words."""
        text, bucket = ngrams(column)
        sizes = np.bincount(text, minlength=len(column))
        with np.errstate(invalid="ignore"):
            return sizes, np.bincount(text, weights=self.ratios[bucket], minlength=len(column)) / sizes


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            text, bucket = ngrams(part.column("text"))
            raw += np.bincount(bucket, minlength=BUCKETS)
            chosen = part.column("target").fill_null(False).to_numpy(zero_copy_only=False)
            target += np.bincount(bucket[chosen[text]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, mean = model.score(part.column("text"))
                rest = [part.column(c) for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes, pa.int64()), pa.array(mean, pa.float64(), mask=sizes == 0)], [*(c for c in part.schema.names if c != "text"), "n_ngrams", "quality_score"])

    return run


def best_cut(scores: list[tuple[float, int]]) -> float:
    """The score from which on accepting has the best balanced accuracy; of equals the lowest.

    Without rows of both classes all texts are accepted.
    """
    rows = sorted((s, y) for s, y in scores if s is not None and y is not None)
    good = sum(y == 1 for _, y in rows)
    bad = len(rows) - good
    if not good or not bad:
        return float("-inf")
    best, cut = 0.5, float("-inf")
    below_good = below_bad = 0
    for k, (s, y) in enumerate(rows[:-1]):
        below_good += y == 1
        below_bad += y != 1
        accuracy = ((good - below_good) / good + below_bad / bad) / 2
        if rows[k + 1][0] > s and accuracy > best:
            best, cut = accuracy, (s + rows[k + 1][0]) / 2
    return cut


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model of a corpus: the raw counts cover all of docs, the target's its labelled good texts.

    At most sample_rows labelled ids are used (the table joined by broadcast has that bound): of one
    half the good texts make the target model, on the other half the cut is set. An id labelled more
    than once counts as bad if any label is 0. Without labels the ratios are 0 and all is accepted.
    """
    sample = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(F.min(label_col).cast("int").alias("label"))
    sample = sample.withColumn("h", F.xxhash64("key", F.lit(SEED))).orderBy("h", "key").limit(sample_rows)
    sample = written(sample.select("key", "label", (F.pmod("h", F.lit(2)) == 0).alias("fits")), "sample")
    base = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    counted = base.join(F.broadcast(sample), "key", "left").select("text", (F.col("fits") & (F.col("label") == 1)).alias("target"))
    counts = np.zeros((2, BUCKETS))
    for row in counted.mapInArrow(_count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        counts[:, row["bucket"]] = row["raw"], row["target"]
    if not counts[1].any():
        return Model(np.zeros(BUCKETS))
    share = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    model = Model(np.log(share[1] / share[0]))
    held = base.join(F.broadcast(sample.where("not fits")), "key").select("label", "text").mapInArrow(_scores(model), "label int, n_ngrams long, quality_score double")
    model.cut = best_cut([(r["quality_score"], r["label"]) for r in held.select("quality_score", "label").collect()])
    return model


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_ngrams, quality_score, accepted) of every row; a text without words is not accepted.

    Texts of any length are scored whole. Ids may be null or repeat; an empty table gives an empty one. Other columns are left out,
    whatever their names.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = base.mapInArrow(_scores(model), f"id {base.schema['id'].dataType.simpleString()}, n_ngrams long, quality_score double")
    return scored.withColumn("accepted", F.coalesce(F.col("quality_score") >= model.cut, F.lit(False)))


def accepted_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, as they are, whose texts the model accepts; no shuffle. Null texts and such without words go; rows may repeat, and
    an empty table gives an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(np.nan_to_num(model.score(part.column(text_col))[1], nan=-np.inf, neginf=-np.inf) >= model.cut) if np.isfinite(model.cut) else pa.array(model.score(part.column(text_col))[0] > 0))

    return docs.mapInArrow(run, docs.schema)


def kth_largest(df: DataFrame, column: str, k: int, cells: int = 4096) -> float | None:
    """The k-th largest value of a double column, exactly; null if there are fewer.

    Histograms of `cells` equal cells narrow the range in which it lies, until one value is left or
    the range holds few enough values to look at; each pass returns at most `cells` counts.
    """
    df = df.select(F.col(column).alias("x")).where("x is not null")
    low, high, n = df.agg(F.min("x"), F.max("x"), F.count("*")).first()
    if k < 1 or n < k:
        return None
    above = 0  # values larger than high
    while low < high:
        width = (high - low) / cells
        if not low + width > low:
            break
        cell = F.least(F.floor((F.col("x") - low) / width), F.lit(cells - 1))
        rows = df.where(F.col("x").between(low, high)).groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        for row in sorted(rows, key=lambda r: -r["cell"]):
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                if row["n"] <= cells:
                    near = sorted((r["x"] for r in df.where(F.col("x").between(low, high)).collect()), reverse=True)
                    return near[k - above - 1]
                break
            above += row["n"]
    return high


def resample(scored: DataFrame, fraction: float, seed: int = SEED, sharpness: float | None = None) -> DataFrame:
    """scored with log_weight, gumbel_key and selected: a share of the accepted rows, drawn without replacement by weight.

    A text's weight is the ratio of the two models, the product over all its n-grams. With `sharpness` it is that power of the ratio's
    geometric mean instead, so that a text's length has no part in it.

    Gumbel top-k: the weight's logarithm plus Gumbel noise, from a hash of the id, is the key; the
    rows with the k largest keys are a weighted draw. k is the share of the accepted rows, rounded; rows
    with equal ids and scores have one key and are selected together. With fraction 1 all accepted rows are selected.
    """
    noise = -F.log(-F.log((F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11) + 0.5) / float(1 << 53)))
    scored = scored.withColumn("log_weight", F.col("quality_score") * (F.col("n_ngrams") if sharpness is None else F.lit(sharpness)))
    scored = scored.withColumn("gumbel_key", F.when(F.col("accepted"), F.col("log_weight") + noise))
    if fraction >= 1:
        return scored.withColumn("selected", F.col("accepted"))
    accepted = scored.where("accepted").count()
    cut = kth_largest(scored, "gumbel_key", round(fraction * accepted))
    return scored.withColumn("selected", F.coalesce(F.col("gumbel_key") >= F.lit(cut), F.lit(False)) if cut is not None else F.lit(False))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = written(classify(docs, fit(docs, table(spark, sf_dir, "labels"))), "scores")
    return resample(scored, 0.5).withColumnRenamed("id", "doc_id")
