"""Document fingerprints: one-permutation MinHash, optimally densified, packed to low-order bits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import shuffle_partitions, table
from .words import CHUNK_BYTES, Words, mix, slices

BINS = 256
BITS = 4
SHINGLE = 5

#: The order in which an empty bin looks for a full one to copy; each bin has an order of its own.
_LOOK = np.argsort(mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)).reshape(BINS, BINS), axis=1)


def fingerprints(column: pa.Array) -> np.ndarray:
    """One row of BINS values of BITS bits per text; a text without words has only zeros.

    Each 5-word shingle (A-Z lower-cased) is hashed once: the upper half of the hash names its bin, the
    lower half competes for the bin's minimum. An empty bin copies the first full one in its own fixed
    random order, which depends on the bin only, so equal sets agree in it.
    """
    n = len(column)
    text, hashes = Words(column, lower=True).shingles(SHINGLE)
    h = mix(hashes + np.uint64(0x14057B7EF767814F))
    empty = np.uint64(1 << 32)
    low = np.full(n * BINS, empty, np.uint64)
    bins = (((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(low, text * BINS + bins, h & np.uint64(0xFFFFFFFF))
    low = low.reshape(n, BINS)
    full = low < empty
    row, bin_ = np.nonzero(~full & full.any(axis=1)[:, None])
    for k in range(BINS):
        if not len(row):
            break
        at = _LOOK[bin_, k]
        hit = full[row, at]
        low[row[hit], bin_[hit]] = low[row[hit], at[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    # the bin enters the kept bits, so that a value copied to many bins does not meet another by chance in all of them
    kept = mix(low + (np.arange(BINS, dtype=np.uint64) << np.uint64(33))) & np.uint64((1 << BITS) - 1)
    return np.where(low < empty, kept, 0).astype(np.uint8)


def packed(values: np.ndarray) -> list[str]:
    """The values of each row, BITS bits each, as hexadecimal digits."""
    width = BINS * BITS // 8
    bits = np.unpackbits(values[:, :, None], axis=2)[:, :, 8 - BITS :].reshape(len(values), BINS * BITS)
    raw = np.packbits(bits, axis=1).tobytes()
    return [raw[i * width : (i + 1) * width].hex() for i in range(len(values))]


def likeness(a: np.ndarray, b: np.ndarray, a_empty: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, 0 to 1: the share of equal bins without what chance makes equal.

    Two texts without words are alike (1); one with and one without are not (0).
    """
    chance = 2.0**-BITS
    alike = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), alike)


def _has_words(texts: list[str]) -> np.ndarray:
    return np.array([bool(t.strip("\t\n\v\f\r ")) for t in texts], bool)


def _largest(bounds: list[int]):
    """The largest key of each range of ids that a batch has."""
    edges = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.sort(batch.column("key").to_numpy())
            ranges = np.searchsorted(edges, keys, "left")
            last = np.flatnonzero(np.append(ranges[1:] != ranges[:-1], True)[: len(keys)])
            yield pa.RecordBatch.from_arrays([pa.array(ranges[last], pa.int32()), pa.array(keys[last], pa.int64())], ["range", "key"])

    return run


def _deal(bounds: list[int], firsts: dict[int, int]):
    """Rows with their range of ids; the first row of each range again, as the tail of the range before it."""
    edges = np.array(bounds, np.int64)
    order = sorted(firsts, reverse=True)  # ranges by descending id
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first range's row is the tail of the last one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch.column("id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            ranges = np.searchsorted(edges, ids)
            raw = [squeeze(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").fill_null("").to_pylist()]
            top = np.flatnonzero(ids == np.array([firsts[r] for r in ranges.tolist()], np.int64)) if len(ids) else np.zeros(0, np.int64)
            pick = np.append(np.arange(len(ids)), top)
            where = np.append(ranges, [before[r] for r in ranges[top].tolist()]).astype(np.int32)
            tail = pick.copy() >= 0
            tail[: len(ids)] = False
            yield pa.RecordBatch.from_arrays(
                [pa.array(where), pa.array(tail), pa.array(ids[pick]), batch.column("id").take(pa.array(pick)), pa.array([raw[i] for i in pick], pa.binary())], ["range", "tail", "key", "id", "raw"]
            )

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each with the next; the last row of a range is followed by the range's tail."""
    expand = zstandard.ZstdDecompressor().decompress
    held: list[tuple] = []  # (range, tail, id, text)
    size = 0
    for batch in batches:
        for where, tail, own, raw in zip(batch.column("range").to_pylist(), batch.column("tail").to_pylist(), batch.column("id").to_pylist(), batch.column("raw")):
            text = expand(raw.as_py()).decode("utf-8", "surrogatepass")
            held.append((where, tail, own, text))
            size += len(text)
            if size > CHUNK_BYTES and len(held) > 1:
                yield _compared(held)
                held, size = held[-1:], len(text)
    if len(held) > 1:
        yield _compared(held)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    texts = [r[3] for r in rows]
    own = [i for i in range(len(rows) - 1) if not rows[i][1]]
    assert all(rows[i][0] == rows[i + 1][0] for i in own), "a range without a tail"
    edited = []
    for i in own:
        cut = len(texts[i]) // 3
        edited.append(texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut])
    prints, changed = fingerprints(pa.array(texts, pa.large_string())), fingerprints(pa.array(edited, pa.large_string()))
    none, none_changed = ~_has_words(texts), ~_has_words(edited)
    at = np.array(own, np.int64)
    pick, follow = prints[at], prints[at + 1]
    columns = [
        pa.array([rows[i][2] for i in own], pa.int64()),
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(packed(pick), pa.string()),
        pa.array(packed(changed), pa.string()),
        pa.array(likeness(pick, changed, none[at], none_changed), pa.float64()),
        pa.array(likeness(pick, follow, none[at], none[at + 1]), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(packed(fingerprints(part.column("text"))), pa.string())], ["id", "fingerprint"])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, without a shuffle. Null and empty texts have the fingerprint of no words.

    Texts of any length count whole. Ids may be null or repeat, and equal texts have equal fingerprints; an empty table gives an
    empty one. Other columns are left out, whatever their names.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_fingerprint_rows, f"id {base.schema['id'].dataType.simpleString()}, fingerprint string")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of an edit of it and that of the next text, by descending id.

    The edit replaces the last floor(n_chars / 3) code points by the first as many of the next text; the
    last row's next is the first. Null texts are empty, null ids come last; rows with one id follow one another in
    the order of their compressed bytes. A single row is its own next, an empty table gives no rows.

    Ids are cut into ranges of even size at sampled quantiles; each text travels once, to its range, where a
    sort puts it before its next. Only the first row of a range travels twice, to end the range before it.
    The driver holds two numbers per range.
    """
    spark = docs.sparkSession
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    key = F.coalesce("id", F.lit(int(np.iinfo(np.int64).min)))
    parts = shuffle_partitions(spark)
    cuts = base.where("id is not null").approxQuantile("id", [k / parts for k in range(1, parts)], 1 / (8 * parts)) if parts > 1 else []
    bounds = sorted({int(c) for c in cuts})
    largest = base.select(key.alias("key")).mapInArrow(_largest(bounds), "range int, key long").groupBy("range").agg(F.max("key").alias("first"))
    firsts = {r["range"]: r["first"] for r in largest.collect()}
    if not firsts:
        return spark.createDataFrame([], schema)
    dealt = base.mapInArrow(_deal(bounds, firsts), "range int, tail boolean, key long, id long, raw binary")
    return dealt.repartition(parts, "range").sortWithinPartitions("range", "tail", F.col("key").desc(), "raw").mapInArrow(_compare, schema)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
