"""Packing tokenised documents into sequences: exact complements first, then best fit."""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spans import SpanStore
from .tables import shuffle_partitions, table, written
from .words import Words, list_column, slices

CAPACITY = 2048
END_ID = 0
#: Hash buckets that pieces of one length are numbered in; with the lengths this bounds the table of their counts.
MOST_BUCKETS = 1024

#: Columns of pack() of its own.
_BUCKET, _BEFORE, _RANK = "__bucket", "__before", "__rank"

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of texts by a tokenizer none of whose tokens spans white space: each distinct word is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encode = Tokenizer.from_file(path).encode_batch_fast
        self.store = SpanStore(lambda texts: [e.ids for e in encode(texts, add_special_tokens=False)], [END_ID])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, END_ID after each, and where each text's begin."""
        words = Words(column)
        codes = np.insert(self.store.codes(words.hashes, words.data, words.starts, words.ends), words.first[1:], 0)
        ids, begin = self.store.values(codes)
        return ids, np.append(0, begin[words.first[1:] + np.arange(1, len(column) + 1)])


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = encode(part.column("text"))
                counts = -(-np.diff(at) // capacity)
                row = np.repeat(np.arange(part.num_rows), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                begin = at[row] + piece * capacity
                end = np.minimum(begin + capacity, at[row + 1])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist())]
                columns = [part.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array(end - begin, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(list_column(ids, end - begin, pa.int32()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32 and, if asked for, ids): each text's ids and END_ID, cut every `capacity` ids.

    Null and empty texts give one piece that holds END_ID; texts of any length are cut, never shortened. Rows with one id are separate
    texts. An empty table gives an empty one. Columns other than id and text are left out, whatever their names.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return base.mapInArrow(_pieces(tokenizer_path, capacity, with_ids), schema)


class SumIndex:
    """What sums one, two and three available lengths have: for a sum, the pairs that make it, and the third length that leaves a pair.

    Of a sum's combinations those with the largest lengths come first. Counts only fall, so a combination that is used up is passed
    for good: each sum keeps its place among its pairs and among its thirds, and a lookup begins there.
    """

    def __init__(self, left: np.ndarray, capacity: int):
        self.left = left
        lengths = np.flatnonzero(left)[::-1]
        big, small = (m.ravel() for m in np.meshgrid(lengths, lengths, indexing="ij"))
        pairs = (big >= small) & (big + small <= capacity)
        order = np.lexsort((-big[pairs], (big + small)[pairs]))
        self.big, self.small = big[pairs][order], small[pairs][order]
        bounds = np.searchsorted(self.big + self.small, np.arange(capacity + 2)).tolist()
        self.pair_at, self.pair_end = bounds[:-1], bounds[1:]
        self.thirds, self.third_at = lengths.tolist(), [0] * (capacity + 1)

    def has(self, lengths: list[int]) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in lengths)

    def pair(self, total: int, held: list[int]) -> list[int] | None:
        """Two lengths with this sum beside those held."""
        for i in range(self.pair_at[total], self.pair_end[total]):
            two = [int(self.big[i]), int(self.small[i])]
            if not self.has(two):
                self.pair_at[total] += i == self.pair_at[total]
            elif self.has(two + held):
                return two
        return None

    def triple(self, total: int, held: list[int]) -> list[int] | None:
        for i in range(self.third_at[total], len(self.thirds)):
            third = self.thirds[i]
            if third > total - 2 or not self.has([third]) or self.pair(total - third, [third]) is None:
                self.third_at[total] += i == self.third_at[total]
            elif self.has([third, *held]) and (two := self.pair(total - third, [third, *held])):
                return [third, *two]
        return None

    def exact(self, gap: int, held: list[int]) -> list[int] | None:
        """One, two or three lengths with this sum beside those held."""
        return [] if not gap else [gap] if self.has([gap, *held]) else self.pair(gap, held) or self.triple(gap, held)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fillings of a sequence, each a tuple of lengths, and how often each is used.

    From the longest on, a length is joined with the one, two or three available lengths that fill its
    gap exactly, as the index of sums has them; what finds no such complement is filled by best fit, the largest
    length that fits first. A filling is used as often as its lengths last, so each step uses up a
    length: the plan's size follows the number of lengths, not of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    found: list[tuple[tuple[int, ...], int]] = []
    sums = SumIndex(left, capacity)

    def use(lengths: list[int]) -> None:
        need = Counter(lengths)
        times = min(int(left[x]) // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= n * times
        found.append((tuple(lengths), times))

    for length in range(capacity, 0, -1):
        while left[length] and (rest := sums.exact(capacity - length, [length])) is not None:
            use([length, *rest])
    while len(there := np.flatnonzero(left)):
        lengths, gap = [int(there[-1])], capacity - int(there[-1])
        left[lengths[0]] -= 1
        while gap and len(fit := np.flatnonzero(left[: gap + 1])):
            lengths.append(int(fit[-1]))
            left[lengths[-1]] -= 1
            gap -= lengths[-1]
        for x in lengths:
            left[x] += 1
        use(lengths)
    return found


def _places(fillings: list[tuple[tuple[int, ...], int]]):
    """For each length: where its ranks pass to the next filling, its number in a sequence, the filling's first sequence, its offsets."""
    slots: dict[int, list[tuple[int, int, list[int]]]] = {}
    sequence = 0
    for lengths, times in fillings:
        offsets: dict[int, list[int]] = {}
        at = 0
        for x in lengths:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, own in offsets.items():
            slots.setdefault(x, []).append((times, sequence, own))
        sequence += times
    out = {}
    for x, own in slots.items():
        sizes = np.array([len(o) for _, _, o in own], np.int64)
        starts = np.append(0, np.cumsum(sizes * np.array([t for t, _, _ in own], np.int64)))
        offset_at = np.append(0, np.cumsum(sizes))
        out[x] = starts, sizes, np.array([s for _, s, _ in own], np.int64), offset_at, np.array([a for _, _, o in own for a in o], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column(_RANK).to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for x in np.unique(lengths):
                rows = np.flatnonzero(lengths == x)
                starts, sizes, first, offset_at, offsets = out[int(x)]
                k = np.searchsorted(starts, ranks[rows], "right") - 1
                within = ranks[rows] - starts[k]
                sequence[rows] = first[k] + within // sizes[k]
                offset[rows] = offsets[offset_at[k] + within % sizes[k]]
            kept = [batch.column(c) for c in batch.schema.names if c != _RANK]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*(c for c in batch.schema.names if c != _RANK), "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, key_cols: tuple[str, ...] = ("id", "piece")) -> DataFrame:
    """pieces (with a long `length` from 1 to capacity) with sequence_id and offset, gapless from 0.

    Only the number of pieces of each length, at most `capacity` numbers, comes to the driver, where the
    plan is made. Pieces are numbered within their length in hash buckets, whose counts give each
    bucket's first number, so that a length that many pieces have is spread over all buckets.
    An empty table gives an empty result. Rows that repeat a key are pieces of their own; null keys are keys like others. Other
    columns stay, whatever their names; sequence_id and offset that the pieces already have are replaced.
    """
    spark = pieces.sparkSession
    buckets = min(shuffle_partitions(spark), MOST_BUCKETS)
    pieces = pieces.drop("sequence_id", "offset").withColumn(_BUCKET, F.pmod(F.xxhash64(*key_cols), F.lit(buckets)).cast("int"))
    sizes = written(pieces.groupBy(F.col(_BUCKET).alias("b"), F.col("length").alias("l")).agg(F.count("*").alias("n")), "lengths")
    counts = {r["l"]: r["n"] for r in sizes.groupBy("l").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("l").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select(F.col("b").alias(_BUCKET), F.col("l").alias("length"), F.coalesce(before, F.lit(0)).alias(_BEFORE))
    # whole rows decide between equal keys, so that a task that runs again numbers them alike
    rest = F.xxhash64(*(F.col(f"`{f.name}`") for f in pieces.schema.fields if not isinstance(f.dataType, T.MapType)))
    number = F.row_number().over(Window.partitionBy(_BUCKET, "length").orderBy(*key_cols, rest)) - 1
    ranked = pieces.withColumn(_RANK, number).join(before, [_BUCKET, "length"])
    ranked = ranked.select(*(F.col(f"`{c}`") for c in pieces.columns if c != _BUCKET), (F.col(_BEFORE) + F.col(_RANK)).alias(_RANK))
    out = T.StructType([*(f for f in ranked.schema.fields if f.name != _RANK), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(_places(plan(counts, capacity)), out)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that carry their ids; a sequence holds at most its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """A row per piece of each document: id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(token_pieces(docs, tokenizer_path), "pieces"))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer()).withColumnRenamed("id", "doc_id")
