"""Exact substring dedup of word windows, with difference-cover anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .tables import table, written
from .words import Words, slices, text_buffers, word_spans

WINDOW = 20
#: Every residue modulo 13 is a difference of two members, so for any two positions some shift below 13 takes both into the cover.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: A shift below 13 and an anchor of 8 words stay inside the 20 words of a window.
ANCHOR = WINDOW - PERIOD + 1
BLOCK_BYTES = 8 << 20

_BLOCK = "block long, rows binary"
_ANCHOR = "hash long, block long"
_WINDOW = "hash long, more long, id long, block long, number long"
_WON = "block long, number long"


def _blocks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "__text", limit):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])
                n += 1

    return run


class _Block:
    """The words of a block, with what the passes need of them in the same order each time."""

    def __init__(self, raw: bytes):
        self.rows = pa.ipc.open_stream(raw).read_all().combine_chunks().to_batches()
        self.rows = self.rows[0] if self.rows else None
        parts = [Words(p.column("__text")) for p in slices(self.rows, "__text")] if self.rows is not None else []
        self.words = Words.__new__(Words)
        self.words.hashes = np.concatenate([w.hashes for w in parts] or [np.zeros(0, np.uint64)])
        self.words.counts = np.concatenate([w.counts for w in parts] or [np.zeros(0, np.int64)])
        self.words.first = np.append(0, np.cumsum(self.words.counts))
        self.words.text = np.repeat(np.arange(len(self.words.counts)), self.words.counts)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of the anchors: at cover positions of each text, where 8 words follow."""
        n = len(self.words.hashes) - ANCHOR + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        chosen = np.zeros(PERIOD, bool)
        chosen[list(COVER)] = True
        at = np.arange(n)
        at = at[chosen[(at - self.words.first[self.words.text[:n]]) % PERIOD] & (self.words.text[:n] == self.words.text[ANCHOR - 1 :])]
        return at, self.words.window_hashes(at, ANCHOR)

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """First word of the windows that hold a repeated anchor at a shift below the period; repeated: sorted hashes of such anchors."""
        at, hashes = self.anchors()
        size = len(self.words.hashes)
        marks = np.zeros(size + 1, np.int64)
        hit = at[np.isin(hashes, repeated)] if len(repeated) else at[:0]
        np.add.at(marks, np.maximum(hit - PERIOD + 1, 0), 1)
        np.add.at(marks, hit + 1, -1)
        n = size - WINDOW + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero((np.cumsum(marks)[:n] > 0) & (self.words.text[:n] == self.words.text[WINDOW - 1 :]))

    def firsts(self, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of windows: both hashes of each distinct sequence, and the first word of its first place in the order of id, then of position."""
        hashes, more = self.words.window_hashes(begin, WINDOW), self.words.window_hashes(begin, WINDOW, True)
        _, order = self.ids()
        by = np.lexsort((begin, order[self.words.text[begin]], more, hashes))
        hashes, more, begin = hashes[by], more[by], begin[by]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (more[1:] != more[:-1]))[: len(begin)]
        return hashes[new], more[new], begin[new]

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Each row's id (null after all others) and its place in the order of id, then of row."""
        column = self.rows.column("__id")
        ids = column.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.empty(len(ids), np.int64)
        order[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        return ids, order


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, pa.int64()) for c in columns], [n.split()[0] for n in names.split(", ")])


def _send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's distinct anchor hashes; those that it holds more than once are sent twice."""
    for batch in batches:
        for block, raw in zip(batch.column("block").to_pylist(), batch.column("rows")):
            keys, counts = np.unique(_Block(raw.as_py()).anchors()[1], return_counts=True)
            keys = np.concatenate([keys, keys[counts > 1]])
            yield _batch(_ANCHOR, keys, np.full(len(keys), block))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hash and block, as a stream -> (hash, block) of the hashes with more than one row, each block once."""
    keys, blocks = np.zeros(0, np.int64), np.zeros(0, np.int64)
    again = False  # whether the row that is held back has the hash of the row before it
    fresh = True  # and whether its block is another one
    for batch in batches:
        keys, blocks = (np.concatenate([held, batch.column(c).to_numpy()]) for held, c in ((keys, "hash"), (blocks, "block")))
        same = keys[1:] == keys[:-1]
        before = np.append(again, same)[: len(keys)]
        new = np.append(fresh, ~(same & (blocks[1:] == blocks[:-1])))[: len(keys)]
        found = (before[:-1] | same) & new[:-1]
        yield _batch(_ANCHOR, keys[:-1][found], blocks[:-1][found])
        if len(keys):
            again, fresh, keys, blocks = before[-1], new[-1], keys[-1:], blocks[-1:]
    if len(keys) and again and fresh:
        yield _batch(_ANCHOR, keys, blocks)


def _send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct sequence of a block's candidate windows, with the smallest id that has it and its number in the block."""
    for batch in batches:
        for block, raw, anchors in zip(batch.column("block").to_pylist(), batch.column("rows"), batch.column("anchors")):
            held = _Block(raw.as_py())
            if len(begin := held.candidates(_listed(anchors))):
                hashes, more, begin = held.firsts(begin)
                yield _batch(_WINDOW, hashes, more, held.ids()[0][held.words.text[begin]], np.full(len(begin), block), np.arange(len(begin)))


def _earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by both hashes, id and block, as a stream -> (block, number) of the first row of each sequence."""
    last = None
    for batch in batches:
        hashes, more = (batch.column(c).to_numpy() for c in ("hash", "more"))
        if not len(hashes):
            continue
        new = np.append(last != (hashes[0], more[0]), (hashes[1:] != hashes[:-1]) | (more[1:] != more[:-1]))
        last = hashes[-1], more[-1]
        yield _batch(_WON, *(batch.column(c).to_numpy()[new] for c in ("block", "number")))


def _keys(key: tuple, group: pa.Table) -> pa.Table:
    """One block's anchor hashes, sorted."""
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "anchors": pa.array([np.sort(group.column("hash").to_numpy().view(np.uint64)).tobytes()], pa.binary())})


def _bits(key: tuple, group: pa.Table) -> pa.Table:
    """One block's numbers, as bits."""
    numbers = group.column("number").to_numpy()
    bits = np.zeros(int(numbers.max()) + 1, bool)
    bits[numbers] = True
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "windows": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _listed(raw: pa.Scalar) -> np.ndarray:
    return np.frombuffer(raw.as_py() or b"", np.uint64)


def _cut(schema: pa.Schema):
    """Writes each block's rows again, with the words that stay and the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, anchors, windows in zip(batch.column("rows"), batch.column("anchors"), batch.column("windows")):
                held = _Block(raw.as_py())
                begin = held.candidates(_listed(anchors))
                stays = np.zeros(len(held.words.hashes), bool)
                if len(begin):
                    # the block's first place of a sequence stays if it is the first anywhere, all others go
                    first = held.firsts(begin)[2]
                    won = np.unpackbits(np.frombuffer(windows.as_py() or b"", np.uint8)).astype(bool)[: len(first)]
                    stays[first[: len(won)][won]] = True
                gone = begin[~stays[begin]]
                marks = np.zeros(len(held.words.hashes) + 1, np.int64)
                np.add.at(marks, gone, 1)
                np.add.at(marks, gone + WINDOW, -1)
                removed = np.cumsum(marks)[:-1] > 0
                yield from _rows(held, removed, schema)

    return run


def _rows(held: _Block, removed: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if held.rows is None:
        return
    at = held.words.first
    totals = np.append(0, np.cumsum(removed))
    n_removed = totals[at[1:]] - totals[at[:-1]]
    row = 0
    for part in slices(held.rows, "__text"):
        data, offsets = text_buffers(part.column("__text"))
        starts, ends = word_spans(data, offsets)
        first = np.searchsorted(starts, offsets)
        raw = data.tobytes()
        kept = []
        for i in range(part.num_rows):
            gone = removed[at[row + i] : at[row + i + 1]]
            a, b = first[i], first[i + 1]
            s, e = (starts[a:b], ends[a:b]) if not n_removed[row + i] else (starts[a:b][~gone], ends[a:b][~gone])
            kept.append(b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist())]))
        n = slice(row, row + part.num_rows)
        columns = [part.column(name if name in part.schema.names else "__text") for name in schema.names[:-3]]
        columns += [pa.array(held.words.counts[n], pa.int64()), pa.array(n_removed[n], pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
        row += part.num_rows


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with three columns more: n_words, n_removed, kept_text (its kept words joined by one space).

    A window is 20 consecutive words of one text. A word goes if a window covers it whose word sequence
    also starts earlier: in a smaller id, or in the same text before. Windows are judged on the input.

    1. Texts are grouped into blocks of about 8 MB, written once, compressed.
    2. Each block sends the distinct hashes of its 8-word anchors, which stand at four of thirteen word
       positions only; any two places of a window share an anchor. Sorted by hash they pass as a stream, and those that
       repeat go back to their blocks.
    3. Each block extends repeated anchors to the windows around them, and sends each window's sequence once, with the smallest
       id that has it. Sorted by sequence and id they pass as a stream; the number of the first of all goes back to its block.
    4. Each block drops the words of all windows but the first places.

    A row is sent for each anchor and candidate window of a block, so rows grow with the data, whatever the number of
    partitions, and no task holds more than a batch of a stream or one block. A block sends a sequence once however often it holds
    it, so common passages grow with the number of blocks, not of copies. Windows are equal when two 64-bit hashes of their words are.
    Null and empty texts have no words. Rows with one id count as one after another in no stated order;
    rows with a null id come after all others. The added names must be new to docs.
    """
    spark = docs.sparkSession
    names = docs.columns
    for name in ("n_words", "n_removed", "kept_text"):
        if name in names:
            raise ValueError(f"docs already has a column {name}")
    rest = [k for k, c in enumerate(names) if c != text_col]
    inner = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"), *(F.col(f"`{names[k]}`").alias(f"c{k}") for k in rest))
    out = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    arrow = to_arrow_schema(out)
    blocks = written(inner.mapInArrow(_blocks(block_bytes), _BLOCK), "blocks")

    sent = blocks.mapInArrow(_send_anchors, _ANCHOR).repartition("hash").sortWithinPartitions("hash", "block")
    anchors = sent.mapInArrow(_repeated, _ANCHOR).groupBy("block").applyInArrow(_keys, "block long, anchors binary")
    known = blocks.join(written(anchors, "anchors"), "block", "left")
    sent = known.mapInArrow(_send_windows, _WINDOW).repartition("hash").sortWithinPartitions("hash", "more", "id", "block")
    windows = sent.mapInArrow(_earliest, _WON).groupBy("block").applyInArrow(_bits, "block long, windows binary")
    known = known.join(written(windows, "windows"), "block", "left")
    done = known.select("rows", "anchors", "windows").mapInArrow(_cut(arrow), out)
    return done.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names)), "n_words", "n_removed", "kept_text")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
), v as (
  select doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) as h from w, unnest(range(1, len(ws) - 18)) t(i)
), r as (
  select doc_id, i, row_number() over (partition by h order by doc_id, i) as n from v
), gone as (
  select doc_id, list_distinct(flatten(list(range(i, i + 20)))) as g from r where n > 1 group by doc_id
), k as (
  select doc_id, ws, case when g is null then ws else list_filter(ws, lambda x, j: not list_contains(g, j)) end as kept from w left join gone using (doc_id)
)
select doc_id, len(ws)::bigint as n_words, (len(ws) - len(kept))::bigint as n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from k
"""
