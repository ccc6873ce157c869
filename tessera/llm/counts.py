"""Token counts that follow edits: segment trees over the pre-tokens of each document."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .spans import SpanStore
from .tables import table
from .words import list_column, slices, span_hashes, text_buffers

#: Words of a leaf.
LEAF_WORDS = 32
#: Signs beside an edit on which the border of a leaf can depend.
CONTEXT = 2

_counters: dict[str, "Counter"] = {}


class Counter:
    """Numbers of tokens by a byte-level BPE vocabulary of ranks.

    A text may be cut before a single space that stands between two ASCII signs which are no white space:
    a pre-token always starts there, so the counts of the parts add up to the count of the text.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.store = SpanStore(lambda texts: [[len(self.encoding.encode_ordinary(t))] for t in texts])
        self.solid = np.zeros(256, bool)
        self.solid[[b for b in range(33, 127)]] = True

    def count(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def leaves(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the leaves of all texts: code points and tokens, and where each text's leaves begin."""
        data, at = text_buffers(column)
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            cut[1 : len(data) - 1] = (data[1:-1] == 32) & self.solid[data[:-2]] & self.solid[data[2:]]
        cut[at] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        tokens, _ = self.store.values(self.store.codes(span_hashes(data, starts, ends), data, starts, ends))
        first = np.searchsorted(starts, at)
        text = np.repeat(np.arange(len(at) - 1), np.diff(first))
        opens = (np.arange(len(starts)) - first[text]) % LEAF_WORDS == 0
        leaf = np.flatnonzero(opens)
        points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        sizes = points[ends] - points[starts]
        if not len(leaf):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        return np.add.reduceat(sizes, leaf), np.add.reduceat(tokens, leaf), np.searchsorted(leaf, first)


def counter(path: str) -> Counter:
    import public_tokenizers

    if path not in _counters:
        _counters[path] = Counter(path, public_tokenizers.PATTERN)
    return _counters[path]


class Tree:
    """Sums over a row of leaves: node k has the nodes 2k and 2k + 1 below it, node 1 is the total."""

    def __init__(self, points: np.ndarray, tokens: np.ndarray):
        self.width = 1 << max(0, int(len(points) - 1).bit_length())
        self.nodes = np.zeros((2, 2 * self.width), np.int64)
        self.nodes[0, self.width : self.width + len(points)] = points
        self.nodes[1, self.width : self.width + len(tokens)] = tokens
        k = self.width
        while k > 1:
            self.nodes[:, k // 2 : k] = self.nodes[:, k : 2 * k].reshape(2, -1, 2).sum(axis=2)
            k //= 2
        self.leaves = len(points)

    def find(self, point: int) -> tuple[int, int]:
        """The leaf that holds a code point (the last one if it is beyond the end), and the leaf's first point."""
        k, before = 1, 0
        while k < self.width:
            k *= 2
            if point >= before + self.nodes[0, k] and before + self.nodes[0, k] < self.nodes[0, 1]:
                before += int(self.nodes[0, k])
                k += 1
        return k - self.width, before

    def put(self, leaf: int, points: int, tokens: int) -> None:
        """Sets a leaf and updates the sums above it."""
        k = leaf + self.width
        change = np.array([points, tokens]) - self.nodes[:, k]
        while k:
            self.nodes[:, k] += change
            k //= 2

    @property
    def total(self) -> int:
        return int(self.nodes[1, 1])


def edited(count: Counter, tree: Tree, text: str, start: int, removed: int, inserted: str) -> tuple[str, int]:
    """The text after an edit, with the tree brought up to date; the second value tells how many code points were encoded again.

    Only the leaves that the edit or its context touches are encoded again, together; their
    sum goes to the first of them, the others become empty.
    """
    start = min(max(start, 0), len(text))
    removed = min(max(removed, 0), len(text) - start)
    new = text[:start] + inserted + text[start + removed :]
    first, low = tree.find(max(0, start - CONTEXT))
    last, high = tree.find(start + removed + CONTEXT)
    high += int(tree.nodes[0, last + tree.width])
    part = new[low : high + len(inserted) - removed]
    tree.put(first, len(part), count.count(part))
    k = first + 1
    while k <= last:
        if tree.nodes[0, k + tree.width]:
            tree.put(k, 0, 0)
        k += 1
    return new, len(part)


def _extended(df: DataFrame, more: list[T.StructField]) -> tuple[T.StructType, pa.Schema]:
    if clash := {f.name for f in more} & set(df.columns):
        raise ValueError(f"the table already has the columns {sorted(clash)}")
    schema = T.StructType(df.schema.fields + more)
    return schema, to_arrow_schema(schema)


def count_tokens(df: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """df with n_tokens, leaf_points and leaf_tokens (arrays): the leaves of each text's segment tree; no shuffle.

    Null and empty texts have no leaves and 0 tokens. A text of any length is counted whole, in leaves. Rows may repeat; an empty table
    gives an empty one. Other columns stay; one that already has an added name is an error.
    """
    whole = T.ArrayType(T.LongType())
    schema, arrow = _extended(df, [T.StructField("n_tokens", T.LongType()), T.StructField("leaf_points", whole), T.StructField("leaf_tokens", whole)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks_path)
        for batch in batches:
            for part in slices(batch, text_col):
                points, tokens, at = count.leaves(part.column(text_col))
                sums = np.append(0, np.cumsum(tokens))[at]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(sums)), list_column(points, np.diff(at), pa.int64()), list_column(tokens, np.diff(at), pa.int64())], schema=arrow)

    return df.mapInArrow(run, schema)


def recount_edits(df: DataFrame, ranks_path: str, text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """Counted texts with `edits` (array of start, removed, inserted, in code points, one after another): the same rows with
    the edited text, its n_tokens and tree, and n_encoded_again, the code points that were encoded for it.

    An edit beyond the end is moved to it; null edits leave the text as it is, and a null text is an empty one from then on. No
    shuffle. Rows may repeat; an empty table gives an empty one. Other columns stay; one called n_encoded_again is an error.
    """
    names = df.columns
    schema, arrow = _extended(df.drop(edits_col), [T.StructField("n_encoded_again", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks_path)
        for batch in batches:
            for part in slices(batch, text_col):
                rows = {c: part.column(c) for c in names}
                out: dict[str, list] = {text_col: [], "n_tokens": [], "leaf_points": [], "leaf_tokens": [], "n_encoded_again": []}
                for text, edits, points, tokens in zip(*(rows[c].to_pylist() for c in (text_col, edits_col, "leaf_points", "leaf_tokens"))):
                    text, again = text or "", 0
                    tree = Tree(np.array(points, np.int64), np.array(tokens, np.int64))
                    for edit in edits or ():
                        text, n = edited(count, tree, text, edit["start"] or 0, edit["removed"] or 0, edit["inserted"] or "")
                        again += n
                    used = slice(tree.width, tree.width + max(tree.leaves, 1 if text else 0))
                    for c, x in (("n_tokens", tree.total), ("leaf_points", tree.nodes[0, used]), ("leaf_tokens", tree.nodes[1, used]), (text_col, text), ("n_encoded_again", again)):
                        out[c].append(x)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if f.name in out else rows[f.name] for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def default_ranks() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document counted, then edited in three places and counted again by its tree."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, default_ranks()).withColumn("n_tokens_before", F.col("n_tokens"))
    n = F.length(F.coalesce("text", F.lit("")))
    size = F.least(F.floor(n / 50).cast("int") + 1, F.lit(200))
    places = [(F.floor(n * k / 4).cast("int"), k) for k in (1, 2, 3)]
    edits = F.array(*(F.struct(at.alias("start"), (size if k != 2 else F.lit(0)).alias("removed"), (F.substring("text", F.lit(1), size) if k != 3 else F.lit("")).alias("inserted")) for at, k in places))
    done = recount_edits(counted.withColumn("edits", edits), default_ranks())
    return done.select("doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), F.size("leaf_tokens").alias("n_leaves"), "n_encoded_again", F.sha2(F.col("text").cast("binary"), 256).alias("edited_sha256"))
