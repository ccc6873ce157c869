"""Exact top-k inner-product search by the three-phase uniform threshold algorithm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import shuffle_partitions, table, written

#: The lists that each hold a part of every score: runs of components.
LISTS = 2
#: Rows of a block of candidates and of a block of queries.
CANDIDATE_ROWS, QUERY_ROWS = 2048, 4096
#: Numbers that a block of queries has for its rows, QUERY_ROWS at least.
NUMBERS = 4096
#: Bytes of the candidates' blocks that a task holds while the queries pass, about.
LANE_BYTES = 64 << 20
#: Queries whose scores with a block are held at once.
STEP = 256
SCALE = 256
#: Rows of a run, of which each list's best entries are looked at first.
RUN = 128
#: Less than any part of a score, and any sum of such.
_NONE = -(1 << 61)

_BLOCK = "block long, ids array<bigint>, dims int, data binary"


def _valid(column: str):
    return F.col(column).isNotNull() & ~F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))


def _pack(block: int, dims: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    """A block: ids in order and vectors of one length, as little-endian 64-bit integers."""
    ids = rows.column("id").to_numpy().astype("<i8")
    order = np.argsort(ids, kind="stable")
    data = np.asarray(rows.column("vector").flatten(), "<i8").reshape(len(ids), dims)[order]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([ids[order]], pa.list_(pa.int64())), pa.array([dims], pa.int32()), pa.array([data.tobytes()], pa.binary())], ["block", "ids", "dims", "data"])


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """rows (id, vector) of each vector length in blocks of `size` at most, made where the rows are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = pc.list_value_length(batch.column("vector")).to_numpy()
            for dims in np.unique(lengths):
                own = np.flatnonzero(lengths == dims)
                for at in range(0, len(own), size):
                    yield _pack(block, int(dims), batch.take(pa.array(own[at : at + size])))
                    block += 1

    return rows.mapInArrow(run, _BLOCK)


def _matrix(ids: list[int], data: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array(ids, np.int64), np.frombuffer(data, "<i8").reshape(len(ids), dims)


def _parts(queries: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Each list's part of every score, exactly: in doubles where no sum can pass 2**53, else in 64-bit integers."""
    out = []
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    kind = np.float64 if bound < 2**53 else np.int64
    for a, b in zip(np.array_split(queries, LISTS, axis=1), np.array_split(rows, LISTS, axis=1)):
        out.append((a.astype(kind) @ b.astype(kind).T).astype(np.int64))
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores; of equal ones those with the smallest ids (ids ascend)."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        return np.append(above, np.flatnonzero(scores == least)[: k - len(above)])
    return np.arange(len(scores))


def _result(rows: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate([r[i] for r in rows] or [np.zeros(0, np.int64)]) for i in range(len(names))]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _steps(row: dict, asked: dict, wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Numbers and ids of some query rows (those at wanted positions, if these are given), the candidates' ids and each list's part of their scores."""
    q_ids, queries = _matrix(asked["ids"], asked["data"], asked["dims"])
    at = np.arange(len(q_ids)) if wanted is None else wanted
    ids, rows = _matrix(row["ids"], row["data"], row["dims"])
    for k in range(0, len(at), STEP):
        some = at[k : k + STEP]
        yield asked["block"] * NUMBERS + some, q_ids[some], ids, _parts(queries[some], rows)


def _seen(q_rows: np.ndarray, q_ids: np.ndarray, ids: np.ndarray, parts: list[np.ndarray], k: int, block: int) -> tuple[np.ndarray, ...]:
    """The best of what the lists have first, with full scores, and a bound that no other score of the block passes.

    The block is looked at in runs of RUN rows. An entry that no list has among its k best of a run is at most the k-th best of the run
    in each list, so its score is at most their sum. Of the entries that a list has there, the block's k best are enough.
    """
    own, n = q_ids[:, None] == ids, len(ids)
    run = max(RUN, 2 * k)
    runs, bound, picks = -(-n // run), 0, []
    for p in parts:
        p[own] = _NONE
        cut = np.pad(p, ((0, 0), (0, runs * run - n)), constant_values=_NONE).reshape(len(q_ids), runs, run)
        pick = np.argpartition(cut, run - k, axis=2)[:, :, run - k :]
        bound = bound + np.take_along_axis(cut, pick, axis=2).min(axis=2)
        picks.append((pick + np.arange(runs)[:, None] * run).reshape(len(q_ids), -1))
    pick = np.sort(np.concatenate(picks, axis=1), axis=1)
    good = (pick < n) & ~np.take_along_axis(own, np.minimum(pick, n - 1), axis=1)
    good[:, 1:] &= pick[:, 1:] != pick[:, :-1]
    at, column = np.nonzero(good)
    pick = pick[at, column]
    score = sum(p[at, pick] for p in parts)
    order = np.lexsort((pick, -score, at))  # ids ascend with the position
    first = np.searchsorted(at, np.arange(len(q_ids)))  # at ascends
    order = order[np.arange(len(at)) - first[at] < k]
    at = at[order]
    return q_rows[at], q_ids[at], ids[pick[order]], score[order], np.full(len(at), block), bound.max(axis=1)[at]


def _reached(row: int, q: int, ids: np.ndarray, parts: list[np.ndarray], least: int, k: int) -> tuple[np.ndarray, ...]:
    near = np.flatnonzero((ids != q) & np.any([p >= -(-least // LISTS) for p in parts], axis=0))
    total = sum(p[near] for p in parts)
    near, total = near[total >= least], total[total >= least]
    top = _best(total, ids[near], k)
    return np.full(len(top), row), np.full(len(top), q), ids[near][top], total[top]


_SEEN = ["q_row", "query_id", "vec_id", "score", "block", "bound"]
_FOUND = _SEEN[:4]


def _gather(k: int):
    """Phase 1: from each list the k best candidates of the block by that list's part, with full scores and the bound of the others."""

    def work(row: dict, asked: dict) -> Iterator[pa.RecordBatch]:
        for q_rows, q_ids, ids, parts in _steps(row, asked):
            yield _result([_seen(q_rows, q_ids, ids, parts, k, row["block"])], _SEEN)

    return work


def _collect(k: int):
    """Phases 2 and 3: the candidates of which a list's part reaches the uniform threshold, resolved to full scores.

    A score of at least the cutoff has a part of at least the cutoff over the number of lists, so
    none is missed. Of the resolved scores that reach the cutoff the block's k best are enough.
    """

    def work(row: dict, asked: dict) -> Iterator[pa.RecordBatch]:
        cut = {c["q_row"]: c["cutoff"] for c in asked["cutoffs"] if c["block"] == row["block"]}
        wanted = np.sort(np.fromiter(cut, np.int64, len(cut))) - asked["block"] * NUMBERS
        for q_rows, q_ids, ids, parts in _steps(row, asked, wanted):
            yield _result([_reached(n, q, ids, [p[i] for p in parts], cut[n], k) for i, (n, q) in enumerate(zip(q_rows.tolist(), q_ids.tolist()))], _FOUND)

    return work


def _passing(work):
    """Rows sorted by lane, the candidates' blocks first, as a stream: a lane's blocks are held, and each block of queries that passes meets them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["lane"] != lane:
                    lane, held = row["lane"], []
                if not row["query"]:
                    held.append(row)
                    continue
                for own in held:
                    if own["dims"] == row["dims"]:
                        yield from work(own, row)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k largest integer inner products with other ids.

    Components become floor(256 * x), x as double; scores are 64-bit integers. Equal scores go by the smaller id.
    Vectors that are null, or hold a null or a value that isn't finite, take no part, nor do null ids; a query
    meets candidates of its own length only, an empty one those that are empty, with a score of 0. Rows that repeat an id stay rows of
    their own: none of them answers a query with that id, and each query row has k results of its own, so a query row that occurs
    twice has them twice. Fewer than k candidates are all returned.

    Candidates are packed into blocks where they are, and dealt to lanes of about 64 MB, each sent once. Blocks of queries are
    sent to every lane and pass a task, which holds its lane, as a stream; no pair of rows is stored. Phase 1
    gathers each list's k best entries per run of a block, takes the k-th best full score of all as a safe cutoff, and
    keeps what no other score of the block can pass: the sum of a run's k-th best parts. Phase 2 sends the cutoffs to those
    blocks only whose bound reaches them, which collect the entries that reach the uniform threshold in any list.
    Phase 3 resolves these exactly. The more candidates there are, the higher the cutoffs and the fewer the blocks
    that phase 2 opens. A block returns k rows per query at most, so that ties don't add up.
    """
    ints = F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))

    def rows(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_col).isNotNull() & _valid(vector_col)).select(F.col(id_col).cast("long").alias("id"), ints.alias("vector"))

    partitions = shuffle_partitions(vectors.sparkSession)
    held = written(_blocks(rows(vectors), CANDIDATE_ROWS), "candidates")
    size = held.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("data").cast("long")), F.lit(0)).alias("bytes")).first()
    spread = max(1, min(partitions, size["n"]), -(-size["bytes"] // LANE_BYTES))
    lane = F.pmod(F.xxhash64("block"), F.lit(spread)).cast("int")
    held = held.withColumn("lane", lane)
    asked = written(_blocks(rows(queries), QUERY_ROWS), "queries")
    cutoff_type = "array<struct<q_row:bigint,block:bigint,cutoff:bigint>>"

    def meet(candidates: DataFrame, passing: DataFrame, work, names: list[str]) -> DataFrame:
        """The candidates' blocks of each lane with the blocks of queries that pass it (lane, and cutoffs where there are)."""
        none = F.lit(None).cast(cutoff_type)
        sides = [candidates.withColumn("cutoffs", none), passing if "cutoffs" in passing.columns else passing.withColumn("cutoffs", none)]
        both = [df.select("lane", F.lit(q).alias("query"), "block", "ids", "dims", "data", "cutoffs") for q, df in zip((False, True), sides)]
        sorted_ = both[0].unionByName(both[1]).repartition(partitions, "lane").sortWithinPartitions("lane", "query")
        return sorted_.mapInArrow(_passing(work), ", ".join(f"{c} long" for c in names))

    every = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    seen = written(meet(held, every, _gather(k), _SEEN), "seen")
    best = Window.partitionBy("q_row").orderBy(F.col("score").desc(), "vec_id")
    top = seen.select("q_row", "vec_id", "score").withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}")
    cutoffs = top.groupBy("q_row").agg(F.min("score").alias("cutoff"), F.count("*").alias("n")).where(f"n = {k}").drop("n")
    bounds = seen.groupBy("q_row", "block").agg(F.max("bound").alias("bound"))
    opened = written(bounds.join(cutoffs, "q_row").where("bound >= cutoff").select("q_row", "block", "cutoff"), "opened")
    wanted = opened.groupBy(F.expr(f"q_row div {NUMBERS}").alias("q_block"), lane.alias("lane")).agg(F.collect_list(F.struct("q_row", "block", "cutoff")).alias("cutoffs"))
    passing = asked.join(wanted, F.col("block") == F.col("q_block"))
    found = meet(held.join(opened.select("block").distinct(), "block", "left_semi"), passing, _collect(k), _FOUND)
    closed = seen.join(opened, ["q_row", "block"], "left_anti").select(_FOUND)
    return found.unionByName(closed).withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e from embeddings
  where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))
