"""Near-duplicate grouping: SuperMinHash signatures, banding, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import shuffle_partitions, table, written
from .words import Words, distinct_by_text, list_column, mix, slices

SHINGLE = 5
LANES = 128
ROWS_PER_BAND = 4
THRESHOLD = (3, 4)
#: Elements whose permutations are held at once.
_ELEMENTS = 1 << 16
#: Pairs with a smaller share of equal lanes are left out; a similarity of 0.75 gives 0.55 or less once in ten million pairs.
LEAST_EQUAL = 0.55
#: Members of a bucket that are compared in one task; more are cut into chunks, of which each two meet.
CHUNK = 1024
#: Members of a hub that are verified together.
SHARE = 2048
#: Sets below this size need many rounds; they take them together.
_FEW = 64


def _steps(text: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs in runs of whole texts with about _ELEMENTS elements, or one longer text."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + _ELEMENTS)
        if stop < len(text):
            stop = max(int(np.searchsorted(text, text[stop], "left")), int(np.searchsorted(text, text[at], "right")))
        yield text[at:stop], hashes[at:stop]
        at = stop


def superminhash(text: np.ndarray, hashes: np.ndarray, n_texts: int, lanes: int = LANES) -> np.ndarray:
    """n_texts x lanes signatures of the sets given as (text index, element hash) pairs, sorted by text.

    Each element visits all lanes in an order of its own (a Fisher-Yates permutation), with rank j
    plus a uniform fraction at the j-th lane it visits; a lane keeps the smallest. Round j handles the
    j-th visit of all elements together. A text is done when its largest lane is below j + 1, as later
    visits can't lower a lane, so large sets stop after a round or two. Texts without elements keep
    the largest value in all lanes.
    """
    out = np.full(n_texts * lanes, np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64(0xFFFFFFFF)
    small = np.bincount(text, minlength=n_texts)[text] < _FEW
    for base, x in (*_steps(text[~small], hashes[~small]), *_steps(text[small], hashes[small])):
        base = base * lanes
        order = None
        for j in range(lanes):
            r = mix(x + np.uint64((j * 0xA24BAED4963EE407 + 0x9FB21C651E98DF25) & (2**64 - 1)))
            visit = j + (((r & low) * np.uint64(lanes - j)) >> np.uint64(32)).astype(np.int64)
            if order is None:
                lane = visit
            else:
                row = np.arange(len(x))
                lane = order[row, visit].astype(np.int64)
                order[row, visit] = order[:, j]
                order[:, j] = lane
            np.minimum.at(out, base + lane, (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32)))
            first = np.flatnonzero(np.append(True, base[1:] != base[:-1]))
            worst = out.reshape(n_texts, lanes)[base[first] // lanes].max(axis=1)
            unfinished = np.repeat(worst >= np.uint64((j + 1) << 32), np.diff(np.append(first, len(base))))
            if not unfinished.any():
                break
            if order is None:
                base, x, lane = base[unfinished], x[unfinished], lane[unfinished]
                order = np.tile(np.arange(lanes, dtype=np.int16), (len(x), 1))
                row = np.arange(len(x))
                order[row, lane], order[:, 0] = 0, lane
            elif not unfinished.all():
                base, x, order = base[unfinished], x[unfinished], order[unfinished]
    return out.reshape(n_texts, lanes)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"), lower=True)
            n = part.num_rows
            text, hashes = distinct_by_text(*words.shingles(SHINGLE))
            sizes = np.bincount(text, minlength=n)
            lanes = superminhash(text, hashes, n).reshape(n, LANES // ROWS_PER_BAND, ROWS_PER_BAND)
            bands = np.zeros(lanes.shape[:2], np.uint64) + np.arange(lanes.shape[1], dtype=np.uint64)
            for k in range(ROWS_PER_BAND):
                bands = mix(bands * np.uint64(31) + lanes[:, :, k])
            some = sizes > 0
            keys = np.array([words.sequence(i) for i in range(n)], np.uint64).reshape(n, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys[:, 0].view(np.int64) if n else [], pa.int64(), mask=~some),
                    pa.array(np.ascontiguousarray(keys[:, 1]).view(np.int64) if n else [], pa.int64(), mask=~some),
                    list_column(bands[some].ravel().view(np.int64), np.where(some, bands.shape[1], 0), pa.int64()),
                    pa.array([a.tobytes() + b.tobytes() for a, b in zip((lanes.reshape(n, LANES) & np.uint64(0xFF)).astype(np.uint8), bands.astype(np.uint32))], pa.binary()),
                ],
                ["id", "n_shingles", "h1", "h2", "bands", "lanes"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids with their full shingle sets: the sorted 64-bit hashes, as compressed differences."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for part in slices(batch, "text"):
            text, hashes = distinct_by_text(*Words(part.column("text"), lower=True).shingles(SHINGLE))
            steps = np.diff(hashes, prepend=np.uint64(0))
            at = np.searchsorted(text, np.arange(part.num_rows + 1))
            steps[at[:-1][np.diff(at) > 0]] = hashes[at[:-1][np.diff(at) > 0]]
            planes = steps.view(np.uint8).reshape(-1, 8)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([squeeze(np.ascontiguousarray(planes[a:b].T).tobytes()) for a, b in zip(at, at[1:])], pa.binary())], ["id", "elements"])


def _elements(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64), dtype=np.uint64)


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    num, den = THRESHOLD
    if len(a) * den < len(b) * num or len(b) * den < len(a) * num:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hub and share, the hub's own row first: links of the hub with the rows that are alike enough."""
    hub, mine = None, np.zeros(0, np.uint64)
    for batch in batches:
        a, b = [], []
        for key, share, own, other, raw in zip(*(batch.column(c).to_pylist() for c in ("hub", "share", "own", "id", "elements"))):
            if own:
                hub, mine = (key, share), _elements(raw)
            elif (key, share) == hub and _alike(mine, _elements(raw)):
                a.append(key)
                b.append(other)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (hub, id) pairs whose sets meet the threshold, as links (a, b).

    Each id's set travels once per hub. A hub's ids are dealt to shares of about SHARE, each with the hub's own set, and a task
    reads a share in a stream; so a hub with very many ids is neither one task's work nor needs memory for them.
    """
    shares = pairs.groupBy("hub").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    dealt = pairs.join(shares, "hub").select("hub", "id", F.pmod(F.xxhash64("id", F.lit(11)), F.col("shares")).cast("int").alias("share"), F.lit(False).alias("own"))
    hubs = shares.select("hub", F.col("hub").alias("id"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(True).alias("own"))
    return (
        dealt.unionByName(hubs)
        .join(sets, "id")
        .repartition(shuffle_partitions(pairs.sparkSession), "hub", "share")
        .sortWithinPartitions("hub", "share", F.col("own").desc(), "id")
        .mapInArrow(_verify, "a long, b long")
    )


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal values in `columns`, of rows that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        change = np.any([k[1:] != k[:-1] for k in keys], axis=0) if batch.num_rows else np.zeros(0, bool)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            key = tuple(k[a] for k in keys)
            if key != last and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _likely_pairs(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a cell's members that may be linked across components, the likeliest pairs first.

    A pair is looked at in the first band only that both have in common.
    """
    ids, own, side = (group.column(c).to_numpy() for c in ("id", "component", "side"))
    raw = np.frombuffer(b"".join(group.column("lanes").to_pylist()), np.uint8).reshape(len(ids), -1)
    lanes, bands = raw[:, :LANES], np.ascontiguousarray(raw[:, LANES:]).view(np.uint32)[:, : group.column("band")[0].as_py()]
    across = side.min() != side.max()
    found = []
    for at in range(0, len(ids), 64):
        rows = slice(at, at + 64)
        fit = (own[rows, None] != own[None]) & (ids[rows, None] < ids[None])
        if across:
            fit &= side[rows, None] != side[None]
        x, y = np.nonzero(fit)
        for k in range(0, len(x), 1 << 16):
            i, j = x[k : k + (1 << 16)] + at, y[k : k + (1 << 16)]
            equal = (lanes[i] == lanes[j]).sum(axis=1, dtype=np.int16)
            i, j, equal = (v[equal >= LEAST_EQUAL * LANES] for v in (i, j, equal))
            first = ~(bands[i] == bands[j]).any(axis=1)
            found.append((i[first], j[first], equal[first]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j, equal = (np.concatenate(v) for v in zip(*found))
    order = np.argsort(-equal, kind="stable")
    return i[order], j[order]


def _open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each cell that are in a likely pair."""
    for group in _runs(batches, ["key", "cell"]):
        keep = np.zeros(group.num_rows, bool)
        for rows in _likely_pairs(group):
            keep[rows] = True
        if keep.any():
            yield from group.filter(pa.array(keep)).combine_chunks().to_batches()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the components of each cell, by the members' full sets; a pair whose components are joined already is left out."""
    for group in _runs(batches, ["key", "cell"]):
        ids, own = group.column("id").to_pylist(), group.column("component").to_pylist()
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        sets: dict[int, np.ndarray] = {}
        raw = group.column("elements")
        a, b = [], []
        for i, j in zip(*(rows.tolist() for rows in _likely_pairs(group))):
            p, q = find(own[i]), find(own[j])
            if p == q:
                continue
            for k in (i, j):
                if k not in sets:
                    sets[k] = _elements(raw[k].as_py())
            if _alike(sets[i], sets[j]):
                parent[max(p, q)] = min(p, q)
                a.append(ids[i])
                b.append(ids[j])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _links_across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """members (key, band, id, component, lanes) of buckets -> links (a, b) that join components of a bucket, all that are needed."""
    n = shuffle_partitions(members.sparkSession)
    sizes = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    open_ = members.join(sizes.select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "key")
    side = F.pmod(F.xxhash64("id", F.lit(7)), F.col("chunks")).cast("int")
    cells = open_.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = cells.withColumn("cell", F.least("side", "other").cast("long") * F.col("chunks") + F.greatest("side", "other"))
    cells = cells.select("key", "cell", "side", "band", "id", "component", "lanes")
    likely = cells.repartition(n, "key", "cell").sortWithinPartitions("key", "cell").mapInArrow(_open_members, cells.schema)
    return likely.join(sets, "id").repartition(n, "key", "cell").sortWithinPartitions("key", "cell").mapInArrow(_settle, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id and kept.

    Words are lower-cased (A-Z) runs without white space; a text's set is its distinct 5-word shingles,
    or its whole sequence if shorter. Texts with a Jaccard similarity of 0.75 or more are linked, as
    counted on the full sets; component_id is the smallest id reachable and kept marks it.

    1. One pass makes signatures, band keys and a 128-bit key of the word sequence per text.
    2. Texts with equal sequences form a class, which its smallest id stands for.
    3. The smallest class of a band's bucket is its hub. Each class is verified against the hub it shares most
       buckets with; components are found.
    4. Where a bucket still holds several components, the members that may be linked across them, by the share
       of equal lanes, are brought together with their sets, in cells of limited size, and verified there until
       their components are joined or no pair is left. An open bucket of n members is dealt to chunks of 1024, each two of
       which meet: it moves n * ceil(n / 1024) signatures, and full sets only of members in a likely pair. No pair that can
       link is dropped.

    Null and empty texts have n_shingles 0 and link to nothing. Rows with one id are one text in the
    grouping and share its component; a null id links to nothing. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketched = written(base.mapInArrow(_sketch, "id long, n_shingles long, h1 long, h2 long, bands array<long>, lanes binary"), "sketch")
    classes = written(sketched.where("h1 is not null and id is not null").groupBy("h1", "h2").agg(F.min("id").alias("hub")), "classes")
    hubs = classes.select(F.col("hub").alias("id")).distinct()

    bands = sketched.join(hubs, "id", "left_semi").select("id", F.posexplode("bands").alias("band", "key"))
    bands = bands.select("id", "band", F.xxhash64("band", "key").alias("key"))
    shared = bands.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = written(bands.join(shared, "key").select("key", "band", "id", "hub"), "buckets")

    wanted = members.select("id").distinct()
    lanes = sketched.where("h1 is not null").join(wanted, "id", "left_semi").groupBy("id").agg(F.max("lanes").alias("lanes"))
    lanes = written(lanes, "lanes")
    sets = written(base.where("id is not null").join(wanted, "id", "left_semi").mapInArrow(_sets, "id long, elements binary"), "sets")

    shares = members.where("id <> hub").groupBy("id", "hub").agg(F.count("*").alias("n"))
    pairs = shares.groupBy("id").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub")).select("hub", "id")
    found = written(components(_confirmed(pairs, sets)), "components")
    placed = members.select("key", "band", "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    across = _links_across(placed.join(lanes, "id"), sets)
    joins = found.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
    found = components(joins.unionByName(across))

    by_class = classes.join(found, F.col("hub") == F.col("id"), "left").select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.coalesce("component", "hub").alias("component"))
    rows = sketched.drop("bands", "lanes").join(by_class, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    component: Column = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.select("id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
), s as (
  select distinct doc_id, md5(array_to_string(ws[i:i + 4], ' ')) as h from w, unnest(range(1, greatest(len(ws) - 3, 2))) t(i) where len(ws) > 0
), n as (
  select doc_id, count(*) as n from s group by 1
), p as (
  select a.doc_id as a, b.doc_id as b, count(*) as n_shared from s a join s b using (h) where a.doc_id < b.doc_id group by 1, 2
), l as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * n_shared >= 75 * (x.n + y.n - n_shared)
), e as (
  select a, b from l union select b, a from l
), reach as (
  select doc_id as id, doc_id as r from documents
  union
  select reach.id, e.b from reach join e on e.a = reach.r
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(r) as component_id, d.doc_id = min(r) as kept
from documents d join reach on reach.id = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id, n.n
"""
