"""SimHash near-duplicates: fingerprints of word shingles, compared at the codewords of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import shuffle_partitions, table, written
from .words import slices, text_buffers, word_spans

SHINGLE = 3
SEED = 42
#: Fingerprints with so many differing bits or fewer are linked.
THRESHOLD = 2
#: The binary Golay code: 23 bits, 12 of them free, every word within 3 bits of exactly one codeword. Its generator is a fixed value.
LENGTH, FREE, RADIUS, GENERATOR = 23, 12, 3, 0xC75
#: Fingerprints at home at one anchor that are compared there; an anchor with more is split into the single words around its fingerprints.
CROWD = 4096
#: Shingles hashed, and pairs compared, at once.
_STEP = 1 << 17
_PAIRS = 1 << 20

#: XXH64's multipliers, fixed values.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

_COUNTERS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view("<u8").reshape(-1)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _stirred(lane: np.ndarray, value: np.ndarray) -> np.ndarray:
    return _turned(lane + value * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each span of bytes; spans may overlap."""
    data = np.append(data, np.zeros(8, np.uint8))
    wide = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    half = np.ndarray(len(data) - 7, "<u4", data, strides=(1,))
    at, size, seed = starts.copy(), (ends - starts), np.uint64(seed)
    out = np.full(len(at), seed + _P5)
    rows = np.flatnonzero(size >= 32)
    if len(rows):
        lanes = [np.full(len(rows), (int(seed) + x) % 2**64, np.uint64) for x in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]
        live = np.arange(len(rows))
        while len(live):
            here = at[rows[live]]
            for k in range(4):
                lanes[k][live] = _stirred(lanes[k][live], wide[here + 8 * k])
            at[rows[live]] += 32
            live = live[at[rows[live]] + 32 <= ends[rows[live]]]
        h = sum(_turned(v, bits) for v, bits in zip(lanes, (1, 7, 12, 18)))
        for v in lanes:
            h = (h ^ _stirred(np.uint64(0), v)) * _P1 + _P4
        out[rows] = h
    out += size.astype(np.uint64)
    while len(rows := np.flatnonzero(at + 8 <= ends)):
        out[rows] = _turned(out[rows] ^ _stirred(np.uint64(0), wide[at[rows]]), 27) * _P1 + _P4
        at[rows] += 8
    rows = np.flatnonzero(at + 4 <= ends)
    out[rows] = _turned(out[rows] ^ (half[at[rows]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[rows] += 4
    while len(rows := np.flatnonzero(at < ends)):
        out[rows] = _turned(out[rows] ^ (data[at[rows]].astype(np.uint64) * _P5), 11) * _P1
        at[rows] += 1
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    return out ^ (out >> np.uint64(32))


def fingerprints(column: pa.Array) -> np.ndarray:
    """64-bit SimHash of each text's 3-word shingles, repeats included; a text with fewer words is one shingle, one without gets zero."""
    data, at = text_buffers(column)
    starts, ends = word_spans(data, at)
    bounds = np.searchsorted(starts, at)
    counts, sizes = np.diff(bounds), ends - starts
    # the words in lower case, each followed by one space
    place = np.append(0, np.cumsum(sizes + 1))
    joined = np.full(int(place[-1]), 32, np.uint8)
    word = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    raw = data[starts[word] + step]
    joined[place[word] + step] = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    n = np.where(counts > SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(n)), n)
    first = bounds[text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    last = np.minimum(first + SHINGLE, bounds[text + 1])
    ones = np.zeros((len(n), 64), np.int64)
    for a in range(0, len(text), _STEP):
        own = text[a : a + _STEP]
        h = xxh64(joined, place[first[a : a + _STEP]], place[last[a : a + _STEP]] - 1)
        # a byte's bits as eight counters of eight bits, which hold the sum of 255 shingles
        begin = np.flatnonzero((np.arange(len(own)) - np.searchsorted(own, own)) % 255 == 0)
        counters = np.add.reduceat(_COUNTERS[h.astype("<u8").view(np.uint8).reshape(-1, 8)], begin, axis=0)
        np.add.at(ones, own[begin], counters.view(np.uint8).reshape(-1, 64))
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fingerprints(part.column("text")).view(np.int64), pa.int64())], ["id", "fp"])


class _Code:
    """The Golay code's error patterns: of each syndrome those of weight 3 or less (one), of weight 4 and of weight 5."""

    def __init__(self):
        patterns = [np.array([sum(1 << b for b in c) for c in combinations(range(LENGTH), k)], np.int64) for k in range(RADIUS + THRESHOLD + 1)]
        self.lists = []
        for own in (np.concatenate(patterns[: RADIUS + 1]), *patterns[RADIUS + 1 :]):
            rest = self.syndrome(own)
            order = np.argsort(rest, kind="stable")
            self.lists.append((own[order], np.searchsorted(rest[order], np.arange((1 << (LENGTH - FREE)) + 1))))

    @staticmethod
    def syndrome(x: np.ndarray) -> np.ndarray:
        """The remainder of x by the generator."""
        for bit in range(LENGTH - 1, LENGTH - FREE - 1, -1):
            x = np.where((x >> bit) & 1, x ^ (GENERATOR << (bit - LENGTH + FREE)), x)
        return x

    def anchors(self, fp: np.ndarray, farthest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, distance beyond the radius) of all anchors within the radius plus `farthest` of each fingerprint.

        An anchor is a pair of codewords, for the bits 0-22 and 23-45, as the 24 bits that tell it; the last 18 bits are free.
        """
        halves = [(fp >> np.int64(LENGTH * k)) & ((1 << LENGTH) - 1) for k in (0, 1)]
        rests = [self.syndrome(x) for x in halves]
        found = []
        for near, far in ((a, b) for a in range(farthest + 1) for b in range(farthest + 1 - a)):
            (p, p_at), (q, q_at) = self.lists[near], self.lists[far]
            many_p, many_q = np.diff(p_at)[rests[0]], np.diff(q_at)[rests[1]]
            n = many_p * many_q
            row = np.repeat(np.arange(len(fp)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            left = halves[0][row] ^ p[p_at[rests[0][row]] + k // many_q[row]]
            right = halves[1][row] ^ q[q_at[rests[1][row]] + k % many_q[row]]
            found.append((row, (left >> (LENGTH - FREE)) | ((right >> (LENGTH - FREE)) << FREE), np.full(len(row), near + far)))
        return tuple(np.concatenate(x) for x in zip(*found))


_code: list[_Code] = []


def _the_code() -> _Code:
    if not _code:
        _code.append(_Code())
    return _code[0]


def _steps(batches: Iterator[pa.RecordBatch], size: int = 1 << 14) -> Iterator[np.ndarray]:
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        for a in range(0, len(fp), size):
            yield fp[a : a + size]


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for fp in _steps(batches):
        row, anchor, _ = _the_code().anchors(fp, 0)
        yield pa.RecordBatch.from_arrays([pa.array(fp[row]), pa.array(anchor)], ["fp", "anchor"])


def _marks(key: tuple, group: pa.Table) -> pa.Table:
    """A part of the map of anchors, as bits: those with fingerprints at home, and those of them that are crowded."""
    bits = np.zeros((2, 1 << 12), bool)
    at = group.column("anchor").to_numpy() & 0xFFF
    bits[0, at] = True
    bits[1, at[group.column("n").to_numpy() > group.column("most").to_numpy()]] = True
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "home": pa.array([np.packbits(bits[0]).tobytes()]), "crowded": pa.array([np.packbits(bits[1]).tobytes()])})


def _visits(home: bytes, crowded: bytes):
    """A row for each anchor within the radius plus the threshold of a fingerprint where others are at home, unless it is crowded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(home, np.uint8) & ~np.frombuffer(crowded, np.uint8)).astype(bool)
        for fp in _steps(batches):
            row, anchor, beyond = _the_code().anchors(fp, THRESHOLD)
            keep = wanted[anchor]
            yield pa.RecordBatch.from_arrays([pa.array(anchor[keep], pa.int64()), pa.array(beyond[keep] > 0), pa.array(fp[row[keep]], pa.int64())], ["anchor", "visitor", "fp"])

    return run


def _points(crowded: bytes):
    """The 65 words within one bit of each fingerprint that comes to a crowded anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(crowded, np.uint8)).astype(bool)
        flips = np.append(np.uint64(0), np.uint64(1) << np.arange(64, dtype=np.uint64)).view(np.int64)
        for fp in _steps(batches):
            row, anchor, _ = _the_code().anchors(fp, THRESHOLD)
            own = fp[np.unique(row[wanted[anchor]])]
            yield pa.RecordBatch.from_arrays([pa.array((own[:, None] ^ flips).reshape(-1), pa.int64()), pa.array(np.repeat(own, 65), pa.int64())], ["point", "fp"])

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, those at home first, as a stream: links of each row with the fingerprints at home before it at its anchor."""
    held = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
    for batch in batches:
        new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "visitor", "fp")]
        old = len(held[0])
        anchor, visitor, fp = (np.concatenate(x) for x in zip(held, new))
        if not len(anchor):
            continue
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        start = np.repeat(first, np.diff(np.append(first, len(anchor))))
        home = np.append(0, np.cumsum(~visitor))
        before = home[:-1] - home[start]
        before[:old] = 0
        total = np.append(0, np.cumsum(before))
        a = old
        while a < len(anchor):
            b = max(a + 1, int(np.searchsorted(total, total[a] + _PAIRS, "right")) - 1)
            n = before[a:b]
            x = np.repeat(np.arange(a, b), n)
            y = start[x] + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
            # a visitor's pair shows at both homes; the smaller one tells it
            near = (np.bitwise_count((fp[x] ^ fp[y]).view(np.uint64)) <= THRESHOLD) & (~visitor[x] | (fp[y] < fp[x]))
            if near.any():
                yield pa.RecordBatch.from_arrays([pa.array(fp[x[near]]), pa.array(fp[y[near]])], ["a", "b"])
            a = b
        keep = slice(first[-1], first[-1] + int(home[-1] - home[first[-1]]))
        held = anchor[keep], visitor[keep], fp[keep]
        if not len(held[0]):  # its visitors have nobody to meet, whatever follows
            held = tuple(x[:0] for x in held)


def fingerprint_links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(fp long) distinct fingerprints -> links (a, b) that connect all with THRESHOLD or fewer differing bits.

    1. Anchors are pairs of Golay codewords, a covering code of radius 3 of each 23 bits. Each fingerprint is at home at one anchor.
    2. A fingerprint visits all anchors within the radius plus the threshold where others are at home: what differs in
       two bits or fewer from it is at home at one of them. A map of the 2**24 anchors, 2 MB whatever the data, tells which.
    3. Rows sorted by anchor pass as a stream, in which each meets those at home.
    4. An anchor with more than `crowd` at home isn't compared pair by pair. What comes to it is sent to the 65 words within one bit:
       two fingerprints that differ in two bits or fewer share such a word, and at most 65 share one.
    """
    spark = fps.sparkSession
    n = shuffle_partitions(spark)
    cells = fps.mapInArrow(_homes, "fp long, anchor long").groupBy("anchor").agg(F.count("*").alias("n")).withColumn("most", F.lit(crowd).cast("long"))
    parts = cells.groupBy(F.shiftright("anchor", 12).alias("part")).applyInArrow(_marks, "part long, home binary, crowded binary").collect()  # 4096 rows at most
    found = {r.part: (bytes(r.home), bytes(r.crowded)) for r in parts}
    home, crowded = (b"".join(found[k][i] if k in found else bytes(512) for k in range(1 << 12)) for i in (0, 1))
    links = fps.mapInArrow(_visits(home, crowded), "anchor long, visitor boolean, fp long").repartition(n, "anchor").sortWithinPartitions("anchor", "visitor", "fp").mapInArrow(_compare, "a long, b long")
    if not any(crowded):
        return links
    near = fps.mapInArrow(_points(crowded), "point long, fp long").groupBy("point").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    return links.unionByName(near.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row per input row: id, fp (the fingerprint as a signed long) and component_id, the smallest id reachable.

    Words are lower-cased (A-Z) runs without white space; h is the XXH64 (seed 42) of each 3-word shingle, repeats included; a bit of
    the fingerprint is 1 if it is set in over half of them. Fingerprints with 2 or fewer differing bits are linked. Equal ones are
    one row from there on, so that copies cost nothing, and only distinct fingerprints travel to anchors.

    Null and empty texts, and such without words, have the fingerprint zero and are linked like others. Rows with one id
    are linked, whatever their texts; a null id takes no part and has a null component. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketched = written(base.mapInArrow(_sketch, "id long, fp long"), "simhash")
    known = sketched.where("id is not null")
    classes = written(known.groupBy("fp").agg(F.min("id").alias("lo")), "fingerprints")
    repeated = known.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("id", "a")
    same_id = known.join(repeated, "id").select("a", F.col("fp").alias("b"))
    found = components(fingerprint_links(classes.select("fp"), crowd).unionByName(same_id)).withColumnRenamed("id", "fp")
    placed = classes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = placed.groupBy("component").agg(F.min("lo").alias("component_id"))
    by_fp = placed.join(lowest, "component").select("fp", "component_id")
    component: Column = F.when(F.col("id").isNotNull(), F.col("component_id"))
    return sketched.join(by_fp, "fp", "left").select("id", "fp", component.alias("component_id"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
