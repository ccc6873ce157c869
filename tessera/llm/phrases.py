"""Collocations: counts of short phrases from depth-truncated suffix subtrees, built for groups of prefixes apart."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import table, written
from .words import mix, slices, span_hashes, text_buffers

LONGEST = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
#: A candidate goes where a longer one that holds it has so many per cent of its occurrences.
HELD_PERCENT = 80
#: Occurrences of prefixes that one group's subtrees hold at most, a prefix more.
BUDGET = 1 << 21
#: Bits of the map that tells which words may be frequent: 8 MB, whatever the data.
_SIEVE_BITS = 26
#: Words whose counts a task holds, and suffixes that it holds, before it sends them on.
_HELD_WORDS, _HELD_SUFFIXES = 1 << 19, 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEYS = [f"w{k}" for k in range(1, LONGEST + 1)]
_COUNT = "w1 long, w2 long, w3 long, w4 long, n long"


def _classes() -> np.ndarray:
    """0: part of a word, 1: between words, 2: between pieces."""
    kind = np.zeros(256, np.uint8)
    kind[[9, 32]] = 1
    kind[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
    return kind


_KIND = _classes()


class _Pieces:
    """The words of a batch of texts, with hashes that differ between languages, and which ones begin a piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        self.data, at = text_buffers(texts)
        kind = _KIND[self.data]
        inside = np.zeros(len(kind) + 2, bool)
        np.equal(kind, 0, out=inside[1:-1])
        first = np.zeros(len(kind) + 1, bool)
        first[at] = True
        self.starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
        self.ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
        text = np.searchsorted(at, self.starts, "right") - 1
        cuts = np.append(0, np.cumsum(kind == 2))[self.starts]
        self.begins = np.append(True, (cuts[1:] != cuts[:-1]) | (text[1:] != text[:-1]))[: len(self.starts)]
        self.langs = ["und" if x is None else x for x in langs.to_pylist()]
        known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(self.langs)}
        self.lang = text
        salt = np.array([known[x] for x in self.langs], np.uint64)[text]
        self.hashes = mix(span_hashes(self.data, self.starts, self.ends, lower=True) * _ODD + salt)

    def strings(self, rows: np.ndarray) -> pa.Array:
        """The words in lower case."""
        sizes = self.ends[rows] - self.starts[rows]
        at = np.append(0, np.cumsum(sizes))
        raw = self.data[np.repeat(self.starts[rows] - at[:-1], sizes) + np.arange(at[-1])]
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        return pa.StringArray.from_buffers(len(rows), pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes()))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[_Pieces]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield _Pieces(part.column("lang"), part.column("text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a task with their counts; a word is sent again where more than _HELD_WORDS others came between."""
    keys, counts, words = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def sent() -> pa.RecordBatch:
        order = np.argsort(np.concatenate([k for k, _, _ in words]))
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([x for _, _, x in words]).take(order), pa.concat_arrays([x for _, x, _ in words]).take(order), pa.array(keys.view(np.int64)), pa.array(counts)],
            ["lang", "word", "w", "n"],
        )

    for part in _parts(batches):
        own, first, n = np.unique(part.hashes, return_index=True, return_counts=True)
        at = np.searchsorted(keys, own)
        old = np.zeros(len(own), bool)
        old[at < len(keys)] = keys[at[at < len(keys)]] == own[at < len(keys)]
        counts[at[old]] += n[old]
        new = ~old
        if new.any():
            rows = first[new]
            words.append((own[new], part.strings(rows), pa.array([part.langs[i] for i in part.lang[rows].tolist()], pa.string())))
            keys, counts = np.insert(keys, at[new], own[new]), np.insert(counts, at[new], n[new])
        if len(keys) > _HELD_WORDS:
            yield sent()
            keys, counts, words = keys[:0], counts[:0], []
    if len(keys):
        yield sent()


def _sieve_part(key: tuple, group: pa.Table) -> pa.Table:
    bits = np.zeros(1 << 15, bool)
    bits[group.column("bit").to_numpy()] = True
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()])})


class _Suffixes:
    """The suffixes of a batch, cut after LONGEST words, at the end of their piece and before words that can't be frequent."""

    def __init__(self, part: _Pieces, sieve: np.ndarray):
        slot = part.hashes >> np.uint64(64 - _SIEVE_BITS)
        fine = (sieve[(slot >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1 > 0
        n = len(part.hashes)
        # the words that may follow each one: a run ends with its piece or before an infrequent word
        goes = np.zeros(n, bool)
        if n:
            goes[:-1] = fine[:-1] & fine[1:] & ~part.begins[1:]
        self.size = fine.astype(np.int64)
        reach = goes.copy()
        for k in range(1, LONGEST):
            self.size += reach
            reach[: max(n - k, 0)] &= goes[k:]
            reach[max(n - k, 0) :] = False
        self.words = part.hashes

    def keys(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """The key of the first `depth` words of suffixes."""
        key = self.words[rows]
        for k in range(1, depth):
            key = mix(key * _ODD + self.words[rows + k])
        return key

    def split(self, heavy: list[np.ndarray], depth: int) -> np.ndarray:
        """Suffixes of at least `depth` words whose shorter prefixes are all heavy."""
        rows = np.flatnonzero(self.size >= max(depth, 2))
        for d in range(1, depth):
            rows = rows[np.isin(self.keys(rows, d), heavy[d - 1])] if len(heavy[d - 1]) else rows[:0]
        return rows


def _added(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the key columns with the sum of their counts."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))[: len(order)]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _count_longer(heavy: list[np.ndarray], depth: int, sieve: bytes):
    """Phrases of `depth` words behind prefixes that are all heavy, with their counts in a task."""

    def sent(held: list) -> pa.RecordBatch:
        keys, counts = _added([np.concatenate(x) for x in zip(*held)], np.ones(sum(len(x[0]) for x in held), np.int64))
        none = pa.nulls(len(counts), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)) for k in keys] + [none] * (LONGEST - depth) + [pa.array(counts)], [*_KEYS, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held = np.frombuffer(sieve, np.uint8), []
        for part in _parts(batches):
            own = _Suffixes(part, bits)
            if len(rows := own.split(heavy, depth)):
                held.append([own.words[rows + k] for k in range(depth)])
            if sum(len(x[0]) for x in held) > _HELD_SUFFIXES:
                yield sent(held)
                held = []
        if held:
            yield sent(held)

    return run


def _squeezed(columns: list[np.ndarray], width: int) -> bytes:
    """Columns of numbers of so many bytes, sorted ones above all, compressed byte by byte."""
    planes = np.array(columns, f"<u{width}").view(np.uint8).reshape(len(columns), -1, width).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unsqueezed(raw: bytes, columns: int, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(columns, width, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f"<u{width}")[:, :, 0]


def _route(heavy: list[np.ndarray], bounds: np.ndarray, sieve: bytes):
    """The distinct suffixes of a task for each group of prefixes with their counts, as compressed codes into a list of their words."""

    def packed(held: list) -> Iterator[pa.RecordBatch]:
        group, words = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(group, kind="stable")
        group, words = group[order], words[order]
        cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        out = []
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            own, codes = np.unique(words[a:b], return_inverse=True)
            codes, counts = _added(list(codes.reshape(-1, LONGEST).T), np.ones(b - a, np.int64))
            out.append((int(group[a]), _squeezed([np.diff(own, prepend=np.uint64(0))], 8), _squeezed([*codes, counts], 4)))
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], ["group", "words", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held = np.frombuffer(sieve, np.uint8), []
        for part in _parts(batches):
            own = _Suffixes(part, bits)
            for depth in range(1, LONGEST):
                rows = own.split(heavy, depth)
                keys = own.keys(rows, depth)
                light = ~np.isin(keys, heavy[depth - 1])
                rows, keys = rows[light], keys[light]
                for at in range(0, len(rows), _HELD_SUFFIXES // 4):
                    some = rows[at : at + _HELD_SUFFIXES // 4]
                    places = np.minimum(some[:, None] + np.arange(LONGEST), len(own.words) - 1)
                    # word 0 stands for none
                    words = np.where(np.arange(LONGEST) < own.size[some][:, None], own.words[places], np.uint64(0))
                    held.append((np.searchsorted(bounds, keys[at : at + len(some)], "right"), words))
                    if sum(len(g) for g, _ in held) > _HELD_SUFFIXES:
                        yield from packed(held)
                        held = []
        if sum(len(g) for g, _ in held):
            yield from packed(held)

    return run


def _subtrees(heavy: list[np.ndarray], least: int):
    """The phrases of a group with `least` or more occurrences: children of a node are sorted one level after the other, and what has
    fewer leaves goes before the next level."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        lists = [np.cumsum(_unsqueezed(x, 1, 8)[0], dtype=np.uint64) for x in group.column("words").to_pylist()]
        every = np.unique(np.concatenate(lists))
        rows = []
        for own, raw in zip(lists, group.column("codes").to_pylist()):
            held = _unsqueezed(raw, LONGEST + 1, 4)
            rows.append(np.vstack([np.searchsorted(every, own).astype(np.int32)[held[:LONGEST]], held[LONGEST:].astype(np.int32)]))
        codes = np.concatenate(rows, axis=1)
        codes, times = codes[:LONGEST], codes[LONGEST]
        none = np.searchsorted(every, np.uint64(0)) if len(every) and every[0] == 0 else -1
        node = codes[0].astype(np.int64)
        prefix = every[codes[0]]
        found = []
        for depth in range(2, LONGEST + 1):
            live = codes[depth - 1] != none
            codes, node, prefix, times = codes[:, live], node[live], prefix[live], times[live]
            child, place = np.unique(node * len(every) + codes[depth - 1], return_inverse=True)
            leaves = np.bincount(place, times, len(child)).astype(np.int64)
            live = leaves[place] >= least
            codes, times, prefix = codes[:, live], times[live], mix(prefix[live] * _ODD + every[codes[depth - 1][live]])
            kept, first = np.unique(place[live], return_index=True)
            # a heavy prefix has its own count, of all its occurrences
            own = first[~np.isin(prefix[first], heavy[depth - 1])] if depth < LONGEST else first
            found.append(([every[codes[k][own]] if k < depth else np.zeros(len(own), np.uint64) for k in range(LONGEST)], leaves[place[live][own]]))
            node = np.searchsorted(kept, place[live])
        keys = [np.concatenate([f[0][k] for f in found]) for k in range(LONGEST)]
        return pa.table([pa.array(k.view(np.int64), pa.int64(), mask=k == 0) for k in keys] + [pa.array(np.concatenate([f[1] for f in found]), pa.int64())], names=[*_KEYS, "n"])

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """docs (lang, text) -> all words (lang, word, w, n), and phrases of 2 to 4 words with `least` or more occurrences (w1..w4, n).

    1. Words are counted per language. A map of 2**26 bits tells in which places frequent words fall, so suffixes end before
       words that can't be frequent (a few others slip through and fail the count).
    2. Prefixes are cut vertically: a word with more than `budget` occurrences is extended by the next word, and so on to 4, whose
       counts are leaves already. Prefixes, in the order of their keys, form groups of about `budget` occurrences; the
       driver holds a bound per group and the heavy prefixes (one per `budget` words of text at most).
    3. Each suffix goes, cut after 4 words, to its prefix's group, packed by task. A group's subtrees are built apart, level by level,
       and phrases get their leaves' totals.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = docs.mapInArrow(_count_words, "lang string, word string, w long, n long").groupBy("lang", "word", "w").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    frequent = words.where(F.col("n") >= least)
    slots = frequent.select(F.shiftrightunsigned("w", 64 - _SIEVE_BITS).alias("slot")).distinct()
    parts = slots.select(F.shiftright("slot", 15).alias("part"), (F.col("slot") % (1 << 15)).alias("bit")).groupBy("part").applyInArrow(_sieve_part, "part long, bits binary").collect()  # 2048 rows at most
    bits = {r.part: bytes(r.bits) for r in parts}
    sieve = b"".join(bits.get(k, bytes(1 << 12)) for k in range(1 << (_SIEVE_BITS - 15)))

    heavy: list[np.ndarray] = []
    prefixes, counted = frequent.select(F.col("w").alias("key"), "n"), []
    for depth in range(1, LONGEST + 1):
        if depth > 1:
            longer = docs.mapInArrow(_count_longer(heavy, depth, sieve), _COUNT).groupBy(*_KEYS).agg(F.sum("n").alias("n"))
            longer = written(longer, "longer")
            counted.append(longer.where(F.col("n") >= (least if depth == LONGEST else max(least, budget + 1))))
            if depth == LONGEST:
                break
            keyed = longer.mapInArrow(_keyed(depth), "key long, n long")
            prefixes = prefixes.unionByName(keyed.where(F.col("n") <= budget))
        else:
            keyed, prefixes = prefixes, prefixes.where(F.col("n") <= budget)
        heavy.append(np.array([r.key for r in keyed.where(F.col("n") > budget).select("key").distinct().collect()], np.int64).view(np.uint64))
        if not len(heavy[-1]):
            break
    heavy += [np.zeros(0, np.uint64)] * (LONGEST - 1 - len(heavy))
    bounds = _group_bounds(prefixes, budget)
    routed = docs.mapInArrow(_route(heavy, bounds, sieve), "group long, words binary, codes binary")
    found = routed.groupBy("group").applyInArrow(_subtrees(heavy, least), _COUNT)
    for more in counted:
        found = found.unionByName(more)
    return words, written(found, "phrases")


def _keyed(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("w1").to_numpy().view(np.uint64)
            for k in range(2, depth + 1):
                key = mix(key * _ODD + batch.column(f"w{k}").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("n")], ["key", "n"])

    return run


def _group_bounds(prefixes: DataFrame, budget: int) -> np.ndarray:
    """Where, in the unsigned order of keys, a running total of occurrences passes the next multiple of the budget: a key per group."""
    order = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    ranged = written(prefixes.select(order.alias("key"), "n").repartitionByRange("key").withColumn("part", F.spark_partition_id()), "prefixes")
    totals = ranged.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    totals = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    upto = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum("n").over(upto)).join(totals, "part").withColumn("upto", F.col("upto") + F.col("before"))
    first = placed.where(F.expr(f"(upto - 1) div {budget} > (upto - n - 1) div {budget} and upto > n")).select("key").collect()
    return np.sort(np.array([r.key for r in first], np.int64).view(np.uint64) ^ np.uint64(1 << 63))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, budget: int = BUDGET, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Per language, the first `top` phrases: lang, rank, phrase, a, l, r, n and score.

    Texts in lower case (A-Z) are cut at [.,;:!?\\x0A-\\x0D] into pieces and those at spaces and tabs into words. A phrase is 2 to 4
    words that stand together a times in pieces, `least` or more. Of its cuts into two parts with l and r occurrences, that with the
    lowest score floor(2,000,000 a / (l + r)) counts, the earliest of equal ones. Phrases inside a longer candidate that has
    80 % of their occurrences are dropped. Order: score, then a, descending, then the phrase's bytes. Null texts hold nothing,
    a null lang is `und`; an empty table gives none. Repeated rows count each time; other columns are ignored.

    Counts are by 64-bit hashes of words (see phrase_counts); frequent words that share one are an error.
    """
    words, phrases = phrase_counts(docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), least, budget)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n_words"))
    frequent = words.where(F.col("n") >= least)
    if frequent.groupBy("w").count().where("count > 1").limit(1).count():
        raise ValueError("two frequent words share a hash")
    spelt = phrases.select(*_KEYS, F.col("n").alias("a"), F.posexplode(F.array_compact(F.array(*_KEYS))).alias("at", "w"))
    spelt = spelt.join(frequent.select("w", "lang", "word"), "w").groupBy(*_KEYS).agg(F.first("lang").alias("lang"), F.first("a").alias("a"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelt = written(spelt.select("lang", F.col("words.word").alias("words"), "a").withColumn("phrase", F.array_join("words", " ")), "spelt")
    counts = spelt.select("lang", "phrase", F.col("a").alias("n")).unionByName(frequent.select("lang", F.col("word").alias("phrase"), "n"))

    cuts = spelt.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("tail"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    score = F.expr(f"cast(a as decimal(20, 0)) * {SCALE} div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))

    size = F.size("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    within = spelt.where(size > 2).select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(f"longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {HELD_PERCENT}")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    kept = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n_words").alias("n"), F.col("score").cast("long").alias("score"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
with d as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), p as (
  select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d
), w as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from p
), g as (
  select lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) as q from w, (values (1), (2), (3), (4)) v(m)
), f as (
  select lang, m, q, count(*) as n from g group by all
), t as (
  select lang, sum(n)::bigint as n from f where m = 1 group by lang
), c as (
  select lang, m, string_split(q, ' ') as ws, q, n as a from f where m > 1 and n >= 30
), cut as (
  select lang, m, q, a, unnest(range(1, m)) as k, ws from c
), parts as (
  select lang, q, a, k, array_to_string(ws[1:k], ' ') as head, array_to_string(ws[k + 1:m], ' ') as tail from cut
), k as (
  select p.lang, p.q, p.a, k, x.n as l, y.n as r, (2000000::hugeint * a) // (x.n + y.n) as score
  from parts p join f x on x.lang = p.lang and x.q = p.head join f y on y.lang = p.lang and y.q = p.tail
), s as (
  select * from k qualify row_number() over (partition by lang, q order by score, k) = 1
), i as (
  select lang, a, ws, m, unnest(range(2, m)) as size from c
), h as (
  select lang, q, max(a) as longer from (select lang, a, unnest(list_transform(range(1, m - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as q from i) group by all
), o as (
  select s.* from s left join h using (lang, q) where longer is null or 100::hugeint * longer < 80::hugeint * a
)
select o.lang, row_number() over (partition by o.lang order by score desc, a desc, encode(q)) as rank, q as phrase, a, l, r, t.n, score::bigint as score
from o join t using (lang) qualify rank <= 2000
"""
