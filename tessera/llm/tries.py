"""The trie of conversations' shared beginnings, found by digests of blocks of turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import shuffle_partitions, table, written

#: Turns of a block, and blocks of a span (running sums go by spans first).
BLOCK, SPAN = 8, 64
#: Ids that are joined into one piece of a node's list of ends differ in the last so many bits.
RUN_BITS = 10

_NODE = ["depth", "q1", "q2"]
_EDGE = ["block", "e1", "e2"]


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range, with the range and each row's number in its conversation's part of the range."""
    part = TaskContext.get().partitionId()
    last, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv").to_numpy()
        first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        number = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv))))
        if conv[0] == last:
            number[: first[1] if len(first) > 1 else None] += n
        last, n = conv[-1], int(number[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), part)), batch.column("conv"), pa.array(number), batch.column("digest"), batch.column("n_bytes")], ["part", "conv", "number", "digest", "n_bytes"])


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, digest, n_bytes): each turn's place in its conversation from 0, the digest of its role and text and the text's bytes.

    Turns are in the order of turn_col, nulls first, equal ones by digest (128 bits of SHA-256). Null roles and texts are empty; rows
    with a null id belong to no conversation and are left out. Only digests are sorted, in ranges of id and turn, so that a
    conversation of any length is cut to several ranges; a row per range tells where its first conversation goes on.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    turns = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    keys = ["conv", "turn", "digest"]
    ranged = written(turns, "turns").repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = written(ranged.mapInArrow(_number, "part long, conv long, number long, digest binary, n_bytes long"), "numbered")
    ends = rows.groupBy("part").agg(F.min("conv").alias("lo"), F.max(F.struct("conv", "number")).alias("hi")).orderBy("part").collect()  # a row per range
    shifts, last, total = [], None, 0
    for r in ends:
        before = total if r.lo == last else 0
        if before:
            shifts.append((r.part, r.lo, before))
        last, total = r.hi.conv, r.hi.number + 1 + (before if r.hi.conv == r.lo else 0)
    if not shifts:
        return rows.select("conv", F.col("number").alias("pos"), "digest", "n_bytes")
    later = conversations.sparkSession.createDataFrame(shifts, "part long, conv long, before long")
    return rows.join(F.broadcast(later), ["part", "conv"], "left").select("conv", (F.col("number") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "n_bytes")


def _xor(items: Column, name: str, start: Column) -> Column:
    return F.aggregate(items, start, lambda a, x: a.bitwiseXOR(x[name]))


def _before(rows: DataFrame, names: dict[str, str], xor: bool = False, back: bool = False) -> DataFrame:
    """rows (conv, block) with the sum of each column of `names` over the conversation's blocks before (back: after) its own.

    names: new name -> column. Sums go by spans first, then inside a span; xor: exclusive or in place of plus.
    """
    add = F.bit_xor if xor else F.sum
    turned = (lambda c: F.desc(c)) if back else F.col
    whole = Window.partitionBy("conv").orderBy(turned("span")).rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("conv", "span").orderBy(turned("block")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    rows = rows.withColumn("span", F.shiftright("block", SPAN.bit_length() - 1))
    spans = rows.groupBy("conv", "span").agg(*(add(c).alias(n) for n, c in names.items()))
    spans = spans.select("conv", "span", *(F.coalesce(add(n).over(whole), zero).alias(f"_{n}") for n in names))
    rows = rows.withColumns({n: F.coalesce(add(c).over(inner), zero) for n, c in names.items()}).join(spans, ["conv", "span"])
    both = {n: F.col(n).bitwiseXOR(F.col(f"_{n}")) if xor else F.col(n) + F.col(f"_{n}") for n in names}
    return rows.withColumns(both).drop("span", *(f"_{n}" for n in names))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of lists of ends, sorted by node and run, as a stream -> the SHA-256 of each node's list."""
    node, digest = None, None
    for batch in batches:
        done = []
        for depth, q1, q2, piece in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "piece"))):
            if node != (depth, q1, q2):
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, q1, q2), hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield _ended(done)
    if node is not None:
        yield _ended([(*node, digest.hexdigest())])


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [*_NODE, "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """turns (conv, pos, digest, n_bytes) of conversations convs (conv) -> a row per distinct beginning of d turns, from d = 0.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256. A
    conversation without turns is a member of the root only; without any conversation there is no node.

    1. Turns are cut to blocks of 8. The digest of a beginning is the sum (exclusive or) of 128-bit hashes of place and turn, so
       beginnings of whole blocks are running sums over blocks, and conversations are grouped by them: an edge is a distinct
       block behind a distinct beginning, with its number of conversations, the smallest of them and its turns.
    2. Where a beginning has one edge only, all inside the block agree and its turns are nodes as they are. Where edges diverge,
       each edge's (not each conversation's) turns are told apart by their digests and added up.
    3. Sums over subtrees need no walk of levels: a node's value belongs to its smallest member, which has it in one edge. Sums over the
       blocks behind, per conversation, are added up by edge and, inside blocks, by turn.
    4. Lists of ends are joined in pieces of up to 1024 ids, which pass sorted, as a stream, into the digest.

    Every group is added up before it is shuffled or has 1024 members at most; a conversation of any length is one row per 512 turns in
    the only windows over whole conversations.
    """
    spark = turns.sparkSession
    place = [F.xxhash64(F.lit(k), "pos", "digest") for k in (1, 2)]
    items = turns.select("conv", F.shiftright("pos", 3).alias("block"), F.struct("pos", place[0].alias("f1"), place[1].alias("f2"), "n_bytes").alias("item"))
    blocks = written(items.groupBy("conv", "block").agg(F.sort_array(F.collect_list("item")).alias("items")), "blocks")
    blocks = blocks.withColumns({f"b{k}": _xor(F.col("items"), f"f{k}", F.lit(0).cast("long")) for k in (1, 2)})
    blocks = _before(blocks, {"p1": "b1", "p2": "b2"}, xor=True)
    blocks = blocks.withColumns({f"e{k}": F.col(f"p{k}").bitwiseXOR(F.col(f"b{k}")) for k in (1, 2)}).withColumn("last", F.col("block") * BLOCK + F.size("items"))
    placed = written(blocks.drop("b1", "b2"), "placed")

    edges = placed.groupBy("p1", "p2", *_EDGE).agg(F.count("*").alias("n"), F.min("conv").alias("lo"), F.first("items").alias("items"))
    edges = written(edges, "edges")
    lone = edges.groupBy("block", "p1", "p2").agg(F.count("*").alias("n_edges")).where("n_edges = 1").select("block", "p1", "p2", F.lit(True).alias("lone"))
    edges = edges.join(lone, ["block", "p1", "p2"], "left")

    def step(x: Column, i: Column) -> Column:
        upto = F.slice("items", 1, i + 1)
        q = {k: _xor(upto, f"f{k}", F.col(f"p{k}")) for k in (1, 2)}
        return F.struct((x["pos"] + 1).alias("depth"), *(q[k].alias(f"q{k}") for k in q), *(q[k].bitwiseXOR(x[f"f{k}"]).alias(f"r{k}") for k in q), x["n_bytes"].alias("n_bytes"))

    steps = edges.select(*_EDGE, "lone", "n", "lo", F.explode(F.transform("items", step)).alias("s")).select(*_EDGE, "lone", "n", "lo", "s.*")
    steps = written(steps, "steps")
    told = steps.where("lone is null").groupBy(*_NODE).agg(*(F.min(c).alias(c) for c in ("r1", "r2", "n_bytes", "lo")), F.sum("n").alias("n"))
    nodes = told.unionByName(steps.where("lone").select(told.columns))
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("r1").alias("q1"), F.col("r2").alias("q2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = written(nodes.withColumns({"value": (F.col("n") - 1) * F.col("n_bytes"), "leaf": (F.col("n_children") == 0).cast("long")}), "nodes")

    # what a conversation owns: the nodes whose smallest member it is
    zero = F.lit(0).cast("long")
    own = steps.select(*_EDGE, "lo", *_NODE).join(nodes.select(*_NODE, F.col("lo").alias("owner"), "value", "leaf"), _NODE)
    own = own.select(*_EDGE, "lo", *_NODE, *(F.when(F.col("lo") == F.col("owner"), F.col(c)).otherwise(zero).alias(c) for c in ("value", "leaf")))
    own = written(own, "owned")
    by_edge = own.groupBy(F.col("lo").alias("conv"), "block").agg(F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    behind = placed.select("conv", *_EDGE).join(by_edge, ["conv", "block"], "left").withColumns({c: F.coalesce(c, zero) for c in ("value", "leaf")})
    behind = _before(behind, {"s_value": "value", "s_leaf": "leaf"}, back=True)
    behind = behind.groupBy(*_EDGE).agg(F.sum("s_value").alias("s_value"), F.sum("s_leaf").alias("s_leaf"))
    deeper = Window.partitionBy(*_EDGE).orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)  # 8 rows at most
    sums = own.withColumns({"value": F.sum("value").over(deeper), "leaf": F.sum("leaf").over(deeper)}).join(behind, _EDGE)
    sums = sums.groupBy(*_NODE).agg(F.sum(F.col("value") + F.col("s_value")).alias("saved_tokens"), F.sum(F.col("leaf") + F.col("s_leaf")).alias("n_leaves"))

    every = convs.agg(F.count("*").alias("n"), F.min("conv").alias("lo")).first()
    below = nodes.agg(F.coalesce(F.sum((F.col("depth") == 1).cast("long")), zero).alias("n_children"), F.coalesce(F.sum("leaf"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("value"), zero).alias("saved")).first()
    columns = [*_NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    schema = ", ".join(f"{c} long" for c in columns)
    root = spark.createDataFrame([(0, 0, 0, every.lo, None, every.n, below.n_children, below.n_leaves, below.saved)] if every.n else [], schema)
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("q1").alias("r1"), F.col("q2").alias("r2"), F.col("lo").alias("above"))
    rest = nodes.where("depth > 1").join(above, ["depth", "r1", "r2"]).unionByName(nodes.where("depth = 1").withColumn("above", F.lit(every.lo).cast("long")))
    rest = rest.join(sums, _NODE).select(*_NODE, F.col("lo").alias("conv_id"), F.col("above").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")

    final = placed.groupBy("conv").agg(F.max(F.struct("block", "last", "e1", "e2")).alias("x")).select("conv", F.col("x.last").alias("depth"), F.col("x.e1").alias("q1"), F.col("x.e2").alias("q2"))
    silent = convs.select("conv").join(final.select("conv"), "conv", "left_anti").select("conv", *(zero.alias(c) for c in _NODE))
    pieces = final.unionByName(silent).groupBy(*_NODE, F.shiftright("conv", RUN_BITS).alias("run")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("piece"))
    ends = pieces.repartition(shuffle_partitions(spark), *_NODE).sortWithinPartitions(*_NODE, "run").mapInArrow(_hash_ends, "depth long, q1 long, q2 long, ends_sha256 string")
    found = rest.unionByName(root).join(ends, _NODE, "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """prefix_trie of conversations as they are; columns: id_col, turn_col, role_col, text_col."""
    turns = numbered_turns(conversations, **columns)
    return prefix_trie(turns, turns.select("conv").distinct())


#: Conversations of one family share beginnings of fewer than so many turns.
FAMILY, HEADS = 5, 9


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns -> the turns of rebuilt conversations, and all conversations (some may have no turns left).

    Conversation c begins with the first h turns of conversation c - c % 5 (the remainder has the sign of c), all if it has fewer,
    none if there is no such conversation, and goes on with its own turns behind its first h. h is the CRC-32 of c's decimal digits modulo 9.
    """
    head, base = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS, F.col("conv") - F.col("conv") % FAMILY
    convs = written(turns.groupBy("conv").agg((F.max("pos") + 1).alias("n")).withColumns({"head": head, "base": base}), "conversations")
    heads = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    others = convs.where("conv <> base").join(heads, "base", "left").withColumn("n_base", F.coalesce("n_base", F.lit(0).cast("long")))
    shift = others.where("n_base < head").select("conv", (F.col("n_base") - F.col("head")).alias("shift"))
    own = turns.where((F.col("conv") == base) | (F.col("pos") >= head)).join(shift, "conv", "left")
    own = own.withColumn("pos", F.col("pos") + F.coalesce("shift", F.lit(0).cast("long"))).drop("shift")
    given = turns.where(F.col("pos") < HEADS - 1).withColumnRenamed("conv", "base").join(others.select("base", "conv", "head"), "base").where("pos < head")
    return own.unionByName(given.select(own.columns)), convs.select("conv")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*with_shared_heads(numbered_turns(table(spark, sf_dir, "conversations"))))


SQL = r"""
with t as (
  select conv_id as c, turn, coalesce(text, '') as text, sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as dig from conversations where conv_id is not null
), o as (
  select c, text, dig, row_number() over (partition by c order by turn nulls first, dig) - 1 as pos from t
), n as (
  select c, count(*) as n, c - c % 5 as b, xor(list_reduce(list_transform(range(1, length(c::varchar) + 1), lambda i: ascii((c::varchar)[i:i])::bigint), lambda a, y: list_reduce(range(8), lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, xor(a, y)), 4294967295::bigint), 4294967295::bigint) % 9 as h from o group by c
), m as (
  select n.c, n.b, n.h, least(n.h, coalesce(x.n, 0)) as got from n left join n x on x.c = n.b
), r as (
  select c, case when c = b then pos else pos - h + got end as pos, text, dig from o join m using (c) where c = b or pos >= h
  union all
  select m.c, o.pos, o.text, o.dig from m join o on o.c = m.b where m.c <> m.b and o.pos < m.h
), s as (
  select c, pos + 1 as d, strlen(text) as bytes, sha256(string_agg(dig, '') over (partition by c order by pos)) as key from r
  union all select c, 0, 0, '' from n
), k as (
  select d, key, min(c) as lo, count(*) as n_convs, any_value(bytes) as bytes, any_value(c) as some from s group by d, key
), p as (
  select k.d, k.key, x.key as above from k join s x on x.c = k.some and x.d = k.d - 1
), ch as (
  select d - 1 as d, above as key, count(*) as n_children from p group by 1, 2
), u as (
  select k.*, coalesce(n_children, 0) as n_children from k left join ch using (d, key)
), sub as (
  select s.d, s.key, sum((u.n_convs - 1) * u.bytes) as saved_tokens, sum((u.n_children = 0)::int) as n_leaves from u join s on s.c = u.lo and s.d <= u.d group by 1, 2
), l as (
  select c, max(d) as d, arg_max(key, d) as key from s group by c
), e as (
  select d, key, string_agg(c::varchar, ',' order by c) as ends from l group by 1, 2
)
select u.lo as conv_id, u.d::bigint as depth, w.lo as parent_conv_id, u.n_convs, u.n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, sha256(coalesce(ends, '')) as ends_sha256
from u join sub using (d, key) left join e using (d, key) left join p using (d, key) left join k w on w.d = u.d - 1 and w.key = p.above
"""
