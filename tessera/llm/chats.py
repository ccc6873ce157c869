"""Chat formatting of quoted messages: quotation linking, reply order, turns without quotes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import table, written

_MARK = re.compile(r"(?:>[ \t]?)+")
_PASSAGES = "conv_id long, turn long, role string, own string, parts array<struct<level:int,text:string,raw:string>>"


def passages(text: str) -> list[tuple[int, str, str]]:
    """Runs of lines of one quote level, as (level, text without the marks, lines as they are); level 0 is the writer's own."""
    found: list[tuple[int, list[str], list[str]]] = []
    for line in text.split("\n"):
        mark = _MARK.match(line)
        level = mark[0].count(">") if mark else 0
        rest = line[mark.end() :] if mark else line
        if not found or found[-1][0] != level:
            found.append((level, [], []))
        found[-1][1].append(rest)
        found[-1][2].append(line)
    return [(level, "\n".join(lines), "\n".join(raw)) for level, lines, raw in found]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("level", pa.int32()), ("text", pa.string()), ("raw", pa.string())]))
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            own, parts = [], []
            for text in part.column("text").to_pylist():
                found = passages(text or "")
                own.append("\n".join(t for level, t, _ in found if not level).strip("\n"))
                parts.append([{"level": level, "text": t if level else None, "raw": raw} for level, t, raw in found])
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("conv_id", "turn", "role")), pa.array(own, pa.string()), pa.array(parts, kind)], ["conv_id", "turn", "role", "own", "parts"])


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


_BLANK = r"\n[ \t]*\n"


def _digest(text: Column) -> Column:
    """Digest of the normalised text, null without words."""
    return F.sha2(F.nullif(normalised(text), F.lit("")), 256)


def _hashes(text: Column) -> Column:
    """Digests of a text as a whole and of its paragraphs, without those that hold no words."""
    parts = F.concat(F.array(text), F.split(text, _BLANK))
    return F.array_distinct(F.transform(F.filter(F.transform(parts, normalised), lambda p: p != ""), lambda p: F.sha2(p, 256)))


def _lines(text: Column) -> Column:
    """Digests of a text's lines that hold words."""
    return F.array_distinct(F.filter(F.transform(F.split(text, "\n"), _digest), lambda d: d.isNotNull()))


def _of(messages: DataFrame, grain: Callable[[Column], Column]) -> DataFrame:
    """(conv_id, of, digest): the own texts of messages, each digest once."""
    return messages.select("conv_id", F.col("turn").alias("of"), F.explode(grain(F.col("own"))).alias("digest")).distinct()


def _quotes(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, text): a row per quoted passage."""
    return messages.select("conv_id", "turn", F.explode(F.filter("parts", lambda p: p["level"] > 0)).alias("p")).select("conv_id", "turn", "p.level", "p.text")


def _known(quotes: DataFrame, own: DataFrame) -> DataFrame:
    """quotes (conv_id, turn, digest, ...) with hit: whether an earlier message of the conversation holds the digest, as its own text or in a
    quotation. What only earlier quotations hold is in the text of the first of them, as nothing before it had it."""
    since = own.select("conv_id", "of", "digest").unionByName(quotes.select("conv_id", F.col("turn").alias("of"), "digest"))
    since = since.groupBy("conv_id", "digest").agg(F.min("of").alias("since"))
    return quotes.join(since, ["conv_id", "digest"], "left").withColumn("hit", F.coalesce(F.col("since") < F.col("turn"), F.lit(False))).drop("since")


def _remaining(gone: Column) -> Column:
    """The text of parts without what gone holds: passages, or else their paragraphs, or else their lines. Quoted lines without words go."""
    bare = lambda t: F.regexp_replace(t, r"(?m)^(?:>[ \t]?)+", "")
    held = lambda t: F.coalesce(F.array_contains(gone, _digest(bare(t))), F.lit(True))
    some = lambda t: F.array_join(F.filter(F.split(t, "\n"), lambda x: ~held(x)), "\n")
    left = lambda t: F.array_join(F.filter(F.transform(F.split(t, r"\n(?:>[ \t]?)+[ \t]*(?=\n)"), lambda x: F.when(~held(x), some(x)).otherwise("")), lambda x: x != ""), "\n")
    kept = F.transform("parts", lambda p: F.when(p["level"] == 0, p["raw"]).when(~held(p["raw"]), left(p["raw"])))
    empty = lambda p, k: (p == "") & (F.element_at("parts", (k + 1).cast("int"))["level"] > 0)
    kept = F.filter(F.transform(kept, lambda p, k: F.when(~empty(p, k), p)), lambda p: p.isNotNull())
    return F.btrim(F.array_join(kept, "\n"), F.lit("\n"))


def link_quotations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per message: what it answers, its thread and its text without quotes.

    Lines that begin with > are quoted; the marks' number is the level. Quoted passages of level 1, and
    their paragraphs, are looked up by a digest of their normalised text among the own texts (and
    paragraphs) of earlier turns of the same conversation. The latest turn of those that share most
    passages is the one answered: reply_to. Messages that find none this way look up the lines of their
    level 1, then the passages and then the lines of each deeper level, and take the lowest level that is
    found; null if none is. thread is the first message that the
    answers lead back to, depth the answers between; position orders a thread by turn, in which every
    message stands after the one it answers. chat is the message as a turn of a chat template.

    Only quoted text that an earlier message of the conversation holds is left out of the text: whole passages,
    or else those of their paragraphs or lines that are found. Other lines with marks (block quotes, prompts,
    edited or missing originals) stay in it as they are.

    Null texts are empty. Messages with equal conv_id and turn are looked up as one and keep rows of their own;
    such with a null conv_id or turn answer nothing. Digests are joined within a conversation, so a
    text that many conversations share adds no rows; a passage that n turns of one conversation share meets
    each earlier one of them, n * n / 2 rows of digests at most. A text of any length is parsed whole. An empty table gives an empty one;
    other columns are left out, whatever their names.
    """
    base = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    parsed = written(base.mapInArrow(_parse, _PASSAGES), "messages")
    key = ["conv_id", "turn"]
    quotes = _quotes(parsed).select(*key, "level", _digest(F.col("text")).alias("whole"), F.explode(_hashes(F.col("text"))).alias("digest")).distinct()
    marks = written(_known(quotes, _of(parsed, _hashes)), "quotes")
    direct = marks.where("level = 1 and hit").select(*key, "digest").distinct()
    found = direct.join(_of(parsed, _hashes), ["conv_id", "digest"]).where("of < turn").groupBy(*key, "of").agg(F.count("*").alias("n"))
    replies = written(found.groupBy(*key).agg(F.max(F.struct("n", "of"))["of"].alias("reply_to")), "replies")
    gone = marks.where("hit").select(*key, "digest").distinct()

    # the few passages that no earlier message holds as a whole
    rest = marks.where("digest = whole and not hit").select(*key).distinct()
    if not rest.isEmpty():
        near = parsed.join(rest.select("conv_id").distinct(), "conv_id", "left_semi")
        lines = _quotes(near).select(*key, "level", F.explode(_lines(F.col("text"))).alias("digest")).distinct()
        lines = written(_known(lines, _of(near, _lines)), "lines")
        gone = gone.unionByName(lines.where("hit").select(*key, "digest").join(rest, key, "left_semi")).distinct()

    unlinked = marks.select(*key).distinct().join(replies, key, "left_anti")
    if not unlinked.isEmpty():
        near = parsed.join(unlinked.select("conv_id").distinct(), "conv_id", "left_semi")
        asked = _quotes(near).join(unlinked, key, "left_semi")
        asked = asked.select(*key, "level", F.lit(0).alias("grain"), F.explode(_hashes(F.col("text"))).alias("digest")).unionByName(asked.select(*key, "level", F.lit(1).alias("grain"), F.explode(_lines(F.col("text"))).alias("digest"))).distinct()
        own = _of(near, _hashes).withColumn("grain", F.lit(0)).unionByName(_of(near, _lines).withColumn("grain", F.lit(1)))
        found = asked.join(own, ["conv_id", "grain", "digest"]).where("of < turn").groupBy(*key, "level", "grain", "of").agg(F.count("*").alias("n"))
        more = found.groupBy(*key).agg(F.max(F.struct(-F.col("level"), -F.col("grain"), "n", "of"))["of"].alias("reply_to"))
        replies = written(replies.unionByName(more), "replies")

    # each pass doubles the answers that a message's way back covers; ways that have come to an end take no further part
    ways = replies.select("conv_id", "turn", F.col("reply_to").alias("top"), F.lit(1).cast("long").alias("depth"), F.lit(True).alias("open"))
    while True:
        done, rest = ways.where("not open"), ways.where("open")
        up = ways.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("higher"), F.col("depth").alias("more"), F.col("open").alias("up_open"))
        longer = rest.join(up, ["conv_id", "top"], "left")
        longer = longer.select("conv_id", "turn", F.coalesce("higher", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("up_open", F.lit(False)).alias("open"))
        ways = written(done.unionByName(longer), "ways")
        if ways.where("open").isEmpty():
            break
    ways = ways.drop("open")

    rows = parsed.join(replies, key, "left").join(ways, key, "left").join(gone.groupBy(*key).agg(F.collect_list("digest").alias("gone")), key, "left")
    left = _remaining(F.coalesce("gone", F.array().cast("array<string>")))
    rows = rows.select("conv_id", "turn", "role", "reply_to", F.coalesce("top", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"), F.size(F.filter("parts", lambda p: p["level"] > 0)).alias("n_quoted"), left.alias("text"))
    position = F.row_number().over(Window.partitionBy("conv_id", "thread").orderBy("turn", "role", "text"))
    chat = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("user")), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    return rows.withColumn("position", position).withColumn("chat", chat)


def threads(linked: DataFrame) -> DataFrame:
    """(conv_id, thread, chat): each thread in one text, by position; for threads that fit into a task."""
    turns = F.array_sort(F.collect_list(F.struct("position", "chat")))
    return linked.groupBy("conv_id", "thread").agg(F.concat_ws("", F.transform(turns, lambda t: t["chat"])).alias("chat"))


def as_mail(messages: DataFrame) -> DataFrame:
    """The conversations as a mail client would show them: each turn quotes the one before, and the one before that twice as deep."""
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    back = [F.lag("text", k).over(by_turn) for k in (1, 2)]

    def quote(text: Column, mark: str) -> Column:
        return F.concat(F.lit(mark), F.regexp_replace(text, "\n", "\n" + mark), F.lit("\n"))

    text = F.concat(F.coalesce(quote(F.col("second"), "> > "), F.lit("")), F.coalesce(quote(F.col("first"), "> "), F.lit("")), F.coalesce("text", F.lit("")))
    return messages.select("conv_id", "turn", "role", "text", back[0].alias("first"), back[1].alias("second")).withColumn("text", text).drop("first", "second")


#: By turn of each conversation: the answered turn is the latest earlier one whose text has most digests in common with the turn before.
SQL = r"""
with m as (
  select *, lag(text) over w as first, lag(turn) over w as before from conversations window w as (partition by conv_id order by turn, role, text)
), d as (
  select conv_id, turn, first, text, before,
    list_distinct(list_filter(list_transform(list_concat([text], regexp_split_to_array(text, '\n[ \t]*\n')), lambda p: trim(regexp_replace(lower(p), '\s+', ' ', 'g'))), lambda p: p <> '')) as own,
    case when first is null then [] else list_distinct(list_filter(list_transform(list_concat([first], regexp_split_to_array(first, '\n[ \t]*\n')), lambda p: trim(regexp_replace(lower(p), '\s+', ' ', 'g'))), lambda p: p <> '')) end as quoted
  from m
), s as (
  select a.conv_id, a.turn, b.turn as of, len(list_intersect(a.quoted, b.own)) as n
  from d a join d b on a.conv_id = b.conv_id and b.turn < a.turn
), r as (
  select conv_id, turn, max_by(of, n * 1000000 + of) as reply_to from s where n > 0 group by all
), t as (
  with recursive up as (
    select conv_id, turn, turn as top, 0::bigint as depth from m
    union all
    select up.conv_id, up.turn, r.reply_to, depth + 1 from up join r on r.conv_id = up.conv_id and r.turn = up.top
  ) select conv_id, turn, arg_max(top, depth) as thread, max(depth) as depth from up group by all
)
select m.conv_id, m.turn, m.role, r.reply_to, t.thread, t.depth,
  row_number() over (partition by m.conv_id, t.thread order by m.turn, m.role, m.text)::integer as position, sha256(trim(m.text, chr(10))) as text_sha256
from m left join r using (conv_id, turn) join t using (conv_id, turn)
"""


def op2_chat_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, quoted as mail, linked again by their quotations."""
    linked = link_quotations(as_mail(table(spark, sf_dir, "conversations")))
    return linked.select("conv_id", "turn", "role", "reply_to", "thread", "depth", "position", F.sha2("text", 256).alias("text_sha256"))
