"""SimHash groups, phrases and conversation tries against plain versions, and on odd tables."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("tessera.llm")

import xxhash
from pyspark.sql import functions as F

from tessera.llm import phrases, queries, simhash, tries

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# SimHash


def plain_fingerprint(text):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """(id, fingerprint) rows -> component of each id, all pairs compared."""
    parent = {i: i for i, _ in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, x) in enumerate(fps):
        for j, y in fps[:k]:
            if bin(x ^ y).count("1") <= 2:
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return {i: find(i) for i in parent}


@needs_data
def test_simhash_query_equals_a_plain_version(spark):
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = plain_components(fps)
    got = queries.queries()["op11_simhash"](spark, DATA).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{x:016x}", want[i]) for i, x in fps} and len(got) == len(fps)


def test_xxh64_equals_the_library():
    rng = random.Random(3)
    raw = bytes(rng.randrange(256) for _ in range(3000))
    starts = np.array([rng.randrange(2000) for _ in range(2000)])
    sizes = np.array([rng.choice([0, 1, 3, 4, 7, 8, 12, 31, 32, 33, 64, 65, 900]) for _ in starts])
    got = simhash.xxh64(np.frombuffer(raw, np.uint8), starts, starts + sizes)
    assert got.tolist() == [xxhash.xxh64_intdigest(raw[a : a + n], seed=42) for a, n in zip(starts.tolist(), sizes.tolist())]


@pytest.mark.parametrize("crowd", [simhash.CROWD, 3])
def test_links_of_close_fingerprints(spark, crowd):
    """Chains, tight crowds and strangers; crowded anchors give the same components as others."""
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            values.add(x)
            for bit in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                x ^= 1 << bit
    base = rng.getrandbits(64)
    for _ in range(120):  # few bits, so that many differ in two or fewer
        values.add(base ^ sum(1 << b for b in rng.sample(range(9), rng.randrange(4))))
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5), crowd)
    rows = links.collect()
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") in (1, 2) for r in rows)
    found = {(min(p, q), max(p, q)) for p, q in rows}
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for p, q in found:
        p, q = sorted((find(p), find(q)))
        parent[q] = p
    want = plain_components(list(zip(signed, values)))
    assert {v: find(v) for v in signed} == want
    if crowd == simhash.CROWD:  # no pair is missing, and none comes twice
        assert len(rows) == len(found) == sum(bin(x ^ y).count("1") <= 2 for k, x in enumerate(values) for y in values[:k])


def test_simhash_on_odd_tables(spark):
    schema = "fp string, text string, doc_id long, id string"
    long = " ".join(f"w{i % 977}" for i in range(300_000))  # above one chunk
    rows = [("x", None, 4, "a"), (None, "", 7, "b"), ("x", " \t\n", 9, None), ("x", "One two", 3, "c"), ("y", "one TWO", 1, "c"), ("y", "one two", None, "c"), ("y", long, 8, "d"), ("y", long, 2, "d"), ("z", "ÄÖ b c", 5, "e"), ("z", "äö b c", 6, "e")]
    docs = spark.createDataFrame(rows + rows[:2], schema)
    got = {(r.id, r.fp & (2**64 - 1), r.component_id) for r in simhash.simhash_groups(docs).collect()}
    want = [(i, plain_fingerprint(t)) for _, t, i, _ in rows if i is not None]
    parts = plain_components(want)
    assert got == {(i, x, parts[i]) for i, x in want} | {(None, plain_fingerprint("one two"), None)}
    assert simhash.simhash_groups(docs).count() == 12
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    # an id with two texts links them
    both = spark.createDataFrame([(1, "a b c d"), (5, "a b c d"), (5, "p q r s"), (9, "p q r s")], "doc_id long, text string")
    assert {r.component_id for r in simhash.simhash_groups(both).collect()} == {1}


# phrases


def plain_phrases(rows, least, top=2000):
    """(lang, text) rows -> the rows of collocations."""
    counts, totals = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    key = (lang, *w[i : i + n])
                    counts[key] = counts.get(key, 0) + 1
    found, out = {k: a for k, a in counts.items() if len(k) > 2 and a >= least}, []
    gone = set()
    for (lang, *q), longer in found.items():
        for n in range(2, len(q)):
            for i in range(len(q) - n + 1):
                key = (lang, *q[i : i + n])
                if 100 * longer >= 80 * counts[key]:
                    gone.add(key)
    for (lang, *q), a in found.items():
        if (lang, *q) not in gone:
            cuts = [(2_000_000 * a // (counts[lang, *q[:k]] + counts[lang, *q[k:]]), k) for k in range(1, len(q))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(q).encode(), counts[lang, *q[:k]], counts[lang, *q[k:]]))
    ranked = []
    for lang in {x[0] for x in out}:
        for rank, (_, score, a, phrase, left, right) in enumerate(sorted(x for x in out if x[0] == lang)[:top], 1):
            ranked.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(ranked)


@needs_data
@pytest.mark.parametrize("least, budget", [(30, phrases.BUDGET), (5, 200), (3, 12)])
def test_phrases_equal_a_plain_version(spark, least, budget):
    """Small budgets split words, pairs and triples of words."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 60")
    got = phrases.collocations(docs.repartition(3), least, 500, budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases([(r.lang, r.text) for r in docs.collect()], least, 500)


def test_phrases_on_odd_tables(spark):
    one = "The cat, sat on. the mat\tThe CAT sat\x0bon the cat"
    long = " ".join(["alpha beta gamma delta", "epsilon"] * 60_000)  # above one chunk, and a heavy phrase of four words
    rows = [(None, one, 1), ("und", one, 1), ("en", None, 2), ("en", "", 3), ("", "x y", 4), ("en", long, 5), ("en", "ä Ä ä Ä.ä Ä ä", 6)] + [("fr", "!?;: \t", 7)]
    docs = spark.createDataFrame(rows * 2, "lang string, text string, word long")
    for budget in (phrases.BUDGET, 50):
        got = phrases.collocations(docs, 2, 100, budget)
        assert sorted(map(tuple, got.collect())) == plain_phrases([r[:2] for r in rows * 2], 2, 100)
    assert phrases.collocations(docs.limit(0), 2).count() == 0
    assert phrases.collocations(docs, 10**6).count() == 0


# tries


def plain_trie(convs):
    """conversation id -> list of (role, text): rows of the trie."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    value = {k: (len(m) - 1) * len(k[-1][1].encode()) if k else 0 for k, m in members.items()}
    children, leaves, saved = {k: 0 for k in members}, {k: 0 for k in members}, {k: 0 for k in members}
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k in members:
        for d in range(len(k) + 1):
            saved[k[:d]] += value[k]
            leaves[k[:d]] += children[k] == 0
    rows = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k))
        rows.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def ordered(rows):
    """(conv_id, turn, role, text) rows -> conversation id -> list of (role, text)."""
    convs = {}
    digest = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(((turn is not None, turn or 0), digest(role, text), role, text))
    return {c: [x[2:] for x in sorted(own)] for c, own in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        out[c] = turns if c == base else convs.get(base, [])[:h] + turns[h:]
    return out


@needs_data
def test_trie_query_equals_a_plain_version(spark):
    rows = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = queries.queries()["op13_conversation_trie"](spark, DATA).collect()
    assert sorted(map(tuple, got), key=str) == plain_trie(rebuilt(ordered(map(tuple, rows))))


@pytest.mark.parametrize("partitions", [1, 7])
def test_trie_of_odd_conversations(spark, partitions):
    """Long, equal, nested and diverging conversations; nulls, repeated rows, equal turns, negative ids, conversations left without turns."""
    rng = random.Random(9)
    rows = [(None, 0, "user", "nobody"), (-7, None, None, None), (-7, 2, "a", "b"), (-7, 2, "a", "b"), (-7, 2, "a", "a"), (11, 0, "user", "x"), (3, 5, "u", ""), (3, None, "u", "ü")]
    base = [("user" if k % 2 else "assistant", f"turn {rng.randrange(4)}") for k in range(700)]
    for c, n in ((20, 700), (21, 700), (22, 520), (23, 513), (24, 512), (25, 8), (26, 16), (27, 7), (2000, 700), (5000, 640)):
        rows += [(c, k, *base[k]) for k in range(n)]
    rows += [(5000, 640, "user", "another end"), (23, 600, "user", "another end")]
    for c in range(100, 160):
        rows += [(c, k, "user", f"{rng.randrange(2) if k > 5 else 0}") for k in range(rng.randrange(1, 20))]
    rng.shuffle(rows)
    turns = spark.createDataFrame([(r[0], r[1], r[2], r[3], "x") for r in rows], "conv_id long, turn long, role string, text string, conv string").repartition(partitions)
    want = ordered(rows)
    assert sorted(map(tuple, tries.conversation_trie(turns).collect()), key=str) == plain_trie(want)
    again = tries.prefix_trie(*tries.with_shared_heads(tries.numbered_turns(turns)))
    assert sorted(map(tuple, again.collect()), key=str) == plain_trie(rebuilt(want))
    assert tries.conversation_trie(turns.limit(0)).count() == 0


# texts above one chunk, for operators that other tests give short ones only


def test_long_texts_in_groups_chats_and_quality(spark):
    from tessera.llm import chats, fingerprints, neardup, quality

    many = 160_000
    long = " ".join(f"w{i % 5003}x{i // 7}" for i in range(many))
    assert len(long) > 1 << 20
    docs = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "short text"), (4, long[: len(long) // 2])], "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect()}
    words = long.split()
    sizes = [len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) for w in (words, words + ["tail"], long[: len(long) // 2].split())]
    assert got == {1: (sizes[0], 1), 2: (sizes[1], 1), 3: (1, 3), 4: (sizes[2], 4)}

    messages = spark.createDataFrame([(1, 0, "user", long), (1, 1, "user", "something else"), (1, 2, "assistant", f"> {long}\nmy answer")], "conv_id long, turn long, role string, text string")
    linked = {r.turn: (r.reply_to, r.text) for r in chats.link_quotations(messages).collect()}
    assert linked == {0: (None, long), 1: (None, "something else"), 2: (0, "my answer")}

    model = quality.fit(docs, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))
    assert {r.id: r.n_ngrams for r in quality.classify(docs, model).collect()}[1] == 2 * (2 * many - 1)

    # names that the operator uses itself
    clash = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("fingerprint"), F.lit("x").alias("text"), F.lit(1).alias("near_next"))
    marks = fingerprints.fingerprint_documents(clash, "id", "fingerprint")
    assert marks.count() == 4 and marks.select("fingerprint").distinct().count() >= 3
