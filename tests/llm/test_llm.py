"""The operators against brute force on small tables, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("tessera.llm")

from pyspark.sql import functions as F

from tessera.llm import chats, components, counts, fingerprints, neardup, packing, pieces, quality, substrings, topk, warc, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = random.Random(5)
LEXICON = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(LEXICON) for _ in range(n))


def corpus():
    """(doc_id, text, n_chars): prose, exact and near copies, shared passages, odd rows. n_chars and extra columns may say anything."""
    passage = prose(60, 1000)
    rows = [(i, prose(20 + 7 * i % 300, i)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    rows += [(110 + i, rows[i + 5][1].replace(" ", "  \n", 3).upper()) for i in range(5)]
    long = prose(400, 77).split()
    rows += [(120 + i, " ".join(long[:i * 8] + ["zz%d" % i] + long[i * 8 + 1 :])) for i in range(12)]
    rows += [(140 + i, prose(30, 200 + i) + "\n" + passage + "\t" + prose(30, 300 + i)) for i in range(8)]
    rows += [(160, None), (161, ""), (162, " \t\n"), (163, "one"), (164, "One"), (165, "a b c d"), (166, "a b c d e"), (167, "Grüße aus Köln 日本語 😀 " * 30), (168, "x" * 50_000), (169, "la " * 3000)]
    rows += [(170, prose(9000, 9)), (0, rows[0][1]), (None, rows[3][1]), (None, "lonely words in a row here")]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    table = spark.createDataFrame(corpus(), "doc_id long, text string")
    return table.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), F.lit(1).alias("hub"), F.lit(2).alias("key")).repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


# words

def test_words_match_regex():
    texts = [t for _, t in corpus()]
    found = words.Words(pa.array(texts))
    raw = found.data.tobytes()
    for i, t in enumerate(texts):
        own = [raw[a:b].decode() for a, b in zip(found.starts[found.first[i] : found.first[i + 1]], found.ends[found.first[i] : found.first[i + 1]])]
        assert own == WORD.findall(t or "")


def test_word_hash_depends_on_the_word_only():
    found = words.Words(pa.array(["a bb ccc", "ccc a", "x" * (3 << 20) + " a"]), lower=True)
    h = found.hashes
    assert h[0] == h[4] == h[6] and h[2] == h[3] and len(set(h.tolist())) == 4


# near duplicates and components

def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_match_brute_force(docs):
    rows = [r for r in corpus() if r[0] is not None]
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if j < i and a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(corpus())
    assert sorted((r.id, r.n_shingles, r.component_id, r.kept) for r in got if r.id is not None) == sorted((i, len(s), find(i), find(i) == i) for i, s in sets)
    assert all(r.component_id is None and r.kept for r in got if r.id is None)


def test_near_duplicates_of_nothing(none):
    assert neardup.near_duplicates(none).count() == 0


def test_a_large_group_of_near_copies_is_one_component(spark):
    base = prose(300, 4).split()
    rows = [(i, " ".join(w if (k * 31 + i * 17) % 97 else f"q{i}" for k, w in enumerate(base))) for i in range(150)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    assert {r.id: r.component_id for r in got} == {i: find(i) for i in sets}


def test_superminhash_estimates_and_visits_each_lane():
    one = neardup.superminhash(np.array([0]), np.array([12345], np.uint64), 1)
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(neardup.LANES))
    r = np.random.default_rng(0)
    both, a, b = (r.integers(0, 2**63, n, dtype=np.uint64) for n in (600, 100, 100))
    sets = [np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))]
    got = neardup.superminhash(np.repeat([0, 1], [700, 700]), np.concatenate(sets), 2)
    assert abs((got[0] == got[1]).mean() - 0.75) < 0.15


# substring dedup

@pytest.mark.parametrize("block_bytes", [2000, 8 << 20])
def test_substrings_match_brute_force(docs, block_bytes):
    rows = sorted((r for r in corpus() if r[0] is not None), key=lambda r: r[0])
    rows = [r for k, r in enumerate(rows) if k == 0 or r[0] != rows[k - 1][0]]
    seen, want = set(), {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if (key := tuple(w[k : k + 20])) in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        want[i] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    cut = substrings.dedup_substrings(unique, block_bytes=block_bytes)
    assert cut.columns == [*docs.columns, "n_words", "n_removed", "kept_text"]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in cut.collect()}
    assert got == want


def test_substrings_with_repeated_and_null_ids(docs, none):
    got = substrings.dedup_substrings(docs).collect()
    assert len(got) == len(corpus())
    assert sorted(r.n_removed for r in got if r.doc_id == 0)[0] == 0 and max(r.n_removed for r in got if r.doc_id == 0) == max(r.n_words for r in got if r.doc_id == 0)
    assert substrings.dedup_substrings(none).count() == 0


def test_cover_has_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


# fingerprints

def test_fingerprints_match_brute_force(docs, none):
    rows = [r for r in corpus() if r[0] is not None]
    rows = sorted(dict(rows).items(), reverse=True)
    got = {r.id: r for r in fingerprints.compare_with_next(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    assert len(got) == len(rows)
    prints = defaultdict(set)
    for k, (i, t) in enumerate(rows):
        t, follow = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + follow[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = shingles(t), shingles(edited), shingles(follow)
        for x, y, z in ((a, b, r.near_edited), (a, c, r.near_next)):
            assert abs(z - (len(x & y) / len(x | y) if x | y else 1.0)) < 0.2
        prints[t].add(r.fingerprint)
        prints[edited].add(r.edited_fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprints.compare_with_next(none).count() == 0
    assert fingerprints.compare_with_next(docs).count() == len(corpus())
    assert fingerprints.fingerprint_documents(docs).where("fingerprint is null").count() == 0


def test_packed_bits_equal_a_plain_version():
    ones = (1 << 64) - 1

    def mixed(x):
        x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & ones
        x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 & ones
        return x ^ (x >> 33)

    texts = [prose(n, n) for n in (1, 4, 5, 6, 40, 900)] + ["", " \n", "Grüße AUS Köln"]
    for text, got in zip(texts, fingerprints.packed(fingerprints.fingerprints(pa.array(texts)))):
        low = {}
        for s in shingles(text):
            own = words.Words(pa.array([" ".join(s)]), lower=True).shingles(5)[1]
            assert len(own) == 1
            h = mixed(int(own[0]) + 0x14057B7EF767814F & ones)
            low[h >> 56] = min(low.get(h >> 56, 1 << 32), h & 0xFFFFFFFF)
        digits = ""
        for b in range(256):
            look = sorted(range(256), key=lambda k: mixed(b * 256 + k + 0x5851F42D4C957F2D)) if b not in low else [b]
            full = next((k for k in look if k in low), None)
            digits += "0" if full is None else f"{mixed(low[full] + (b << 33)) & 15:x}"
        assert got == digits


# packing

def test_pieces_equal_the_tokenizer_and_sequences_are_whole(docs, none):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    held = packing.token_pieces(docs, path, with_ids=True).persist()
    packed = packing.pack(held)
    rows = packed.collect()
    want = []
    for i, t in corpus():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        for k in range(0, len(ids), 2048):
            raw = np.array(ids[k : k + 2048], "<u4").tobytes()
            want.append((str(i), k // 2048, k, len(raw) // 4, zlib.crc32(raw)))
    assert sorted((str(r.id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length, r.ids))
    for own in by.values():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert {r.sequence_id: r.ids for r in packing.sequences(packed).collect()} == {s: [i for _, _, ids in sorted(own) for i in ids] for s, own in by.items()}
    assert packing.pack_documents(none, path).count() == 0


def test_plan_uses_all_and_is_near_the_bound():
    r = random.Random(3)
    counts_ = defaultdict(int)
    for _ in range(20_000):
        counts_[min(2048, int(r.lognormvariate(5.5, 1)) + 1)] += 1
    found = packing.plan(counts_)
    used = defaultdict(int)
    for lengths, times in found:
        assert sum(lengths) <= 2048 and times > 0
        for x in lengths:
            used[x] += times
    assert used == counts_
    assert sum(t for _, t in found) <= -(-sum(k * v for k, v in counts_.items()) // 2048) + 2
    assert packing.plan({2048: 2, 1000: 1, 500: 1, 548: 1}) == [((2048,), 2), ((1000, 548, 500), 1)]


# top-k

def test_packing_keeps_columns_of_any_name(spark):
    rows = spark.createDataFrame([(i // 2, i % 2, 1 + i % 7, f"x{i}", i, i, i, i, i, i) for i in range(60)] + [(0, 0, 1, "x0", 0, 0, 0, 0, 0, 0)], "id int, piece int, length long, b string, l int, bucket int, before int, number int, rank int, offset int")
    packed = packing.pack(rows, 10)
    assert packed.columns == ["id", "piece", "length", "b", "l", "bucket", "before", "number", "rank", "sequence_id", "offset"]
    got = packed.collect()
    assert sorted((r.id, r.piece, r.length, r.b, r.l, r.rank) for r in got) == sorted((r.id, r.piece, r.length, r.b, r.l, r["rank"]) for r in rows.collect())
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 10
    assert packing.pack(rows.where("false"), 10).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=40))
def test_exact_complements_come_before_best_fit(lengths):
    """While a length has one, two or three others that fill its gap, it is used with such, the largest first."""
    left, sequences = Counter(lengths), []
    for size in range(12, 0, -1):
        while left[size]:
            left[size] -= 1
            there = sorted(left.elements(), reverse=True)
            fits = [c for n in (0, 1, 2, 3) for c in itertools.combinations(there, n) if sum(c) == 12 - size]
            left[size] += 1
            if not fits:
                break
            use = (size, *fits[0])
            left -= Counter(use)
            sequences.append(use)
    exact = [x for x, n in packing.plan(Counter(lengths), 12) for _ in range(n) if sum(x) == 12 and len(x) < 5]
    assert Counter(tuple(sorted(x)) for x in sequences) == Counter(tuple(sorted(x)) for x in exact)


def test_top_k_matches_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=6).round(2).tolist()) for i in range(150)]
    rows += [(150 + i, [0.1] * 6) for i in range(30)] + [(400, None), (401, []), (402, [None] * 6), (403, [float("nan")] * 6), (404, [1.0, 2.0]), (450, [float("inf")] * 6), (None, [0.5] * 6), (3, rows[3][1]), (50, rows[50][1]), (100, rows[7][1]), (500, []), (501, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(table, table.where("vec_id % 50 = 0")).collect()
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []  # each row of a repeated query has results of its own
    for q, a in ok:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(b) == len(a))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best[:5])]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(table.where("false"), table.where("false")).count() == 0


# archives

def test_records_that_share_an_id_and_rows_that_repeat_often(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 3)
    path = str(tmp_path / "often")
    warc.write_archives(spark.createDataFrame([(1, "http://a.example/", "same")] * 8, "page_id long, url string, html string"), path)
    found = warc.read_records(spark, path)
    rows = warc.assemble(found).collect()
    assert sorted(r.capture.record_type for r in rows) == ["response"] + ["revisit"] * 7
    twice = found.unionByName(found.withColumn("target_uri", F.lit("http://0.example/")))
    again = {tuple(map(str, r)) for r in warc.assemble(twice.repartition(5)).collect()}
    assert again == {tuple(map(str, r)) for r in warc.assemble(twice.repartition(1)).collect()} and len(again) == 8
    assert {r.capture.target_uri for r in warc.assemble(twice).collect()} == {"http://0.example/"}


def test_bounds_open_few_blocks_and_miss_nothing(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8))
    held = np.clip(np.repeat(centres, 25, axis=0) + rng.normal(scale=0.1, size=(1000, 8)), -3, 3)
    held[500:520] = held[0]  # ties
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(held)], "vec_id long, embedding array<double>").coalesce(3)
    ints = np.floor(held * 256).astype(np.int64)
    got = [tuple(r) for r in topk.top_k(table, table.where("vec_id % 20 = 0"), 4).orderBy("query_id", "rank").collect()]
    want = []
    for q in range(0, 1000, 20):
        scores = ints @ ints[q]
        order = [i for i in np.lexsort((np.arange(1000), -scores)) if i != q][:4]
        want += [(q, k + 1, i, int(scores[i])) for k, i in enumerate(order)]
    assert got == want
    parts = topk._parts(ints[:5], ints[:40])
    full = sum(parts)
    monkeypatch.setattr(topk, "RUN", 10)
    _, q_ids, ids, scores, _, bound = topk._seen(np.arange(5), np.arange(5), np.arange(40), parts, 4, 0)
    for q in range(5):
        own = scores[q_ids == q].tolist()
        assert len(own) == 4 and own == full[q, ids[q_ids == q]].tolist() == sorted(own, reverse=True)
        others = [full[q, i] for i in range(40) if i != q and i not in ids[q_ids == q]]
        assert max(others) <= max(bound[q_ids == q][0], own[-1])


def test_candidates_are_sent_once_however_many_queries_there_are(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    sent, passed, plain = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), topk._passing

    def counting(work):
        run = plain(work)

        def counted(batches):
            def seen():
                for batch in batches:
                    queries = sum(batch.column("query").to_pylist())
                    passed.add(queries)
                    sent.add(batch.num_rows - queries)
                    yield batch

            yield from run(seen())

        return counted

    monkeypatch.setattr(topk, "_passing", counting)
    rng = np.random.default_rng(4)
    table = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(640)], "vec_id long, embedding array<double>").coalesce(2)
    assert topk.top_k(table, table.where("vec_id % 10 = 0"), 4).count() == 64 * 4
    blocks = 640 // 32 + 2
    assert sent.value <= 2 * blocks and passed.value >= 4 * 16  # each candidate block once a phase, 16 query blocks to 4 lanes


def test_archives_round_trip(spark, tmp_path):
    pages = [(5, "http://a.example/x?y", "<p>one\r\n\r\nWARC/1.1</p>"), (3, "http://b.example", "<p>one\r\n\r\nWARC/1.1</p>"), (9, None, None), (8, "u\r\nBad: 1", ""), (None, "http://c.example/", "ü" * 70_000), (4, "http://d.example/", "single"), (4, "http://d.example/", "single")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "warc")
    warc.write_archives(table, path)
    found = warc.read_records(spark, path)
    assert found.groupBy("record_type").count().where("record_type in ('request', 'metadata')").agg(F.min("count"), F.max("count")).first() == (7, 7)
    rows = warc.assemble(found).select("metadata.page_id", "capture.*").collect()
    assert len(rows) == 7 and all(r.digest_ok in (True, None) for r in rows)
    by_payload = {r.payload.decode(): r.page_id for r in rows if r.record_type == "response"}
    assert by_payload == {pages[0][2]: 3, "": 8, pages[4][2]: None, "single": 4}
    assert sorted((str(r.page_id), r.payload_bytes) for r in rows if r.record_type == "revisit") == [("4", 6), ("5", 22), ("9", 0)]
    warc.write_archives(table.where("false"), str(tmp_path / "none"))
    assert warc.assemble(warc.read_records(spark, str(tmp_path / "none"))).count() == 0


def test_a_cut_archive_fails():
    raw = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <x>\r\nContent-Length: 50\r\n\r\nshort"
    with pytest.raises(EOFError):
        list(warc.records(raw, True))


# quality

def test_quality_accepts_prose_and_rejects_junk(spark):
    rows, labels = [], []
    for i in range(400):
        junk = i % 5 == 0
        text = prose(60, i)
        if junk:
            text = " ".join(w + "$$$" for w in text.split()) if i % 2 else text.upper().replace(" ", "!! ")
        rows.append((i, text))
        if i < 250:
            labels.append((i, 0 if junk else 1))
    rows += [(900, None), (901, ""), (None, prose(50, 901)), (7, rows[7][1])]
    labels += [(None, 1), (3, 1), (5000, None)]
    docs_, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs_, marks)
    got = quality.classify(docs_, model).collect()
    assert len(got) == len(rows)
    assert all(r.accepted == (r.id is None or r.id % 5 != 0) for r in got if r.id not in (900, 901))  # ids from 250 on are held out
    assert not any(r.accepted for r in got if r.id in (900, 901))
    assert quality.accepted_rows(docs_, model).count() == sum(r.accepted for r in got)
    drawn = quality.resample(quality.classify(docs_, model), 0.25)
    accepted = sum(r.accepted for r in got)
    assert abs(drawn.where("selected").count() - round(accepted / 4)) <= 1 and drawn.where("selected and not accepted").count() == 0
    everything = quality.fit(docs_, marks.where("false"))
    assert quality.classify(docs_, everything).where("accepted").count() == len(rows) - 2
    assert quality.classify(docs_.where("false"), quality.fit(docs_.where("false"), marks)).count() == 0


def test_kth_largest(spark):
    r = random.Random(1)
    values = [r.random() ** 9 for _ in range(5000)] + [0.5] * 50
    table = spark.createDataFrame([(x,) for x in values], "x double")
    for k in (1, 7, 2500, 5050):
        assert quality.kth_largest(table, "x", k, cells=16) == sorted(values, reverse=True)[k - 1]
    assert quality.kth_largest(table, "x", 6000) is None


# pieces

def test_pieces_equal_the_library_and_round_trip(docs):
    from sentencepiece import SentencePieceProcessor

    path = pieces.default_model()
    library = SentencePieceProcessor(model_file=path)
    encoded = pieces.encode(docs.select("doc_id", "text", F.col("text").alias("original")), path)
    assert all(r.ids == library.encode(r.original or "") for r in encoded.collect())
    assert pieces.decode(encoded, path).where("decoded <> coalesce(original, '')").count() == 0
    model = pieces.pieces(path)
    r = random.Random(8)
    texts = ["".join(r.choice(["the", "ing", "er", "tion", " ", "  ", "é", "日", "\n", "a", "st"]) for _ in range(r.randint(0, 200))) for _ in range(300)] + ["a" * 3000, "ab" * 2000 + "▁ x"]
    ids, at = model.encode_column(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == library.encode(texts)
    with pytest.raises(ValueError):
        pieces.encode(docs.withColumn("ids", F.lit(1)), path)


def test_windows_become_final_all_along_a_text():
    from sentencepiece import SentencePieceProcessor

    path = pieces.default_model()
    model, library = pieces.Pieces(path), SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(6)
    for text in ("".join(rng.choice(list("aeinrstlo-ü"), 6000)), "überdampf" * 700):  # no spaces: one part
        before = model.commits
        ids, at = model.encode_column(pa.array([text]))
        assert ids.tolist() == library.encode(text) and at.tolist() == [0, len(ids)]
        assert model.commits - before > len(text) // (2 * model.longest)


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_pieces_equal_the_library(tmp_path, fallback):
    """A model written by hand; scores are quarters, so that sums are exact in the library's floats, too."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    r = random.Random(12)
    proto = ModelProto()
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = 1, fallback
    norm = proto.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, True
    for piece, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        proto.pieces.add(piece=piece, score=0, type=kind)
    if fallback:
        for k in range(256):
            proto.pieces.add(piece=f"<0x{k:02X}>", score=0, type=6)
    found = {"▁"} | set("abcd") | {("▁" if r.random() < 0.3 else "") + "".join(r.choice("abcdxé") for _ in range(r.randint(2, 5))) for _ in range(150)}
    for piece in sorted(found):
        proto.pieces.add(piece=piece, score=-r.randint(4, 60) / 4, type=1)
    path = str(tmp_path / f"unigram{fallback}.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    library, model = SentencePieceProcessor(model_file=path), pieces.pieces(path)
    texts = ["".join(r.choice("abcdabcdxé \n日") for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += ["".join(r.choice("abcdxé") for _ in range(20_000)), "abcd" * 5000, "日" * 3000, ""]
    ids, at = model.encode_column(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == library.encode(texts)


# counts

def test_counts_follow_edits(spark):
    count = counts.counter(counts.default_ranks())
    r = random.Random(4)
    rows = []
    for i, (_, t) in enumerate(corpus()):
        n = len(t or "")
        rows.append((i, t, [(r.randint(0, n + 3), r.randint(0, 30), r.choice(["", "  new words ", "é日", "\n\n", prose(20, i)])) for _ in range(r.randint(0, 4))] if i % 9 else None))
    table = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,removed:int,inserted:string>>")
    counted = counts.count_tokens(table, counts.default_ranks())
    assert all(r.n_tokens == count.count(r.text or "") == sum(r.leaf_tokens) for r in counted.collect())
    for (i, t, edits), row in zip(rows, counts.recount_edits(counted, counts.default_ranks()).orderBy("doc_id").collect()):
        t = t or ""
        for start, removed, inserted in edits or ():
            start = min(start, len(t))
            t = t[:start] + inserted + t[start + removed :]
        assert (row.text, row.n_tokens, sum(row.leaf_points)) == (t, count.count(t), len(t))


# chats

def test_quotations_are_linked(spark):
    rows = [
        (1, 0, "user", "How do I  sort?\n\nAnd search?"),
        (1, 1, "assistant", "> how do i sort?\nUse sort."),
        (1, 2, "user", "> And search?\nStill open."),
        (1, 3, "assistant", "> > How do I sort?\n> Use sort.\nRight."),
        (1, 4, "user", None),
        (2, 0, "user", "> Use sort.\nFrom elsewhere."),
        (None, 0, "user", "> How"),
        (3, 1, "user", ""),
        (3, 1, "user", ""),
    ]
    linked = chats.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.turn): r for r in linked.collect()}
    assert linked.count() == len(rows)
    assert [got[1, k].reply_to for k in range(5)] == [None, 0, 0, 1, None]
    assert [got[1, k].thread for k in range(5)] == [0, 0, 0, 0, 4] and got[1, 3].depth == 2 and [got[1, k].position for k in range(4)] == [1, 2, 3, 4]
    assert got[2, 0].reply_to is None and got[1, 3].text == "Right." and got[1, 1].chat == "<|im_start|>assistant\nUse sort.<|im_end|>\n"
    assert chats.threads(linked).where("conv_id = 1 and thread = 0").first().chat.count("<|im_start|>") == 4
    assert chats.link_quotations(linked.where("false").select("conv_id", "turn", "role", "text")).count() == 0


def test_deeper_and_partial_quotations_are_linked_and_others_stay(spark):
    rows = [
        (1, 0, "u", "First line\nsecond line\nthird line"),
        (1, 1, "a", "An answer\n\nof two paragraphs"),
        (1, 2, "u", "> second line\nYes."),
        (1, 3, "a", "> > An answer\n> edited away\nSo."),
        (1, 4, "u", ">>> print(1)\nlike this"),
        (1, 5, "a", "> > > > print(1)\n> like this\nRight."),
        (1, 6, "u", "> First line\n> new words\n>\n> An answer\n\nDone."),
        (1, 7, "a", ">> Done.\n> Right.\nBoth."),
    ]
    got = {r.turn: r for r in chats.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[k].reply_to for k in range(8)] == [None, None, 0, 1, None, 4, 1, 5]
    assert [got[k].text for k in (2, 3, 4, 5)] == ["Yes.", "> edited away\nSo.", ">>> print(1)\nlike this", "Right."]
    assert got[6].text == "> new words\n\nDone." and got[7].text == "Both."


# odd tables

def test_token_operators_on_odd_tables(docs, none):
    from sentencepiece import SentencePieceProcessor

    model, ranks = pieces.default_model(), counts.default_ranks()
    assert pieces.encode(none, model).count() == 0 and pieces.decode(pieces.encode(none, model), model).count() == 0
    counted = counts.count_tokens(none, ranks)
    assert counted.count() == 0 and counts.recount_edits(counted.withColumn("edits", F.lit(None).cast("array<struct<start:int,removed:int,inserted:string>>")), ranks).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(docs.withColumnRenamed("hub", "ids"), model)
    with pytest.raises(ValueError):
        counts.count_tokens(docs.withColumnRenamed("hub", "n_tokens"), ranks)
    # longer than a chunk: words, and one word without a space
    long = [(1, prose(260_000, 5)), (2, "abc" * 120_000), (2, "abc" * 120_000)]
    table = docs.sparkSession.createDataFrame(long, "doc_id long, text string")
    assert len(long[0][1]) > words.CHUNK_BYTES
    library = SentencePieceProcessor(model_file=model)
    want = sorted((i, library.encode(t)) for i, t in long)
    assert sorted((r.doc_id, list(r.ids)) for r in pieces.encode(table, model).collect()) == want
    got = counts.count_tokens(table, ranks).collect()
    assert all(sum(r.leaf_points) == len(r.text) and sum(r.leaf_tokens) == r.n_tokens for r in got) and len(got) == 3
    cut = packing.token_pieces(table, packing.default_tokenizer()).collect()
    assert all(r.start == r.piece * packing.CAPACITY and r.length <= packing.CAPACITY for r in cut) and len([r for r in cut if r.id == 1]) > 100
    assert {r.n_removed for r in substrings.dedup_substrings(table).collect()} == {0}
    prints = [r.fingerprint for r in fingerprints.fingerprint_documents(table).orderBy("id").collect()]
    assert prints[1] == prints[2] != prints[0]
    assert fingerprints.fingerprint_documents(none).count() == 0


def test_pipeline_stages_on_odd_rows(spark, docs, none):
    import corpus_pipeline

    odd = docs.withColumns({"n_words": F.lit(1), "kept_text": F.lit("x"), "id": F.lit(3)})
    labels = [("labels", spark.createDataFrame([(i, int(i % 2)) for i in range(20)], "doc_id long, quality int"))]
    near, cut = corpus_pipeline.drop_near_duplicates(spark, odd, ""), corpus_pipeline.drop_repeated_passages(spark, odd, "")
    assert near.columns == cut.columns == odd.columns and cut.count() == odd.count()
    rows = {(r.doc_id, r.text) for r in near.collect()}
    assert (None, "lonely words in a row here") in rows and (160, None) in rows and (164, "One") not in rows
    assert all(r.n_chars == len(r.text) for r in cut.where("doc_id > 140 and doc_id < 148").collect())
    assert corpus_pipeline.drop_repeated_passages(spark, odd.drop("n_chars"), "").columns == odd.drop("n_chars").columns
    packed = corpus_pipeline.pack_sequences(spark, odd, "")
    assert packed.select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()
    kept = quality.accepted_rows(odd, quality.fit(odd, labels[0][1]))
    assert kept.columns == odd.columns and kept.where("text is null or trim(text) = ''").count() == 0
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.drop_repeated_passages, corpus_pipeline.pack_sequences):
        assert stage(spark, odd.where("false"), "").count() == 0
