"""The registered queries over the smallest test tables: against SQL where there is some, else against a plain version."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tessera.llm")

import corpus_pipeline
from tessera.llm import counts, packing, pieces, quality, queries, words

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    import duckdb

    base = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        base.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = base.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want.fetchall()))


def test_sentencepiece_query(spark, texts):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=pieces.default_model())
    rows = queries.queries()["op1_sentencepiece"](spark, DATA).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows:
        ids = np.array(library.encode(texts[r.doc_id]), "<u4")
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_token_count_query(spark, texts):
    count = counts.counter(counts.default_ranks()).count
    for r in queries.queries()["op3_token_counts"](spark, DATA).collect():
        t = texts[r.doc_id]
        assert r.n_tokens_before == count(t)
        n, size = len(t), min(len(t) // 50 + 1, 200)
        head = t[:size]
        for k in (1, 2, 3):
            at = n * k // 4
            t = t[:at] + (head if k != 3 else "") + t[at + (size if k != 2 else 0) :]
        assert (r.n_tokens_after, r.edited_sha256) == (count(t), hashlib.sha256(t.encode()).hexdigest())


def test_fingerprint_query(spark, texts):
    rows = {r.doc_id: r for r in queries.queries()["op5_fingerprints"](spark, DATA).collect()}
    order = sorted(texts, reverse=True)
    assert set(rows) == set(order)

    def shingles(t):
        w = WORD.findall(t.lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)}

    errors = []
    for i, follow in zip(order, order[1:] + order[:1]):
        t, cut = texts[i], len(texts[i]) // 3
        edited = t[: len(t) - cut] + texts[follow][:cut]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, rows[i].near_edited), (texts[follow], rows[i].near_next)):
            a, b = shingles(t), shingles(other)
            errors.append(near - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06 and np.abs(errors).max() < 0.3


def packed_well(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    held, want, by = {(r.doc_id, r.piece): r for r in rows}, 0, defaultdict(list)
    for i, t in texts.items():
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            r, part = held[i, k // 2048], ids[k : k + 2048]
            assert (r.start, r.length, r.ids_crc32) == (k, len(part), zlib.crc32(part.tobytes()))
            want += 1
    assert want == len(rows)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        ends = np.cumsum([0] + [n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == ends[:-1].tolist() and ends[-1] <= 2048
    assert len(by) <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 2


def test_packing_query(spark, texts):
    packed_well(queries.queries()["op6_best_fit_packing"](spark, DATA).collect(), texts)


# the quality model in plain Python: word strings, dictionaries and integers

_M64 = (1 << 64) - 1


def _mixed(x):
    for k in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> 33)) * k & _M64
    return x ^ (x >> 33)


def _plain_ngrams(text):
    """Buckets of words, pairs of words, shapes and pairs of shapes of one text."""
    found, before = [], None
    mark = lambda b: b if 33 <= b < 127 and not chr(b).isalnum() else 0
    hashes, shapes = [], []
    for word in WORD.findall(text):
        raw = word.encode()
        low = bytes(b + 32 if 65 <= b < 91 else b for b in raw)
        value = sum(int(words._BYTE[b]) * pow(int(words._BASE), i, 1 << 64) for i, b in enumerate(low)) + len(raw) * 0xD6E8FEB86659FD93
        hashes.append(_mixed(value & _M64))
        upper, lower = sum(65 <= b < 91 for b in raw), sum(97 <= b < 123 for b in raw)
        if not upper and not lower:
            case = 0
        elif not upper:
            case = 1
        elif not lower:
            case = 2 if upper > 1 else 3
        else:
            case = 3 if 65 <= raw[0] < 91 and upper == 1 else 4
        shape = case + 8 * any(48 <= b < 58 for b in raw) + 16 * (low == before)
        for k, b in enumerate((raw[0], raw[-1], raw[-2] if len(raw) > 1 else raw[0])):
            shape += mark(b) << (8 + 8 * k)
        shapes.append(_mixed((shape + (1 << 40)) & _M64))
        before = low
    for own in (hashes, shapes):
        found += own + [_mixed((3 * a + b) & _M64) for a, b in zip(own, own[1:])]
    return [x % quality.BUCKETS for x in found]


def _plain_model(spark, texts):
    """Of a plain version: marks, hashes of ids, n-grams, scores and the accepted ids."""
    marks = {}
    for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality is not null").collect():
        marks[r.doc_id] = min(r.quality, marks.get(r.doc_id, 1))
    ids = spark.createDataFrame([(i,) for i in texts], "id long")
    hashed = {r.id: r.h for r in ids.select("id", F.xxhash64("id", F.lit(quality.SEED)).alias("h")).collect()}
    grams = {i: _plain_ngrams(t) for i, t in texts.items()}
    raw, target = Counter(), Counter()
    for i, own in grams.items():
        raw.update(own)
        if marks.get(i) == 1 and hashed[i] % 2 == 0:
            target.update(own)
    sizes = [sum(c.values()) + quality.BUCKETS for c in (raw, target)]
    ratio = lambda b: math.log((target[b] + 1) / sizes[1]) - math.log((raw[b] + 1) / sizes[0])
    score = {i: sum(map(ratio, own)) / len(own) if own else None for i, own in grams.items()}

    held = sorted((score[i], y) for i, y in marks.items() if i in score and hashed[i] % 2 and score[i] is not None)
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    cuts = [-math.inf] + [(a[0] + b[0]) / 2 for a, b in zip(held, held[1:]) if a[0] < b[0]]
    worth = lambda c: (sum(s >= c for s in good) / len(good) + sum(s < c for s in bad) / len(bad)) / 2
    best = max(map(worth, cuts))
    cut = min(c for c in cuts if worth(c) > best - 1e-12)
    return hashed, grams, score, {i for i, s in score.items() if s is not None and s >= cut}


def test_quality_query_equals_a_plain_version(spark, texts):
    hashed, grams, score, accepted = _plain_model(spark, texts)
    rows = {r.doc_id: r for r in queries.queries()["op9_quality"](spark, DATA).collect()}
    assert set(rows) == set(texts)
    assert all(rows[i].n_ngrams == len(own) and (rows[i].quality_score is None if not own else abs(rows[i].quality_score - score[i]) < 1e-9) for i, own in grams.items())
    assert {i for i, r in rows.items() if r.accepted} == accepted
    noise = {i: -math.log(-math.log((((hashed[i] & _M64) >> 11) + 0.5) / 2**53)) for i in accepted}
    keys = {i: len(grams[i]) * score[i] + noise[i] for i in accepted}
    assert all(abs(rows[i].gumbel_key - keys[i]) < 1e-5 for i in accepted)
    assert {i for i, r in rows.items() if r.selected} == set(sorted(keys, key=keys.get)[-round(len(keys) / 2) :])


def test_quality_query(spark, texts):
    rows = queries.queries()["op9_quality"](spark, DATA)
    assert rows.count() == len(texts)
    marks = rows.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    right = [r.accepted == (r.quality == 1) for r in marks]
    assert np.mean(right) > 0.9
    accepted = sum(r.accepted for r in rows.collect())
    assert rows.where("selected").count() == round(accepted / 2)


def test_pipeline_stages_equal_plain_versions(spark, texts, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, held = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, DATA)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        held.append(docs.collect())
        assert docs.columns == names or k == 3
    first, second, third, last = held
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in first}
    assert np.mean([(i in kept) == (q == 1) for i, q in marks.items()]) > 0.9
    assert kept == _plain_model(spark, texts)[3]

    # near-duplicates of what the first stage kept
    def shingles(t):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    sets, parent = {r.doc_id: shingles(r.text) for r in first}, {r.doc_id: r.doc_id for r in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    assert sorted(r.doc_id for r in second) == sorted(i for i in parent if find(i) == i)

    # repeated windows of what the second stage kept
    seen, want = set(), {}
    for r in sorted(second, key=lambda r: r.doc_id):
        w = WORD.findall(r.text)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if (key := tuple(w[k : k + 20])) in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        want[r.doc_id] = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else r.text
    assert {r.doc_id: r.text for r in third} == want
    packed_well(last, want)
