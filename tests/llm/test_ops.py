"""Each operator on ordinary and on difficult rows: against SQL, a plain version, or a property of the result."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from heronlake.llm import chat, jaccard, langid, lines, lzprint, mixing, packing, suffixes, topk, toxicity
from heronlake.sources.tables import table
from tests.llm import plain
from tests.llm.conftest import messy_rows
from tests.oracle import connect, differences


def texts(rows):
    return [(r[0], r[1]) for r in rows]


# --- 1 toxicity

def test_toxicity_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    toxic = [r.score for r in held if r.toxic]
    clean = [r.score for r in held if not r.toxic]
    assert sum(s >= 0.5 for s in toxic) >= 0.85 * len(toxic)
    assert sum(s >= 0.5 for s in clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def plain_value(model, buckets):
    """The machine's value by a loop over all pairs."""
    w = model.weights.astype(float)
    value = model.bias + sum(w[i, 0] for i in buckets)
    return value + sum(float(w[i, 1:] @ w[j, 1:]) for k, i in enumerate(buckets) for j in buckets[:k])


@pytest.mark.parametrize("alike", [True, False])
def test_toxicity_learns_pairs(spark, alike):
    """Neither word tells anything alone, only both together (or only one of them) do: no sum of single weights can say that."""
    held = [np.array(x) for x in ([0], [1], [0, 1], [2])] * 60
    toxic = np.array([0.0, 0.0, 1.0, 1.0] * 60)  # 2: neither word
    m = toxicity.fit_machine(3, held, toxic if alike else 1 - toxic, toxicity.Settings(epochs=60, patience=60))
    p = [toxicity.sigmoid(plain_value(m, x)) for x in ([0], [1], [0, 1], [2])]
    assert min(p[2:]) > 0.9 > 0.1 > max(p[:2]) if alike else min(p[:2]) > 0.7 > 0.4 > max(p[2:])


def pair_corpus(n, fill):
    """Texts that are toxic if they have both or neither of two words, among `fill` others."""
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        words = [f"filler{rnd.randrange(fill)}" for _ in range(12)] + ["zebra"] * a + ["quartz"] * b
        words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
        rnd.shuffle(words)
        rows.append((i, " ".join(words), int(a == b)))
    return rows


def test_toxicity_finds_a_pair_among_thousands_of_words(spark):
    rows = pair_corpus(5_000, 6_000)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    held = [(got[i].predicted, t) for i, _, t in rows if got[i].held_out]
    assert len(held) > 800 and sum(p == t for p, t in held) >= 0.95 * len(held)


def test_toxicity_scores_are_those_of_all_pairs(spark, messy):
    """Scores against a double loop over the pairs of a text, a long one among them."""
    model = toxicity.Model(-0.3, np.random.default_rng(4).normal(0, 0.05, (toxicity.BUCKETS, 9)).astype(np.float32))
    rows = texts(messy_rows())[:40] + [(1_000, "Word " * 300_000 + "other words"), (1_001, None), (1_001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), round(r.score, 5)) for r in toxicity.score(df, model).collect())
    want = sorted((str(d), round(float(toxicity.sigmoid(plain_value(model, sorted(toxicity.text_buckets(t or ""))))), 5)) for d, t in rows)
    assert [g[0] for g in got] == [w[0] for w in want] and all(abs(g[1] - w[1]) < 2e-3 for g, w in zip(got, want))


def test_toxicity_difficult(spark, messy, nothing):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)] + [(3, 0), (None, 1), (4, None), (999, 1)],
                                   "doc_id long, toxic int")
    rows = toxicity.classify(messy, labels).collect()
    assert len(rows) == len(messy_rows()) and all(0 <= r.score <= 1 for r in rows)
    empties = {r.score for r in rows if r.doc_id in (200, 201, 202)}
    assert len(empties) == 1
    assert toxicity.classify(messy, labels.filter("false")).filter("predicted = 1").count() == 0
    assert toxicity.classify(nothing, labels).count() == 0


# --- 2 fingerprints

@given(st.text("ab c", max_size=80), st.text("abc", max_size=60))
def test_edited_fingerprint_is_that_of_the_edited_text(text, other):
    edited, found = lzprint.Parsed(text).edited(other)
    assert edited == text[:len(text) - len(text) // 2] + other[:len(text) // 2]
    assert lzprint.encode(found) == lzprint.fingerprint(edited)
    assert lzprint.encode(lzprint.Parsed(text).print) == lzprint.fingerprint(text)


@given(st.text("ab", max_size=200))
def test_phrases_make_up_the_text(text):
    found, rest = lzprint.parse(text, set())
    assert "".join(found) + rest == text and len(set(found)) == len(found)
    assert all(len(p) == 1 or p[:-1] in found[:i] for i, p in enumerate(found))


def neighbours(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return [(a, order[(i + 1) % len(order)]) for i, a in enumerate(order)]


def test_edit_test(messy, nothing, spark, rows_of):
    want = []
    for (doc_id, text), (_, other) in neighbours(texts(messy_rows())):
        text, other = text or "", other or ""
        edited = text[:len(text) - len(text) // 2] + other[:len(text) // 2]
        a, b, c = (lzprint.fingerprint(t) for t in (text, edited, other))
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b,
                     lzprint.likeness(lzprint.decode(a), lzprint.decode(b)), lzprint.likeness(lzprint.decode(a), lzprint.decode(c))))
    assert rows_of(lzprint.edit_test(messy)) == sorted(want, key=repr)
    assert lzprint.edit_test(nothing).count() == 0
    alone = lzprint.edit_test(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and alone.near_next == 1.0
    prints = dict(rows_of(lzprint.fingerprints(messy.filter("doc_id in (9, 300, 301)"))))
    assert prints[300] == prints[301]


def test_likeness_follows_the_overlap(small_documents):
    row = lzprint.edit_test(small_documents).agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert row.e > 0.35 > 0.2 > row.n
    a, b = set(range(0, 3000)), set(range(1000, 4000))
    h = lambda s: lzprint.least(toxicity.np.array([zlib.crc32(str(x).encode()) for x in s], "u4"), 256)
    assert abs(lzprint.likeness(h(a), h(b), 256) - 0.5) < 0.1


# --- 3 chat

TRICKY = st.text(alphabet="<|\\>ai\n", max_size=30)


@given(TRICKY, TRICKY)
def test_turn_round_trip(role, text):
    segments = chat.format_turn(chat.CHATML, role, text)
    assert chat.read_turn(chat.CHATML, segments) == (role, text, text if role == "assistant" else "")
    assert "<|" not in segments[1]["text"]


def test_chat_rows_and_sql(spark, rows_of):
    data = [(1, 0, "user", "a"), (1, 1, "assistant", "<|im_end|>\\<\\|x"), (1, 1, "assistant", "<|im_end|>\\<\\|x"), (2, 0, "system", ""),
            (2, 1, "user", None), (2, 2, "assistant", "é" * 3000), (3, 0, "assistant", "first"), (4, 0, None, "x"),
            (None, 0, "user", "no id"), (None, None, "assistant", "b"), (5, 0, "tool", "y")]
    df = spark.createDataFrame([(*r, "z") for r in data], "conv_id long, turn long, role string, text string, valid string")
    got = rows_of(chat.read_back(chat.format_turns(df)))
    con = connect("/root/testdata/sf0.001")
    con.execute("DROP VIEW conversations")
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", data)
    # SQL sorts null turns last where Spark has them first: the one conversation that has such a turn is looked at below
    verdict, _, _ = differences(chat.read_back(chat.format_turns(chat.with_probe(spark, df))).filter("conv_id is not null"), con,
                                f"SELECT * FROM ({chat.SQL}) WHERE conv_id IS NOT NULL")
    assert verdict == "ok"
    by = {r[0]: r for r in got}
    assert by[None][2] == hashlib.sha256(b"assistant\nb\nuser\nno id\n").hexdigest()
    assert [by[i][-1] for i in (1, 2, 3, 4, 5)] == [False, True, False, False, False]
    assert chat.read_back(chat.format_turns(df.filter("false"))).count() == 0


# --- 4 top-k

def test_topk_ties_copies_and_bad_rows(spark, rows_of):
    nan, inf = float("nan"), float("inf")
    data = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-1.0, 2.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0]),
            (50, [0.1, 0.1]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]),
            (100, [1.0]), (8, [3.0]), (150, []), (9, [0.5, 0.25]), (10, [0.5, 0.25]), (11, [0.5, 0.25]), (12, [1e12, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<double>, score string")
    want = []
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in data
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for a, (i, q) in enumerate(good):
        if i % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(q, c)), j) for b, (j, c) in enumerate(good) if a != b and len(c) == len(q))[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    for shard_rows in (3, 16_384):
        assert rows_of(topk.search(df, shard_rows=shard_rows, query_rows=2)) == sorted(want, key=repr)
    assert topk.search(df.filter("false")).count() == 0


def test_products_stay_exact():
    q, c = np.array([[2**40, 1]]), np.array([[2**20, 1], [2**40, 3]])
    assert topk.products(q, c).tolist() == [[2**60 + 1, 2**63 - 1]]


# --- 5 mixing

def test_mixing_difficult(messy, messy_con, nothing):
    got = mixing.mix(messy).select("doc_id", "size", "source_size", "target", "taken")
    # equal (id, source, size) rows may swap places; ids are not unique here, so compare sums per id and source size
    totals = got.groupBy("doc_id", "source_size").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.max("target").alias("target"))
    sql = (f"SELECT doc_id, source_size, sum(size)::BIGINT AS size, sum(taken)::BIGINT AS taken, max(target) AS target "
           f"FROM ({mixing.SQL}) GROUP BY ALL")
    verdict, _, _ = differences(totals, messy_con, sql)
    assert verdict == "ok"
    assert mixing.mix(nothing).count() == 0


def test_mixing_comes_near_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{0 if i % 3 == 0 else i % 9}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    per = defaultdict(lambda: [0, 0.0])
    for r in got:
        per[r.source][0] += r.taken
        per[r.source][1] = r.target
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size
    assert all(abs(t - target) <= 40 for t, target in per.values())
    assert abs(sum(t for _, t in per.values()) - sum(r.size for r in got)) < 40
    out = mixing.mixed_documents(df)
    assert Counter(r.doc_id for r in out.collect()) == {r.doc_id: r.taken // r.size for r in got if r.taken}
    assert out.columns == df.columns


def test_water_level_by_bisection(spark):
    sizes = [100, 5, 40, 3, 900, 2, 2, 70]
    df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    weights, low, high = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))], 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(w * mid, 3 * s) for w, s in zip(weights, sizes)) < sum(sizes) else (low, mid)
    assert all(abs(got[f"s{i}"] - min(w * low, 3 * s)) < 1e-6 for i, (w, s) in enumerate(zip(weights, sizes)))


# --- 6 line dedup

def test_lines_difficult(messy, nothing):
    rows = messy_rows()
    want = plain.without_boilerplate([(r[0], r[1], r[3]) for r in rows], 10)
    got = lines.dedup(messy).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(zip([r[0] for r in rows], want), key=repr)
    assert all(r.n_lines == (len(next(x[1] for x in rows if x[0] == r.doc_id).split("\n"))) for r in got
               if r.doc_id is not None and r.doc_id < 5)
    assert sum(r.n_removed for r in got) > 60
    assert lines.dedup(nothing).count() == 0


def test_lines_of_rows_with_one_id(spark):
    """Different texts under one id and under null ids lose only their own boilerplate lines."""
    menu = [(i, f"own {i}\nmenu\nfoot", f"s{i}") for i in range(12)]
    rows = menu + [(50, "menu\na\nb\nfoot", "s1"), (50, "c\nd\nmenu\ne", "s2"), (50, "f\ng\nh\ni", "s3"),
                   (None, "k\nmenu\nl\nm", "s4"), (None, "n\no\nfoot\nmenu", None), (None, "menu\nfoot", "s5"),
                   (None, "p\nq\nr\ns", "s6"), (None, "p\nq\nr\ns", "s7"), (None, None, "s8"), (50, "menu\na\nb\nfoot", "s9")]
    df = spark.createDataFrame([(*r[:2], None, r[2], None) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = lines.dedup(df).collect()
    want = plain.without_boilerplate(rows, 10)
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(((r[0], t) for r, t in zip(rows, want)), key=repr)
    assert sum(r.n_removed for r in got) == sum(len(r[1].split("\n")) - len(t.split("\n")) if t else 2
                                                for r, t in zip(rows, want) if r[1] is not None)
    kept = corpus_pipeline.line_dedup(spark, df, "/nowhere").collect()
    assert sorted((r.text for r in kept), key=repr) == sorted((t for t in want if t != ""), key=repr)


@pytest.mark.parametrize("lg_k", [4, 12])
def test_lines_near_the_threshold_are_exact(spark, lg_k):
    """Lines on 30 to 70 sites, with a threshold of 50 and sketches that err by a quarter: none may be decided wrongly."""
    data = [(n * 1000 + i, f"line {n}", f"site {i}") for n in range(30, 71) for i in range(n)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.text for r in lines.dedup(df, min_sites=50, lg_k=lg_k).filter("n_removed = 0").groupBy("text").count().filter("count > 1").collect()}
    assert got == {f"line {n}" for n in range(30, 50)}


def test_a_text_of_very_many_lines(spark):
    """200,000 lines, most of them boilerplate: work in proportion to the lines."""
    import time

    shared = [f"shared {i % 50}" for i in range(190_000)]
    rows = [(0, "\n".join(shared + [f"own {i}" for i in range(10_000)]), "s0")]
    rows += [(i, "\n".join(f"shared {k}" for k in range(50)), f"s{i}") for i in range(1, 13)]
    start = time.time()
    got = {r.doc_id: r for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert time.time() - start < 60
    assert got[0].n_removed == 190_000 - 50 and got[0].text.split("\n")[50:] == [f"own {i}" for i in range(10_000)]
    assert all(got[i].n_removed == 50 and got[i].text == "" for i in range(1, 13))


# --- 7 packing

@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_is_gapless_and_complete(lengths):
    counts = Counter(lengths)
    runs = packing.plan(dict(counts), 64)
    held, done = defaultdict(list), Counter()
    for length, first, count, sequence, each, offset in runs.tolist():
        assert first == done[length]
        done[length] += count
        for i in range(count):
            held[sequence + i // each].append((offset + i % each * length, length))
    assert done == counts
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64 and sum(3 * n > 64 for _, n in parts) <= 2
    best = first_fit_decreasing(lengths, 64)
    assert len(held) <= best + 1 + best // 20


def first_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        for i, free in enumerate(bins):
            if free >= n:
                bins[i] -= n
                break
        else:
            bins.append(capacity - n)
    return len(bins)


def packed_ids(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [(d, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for d, x in rows]


def test_packing_rows(messy, nothing):
    got = packing.pack(messy).collect()
    pieces = []
    for doc_id, ids in packed_ids(texts(messy_rows())):
        for i, (start, length) in enumerate(packing.cut(len(ids))):
            pieces.append((doc_id, i, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(pieces, key=repr)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024
    assert len(held) <= first_fit_decreasing([r.length for r in got], 1024)
    assert packing.pack(nothing).count() == 0


@given(st.text(alphabet=" \t\n  a'é1.Z日", max_size=40))
def test_fast_ids_are_the_tokenizer_s(text):
    e = packing.encoder("byte_bpe_50k", None)
    assert np.frombuffer(e.ids(text), "<u4").tolist() == e.whole.encode(text, add_special_tokens=False).ids


# --- 8 Jaccard join

@pytest.mark.parametrize("how", [jaccard.Settings(), jaccard.NEAR])
def test_classes(messy, rows_of, how, monkeypatch):
    rows = texts(messy_rows())
    want = sorted(plain.classes(rows, how.words, how.num), key=repr)
    assert rows_of(jaccard.classes(messy, how)) == want


def test_classes_in_chunks(messy, rows_of, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 4)  # buckets of near copies are dealt out in pairs of chunks
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", 300)
    rows = texts(messy_rows())
    assert rows_of(jaccard.classes(messy)) == sorted(plain.classes(rows, 3, 90), key=repr)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_of_one_id_do_not_multiply(spark, rows_of, monkeypatch, doc_id):
    """Each node that may link moves its own text only, also if all rows share an id or have none."""
    moved, plainly = [], jaccard.verified_links

    def spy(rows, s):
        moved.append(rows.select("node").collect())
        return plainly(rows, s)

    monkeypatch.setattr(jaccard, "verified_links", spy)
    rows = [(doc_id, " ".join(f"w{g}x{i}" for i in range(60 + k))) for g in range(10) for k in range(3)]
    got = rows_of(jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")))
    s = jaccard.Settings()
    assert got == sorted(plain.classes(rows, s.words, s.num, s.den), key=repr)
    assert len(moved[0]) == len({r.node for r in moved[0]}) == 30


def test_bitmaps_never_drop_a_link():
    """Sets of 300 to 3,000 shingles, some near one another: whatever links passes the bound, and most of the rest does not."""
    rng, s = np.random.default_rng(2), jaccard.Settings()
    sets = []
    for size in (300, 500, 520, 1_000, 1_050, 3_000):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for change in (0, 5, 20, 60):
            other = base.copy()
            other[:size * change // 1000] = rng.integers(0, 1 << 63, size * change // 1000, dtype=np.uint64)
            sets.append(np.unique(other[:size - change // 10]))
        sets += [np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(3)]
    sets.sort(key=len)
    n = np.array([len(x) for x in sets])
    passed = linked = 0
    for bits in (jaccard.Bitmaps([jaccard.bitmap(x, jaccard.wide(len(x))).view(np.uint64) for x in sets]),
                 jaccard.Bitmaps([jaccard.bitmap(x).view(np.uint64) for x in sets])):
        for i, a in enumerate(sets):
            near = set(jaccard.near_pairs(n, bits, i, s).tolist())
            for j in range(i + 1, len(sets)):
                common = len(np.intersect1d(a, sets[j]))
                if 100 * common >= 90 * (len(a) + len(sets[j]) - common):
                    assert j in near
                    linked += 1
            passed += len(near)
        if linked and bits.rows[-1].shape[1] > 32:
            assert passed - linked < 0.05 * len(sets) * (len(sets) - 1) / 2
    assert linked > 30


def test_one_of_each(messy, nothing):
    rows = messy_rows()
    kept = jaccard.one_of_each(messy)
    assert kept.columns == messy.columns
    got = Counter(r.doc_id for r in kept.collect())
    want = Counter()
    for doc_id, n, least in plain.classes(texts(rows), 5, 80):
        if n == 0:
            want[doc_id] += 1
        elif least is None or doc_id == least:
            want[doc_id] = 2 if doc_id == 6 else 1  # id 6 has two texts of different classes
    assert got == want
    assert jaccard.classes(nothing).count() == 0 and jaccard.one_of_each(nothing).count() == 0


def test_components_of_a_long_path(spark):
    from heronlake.llm.components import components

    path = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(path).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


# --- 9 language

def test_language_held_out(small_documents):
    rows = langid.identify(small_documents).join(small_documents.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_language_difficult(messy, nothing, rows_of):
    got = rows_of(langid.identify(messy))
    assert len(got) == len(messy_rows())
    und = {r[0] for r in got if r[2] == "und"}
    assert und == {None, 200, 201, 202, 206} and all(r[3] == 0 for r in got if r[2] == "und")
    assert langid.identify(nothing).count() == 0
    assert {r.lang_pred for r in langid.identify(messy.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.known_language(messy).columns == messy.columns


def test_wide_alphabets_take_the_other_route():
    s = langid.Settings(dimension=64)
    wide = "".join(chr(0x4E00 + i) for i in range(400))
    a, _ = langid.bundle([wide, "abc abd"], s)
    b = np.stack([langid.bundle([t], s)[0][0] for t in (wide, "abc abd")])
    assert np.allclose(a, b)


# --- 10 suffixes

def test_passages(messy, nothing, rows_of, monkeypatch):
    rows = texts(messy_rows())
    want = sorted(plain.removed_passages(rows), key=repr)
    assert rows_of(suffixes.dedup(messy)) == want
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 3_000)
    assert rows_of(suffixes.dedup(messy)) == want
    assert suffixes.dedup(nothing).count() == 0


@pytest.mark.parametrize("hot", [0, 3, 20])
def test_passages_of_hot_seeds(messy, rows_of, monkeypatch, hot):
    """Settled string by string or in buckets, in small pieces and blocks: always the same result."""
    for name, value in {"HOT": hot, "RUNS_PIECE": 5, "BLOCK_BYTES": 3_000, "BUCKET_SUFFIXES": 40}.items():
        assert hasattr(suffixes, name)
        monkeypatch.setattr(suffixes, name, value)
    assert rows_of(suffixes.dedup(messy)) == sorted(plain.removed_passages(texts(messy_rows())), key=repr)


def test_buckets_do_not_grow_with_the_documents_of_a_passage(spark, rows_of, monkeypatch):
    """A bucket gets a block's context once, however many documents hold it."""
    sent, plainly = [], suffixes.intervals

    def spy(rows):
        unpack = suffixes.zstandard.ZstdDecompressor()
        sent.append(sum(len(unpack.decompress(r.payload)) for r in rows.collect()))
        return plainly(rows)

    monkeypatch.setattr(suffixes, "intervals", spy)
    passage, parts = " ".join(str(i * i) for i in range(100)), [" ".join(str(i ** 3 + k) for i in range(40, 60)) for k in range(4)]
    for n in (64, 256):  # different documents whose borders between parts repeat as well
        rows = [(i, "".join(parts[i * 11 % 256 >> k & 3] for k in (0, 2, 4, 6)) + passage) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        assert rows_of(suffixes.dedup(df)) == sorted(plain.removed_passages(rows), key=repr)
    assert sent[1] < 1.5 * sent[0]


@given(st.lists(st.binary(min_size=0, max_size=12), max_size=40))
def test_multikey_order(rows):
    matrix = np.zeros((len(rows), 19), np.uint8)
    for i, r in enumerate(rows):
        matrix[i, :len(r)] = np.frombuffer(r, np.uint8)
    order = suffixes.multikey_order(matrix)
    assert [matrix[i].tobytes() for i in order] == sorted(m.tobytes() for m in matrix)


@given(st.text("ab", min_size=50, max_size=300))
def test_every_string_holds_a_synchronizing_place(text):
    body = np.frombuffer(text.encode(), np.uint8)
    place, _ = suffixes.synchronizing(body, np.array([len(body)]))
    for i in range(len(body) - suffixes.LENGTH + 1):
        assert ((place >= i) & (place <= i + suffixes.LENGTH - suffixes.SEED)).any()


# --- all together

@pytest.mark.parametrize("key", [k for k in entry.oracle_sql() if re.match(r"op\d", k)])
def test_same_as_sql(key, spark):
    con = connect("/root/testdata/sf0.01")
    verdict, _, _ = differences(entry.queries()[key](spark, "/root/testdata/sf0.01"), con, entry.oracle_sql()[key])
    assert verdict == "ok"


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in entry.queries()} and "pipeline" in entry.queries()


def test_mixing_stays_native(spark):
    df = mixing.mix(table(spark, "/root/testdata/sf0.001", "documents"))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
