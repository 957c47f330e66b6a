"""The stages against plain versions, each on what the stage before it kept."""

from collections import Counter, defaultdict

import corpus_pipeline
from heronlake.llm import langid
from heronlake.session import settle
from tests.llm import plain
from tests.llm.test_ops import packed_ids


def test_stages(spark, messy):
    docs, out = settle(messy, "test-docs"), {}
    for name, stage in corpus_pipeline.STAGES:
        nxt = settle(stage(spark, docs, "/nowhere"), f"test-{name}")
        out[name] = (docs, nxt)
        if name != "best_fit_packing":
            assert nxt.columns == docs.columns
        docs = nxt

    before, after = out["language_id"]
    pred = langid.with_language(before.select("doc_id", "text"), langid.fit(before)).collect()
    gone = [r for r in pred if r._lang == "und" or (r._letters >= 100 and r._score < 0.1)]
    assert Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in before.collect()) - Counter(r.doc_id for r in gone)

    before, after = out["line_dedup"]
    rows = before.collect()
    texts = plain.without_boilerplate([(r.doc_id, r.text, r.source) for r in rows], 10)
    want = [(r.doc_id, t) for r, t in zip(rows, texts) if t is None or t == r.text or plain.words(t)]
    assert sorted(((r.doc_id, r.text) for r in after.collect()), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.text is not None)

    before, after = out["ngram_jaccard"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    classes = plain.classes(rows, 5, 80)
    kept = Counter(r.doc_id for r in after.collect())
    assert set(kept) == {d for d, n, least in classes if n == 0 or least is None or d == least}
    assert sum(kept.values()) == len({number for *_, number in plain.numbered_classes(rows, 5, 80)})

    before, after = out["source_mixing"]
    sizes = {(r.doc_id, r.text): len(plain.words(r.text)) for r in before.collect()}
    taken = Counter((r.doc_id, r.text) for r in after.collect())
    assert max(taken.values()) <= 3 and set(taken) <= set(sizes) and all(sizes[k] for k in taken)
    assert sum(sizes.values()) * 0.9 <= sum(sizes[k] * n for k, n in taken.items()) <= sum(sizes.values())

    before, after = out["best_fit_packing"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert after.agg({"length": "sum"}).first()[0] == sum(len(ids) for _, ids in packed_ids(rows))
    ends = defaultdict(int)
    for r in sorted(after.collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 1024


def test_empty_input(spark, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, "/nowhere"), f"test-{name}")
        assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
