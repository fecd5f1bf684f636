"""Quality classifier, language identification and the pipeline."""

import numpy as np
import public_tokenizers as P

import corpus_pipeline
from strata.llm import langid, quality, spm
from strata.llm.common import written


def test_classifier_on_labelled_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    train, held = (labels.where(f"doc_id % 3 {c} 0") for c in ("<>", "="))
    got = {r.doc_id: r for r in quality.scored(docs, train).collect()}
    truth = [(got[r.doc_id], r.quality) for r in held.collect()]
    assert sum(g.keep == (q == 1) for g, q in truth) >= 0.95 * len(truth)
    assert len(got) == docs.count() and all(0 <= g.score <= 1 for g in got.values())


def test_exchange_sums_over_all_unlabelled_rows(spark, sf_dir):
    """Sums of a round against dense matrices of every row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (-1, "", "en", "x", 0), (-1, "", "en", "x", 0)], "doc_id long, text string, lang string, source string, n_chars long"),
        allowMissingColumns=True)
    rows = [r for r in docs.collect()]
    table, _ = written(quality.features(docs.repartition(5)), "features")
    rng = np.random.default_rng(3)
    wt, wp = rng.normal(0, 0.8, quality.TEXT_DIM + 1), rng.normal(0, 1.5, quality.PAGE_DIM + 1)
    labelled = {r.doc_id: 1 for r in rows[::7] if r.doc_id is not None}
    free = [r for r in rows if r.doc_id not in labelled]
    xt = np.stack([np.r_[quality._dense(*quality.text_view(r.text or "")), 1.0] for r in free])
    xp = np.zeros((len(free), quality.PAGE_DIM + 1))
    for x, r in zip(xp, free):
        x[[*quality.page_view(r.lang, r.source, r.n_chars), -1]] = 1
    views, p = (xt, xp), (quality.sigmoid(xt @ wt), quality.sigmoid(xp @ wp))
    got = quality.handed_over(table, labelled, wt, wp)
    for (k, c), (n, g, d) in got.items():
        sure = (p[1 - k] if c else 1 - p[1 - k]) >= quality.SURE
        x = views[k][sure]
        assert n == sure.sum() > 0
        assert np.allclose(g, x.T @ (p[k][sure] - c), atol=1e-2)
        assert np.allclose(d, 0.25 * x.T @ x.sum(1), rtol=1e-3, atol=1e-2)


def test_exchange_teaches_the_page_view(spark):
    """The texts of unlabelled rows from a source without labels say what that source is worth."""
    rng = np.random.default_rng(5)
    good, bad = "steady careful reading of the river report".split(), "WIN $$$ CLICK!!! 777 cheap pills now".split()
    rows, labels = [], []
    for i in range(600):
        fine = bool(rng.random() < 0.5)
        source = ("books" if fine else "ads") if i >= 100 else "mixed"
        rows.append((i, " ".join(rng.choice(good if fine else bad, 30)), "en", source, 200))
        if i < 100:
            labels.append((i, int(fine)))
    rows += [(1000, "", "en", "books", 200), (1001, "", "en", "ads", 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    model, alone = quality.train(docs, table), quality.train(docs, table, rounds=0)
    gap = lambda m: m.margins("", "en", "books", 200)[1] - m.margins("", "en", "ads", 200)[1]
    assert abs(gap(alone)) < 1e-6 and gap(model) > 0.1
    got = {r.doc_id: r for r in quality.scored(docs, table).collect()}
    assert len(got) == len(rows) and all(got[i].keep == (t.split()[0] in good) for i, t, *_ in rows[:600])


def test_every_labelled_row_takes_part(spark, monkeypatch):
    """The fitted weights against the gradient over dense rows of 4,000 labelled documents."""
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words[20 * (i % 2):20 * (i % 2) + 40], 20)) for i in range(4000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 100) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    seen, plain = [], quality.co_train
    monkeypatch.setattr(quality, "co_train", lambda rows, *more: seen.append((rows.counts.copy(), rows.split, rows.fit([(0, None, np.zeros(quality.TEXT_DIM + 1), None)])[0],
                                                                             {r.id: r.part for r in rows.table.select("id", "part").collect()})) or plain(rows, *more))
    model = quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int"), rounds=0)
    (counts, split, w, part), = seen
    assert counts.sum() == 4000 and split and len(part) == 4000
    learn = [i for i in range(4000) if part[i] % quality.FOLDS]
    x = np.stack([np.r_[quality._dense(*quality.text_view(texts[i])), 1.0] for i in learn])
    y = np.array(learn) % 2
    start = x.T @ (0.5 - y) / len(y)
    left = x.T @ (quality.sigmoid(x @ w) - y) / len(y) + quality.L2 * np.r_[w[:-1], 0]
    assert np.abs(left).max() < 0.02 * np.abs(start).max()
    assert np.mean([(model.margins(texts[i], "en", "s", 100)[0] > 0) == i % 2 for i in range(4000)]) > 0.9


def test_few_unlabelled_rows_meet_the_labels(spark, monkeypatch):
    """The bitmap passes every labelled id and few others; a full one, which passes all, changes no result."""
    docs = spark.createDataFrame([(i if i % 50 else None, f"{'good' if i % 2 else 'bad'} word{i % 7}", "en", "s", 9) for i in range(-1000, 3000)] * 2,
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(-70, 130)] + [(None, 1), (9999, 0)], "doc_id long, quality int")
    bits = spark.sparkContext.broadcast(quality.id_map(labels.select(labels["doc_id"].alias("label_id")).where("label_id is not null")))
    passed = [r.id for r in quality.features(docs, bits).where("maybe = 1").select("id").collect()]
    wanted = {i for i in range(-70, 130) if i % 50}
    assert wanted <= set(passed) and None not in passed and len(passed) <= 2 * (len(wanted) + 5)
    want = sorted(map(str, quality.scored(docs, labels).collect()))
    monkeypatch.setattr(quality, "id_map", lambda ids: np.full(1 << quality.ID_BITS - 3, 255, np.uint8))
    assert sorted(map(str, quality.scored(docs, labels).collect())) == want and len(want) == 8000


def test_scores_come_from_the_written_features(spark, sf_dir):
    """Ids with scores need no second look at the texts; both ways of scoring agree, on odd words too."""
    odd = ["", None, "a", "É9x É9x ǅ٣ 12,5 AAAbbb...!! x" + "y" * 60, "don't DON'T \x00 \x1c tab\tend", "1 1 1 1"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame(
        [(-1 - i, t, "en", "x", 5) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    frame = quality.scored(docs, labels)
    assert "documents.parquet" not in "".join(frame.inputFiles()) and frame.count() == docs.count()
    other = {r.doc_id: r.held for r in quality.score(docs, quality.train(docs, labels), "held").select("doc_id", "held").collect()}
    assert all(abs(r[k] - other[r.doc_id][k]) < 1e-9 for r in frame.collect() for k in ("p_text", "p_page", "score"))
    for text in odd:
        words = (text or "").split()
        plain = [quality.zlib.crc32(w.lower().strip(quality._MARKS).encode()) % quality.WORD_DIM * quality.SHAPE_DIM
                 + quality.zlib.crc32(quality._shape(w).encode()) % quality.SHAPE_DIM for w in words]
        assert quality.text_view(text or "")[0].tolist() == plain


def test_classifier_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (5, 1), (7, 0), (7, 0), (7, None), (None, 1), (99, 0)], "doc_id long, quality int")
    for some in (labels, labels.limit(0), labels.where("quality = 1")):
        assert quality.scored(odd_docs, some).count() == 10
    out = quality.keep_good(odd_docs, labels.limit(0))
    assert out.columns == odd_docs.columns and out.count() == 10
    assert quality.scored(odd_docs.limit(0), labels).count() == 0


def test_language_of_pages(spark, sf_dir):
    docs, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "pages"))
    got = langid.identify(pages, docs).collect()
    assert len(got) == pages.count()
    assert sum(r.lang == r.declared for r in got) >= 0.95 * len(got)


def test_host_and_markup_decide_where_the_text_says_little(spark):
    docs = spark.createDataFrame([("the house and the garden of the king", "en"), ("das haus und der garten des koenigs", "de"), (None, "fr"), ("x", None)],
                                 "text string, lang string")
    pages = [(i, "http://a.de/de/x", '<html lang="de"><p>das haus und der garten') for i in range(20)] + \
            [(100 + i, "http://b.com/en/x", '<html lang="en"><p>the house and the garden') for i in range(20)] + \
            [(200, "http://a.de/de/y", '<html lang="de"><p>42'), (201, "http://b.com/en/y", '<html lang="en"><p>42')]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, own string")
    got = {r.page_id: r.lang for r in langid.identify(frame, docs).collect()}
    assert got[200] == "de" and got[201] == "en"


def test_language_odd_rows(spark):
    docs = spark.createDataFrame([("the of and", "en"), ("der die das", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    pages = spark.createDataFrame([(1, None, None), (2, "http://a.de/", "<p>der die"), (2, "http://[bad", "<<<>"), (None, "", "<script>" * 10_000)],
                                  "page_id long, url string, html string")
    assert langid.identify(pages, docs).count() == 4
    assert langid.identify(pages.limit(0), docs).count() == 0
    assert {r.lang for r in langid.identify(pages, docs.limit(0)).collect()} == {None}


def test_pipeline_stages(spark, sf_dir):
    """Each stage against what it must keep: the classifier's decisions, one row of each group, no benchmark
    text, no personal data, exact encodings."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out, _ = written(stage(spark, frames[-1], sf_dir), "stage")
        frames.append(out)
    assert all(f.columns == columns for f in frames[:-1])
    source, good, single, clean, private = ({r.doc_id: r.text for r in f.collect()} for f in frames[:-1])
    verdict = {r.doc_id: r.keep for r in quality.scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert set(good) == {d for d, k in verdict.items() if k}
    words = {d: t.lower().split() for d, t in good.items()}
    sets = {d: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for d, w in words.items()}
    kept = sorted(single)
    for i, a in enumerate(kept):
        for b in kept[:i]:
            assert not sets[a] or 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])
    for d in set(good) - set(single):
        assert any(100 * len(sets[d] & sets[o]) >= 80 * len(sets[d] | sets[o]) for o in good if o != d)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in t for t in clean.values() for i in items)
    assert set(private) == set(clean) and "@mail" in "".join(private.values())
    assert all(private[d] == clean[d] for d in clean if not any(c in clean[d] for c in "0123456789@"))
    m = spm.PieceModel(P.path("piece_bpe_32k.model"))
    last = frames[-1].collect()
    assert {r.doc_id for r in last} == set(private)
    assert all(m.decode(list(r.ids)) == private[r.doc_id] for r in last)


def test_pipeline_odd_rows(spark, odd_docs, sf_dir):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[1:]:
        out, _ = written(stage(spark, docs, sf_dir), "odd")
        assert name == "sentencepiece" or out.columns == odd_docs.columns
        docs = out
    assert docs.where("doc_id in (1, 5)").count() == 1
    empty = odd_docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
