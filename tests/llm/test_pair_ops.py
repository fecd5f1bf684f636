"""WARC, lattice near-duplicates, MinHash near-duplicates, decontamination: brute force and odd rows."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest

from strata.llm import decontam, lattice, minhash, warc
from strata.llm.common import connected_components
from strata.session import scratch_path


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    return [find(x) for x in range(n)]


def least(ids, links):
    r, low = roots(len(ids), links), {}
    for i, x in enumerate(r):
        if ids[i] is not None:
            low[x] = min(low.get(x, ids[i]), ids[i])
    return [low.get(x) for x in r]


def test_connected_components(spark):
    pick = random.Random(0)
    links = [(i, i + 1) for i in range(60)] + [(pick.randrange(100, 400), pick.randrange(100, 400)) for _ in range(180)] + [(7, 7), (500, 999)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    expected = least(list(range(1000)), links)
    assert got == {i: expected[i] for i in got} and {x for a, b in links if a != b for x in (a, b)} == set(got)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1 -------------------------------------------------------------------------------------------
PAGES = [(1, "u", "aa"), (2, "u", "aa"), (2, "u", "aa"), (3, "u", None), (4, None, ""), (5, "v", "日本\r\nWARC/1.1\r\n"), (None, "n", "aa"),
         (None, "n", "q"), (7, "x", "uniq"), (2, "w", "other"), (9, "z", "zz"), (9, "z", "zz"), (10, "long", "h" * 200_000)]


def warc_rows(rows):
    by = collections.defaultdict(list)
    for i, _, html in rows:
        by[(html or "").encode()].append(i)
    out = []
    for payload, ids in by.items():
        ids = sorted(ids, key=lambda x: (x is not None, x or 0))
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out += [(i, len(payload), sha, "revisit", ids[-1]) for i in ids[:-1]] + [(ids[-1], len(payload), sha, "response", None)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 900, "file_bytes": 500}])
def test_warc_round_trip(spark, sizes):
    pages = spark.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id long, url string, html string, payload string, kind int")
    out, again = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    files = warc.write(pages, out, **sizes).orderBy("shard", "file").collect()
    got = warc.read(spark, out).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == warc_rows(PAGES)
    assert all(r.payload.decode() == "h" * 200_000 for r in got if r.page_id == 10)
    same = warc.write(pages.repartition(5), again, **sizes).orderBy("shard", "file").collect()
    assert [(f.final, f.sha1) for f in files] == [(f.final, f.sha1) for f in same]  # the same files whatever the input's order
    assert len(files) > 3 or not sizes


def test_warc_addresses_cannot_change_headers(spark):
    """Line breaks, header lines, escapes and white space in addresses: read back as they were, beside a record each."""
    urls = ["http://a\nWARC-Type: revisit", "..\nX-Id: 99", "x\r\n\r\nbody", "\n", " http://b ", "http://c/%0A%25", "%\n%0A", "http://d/\x85\u2028é", "\x00", None, ""]
    rows = [(None if i == 1 else i, u, "same" if i % 2 else f"p{i}") for i, u in enumerate(urls)]
    out = scratch_path(spark, "t_warc_urls")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), out, shard_bytes=900)
    got = warc.read(spark, out)
    assert got.rdd.getNumPartitions() > 1
    own = {(r.page_id, r.url, r.record_type, r.refers_to) for r in got.collect()}
    last = max(i for i in range(len(urls)) if i % 2)
    assert own == {(r[0], r[1] or "", "revisit" if i % 2 and i != last else "response", last if i % 2 and i != last else None) for i, r in enumerate(rows)}


def test_warc_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    out = scratch_path(spark, "warc")
    warc.write(pages, out, min_bytes=2)
    kinds = {(r.page_id, r.payload_bytes): r.record_type for r in warc.read(spark, out).collect()}
    assert kinds[3, 0] == kinds[4, 0] == "response" and kinds[1, 2] == "revisit"
    empty = scratch_path(spark, "warc")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


# ---- 3 -------------------------------------------------------------------------------------------
def lattice_rows(rows, at=0.98):
    ok = [la is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, la in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= at:
                    links.append((i, j))
    n = collections.Counter(x for pair in links for x in pair)
    comp = least([r[0] for r in rows], links)
    return sorted((r[0], n[i], comp[i], comp[i] == r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize("block", [5, 1024])
def test_lattice_equals_brute_force(spark, block):
    made = np.random.default_rng(5)
    base = made.standard_normal((6, 16))
    rows = [(i, [float(x) for x in (base[i % 6] + (0 if i % 5 == 0 else 0.12) * made.standard_normal(16)) * made.uniform(0.5, 2)],
             i % 3 if i % 17 else None) for i in range(240)]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [float("nan")] * 16, 1), (1004, [float("inf")] + [1.0] * 15, 1),
             (1005, [None] + [1.0] * 15, 1), (1006, [1.0, 2.0], 1), (1007, [2.0, 4.0], 1), (1008, rows[1][1], 1), (1009, rows[1][1], 1)]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, label int, cid int, vec string")
    assert sorted(map(tuple, lattice.near_duplicates(frame, block=block).collect())) == lattice_rows(rows)


def test_lattice_recall_and_empty(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in e.collect()]
    got = sorted(map(tuple, lattice.near_duplicates(e, threshold=0.9).collect()))
    found, all_links = sum(r[1] for r in got), sum(r[1] for r in lattice_rows(rows, 0.9))
    assert found <= all_links and found >= 0.9 * all_links
    assert lattice.near_duplicates(e.limit(0)).count() == 0


def test_e8_decoding_is_nearest():
    x = np.random.default_rng(1).normal(size=(300, 8)) * 2
    p = lattice.decode_e8(x)
    assert (np.abs(p * 2 - np.rint(p * 2)) == 0).all() and ((p.sum(1) % 2) == 0).all()
    step = ((x[:, None] - (p[:, None] + lattice.DIRECTIONS[None])) ** 2).sum(2).min(1)
    assert (((x - p) ** 2).sum(1) <= step + 1e-9).all()


# ---- 6 -------------------------------------------------------------------------------------------
def minhash_rows(rows, width, percent):
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    sets = [{tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set() for w in words]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    comp = least([r[0] for r in rows], links)
    return sorted(((r[0], len(sets[i]), comp[i], comp[i] == r[0]) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("width,percent,block", [(3, 85, 512), (5, 80, 7)])
def test_minhash_equals_brute_force(spark, width, percent, block):
    pick = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    base = [[pick.choice(words) for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(160):
        w = list(base[i % 4])
        for _ in range(pick.randint(0, 6)):
            w[pick.randrange(60)] = pick.choice(words)
        rows.append((i, " ".join(w).upper() if i % 2 else "\n".join(w)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "a b"), (904, "A  b"), (905, "a"), (906, "a b c"), (906, "a b c"), (907, "é É"), (908, "x " * 50_000)]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, cid int, pair string")
    got = sorted(map(tuple, minhash.near_duplicates(frame, width=width, percent=percent, block=block).collect()), key=str)
    assert got == minhash_rows(rows, width, percent)


def test_minhash_odd_rows(spark, odd_docs):
    got = minhash.near_duplicates(odd_docs, width=5).collect()
    assert len(got) == 10 and {r.component_id for r in got if r.doc_id in (1, 5)} == {1}
    assert all(r.kept for r in got if r.doc_id in (2, 3, 4, 7, 9))
    assert minhash.near_duplicates(odd_docs.limit(0)).count() == 0


# ---- 7 -------------------------------------------------------------------------------------------
def test_common_length():
    pick = random.Random(1)
    for _ in range(200):
        a, b = ([pick.randint(0, 5) for _ in range(pick.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common_length(a, np.array(b)) == table[-1][-1]


def test_decontamination_finds_planted_passages(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    held, items = docs.collect(), bench.collect()
    exact = {(d.doc_id, b.item_id) for d in held for b in items if b.text in d.text}
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    assert exact <= got and len(got - exact) <= 2
    pick = random.Random(3)
    planted = []
    for k, b in enumerate(items):
        w = b.text.split()
        for _ in range(max(1, len(w) // 12)):  # a paraphrase: some words replaced, case and marks changed
            w[pick.randrange(max(1, len(w) - 6))] = "changed"
        planted.append((10_000 + k, held[k].text[:1500].replace("\n", " ") + " " + " ".join(w).upper() + " -- " + held[k + 1].text[:900]))
    frame = spark.createDataFrame(planted, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(frame, bench).collect()}
    assert sum((10_000 + k, b.item_id) in found for k, b in enumerate(items)) >= 0.9 * len(items)
    clean = docs.join(spark.createDataFrame([(d,) for d in {d for d, _ in got}], "doc_id long"), "doc_id", "left_anti")
    assert decontam.without_leaks(docs, bench).count() == clean.count()


def test_latent_space_comes_from_all_documents(spark, sf_dir, monkeypatch):
    """The product behind the latent space against dense rows of every passage of 6,000 documents."""
    pick = random.Random(17)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    spare = [w for t in texts for w in t.split()] + ["other", "words"] * 200
    rows = [(i, None if i % 500 == 0 else " ".join(pick.choice(spare) for _ in range(pick.randrange(120)))) for i in range(6000)]
    seen, plain = {}, decontam.space
    monkeypatch.setattr(decontam, "space", lambda basis, product, own, rank: seen.update(basis=basis, product=product, own=own) or plain(basis, product, own, rank))
    block, coded, _ = decontam.prepare(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), list(enumerate(texts[:12])))
    assert coded.count() == len(rows)
    dense = []
    for _, text in rows:
        codes = block.codes(text)
        for part in (codes[i:i + decontam.PASSAGE] for i in range(0, len(codes), decontam.PASSAGE)):
            row = np.bincount(part[part >= 0], minlength=len(block.terms)) * block.idf
            if row.any():
                dense.append(row / np.linalg.norm(row))
    dense = np.array(dense)
    assert np.allclose(seen["basis"].T @ seen["basis"], np.eye(seen["basis"].shape[1]))
    assert np.allclose(seen["product"], dense.T @ (dense @ seen["basis"]), rtol=1e-4, atol=1e-3)
    # The space holds the passages about as well as the principal directions of the whole matrix do.
    gram, own = dense.T @ dense, seen["own"]
    best = np.linalg.eigh(gram / np.trace(gram) + own.T @ own / np.trace(own.T @ own) * len(own))[1][:, -len(own):]
    assert (block.held >= 0.9 * np.linalg.norm(own @ best, axis=1)).all()


def test_decontamination_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "The cat sat on the mat again"), (None, "a text without"), (4, "...")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(odd_docs, bench).collect()}
    assert got == {(1, 3), (5, 3), (None, None)}
    kept = decontam.without_leaks(odd_docs, bench)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7, 8, 9]
    assert decontam.leaks(odd_docs.limit(0), bench).count() == 0 and decontam.leaks(odd_docs, bench.limit(0)).count() == 0
    assert decontam.without_leaks(odd_docs, bench.limit(0)).count() == 10


def planted_in(held, passages, pick, replaced, times=1):
    """(doc_id, text) rows with a passage of each kind in the middle of a document's words, the last ``keep`` words untouched."""
    rows, spare = [], [w for t in held for w in t.split()]
    for k, (text, keep) in enumerate(passages):
        for n in range(times):
            w, outer = text.split(), held[pick.randrange(len(held))].split()
            for i in pick.sample(range(len(w) - keep), int(replaced * (len(w) - keep))):
                w[i] = pick.choice(spare)
            at = pick.randrange(len(outer) + 1)
            rows.append((k * times + n, " ".join(outer[:at] + w + outer[at:])))
    return rows


def confirmed(item, text):
    """Brute force: the rule of the docstring over the whole document, without any search before it."""
    one = decontam.Passages([(0, item)])
    codes, (words,), (answer,) = one.codes(text), one.items, one.answers
    share = decontam.common_length(words, codes) / len(words)
    return share >= decontam.LCS or share >= decontam.LOOSE and decontam.common_length(answer, codes) >= 0.8 * len(answer)


def test_decontamination_recall_of_large_benchmarks(spark, sf_dir):
    pick = random.Random(11)
    held = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text and len(r.text.split()) > 80]
    spare = [w for t in held for w in t.split()]
    items = [" ".join(pick.choice(spare) for _ in range(pick.randrange(25, 60))) for _ in range(240)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for replaced in (0.3, 0.5):
        rows = planted_in(held, [(t, 5) for t in items], pick, replaced)
        due = {(d, d) for d, text in rows if confirmed(items[d], text)}
        found = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
        assert len(due) > 100 and len(due & found) >= 0.97 * len(due)


def test_decontamination_long_passages(spark, sf_dir):
    pick = random.Random(12)
    held = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text and len(r.text.split()) > 80]
    spare = [w for t in held for w in t.split()]
    starts = [pick.randrange(len(spare) - n) for n in (400, 700, 1000, 1500, 2500) for _ in range(4)]
    items = [" ".join(spare[s:s + n]) for s, n in zip(starts, [n for n in (400, 700, 1000, 1500, 2500) for _ in range(4)])]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = planted_in(held, [(t, 60) for t in items], pick, 0) + [(100 + d, t) for d, t in planted_in(held, [(t, 60) for t in items], pick, 0.25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    missed = [d for d, text in rows if confirmed(items[d % 100], text) and (d, d % 100) not in found]
    assert not missed
    assert {len(p) for p in decontam.Passages([(0, items[-1])]).pieces} == {59, 60}


def test_decontamination_short_passages(spark, sf_dir):
    pick = random.Random(13)
    held = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text and len(r.text.split()) > 80]
    spare = [w for w in " ".join(held).split() if decontam.words_of(w)]
    items = [" ".join(spare[s:s + n]) for n in (2, 3, 4, 5, 8, 11) for s in pick.sample(range(len(spare) - n), 25)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = planted_in(held, [(t, len(t.split())) for t in items], pick, 0)
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert {(d, d) for d, _ in rows} <= found
