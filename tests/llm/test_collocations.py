"""Dynamic itemset counting against plain counting."""

import random
import re
from collections import Counter

import pytest

from strata.llm import collocations as C


def plain(rows, least, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    longer = {}
    for (lang, p), a in f.items():
        if len(p) == 3 and a >= least:
            for part in (p[:2], p[1:]):
                longer[lang, part] = max(a, longer.get((lang, part), 0))
    out = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least and not 100 * longer.get((lang, p), 0) >= 50 * a:
            score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, own in out.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


def texts(seed, n):
    pick = random.Random(seed)
    words = ["the", "The", "of", "new", "York", "city", "a", "é", "日本", "z\x00", "x\x1cy", "-"] + [f"w{i}" for i in range(40)]
    ends = [" ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "\x0b", "!?", " new york city ", "\xa0", "\x85"]
    langs = ["en", "en", "en", "de", None, "", "und", "日"]
    return [(pick.choice(langs), None if pick.random() < 0.02 else "".join(pick.choice(words) + pick.choice(ends) for _ in range(pick.randint(0, 60))))
            for _ in range(n)]


@pytest.mark.parametrize("shards, slots, least, top", [(3, (1 << 12, 1 << 12), 10, 2000), (2, (8, 8), 10, 50), (5, (C.WORD_SLOTS, C.PAIR_SLOTS), 4, 2000), (1, (64, 64), 10, 2000)])
def test_collocations_equal_plain_counts(spark, shards, slots, least, top):
    rows = texts(shards, 600)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = sorted(tuple(r) for r in C.collocations(frame, least=least, top=top, shards=shards, word_slots=slots[0], pair_slots=slots[1]).collect())
    assert got == plain(rows, least, top)


@pytest.mark.parametrize("shards, slots", [(3, (1 << 16, 16)), (4, (512, 64)), (3, (1 << 16, 1 << 10))])
def test_pairs_that_share_a_slot_are_counted_whole(spark, shards, slots):
    """A slot that a pair of early words starts holds pairs, too, whose words reach the threshold scans later."""
    phrases = [f"p{i} q{i} r{i}" for i in range(40) for _ in range(60)] + [f"x{i} y{i} z{i}" for i in range(100) for _ in range(10 + i % 3)]
    random.Random(7).shuffle(phrases)
    rows = [("en", p) for p in phrases]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = sorted(tuple(r) for r in C.collocations(frame, shards=shards, word_slots=slots[0], pair_slots=slots[1]).collect())
    assert got == plain(rows, 10, 2000)


def test_collocations_odd_rows(spark, odd_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    got = sorted(tuple(r) for r in C.collocations(odd_docs, least=2).collect())
    assert got == plain(rows, 2, 2000) and any(r[2] == "long long long" or r[2] == "long long" for r in got)
    assert C.collocations(odd_docs.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    """Counts as they are met in a large corpus: the product of squares passes 64 bits."""
    row = spark.sql("select (cast(4000000000000 as decimal(19, 0)) * cast(4000000000000 as decimal(19, 0)) * 1000000) div "
                    "(cast(5000000000000 as decimal(19, 0)) * cast(4100000000001 as decimal(19, 0))) as s").first()
    assert row.s == 1000000 * 4000000000000**2 // (5000000000000 * 4100000000001)


def test_a_phrase_is_counted_for_one_cycle():
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 2, "text": ["a b c. a b", "a\nb c"]})
    words, pairs = np.full(1 << 16, C.NEVER, np.uint8), np.full(1 << 16, C.NEVER, np.uint8)

    def counted(scan):
        rows = [r for part in C._count(batch, scan, 3, 1, words, pairs) for r in part.to_pylist()]
        trials = {r["len"]: sorted(C._unpacked(r["cells"])[1].tolist()) for r in rows if r["cells"] is not None}
        return trials, {r["phrase"]: r["n"] for r in rows if r["cells"] is None and r["len"]}

    assert counted(0) == ({1: [2, 3, 3]}, {}) and counted(3) == ({}, {})
    words[:] = 2
    assert counted(1) == ({1: [2, 3, 3]}, {}) and counted(2) == ({2: [2, 2]}, {"a": 3, "b": 3, "c": 2})
    assert counted(4) == counted(2) and counted(5) == ({}, {})
    pairs[:] = 3
    assert counted(3) == ({}, {"a": 3, "b": 3, "c": 2, "a b": 2, "b c": 2, "a b c": 1})
    assert counted(5) == ({}, {"a b": 2, "b c": 2, "a b c": 1}) and counted(6) == ({}, {})


def test_runs_of_cells_round_trip():
    import numpy as np

    cells = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 1000, dtype=np.uint64).astype(np.uint32))
    got, counts = C._unpacked(C._packed(cells, np.full(len(cells), 300)))
    assert (got == cells).all() and (counts == 255).all() and len(C._unpacked(b"")[0]) == 0
