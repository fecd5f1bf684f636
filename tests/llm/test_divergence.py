"""Quality rules by distribution divergence: counts against brute force, verdicts on junk, odd rows."""

import random
import re
from collections import Counter

from strata.llm import divergence as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) for k in range(3) if windows[w[i], w[i + 1], w[i + 2]] > 1}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def texts(seed, n):
    pick = random.Random(seed)
    bits = ["a", "b", "a", "é", "日本", "😀", "#", "$&|", "the", "The", "A" * 5, "x\x1cy", "\x00", "12", "\xa0", "<b>"]
    ends = [" ", " ", "  ", "\t", "\n", "\n", "\r\n", "\x0b", "\x0c", "\x85", " "]
    return ["".join(pick.choice(bits) + pick.choice(ends) for _ in range(pick.randint(0, 150))) for _ in range(n)]


def test_counts_equal_brute_force(spark):
    own = texts(1, 400) + [None, "", " \n", "x", "a b c a b c", "a b c d a b c", "a a a a", "a a a", "one\none\n\none\n \n ", "w " * 40_000]
    frame = spark.createDataFrame([(i, t, None) for i, t in enumerate(own)], "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: tuple(r)[1:7] for r in D.judge(frame).collect()}
    assert got == {i: base(t or "") for i, t in enumerate(own)}


def test_windows_with_equal_hashes_are_told_apart(spark):
    """The exact step alone, fed with every place, gives what the hashed step gives."""
    rows = spark.createDataFrame([(t,) for t in texts(7, 100)], "text string")
    exact = D.repeated_words("w").replace("bigint(hash(w[i], w[i + 1], w[i + 2]))", "bigint(0)")
    assert "bigint(0)" in exact
    both = rows.selectExpr(D._let("w", D.words("text"), f"struct({D.repeated_words('w')} as a, {exact} as b)") + " as x").collect()
    assert all(r.x.a == r.x.b for r in both) and any(r.x.a for r in both)


def prose(pick, n):
    common = ["the", "of", "and", "to", "in"]
    return " ".join(pick.choice(common) if pick.random() < 0.4 else "".join(pick.choice("abcdefghilmnoprst") for _ in range(pick.randint(3, 9))) for _ in range(n))


def test_far_documents_go_and_clean_ones_stay(spark):
    pick = random.Random(3)
    clean = [prose(pick, pick.randint(60, 300)) for _ in range(300)]
    junk = ["".join(pick.choice("#$%&*|<>") if pick.random() < 0.4 else pick.choice("abc 123") for _ in range(900)) for _ in range(15)]
    junk += [prose(pick, 120).upper() + "!" for _ in range(15)]
    short = ["zzz QQQ ### 1234 " * 3]
    own = clean + junk + short
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(own)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in D.judge(frame).collect()}
    assert all(got[i].kept for i in range(len(clean)))
    assert not any(got[i].kept for i in range(len(clean), len(clean) + len(junk)))
    last = got[len(own) - 1]
    assert last.base_failed and last.char_distance is None and last.word_distance is None


def test_little_reference_decides_nothing(spark):
    frame = spark.createDataFrame([(1, prose(random.Random(1), 100), "aa"), (2, prose(random.Random(2), 100).upper(), "aa")], "doc_id long, text string, lang string")
    assert all(r.kept and r.word_distance is None for r in D.judge(frame).collect())


def test_divergence_odd_rows(spark, odd_docs):
    got = D.judge(odd_docs).collect()
    assert len(got) == 10 and sum(r.doc_id is None for r in got) == 1 and sum(r.doc_id == 5 for r in got) == 2
    clash = odd_docs.selectExpr("doc_id as id", "text", "lang", "1 as n_words", "'x' as w", "'y' as common", "2 as classes")
    assert D.judge(clash, id_col="id").count() == 10 and D.judge(clash, id_col="id").columns[0] == "id"
    assert D.judge(odd_docs.limit(0)).count() == 0


def test_divergence_runs_no_python(spark, odd_docs):
    plan = D.judge(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
