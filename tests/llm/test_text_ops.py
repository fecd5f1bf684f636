"""Token counts, exact encoding, pseudonyms and the language model on odd rows and against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers as P
import pytest

from strata.llm import maxent, pii, spm, tokens

JSON, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
BITS = ["a", "b", " ", "  ", "\n", "\t", "é", "日本", "😀", "\x00", "the", "ing", "'s", "'ll", "<|endoftext|>", "<s>", "<0x0A>", "12", "²", "\x85",
        "\xa0", "\x1c", "ª", "ß", "İ", "!!", "'", " the", "½", "̈", "▁", "x" * 30, "\r\n", "="]


def mixed(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice(BITS) for _ in range(pick.randint(0, 40))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# ---- 8 -------------------------------------------------------------------------------------------
@pytest.mark.parametrize("bound", [8, tokens.HOT_BOUND])
def test_token_counts_equal_the_library(spark, bound):
    from tokenizers import Tokenizer

    texts = mixed(800, 3) + [None, "", "word " * 5000]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(frame(spark, texts), JSON, bound=bound).collect()}
    library = Tokenizer.from_file(JSON)
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False))
        assert got[i] == (len((t or "").encode()), n, n > 1024)


def test_token_counts_odd_rows(spark, odd_docs):
    got = tokens.token_counts(odd_docs, JSON).collect()
    assert len(got) == 10 and sum(r.doc_id == 5 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1
    assert tokens.token_counts(odd_docs.limit(0), JSON).count() == 0


# ---- 10 ------------------------------------------------------------------------------------------
def test_encoding_equals_the_library():
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm.PieceModel(PIECES)
    texts = mixed(5000, 5) + [" " * k for k in range(40)] + ["a" + " " * k + "b" for k in range(40)] + ["a" * 5000, " " * 5003 + "x"]
    for t in texts:
        ids = library.encode(t)
        assert own.encode(t) == (",".join(map(str, ids)), library.decode(ids)), repr(t)


def test_encoding_round_trip_and_odd_rows(spark, odd_docs):
    got = spm.encode_documents(odd_docs, PIECES).collect()
    assert len(got) == 10
    for r in got:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
    assert {r.round_trip for r in got if r.doc_id != 9} == {True}
    back = spm.decode_documents(spm.encode_documents(odd_docs, PIECES), PIECES).collect()
    assert sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in back) == sorted(r.decoded_sha256 for r in got)
    assert spm.encode_documents(odd_docs.limit(0), PIECES).count() == 0


# ---- 9 -------------------------------------------------------------------------------------------
def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_format_and_link(spark):
    texts = ["x 4918187128635271 y 4918-1871-2863-5271.", "4918187128635271", "no 4918187128635272", "ip 42.144.35.254 256.1.1.1",
             "2024-02-29 30.02.2024 12/31/1999", "123-45-6789 000-45-6789", "+1 (578) 555-6437", "bob.s42@mail.example.com", "bob.s42@mail.example.com!"]
    got = {r.doc_id: r for r in pii.pseudonymise(frame(spark, texts), "k", found_col="n").collect()}
    cards = re.findall(r"\d{16}", got[0].text)
    assert luhn(cards[0]) and cards[0] != "4918187128635271" and cards[0][0] == "4"
    assert got[1].text == cards[0] and re.sub("-", "", got[0].text).count(cards[0]) == 2
    assert got[2].text == texts[2] and got[2].n == 0
    ip, kept = got[3].text.split()[1:]
    assert kept == "256.1.1.1" and ip != "42.144.35.254" and all(int(o) < 256 for o in ip.split("."))
    day, bad, us = got[4].text.split()
    assert bad == "30.02.2024" and re.fullmatch(r"\d{4}-\d\d-\d\d", day) and re.fullmatch(r"\d\d/\d\d/\d{4}", us)
    assert got[5].text.endswith(" 000-45-6789") and got[5].n == 1
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[6].text) and got[6].text != texts[6]
    assert re.fullmatch(r"[a-z]{3}\.[a-z]\d\d@mail\.example\.com", got[7].text) and got[8].text == got[7].text + "!"
    other = pii.pseudonymise(frame(spark, texts), "other key").collect()
    assert other[1].text != got[1].text


def test_feistel_is_a_permutation(spark):
    values = spark.range(250 * 292).selectExpr(pii.feistel("id", "250", "292", "'t'", "'k'") + " AS v")
    assert values.distinct().count() == 250 * 292 and values.where("v < 0 or v >= 73000").count() == 0


def test_pseudonyms_odd_rows(spark, odd_docs):
    out = pii.pseudonymise(odd_docs, "k'\\")
    assert out.columns == odd_docs.columns and out.count() == 10
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[2] is None and texts[3] == "" and texts[4] == " \t\n" and "4111 1111" not in texts[8] and "a.b@" not in texts[8]
    assert pii.pseudonymise(odd_docs.limit(0), "k").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 4 -------------------------------------------------------------------------------------------
def base_scores(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return sorted((str(i), held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in rows)


@pytest.mark.parametrize("hot", [2, maxent.HOT_WORDS])
def test_base_scores_equal_brute_force(spark, odd_docs, hot):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                 for r in maxent.score(odd_docs, hot_words=hot).collect())
    assert got == base_scores(rows)
    assert maxent.score(odd_docs.limit(0)).count() == 0


def pairs_of_rarer_words():
    """Texts of 200 fixed pairs of words, each word under 1/510 of the tokens and with the same last three bytes, among words seen once."""
    pick = random.Random(6)
    return [" ".join(f"{k}left_ab {k}right_ab once{n}x{i}" for i, k in enumerate(pick.choices(range(200), k=20))) for n in range(300)]


def test_frequent_words_have_classes_of_their_own_whatever_their_share(spark):
    got = maxent.score(frame(spark, pairs_of_rarer_words())).where("held_out").collect()
    assert len(got) > 20 and sum(r.score for r in got) > 0.57 * sum(r.base_score for r in got)


def test_model_beats_the_base_on_held_out_texts(spark):
    pick = random.Random(4)
    east, west = [[f"{p}{i}" for i in range(60)] for p in "ew"]
    texts = [" ".join(pick.choices(side, [1 / (k + 1) for k in range(60)], k=60)) for side in (east, west) for _ in range(150)]
    got = maxent.score(frame(spark, texts)).where("held_out").collect()
    assert len(got) > 20 and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert all(r.score <= 0 for r in got)


def test_model_is_a_distribution(spark):
    cells = spark.createDataFrame([(maxent.START, [0, maxent.LEAVES + 3], [5, 5]), (3, [1, maxent.LEAVES + maxent.END], [2, 2])],
                                  "h1 int, at array<int>, n array<long>")
    w = maxent.train_weights(cells)
    import numpy as np

    h1 = np.arange(maxent.LEAVES)
    group, member = np.exp(w.group_logp(h1)), np.exp(w.class_logp(h1))
    assert abs((group[:, :, :, None] * member[:, None]).sum((2, 3)) - 1).max() < 1e-9


def pair_scores(rows, min_gain):
    """By row: what word pairs add to the score; plain Python, from the counts of the training rows."""
    import math
    import zlib
    from collections import Counter, defaultdict

    split = [(i, t.encode().lower().split()) for i, t in rows]
    train = [w for i, w in split if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for words in train for w in words)
    own = {w for w, _ in sorted(count.items(), key=lambda c: (-c[1], c[0]))[:maxent.HOT_CLASSES]}
    once, twice = (sum(n == k for n in count.values()) for k in (1, 2))
    discount, tokens = once / (once + 2 * twice), Counter()
    for w, n in count.items():
        if w not in own:
            tokens[maxent.tail_class(w)] += n
    pairs = Counter((b, w) for words in train for b, w in zip([None, *words], words) if w not in own)
    total, kept = Counter(), defaultdict(dict)
    for (b, w), n in pairs.items():
        total[b, maxent.tail_class(w)] += n
    for (b, w), n in pairs.items():
        c, q = (b, maxent.tail_class(w)), max(count[w] - discount, 1e-9) / tokens[maxent.tail_class(w)]
        e = total[c] * q
        if n >= 2 and n > e and n * math.log(n / e) - n + e >= min_gain:
            kept[c][w] = [n - maxent.PAIR_DISCOUNT, q, 0.0]
    norm = {}
    for c, found in kept.items():
        left = lambda at: max(1 - sum(at(v) for v in found.values()), 1e-9)
        alpha = left(lambda v: v[0] / total[c]) / left(lambda v: v[1])
        for v in found.values():
            v[2] = math.log(v[0] / total[c] / v[1] / alpha)
        for _ in range(maxent.PAIR_ROUNDS):
            z = 1 + sum(q * (math.exp(x) - 1) for _, q, x in found.values())
            for v in found.values():
                model = total[c] * v[1] * math.exp(v[2]) / z
                v[2] += min(max(maxent.RATE * (v[0] - model - maxent.PAIR_L2 * v[2]) / (model + maxent.PAIR_L2), -1), 1)
        norm[c] = math.log10(1 + sum(q * (math.exp(x) - 1) for _, q, x in found.values()))
    out = {}
    for i, words in split:
        at = [((b, maxent.tail_class(w)), w) for b, w in zip([None, *words], words) if w not in own]
        out[i] = sum((kept[c][w][2] / math.log(10) if w in kept[c] else 0.0) - norm[c] for c, w in at if c in norm)
    return out


@pytest.mark.parametrize("hot", [2, maxent.HOT_WORDS])
def test_pair_weights_equal_brute_force(spark, hot):
    pick = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in ("ing", "ed", "s", "日", "Ly", "er", "est", "ion")]
    fixed = [(vocabulary[k], vocabulary[799 - k]) for k in range(400)]
    texts = [" ".join(w for _ in range(60) for w in (pick.choice(fixed) if pick.random() < 0.5 else [pick.choice(vocabulary)])) for _ in range(80)]
    rows = list(enumerate(texts))
    bare, full = ({r.doc_id: r.score for r in maxent.score(frame(spark, texts), hot_words=hot, min_gain=g).collect()} for g in (float("inf"), 1.0))
    want = pair_scores(rows, 1.0)
    assert sum(abs(v) > 0.5 for v in want.values()) > 40
    assert all(abs(full[i] - bare[i] - want[i]) < 1e-6 for i in want)


def test_rare_pairs_are_learnt(spark):
    """5,000 fixed pairs, no word of them among those with a class of their own: held-out texts gain by the pairs alone."""
    pick = random.Random(9)
    texts = [" ".join([f"{k:04d}left {k:04d}mate" for k in pick.choices(range(5000), k=60)] + [f"often{j}" for j in range(510)]) for _ in range(900)]
    docs = frame(spark, texts)
    bare, full = ([r for r in maxent.score(docs, min_gain=g).where("held_out").collect()] for g in (float("inf"), maxent.MIN_GAIN))
    gain = sum(r.score for r in full) - sum(r.score for r in bare)
    assert gain / sum(60 for _ in full) > 1.5  # of at most log10(5000) for each pair


def test_tokens_of_many_texts_at_once():
    """Classes, contexts and pair keys of a slice of texts against those of each text, word by word."""
    texts = ["b a c a", "", "a", "  x\n日本 a x日本 ", "", "c c c c"]
    own = {b"a": 0, b"c": 5}
    words, length, packed = maxent.spread(texts, maxent._Tokens({w: ~maxent._packed(w, k) for w, k in own.items()}))
    doc, leaf, before, skip, of, key = maxent.laid_out(length, ~packed)
    at, pairs, said = 0, [], []
    for d, text in enumerate(texts):
        mine = text.encode().split()
        classes = [own.get(w, maxent.tail_class(w)) for w in mine] + [maxent.END]
        hashes = [maxent._HASH[w] for w in mine]
        for i, c in enumerate(classes):
            last = [maxent.START, maxent.START, *classes][i:i + 2]
            assert (doc[at], leaf[at], before[at], skip[at]) == (d, c, last[1], maxent._SKIP[last[0]])
            if maxent.TAIL <= c < maxent.END:
                pairs.append((d, (c << 28 | (hashes[i - 1] >> 36 if i else 0)) << 24 | hashes[i] >> 40))
            at += 1
        said += mine
    assert at == len(doc) and words == said and list(zip(of.tolist(), key.tolist())) == pairs and len(pairs) == 4
    assert maxent._has(maxent._often_map(key), maxent._fold(key) & (1 << maxent.OFTEN_BITS) - 1).all()


def test_rare_words_are_found_by_the_first_bits_of_their_hash(spark):
    words = ["é日本", "x" * 100, "word", "a"]
    got = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", f"shiftrightunsigned(xxhash64(w), {64 - maxent.HASH_BITS}) h").collect()
    tokens = maxent._Tokens({})
    assert all(~tokens[w] == maxent._packed(w, maxent.tail_class(w)) for w in (r.w.encode() for r in got))
    assert all(~tokens[r.w.encode()] & (1 << maxent.HASH_BITS) - 1 == r.h for r in got)


def test_rows_to_look_up_are_not_sorted(spark):
    """The table of weights is the hashed side of the look-up."""
    texts = [f"new{k % 3}ab old{k % 3}ab " * (1 + k % 4) + f"one{k}" for k in range(200)]
    plan = maxent.score(frame(spark, texts))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_hashes_of_words_are_those_of_spark(spark):
    words = ["a", "é日本😀", "x" * 100, "word", "12345678", "0123456789abcdef0123456789abcdefg"]
    got = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) h").collect()
    assert all(r.h % 2**64 == maxent._HASH[r.w.encode()] for r in got)


def test_a_word_of_many_texts_is_looked_up_once():
    asked = []

    class Asked(maxent._Tokens):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

        def of(self, words):
            asked.extend(w.encode() for w in words.to_pylist())
            return super().of(words)

    words, length, code = maxent.spread(["b a B", "", "日本 a"] * 50, Asked({b"a": 7}))
    assert sorted(asked) == [b"a", b"b", "日本".encode()]
    assert words == [b"b", b"a", b"b", "日本".encode(), b"a"] * 50 and length.tolist() == [3, 0, 2] * 50
    assert code.tolist() == [7 if w == b"a" else ~maxent._packed(w, maxent.tail_class(w)) for w in words]


def test_words_are_split_at_the_six_spaces_alone():
    import pyarrow as pa

    texts = mixed(500, 12) + [None, "", " ", "\x0b\x0ca\x1cb\x85c\xa0d \r\n", "İK\u212a ẞ\u2003x"]
    words, length = maxent.split(pa.array(texts).slice(3))
    want = [(t or "").encode().lower().split() for t in texts[3:]]
    assert length.tolist() == [len(w) for w in want] and words.cast(pa.binary()).to_pylist() == [w for own in want for w in own]


def test_counts_of_pairs_travel_in_arrays_of_buckets(spark, monkeypatch):
    """Exact counts with many buckets and tasks that add up often; no row for each pair is moved or put in a window."""
    monkeypatch.setattr(maxent, "PART_PAIRS", 300)
    monkeypatch.setattr(maxent, "BUCKET_TOKENS", 50)
    texts = [*pairs_of_rarer_words(), None, "", "w0x " * 3000, *(f"w{k % 7}x w{k % 5}x" for k in range(400))]
    cells, pairs, total = Counter(), Counter(), Counter()
    for t in texts:
        _, length, code = maxent.spread([t or ""], maxent._Tokens({}))
        _, leaf, before, skip, _, key = maxent.laid_out(length, ~code)
        for b, s, c in zip(before.tolist(), skip.tolist(), leaf.tolist()):
            cells.update((b * 2 * maxent.LEAVES + s * maxent.GROUPS + c // maxent.GROUPS, b * 2 * maxent.LEAVES + maxent.LEAVES + c))
        pairs.update(key.tolist())
        total.update((key >> maxent.WORD_BITS).tolist())
    counted = maxent._statistics(frame(spark, texts).repartition(3), {}, sum(total.values()))
    plan, rows = counted._jdf.queryExecution().executedPlan().toString(), counted.collect()
    assert {-1 - r.c: r.n for r in rows if r.c < 0} == cells
    assert sorted((r.c, r.a, r.n, r.total) for r in rows if r.c >= 0) == sorted((a >> maxent.WORD_BITS, a, n, total[a >> maxent.WORD_BITS]) for a, n in pairs.items() if n >= 2)
    assert "Window" not in plan and "HashAggregate" not in plan
