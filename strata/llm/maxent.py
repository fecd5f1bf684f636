"""Operator 4: hashed maximum-entropy language model with a class-factored softmax.

log P(text) = sum over tokens of log P(group | context) + log P(class | group, context) + log P(word | class, word before).

Classes are the leaves of a two-level tree (GROUPS x GROUPS). The HOT_CLASSES most frequent words of the
training tokens (ties by the word) are classes of their own, every other word is hashed
by its last three bytes into a class, the end of a text is one class. A word's class is its hashed
feature; the context features are the previous word (bigram), the word before it (skip, hashed into
GROUPS buckets) and a hash of both. The group softmax uses all three, the class softmax the bigram.

Training: the counts of (previous, skip, group) and (previous, class) over all training tokens are
sufficient statistics of these features, so one pass over the corpus gathers them; they stay spread over
the cluster. Each round broadcasts the weights, every task computes expected feature counts of its rows,
Spark sums them and the weights move along the gradient (observed - expected - l2 * w), scaled by the
expected count. Weight tables have a fixed size, whatever the corpus.

q(word | class) is the discounted relative frequency of the word among the training tokens of its class;
what the discount leaves is the class's unknown word. It is the base measure of the word softmax
P(word | class, before) = q(word | class) exp(weight(before, word)) / Z(before, class), whose features are pairs of
whole words, the word before hashed to PREVIOUS_BITS, the word within its class to WORD_BITS. A pair has a weight if it was met at least twice and tells MIN_GAIN nats or more beyond q;
all others weigh 0, so Z = 1 + sum of q (exp(weight) - 1) over the weighted pairs of the context alone. Pairs are
counted over all training tokens in a table that grows with the corpus; until they are added up they travel in arrays,
a row for each bucket of contexts. Their weights start where the discounted
counts are met exactly and take gradient steps (observed - expected - l2 * w) by context on Spark. So the model is
a distribution over the known words, one unknown word for each hashed class, and the end.

Scoring takes the weights of pairs and contexts with a share of 1/HOT_WORDS from a broadcast, as for words, and looks
up all others in the table of weights, in the join that also serves the rare words. A bitmap of the table's hashed keys, of fixed size, spares the shuffle most keys that have no weight; it
passes every key that has one, however full it is.

Word counts are exact, over all training tokens. Words with a share of 1/HOT_WORDS (hence at most
HOT_WORDS of them) or a class of their own are broadcast for scoring; every other (word, text, frequency) row meets its count
in a join on the word, where no key can be hot.

Defined results: null and empty texts are the end alone; a null id is not held out; repeated rows are
scored, and trained on, one by one; without training text all counts are 0; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SLICE_BYTES, SLICE_ROWS, mix64, remove, slices, written

GROUPS, HOT_CLASSES, HOT_WORDS, CROSS = 32, 510, 1 << 20, 1 << 13
LEAVES = GROUPS * GROUPS
TAIL, END, START = 512, 1022, 1023
SUFFIXES = END - TAIL
ROUNDS, RATE, L2, PRIOR, PART_BYTES = 8, 0.6, 0.5, 2.0, 32 << 20
#: Pair weights: least gain, what is taken off a pair's count, rounds and l2 of its weights; pairs sorted at once in a task.
MIN_GAIN, PAIR_DISCOUNT, PAIR_ROUNDS, PAIR_L2, PART_PAIRS = 4.0, 0.5, 2, 0.05, 1_500_000
#: Counts of pairs travel in arrays of the pairs of a bucket of contexts, of at most about so many training tokens.
BUCKET_TOKENS = 1 << 20
#: Bits of a pair's key: class, hash of the word before, hash of the word; the bit above marks the key of a context.
CLASS_BITS, PREVIOUS_BITS, WORD_BITS = 10, 28, 24
CONTEXT = 1 << CLASS_BITS + PREVIOUS_BITS + WORD_BITS
#: First bits of a word's hash that are kept beside its class.
HASH_BITS = 53
#: No word's code: above its class are classes that no word has.
_STRANGE = np.iinfo(np.int64).min
#: Bits of the bitmaps of keys with a weight and of frequent ones, and of a row of the first.
KEY_BITS, OFTEN_BITS, ROW_BITS = 26, 24, 15
#: Bits that hold a text's place in a slice.
AT_BITS = SLICE_ROWS.bit_length()

_H1 = np.arange(LEAVES)
_K = np.arange(GROUPS)
_CROSSED = ((_H1[:, None] * GROUPS + _K).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(51)).astype(np.int64)
_SKIP = (_H1.astype(np.uint64) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(59)).astype(np.int64)


def tail_class(word: bytes) -> int:
    return TAIL + zlib.crc32(word[-3:]) % SUFFIXES


def split(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, number of each text's words); a null has none."""
    text = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    parts, empty = pc.ascii_split_whitespace(text), pc.equal(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    words = parts.flatten()
    if empty.any():  # split into one empty word
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words, pc.list_value_length(parts).to_numpy().astype(np.int64) - empty


class _Hashes(dict):
    """64-bit hashes of words, as Spark's xxhash64 gives them; none is kept."""

    def __missing__(self, word):
        return xxhash.xxh64_intdigest(word, 42)


_HASH = _Hashes()


class _Tokens:
    """What ``own`` says of a word, else ~(class << HASH_BITS | first bits of its hash)."""

    def __init__(self, own: dict[bytes, int]):
        self.own = own.get

    def __getitem__(self, word: bytes) -> int:
        return int(self.of(pa.array([word], pa.binary()))[0])

    def of(self, words: pa.Array) -> np.ndarray:
        """The same of each of ``words``, which are best distinct."""
        words = words.cast(pa.binary())
        said = words.to_numpy(zero_copy_only=False)
        code = np.fromiter(map(self.own, said, repeat(_STRANGE)), np.int64, len(said))
        new = code == _STRANGE
        strange = pa.array(new)
        ends = pc.binary_slice(words.filter(strange), -3).dictionary_encode()
        leaf = np.fromiter(map(tail_class, ends.dictionary.to_pylist()), np.int64, len(ends.dictionary))[ends.indices.to_numpy()]
        first = np.fromiter(map(xxhash.xxh64_intdigest, said[new], repeat(42)), np.uint64, len(leaf)) >> np.uint64(64 - HASH_BITS)
        code[new] = ~(leaf << HASH_BITS | first.astype(np.int64))  # ~_packed(word, tail_class(word))
        return code


def _packed(word: bytes, leaf: int) -> int:
    return leaf << HASH_BITS | _HASH[word] >> 64 - HASH_BITS


def coded(text: pa.Array, tokens: _Tokens) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words of all texts, number of each text's words, place of each word among the distinct ones, what ``tokens``
    gives for these): a word is looked up once for all texts."""
    words, length = split(text)
    found = words.dictionary_encode()
    distinct = found.dictionary
    return distinct, length, found.indices.to_numpy(), tokens.of(distinct)


def spread(texts: list[str], tokens: _Tokens) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words of all texts, number of each text's words, what ``tokens`` gives for the words)."""
    distinct, length, place, code = coded(pa.array(texts, pa.string()), tokens)
    return distinct.cast(pa.binary()).take(pa.array(place)).to_pylist(), length, code[place]


def laid_out(length: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, ...]:
    """For all tokens of texts with so many words (``packed``: class << HASH_BITS | first bits of the hash), ends included:
    text, class, class of the word before, skip bucket; for tokens whose class has several words: text, key of the word
    pair. key >> WORD_BITS is the pair's context."""
    ends = (length + 1).cumsum() - 1
    starts, word = ends - length, np.ones(len(packed) + len(length), bool)
    word[ends] = False
    full = np.full(len(word), END << HASH_BITS, np.int64)
    full[word] = packed
    doc, leaf, first = np.repeat(np.arange(len(length)), length + 1), full >> HASH_BITS, full >> HASH_BITS - PREVIOUS_BITS & (1 << PREVIOUS_BITS) - 1
    before = np.r_[START, leaf[:-1]]
    before[starts] = START
    second = np.r_[START, before[:-1]]
    second[starts] = START
    at = np.flatnonzero((leaf >= TAIL) & (leaf < END))
    key = (leaf[at] << PREVIOUS_BITS | np.r_[0, first[:-1]][at]) << WORD_BITS | first[at] >> PREVIOUS_BITS - WORD_BITS  # an end's bits are 0
    return doc, leaf, before, _SKIP[second], doc[at], key


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(-1, keepdims=True)
    return z - np.log(np.exp(z).sum(-1, keepdims=True))


class Weights:
    """Group softmax: bias b, bigram u, skip s, crossed x; class softmax: bias c, bigram w."""

    names = ("b", "u", "s", "x", "c", "w")

    def __init__(self):
        self.b, self.c = np.zeros((1, GROUPS)), np.zeros((GROUPS, GROUPS))
        self.u, self.s = np.zeros((LEAVES, GROUPS)), np.zeros((GROUPS, GROUPS))
        self.x, self.w = np.zeros((CROSS, GROUPS)), np.zeros((LEAVES * GROUPS, GROUPS))

    def group_logp(self, h1: np.ndarray) -> np.ndarray:
        """(h1, skip bucket, group) log probabilities."""
        return log_softmax(self.b[0] + self.u[h1][:, None] + self.s[None] + self.x[_CROSSED[h1]])

    def class_logp(self, h1: np.ndarray) -> np.ndarray:
        """(h1, group, member) log probabilities."""
        return log_softmax(self.c[None] + self.w.reshape(LEAVES, GROUPS, GROUPS)[h1])


def _count_words(train: DataFrame) -> DataFrame:
    def count(batches):
        held, size = [], 0

        def rows():
            found = pa.chunked_array(held).value_counts()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

        for part in slices(batches):
            words, _ = split(part.column("text"))
            held.append(words)
            size += words.nbytes
            if size > PART_BYTES:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    return train.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _added_up(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of all (values, counts), in order, and the sums of their counts."""
    a, n = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(a)
    a = a[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    return a[first], np.add.reduceat(n[order], first)


def _statistics(train: DataFrame, hot: dict[bytes, int], spoken: int) -> DataFrame:
    """(c, a, n, total): counts by previous class, c < 0, -1 - c = h1 * 2 * LEAVES + place, place below LEAVES: skip bucket
    and group, else LEAVES + class; and counts of word pairs met at least twice, a = pair, c = context, with the
    tokens of the context. Tasks add up their pairs first, so a context of any share is a few entries from each; a row
    holds those of a bucket of contexts. ``spoken``: words of the training texts."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast(hot)
    buckets = max(spoken // BUCKET_TOKENS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def rows(a, n):
        """One row for each bucket."""
        bucket = (mix64((a >> WORD_BITS).astype(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        order, size = np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(size)
        ends = pa.array(np.r_[0, size[some].cumsum()], pa.int32())
        return pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "a": pa.ListArray.from_arrays(ends, pa.array(a[order], pa.int64())),
                                           "n": pa.ListArray.from_arrays(ends, pa.array(n[order], pa.int64()))})

    def count(batches):
        cells, found, held = np.zeros(2 * LEAVES * LEAVES, np.int64), [], 0
        tokens = _Tokens({w: ~_packed(w, leaf) for w, leaf in shared.value.items()})
        for part in slices(batches, size=SLICE_BYTES // 4):
            _, length, place, packed = coded(part.column("text"), tokens)
            _, leaf, before, skip, _, key = laid_out(length, ~packed[place])
            for code in (skip * GROUPS + leaf // GROUPS, LEAVES + leaf):
                np.add.at(cells, before * 2 * LEAVES + code, 1)
            found.append(key)
            held += len(key)
            if held > PART_PAIRS:
                yield rows(*np.unique(np.concatenate(found), return_counts=True))
                found, held = [], 0
        if held:
            yield rows(*np.unique(np.concatenate(found), return_counts=True))
        at = np.flatnonzero(cells)
        if len(at):
            yield rows(-1 - at << WORD_BITS, cells[at])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, least = [], 0, 0
        for batch in batches:
            found.append(tuple(batch.column(k).flatten().to_numpy() for k in "an"))
            held += len(found[-1][0])
            if held > 2 * least + PART_PAIRS:  # so no more is held than a few times the bucket's distinct pairs
                found = [_added_up(found)]
                held = least = len(found[0][0])
        a, n = _added_up(found)
        c = a >> WORD_BITS
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        total = np.repeat(np.add.reduceat(n, first), np.diff(np.r_[first, len(c)]))
        kept = np.flatnonzero((c < 0) | (n >= 2))
        for i in range(0, len(kept), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[kept[i:i + 100_000]], pa.int64()) for x in (c, a, n, total)], ["c", "a", "n", "total"])

    return train.select("text").mapInArrow(count, "bucket int, a array<long>, n array<long>").groupBy("bucket").applyInArrow(
        add_up, "c long, a long, n long, total long")


def train_pairs(pairs: DataFrame, words: DataFrame, min_gain: float) -> DataFrame:
    """(c, a, n, total, weight, log_z) of every pair with a weight; ``pairs``: c, a, n, total; ``words``: leaf, code, q."""
    expected, context = F.col("total") * F.col("q"), Window.partitionBy("c")
    pairs = pairs.withColumn("leaf", F.shiftright("a", PREVIOUS_BITS + WORD_BITS)).withColumn("code", F.col("a").bitwiseAND(F.lit((1 << WORD_BITS) - 1)))
    gain = F.col("n") * F.log(F.col("n") / expected) - F.col("n") + expected
    held = pairs.join(words.groupBy("leaf", "code").agg(F.sum("q").alias("q")), ["leaf", "code"]).where((F.col("n") > expected) & (gain >= F.lit(min_gain))).withColumn("seen", F.col("n") - PAIR_DISCOUNT)

    def left(share: Column) -> Column:
        return F.greatest(1 - F.sum(share).over(context), F.lit(1e-9))

    share = F.col("seen") / F.col("total")
    held = held.withColumn("weight", F.log(share / F.col("q") * left(F.col("q")) / left(share)))
    norm = 1 + F.sum(F.col("q") * (F.exp("weight") - 1)).over(context)
    for _ in range(PAIR_ROUNDS):
        model = F.col("total") * F.col("q") * F.exp("weight") / F.col("z")
        step = RATE * (F.col("seen") - model - PAIR_L2 * F.col("weight")) / (model + PAIR_L2)
        held = held.withColumn("z", norm).withColumn("weight", F.col("weight") + F.greatest(F.least(step, F.lit(1.0)), F.lit(-1.0)))
    return held.withColumn("log_z", F.log(norm)).select("c", "a", "n", "total", "weight", "log_z")


def _fold(key: np.ndarray) -> np.ndarray:
    return (key ^ key >> 28 ^ key >> 36) & ((1 << KEY_BITS) - 1)


def _has(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which places of a bitmap, in bytes, are set."""
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _often_map(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << OFTEN_BITS, bool)
    out[_fold(keys) & (1 << OFTEN_BITS) - 1] = True
    return np.packbits(out, bitorder="little")


def _own_key(row: np.ndarray) -> np.ndarray:
    """Keys that spread texts' own rows and that neither a pair nor a context has: both top bits after the sign are set."""
    return row.astype(np.int64) | 3 << 61


def _key_map(features: DataFrame) -> np.ndarray:
    """Bitmap of the folded keys (see _fold), in bytes; built by Spark in rows of 2^ROW_BITS bits."""
    low = F.expr(f"(key ^ shiftright(key, 28) ^ shiftright(key, 36)) & {(1 << KEY_BITS) - 1}")
    out = np.zeros(1 << KEY_BITS - 3, np.uint8)
    rows = features.groupBy(F.shiftright(low, ROW_BITS).alias("line")).agg(
        F.bitmap_construct_agg(low.bitwiseAND(F.lit((1 << ROW_BITS) - 1))).alias("bits")).collect()  # at most 2^(KEY_BITS - ROW_BITS) rows
    for r in rows:
        out[r.line << ROW_BITS - 3:r.line + 1 << ROW_BITS - 3] = np.frombuffer(r.bits, np.uint8)
    return out


def train_weights(cells: DataFrame, rounds: int = ROUNDS, trace: list | None = None) -> Weights:
    """``cells``: rows (h1, at array, n array), at most LEAVES of them."""
    spark = cells.sparkSession
    sums = [F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(GROUPS)]

    def dense(batch):
        h1 = batch.column("h1").to_numpy()
        out = np.zeros((len(h1), 2 * LEAVES))
        for i, (at, n) in enumerate(zip(batch.column("at").to_pylist(), batch.column("n").to_pylist())):
            out[i, at] = n
        return h1, out[:, :LEAVES].reshape(-1, GROUPS, GROUPS), out[:, LEAVES:].reshape(-1, GROUPS, GROUPS)

    def rows(**tables):
        kinds, at, v = [], [], []
        for k, name in enumerate(Weights.names):
            some, values = tables[name]
            keep = np.flatnonzero(values.any(1))
            kinds += [np.full(len(keep), k)]
            at += [some[keep]]
            v += [values[keep]]
        return pa.RecordBatch.from_pydict({"kind": pa.array(np.concatenate(kinds), pa.int32()), "at": pa.array(np.concatenate(at), pa.int32()),
                                           "v": pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(v).ravel()), GROUPS).cast(pa.list_(pa.float64()))})

    def features(h1, groups, classes):
        """Feature counts from (h1, skip, group) and (h1, group, member) counts."""
        crossed = np.zeros((CROSS, GROUPS))
        np.add.at(crossed, _CROSSED[h1].ravel(), groups.reshape(-1, GROUPS))
        return rows(b=(np.zeros(1, int), groups.sum((0, 1))[None]), u=(h1, groups.sum(1)), s=(_K, groups.sum(0)), x=(np.arange(CROSS), crossed),
                    c=(_K, classes.sum(0)), w=((h1[:, None] * GROUPS + _K).ravel(), classes.reshape(-1, GROUPS)))

    def gather(make) -> dict[str, np.ndarray]:
        out = Weights()
        found = cells.mapInArrow(make, "kind int, at int, v array<double>").groupBy("kind", "at").agg(*sums).toArrow()  # fixed number of rows
        kind, at = found.column("kind").to_numpy(), found.column("at").to_numpy()
        v = np.stack([found.column(f"v{i}").to_numpy() for i in range(GROUPS)], 1) if len(kind) else np.zeros((0, GROUPS))
        for k, name in enumerate(Weights.names):
            getattr(out, name)[at[kind == k]] = v[kind == k]
        return {name: getattr(out, name) for name in Weights.names}

    def observed(batches):
        for batch in batches:
            if batch.num_rows:
                yield features(*dense(batch))

    seen = gather(observed)
    weights = Weights()
    weights.b = np.log(seen["b"] + 1.0)
    weights.c = np.log(seen["c"] + 1.0)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def expected(batches):
            for batch in batches:
                if batch.num_rows:
                    h1, groups, classes = dense(batch)
                    p, q = shared.value.group_logp(h1), shared.value.class_logp(h1)
                    yield features(h1, np.exp(p) * groups.sum(2, keepdims=True), np.exp(q) * classes.sum(2, keepdims=True))

        model = gather(expected)
        for name in Weights.names:
            w = getattr(weights, name)
            free = 0.0 if name in "bc" else L2
            gradient = seen[name] - model[name] - free * w
            setattr(weights, name, w + np.clip(RATE * gradient / (model[name] + PRIOR), -1.0, 1.0))
        shared.unpersist()
        if trace is not None:
            trace.append(sum(np.abs(seen[k] - model[k]).sum() for k in Weights.names))
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_words: int = HOT_WORDS, min_gain: float = MIN_GAIN) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    frame = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.monotonically_increasing_id().alias("row"),
                        F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % 7 == 2, F.lit(False)).alias("held_out"))
    train = frame.where("not held_out")
    vocabulary, _ = written(_count_words(train), "maxent-words")
    ends = train.count()
    spoken, distinct, once, twice = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1),
                                                   F.count_if(F.col("n") == 2)).first()
    total, size = spoken + ends, distinct + (ends > 0)
    discount = once / (once + 2 * twice) if once else 0.5

    own = vocabulary.orderBy(F.desc("n"), "word").limit(HOT_CLASSES).collect()
    hot = {r.word.encode(): i for i, r in enumerate(own)}
    has_class = F.col("word").isin([r.word for r in own])
    leaf = F.lit(TAIL) + F.crc32(F.expr("substring(cast(word as binary), -3, 3)")) % SUFFIXES
    tail = vocabulary.where(~has_class).groupBy(leaf.cast("int").alias("leaf")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # at most SUFFIXES rows
    tokens, kinds = np.zeros(LEAVES), np.zeros(LEAVES)
    for r in tail:
        tokens[r.leaf], kinds[r.leaf] = r.n, r.v
    unknown = np.where(tokens > 0, discount * kinds / np.maximum(tokens, 1), 1.0)

    place = (F.crc32(F.expr("substring(cast(word as binary), -3, 3)")) % SUFFIXES).cast("int")
    log_tokens = F.array(*(F.lit(float(x)) for x in np.log10(np.maximum(tokens[TAIL:END], 1))))
    log_unknown = F.array(*(F.lit(float(x)) for x in np.log10(unknown[TAIL:END])))
    counted, counted_path = written(_statistics(train, hot, spoken), "maxent-counts")
    cells, _ = written(counted.where("c < 0").groupBy(F.expr(f"cast((-1 - c) div {2 * LEAVES} as int)").alias("h1")).agg(
        F.collect_list(F.struct(((-1 - F.col("c")) % (2 * LEAVES)).cast("int").alias("at"), "n")).alias("held")).select(
        "h1", "held.at", "held.n").repartition(8, "h1"), "maxent-cells")
    base_measure = F.greatest(F.col("n") - discount, F.lit(1e-9)) / F.pow(F.lit(10.0), log_tokens[place])
    hashed = vocabulary.where(~has_class).select((place + TAIL).cast("long").alias("leaf"), F.shiftrightunsigned(F.xxhash64("word"), 64 - WORD_BITS).alias("code"),
                                                 base_measure.alias("q"))
    pairs, _ = written(train_pairs(counted.where("c >= 0"), hashed, min_gain), "maxent-pairs")
    remove(spark, counted_path)
    features = pairs.select(F.col("a").alias("key"), F.col("n").alias("uses"), (F.col("weight") / np.log(10)).alias("value")).unionByName(
        pairs.groupBy(F.col("c").bitwiseOR(F.lit(CONTEXT)).alias("key")).agg(F.first("total").alias("uses"), (-F.first("log_z") / np.log(10)).alias("value")))
    features, _ = written(features, "maxent-features")
    often = F.col("uses") * hot_words >= spoken
    held = features.where(often).select("key", "value").toArrow()  # at most 2 * HOT_WORDS rows
    hot_keys, hot_values = (held.column(c).to_numpy() for c in ("key", "value"))
    order = np.argsort(hot_keys)
    hot_keys, hot_values = np.r_[hot_keys[order], np.iinfo(np.int64).max], np.r_[hot_values[order], 0.0]
    features = features.where(~often)
    weights = train_weights(cells)

    known = dict(vocabulary.where((F.col("n") * hot_words >= spoken) | has_class).toPandas().itertuples(index=False, name=None)) if spoken else {}
    names = [w.encode() for w in known]
    counts = np.array(list(known.values()), float)
    base = np.log10((counts + 1) / (total + size + 1))
    leaves = np.array([hot[w] if w in hot else tail_class(w) for w in names], np.int64)
    inner = np.where(leaves < TAIL, 0.0, np.log10(np.maximum(counts - discount, 1e-9) / np.maximum(tokens[leaves], 1)))
    base_unknown, base_end = np.log10(1 / (total + size + 1)), np.log10((ends + 1) / (total + size + 1))
    ten = np.log(10)
    shared = spark.sparkContext.broadcast({
        "code": {w: i for i, w in enumerate(names)}, "base": base, "inner": inner,
        "packed": np.array([_packed(w, leaf) for w, leaf in zip(names, leaves.tolist())], np.int64), "keys": _key_map(features), "often": _often_map(hot_keys[:-1]),
        "hot": hot_keys, "value": hot_values, "unknown": np.log10(unknown),
        "group": (weights.group_logp(_H1) / ten).astype(np.float32), "class": (weights.class_logp(_H1) / ten).astype(np.float32)})

    def rate(batches):
        m = shared.value
        tokens = _Tokens(m["code"])
        group, classes = m["group"].ravel(), m["class"].ravel()
        for part in slices(batches, size=SLICE_BYTES // 8):
            n = part.num_rows
            distinct, length, word, code = coded(part.column("text"), tokens)
            new = code < 0  # of each distinct word, as the next three
            packed, base, inner = ~code, np.zeros(len(code)), np.zeros(len(code))
            packed[~new] = m["packed"][code[~new]]
            base[~new] = m["base"][code[~new]]
            inner[new], inner[~new] = m["unknown"][packed[new] >> HASH_BITS], m["inner"][code[~new]]
            doc, leaf, before, skip, at, key = laid_out(length, packed[word])
            of = np.repeat(np.arange(n), length)

            def summed(where, values):
                return np.bincount(where, values, n)

            strange = np.flatnonzero(new[word])
            rare = np.bincount(of[strange], minlength=n)
            bases = summed(of, base[word]) + base_end + rare * base_unknown
            scores = summed(doc, group[before * LEAVES + skip * GROUPS + leaf // GROUPS] + classes[before * LEAVES + leaf].astype(float)) + summed(of, inner[word])
            at, key = np.repeat(at, 2), np.c_[key, key >> WORD_BITS | CONTEXT].ravel()
            low = _fold(key)
            seen = np.flatnonzero(_has(m["often"], low & (1 << OFTEN_BITS) - 1))
            place = np.searchsorted(m["hot"], key[seen])
            same = m["hot"][place] == key[seen]
            scores += summed(at[seen[same]], m["value"][place[same]])
            left = _has(m["keys"], low)
            left[seen[same]] = False
            # What is looked up: each key once for each text, with its number of times; where another key's hash is the same, in parts.
            key, at = key[left], at[left]
            order = np.argsort(at.astype(np.uint64) << np.uint64(64 - AT_BITS) | mix64(key.astype(np.uint64)) >> np.uint64(AT_BITS))
            key, at = key[order], at[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (at[1:] != at[:-1])][:len(key)])
            key, at, times = key[first], at[first], np.diff(np.r_[first, len(key)])
            rare_at, rare_times = np.unique(of[strange] * len(distinct) + word[strange], return_counts=True)
            rare_at, unlike = np.divmod(rare_at, max(len(distinct), 1))
            ids = part.column("row").to_numpy()
            f, k = len(key), len(unlike)
            own = pa.StructArray.from_arrays([part.column("id"), part.column("held_out"), pa.array(length + 1, pa.int64()), pa.array(length + 1 - rare - (ends == 0), pa.int64()),
                                              pa.array(bases, pa.float64()), pa.array(scores, pa.float64())],
                                             ["id", "held_out", "n_tokens", "n_known", "base", "score"])
            hashes = packed[unlike] & (1 << HASH_BITS) - 1 | np.iinfo(np.int64).min
            yield pa.RecordBatch.from_pydict({
                # Keys of words are below zero, those of pairs and contexts are not; a text's own row has one that no lookup has.
                "key": pa.concat_arrays([pa.array(key, pa.int64()), pa.array(hashes, pa.int64()), pa.array(_own_key(ids))]),
                "word": pa.concat_arrays([pa.array([""], pa.string()).take(pa.array(np.zeros(f, np.int64))), distinct.take(pa.array(unlike, pa.int64())),
                                          pa.nulls(n, pa.string())]),
                "row": pa.array(np.r_[ids[at], ids[rare_at], ids], pa.int64()),
                "times": pa.concat_arrays([pa.array(times, pa.int64()), pa.array(rare_times, pa.int64()), pa.nulls(n, pa.int64())]),
                # A list takes no room where there is none; a null struct takes that of its fields.
                "own": pa.ListArray.from_arrays(pa.array(np.r_[np.zeros(f + k), np.arange(n + 1)], pa.int32()), own, mask=pa.array(np.arange(f + k + n) < f + k))})

    rows = frame.mapInArrow(rate, f"key long, word string, row long, times long, own array<struct<id: {kind}, held_out: boolean, n_tokens: long, n_known: long, base: double, score: double>>")
    gain = F.log10(F.greatest(F.col("n") - discount, F.lit(1e-9))) - log_tokens[place] - log_unknown[place]
    rare = vocabulary.where((F.col("n") * hot_words < spoken) & ~has_class).select(
        F.shiftrightunsigned(F.xxhash64("word"), 64 - HASH_BITS).bitwiseOR(F.lit(-1 << 63)).alias("key"), F.col("word").alias("its"), F.col("n").alias("c"), gain.alias("value"))
    looked_up = rare.unionByName(features.select("key", F.lit("").alias("its"), F.lit(0).cast("long").alias("c"), "value"))
    # A text's own row counts its rare words as unknown; each word found adds the difference, each pair and context its value.
    # The join is by key alone; a word that merely shares the hash of another adds nothing.
    hit, times = F.coalesce(F.col("word") == F.col("its"), F.lit(False)), F.col("times")
    # The looked-up rows of a partition are the fewer ones: they are hashed, the others need no sort.
    found = rows.join(looked_up.hint("shuffle_hash"), "key", "left").select(
        "row", F.get("own", F.lit(0)).alias("own"), F.when(hit & (F.col("word") != ""), times).otherwise(0).alias("known"),
        F.when(hit, times * F.log10(F.col("c") + F.lit(1.0))).otherwise(0.0).alias("base"), F.when(hit, times * F.col("value")).otherwise(0.0).alias("score"))
    return found.groupBy("row").agg(
        F.max("own.id").alias(id_col), F.max("own.held_out").alias("held_out"), F.max("own.n_tokens").alias("n_tokens"),
        (F.max("own.n_known") + F.sum("known")).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.max("own.base") + F.sum("base")).alias("base_score"), (F.max("own.score") + F.sum("score")).alias("score")).drop("row")
