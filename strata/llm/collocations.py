"""Operator 13: phrase collocations by dynamic itemset counting.

Documents are dealt into ``shards`` parts of a written table that are scanned in turn, over and over. Words are on trial
from the first scan on. A phrase of two words goes on trial with the scan after both its words reached ``least``
occurrences. A trial ends when the phrase reaches ``least`` itself, or after one full cycle. A phrase that reached it
is counted by name for one full cycle, so over every part once, and so is one of three words from the scan after both
its two-word phrases reached it. A phrase that occurs ``least`` times has parts that do, so none is missed, and the scans
end when no cycle runs any more. All lengths share the scans.

Trials are counted by hash: per slice of texts and hash bucket one sorted run of cells and counts, merged bucket by
bucket (their number grows with the texts, so a bucket stays small). When a phrase reached ``least`` is kept by slot: one
byte for each of a fixed number of slots of words and of two-word phrases holds the first scan after which a cell of the slot had
``least`` occurrences. These bytes are the only thing broadcast, and their number does not depend on the data.
Phrases that share a cell or slot may go on early, which costs time but changes no count: all results come from the counts by
name, whose cycles start where the bytes say, though not before the phrase's own trial, the same in every task and scan. With far more frequent phrases
than slots more phrases are named than need be.

Within a task, bounded slices of texts are cut into words and counted by number as numpy arrays; only distinct phrases
of a slice leave it, are combined map-side and meet by (language, phrase) once. Scores use the exact totals: a candidate's
cuts are joined with the counts of their parts, which adaptive execution splits where a part is hot; the rank per
language is limited before its shuffle.

Defined results: null texts count as empty, a null language is ``und``; a text without words adds nothing; repeated rows
count each; equal scores go by count, then phrase; an empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import mix64, remove, slices, written
from strata.session import scratch_path

SHARDS, LEAST, TOP = 3, 10, 2000
#: Slots of words and of two-word phrases; a byte each goes to every executor.
WORD_SLOTS, PAIR_SLOTS = 1 << 22, 1 << 24
NEVER = 255
SLICE_ROWS, SLICE_BYTES = 10_000, 16 << 20
#: A two-word phrase with this percentage of a candidate's occurrences inside one longer phrase is dropped.
COVERED = 50
#: Slots of one bitmap that Spark's bitmap functions make (fixed value).
_BITMAP = 8 * 4096

_BLANK, _END = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x09, 0x20]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CELLS = np.uint64((1 << 32) - 1)
#: Bytes of text for one hash bucket of trials.
BUCKET_BYTES = 4 << 20
#: What a scan writes: counts by name, and runs of cells on trial (lang, phrase and n null).
_COUNTS = "len tinyint, lang string, phrase string, n long, bucket int, cells binary"
_TRIALS = "len tinyint, bucket int, cells binary, slots array<int>"


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column without nulls."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    return at, np.frombuffer(held, np.uint8) if held else np.empty(0, np.uint8)


def _hashes(column: pa.Array) -> np.ndarray:
    """64-bit hashes of byte strings: the same for equal strings in every process."""
    at, data = _buffers(column)
    sizes = np.diff(at)
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        data = data[at[0]:at[-1]]
        place = np.arange(len(data)) - np.repeat(at[:-1] - at[0], sizes)
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(sizes.max()), _BASE)]))
        out[some] = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[place], at[:-1][some] - at[0])
    return mix64(out + sizes.astype(np.uint64))


def _distinct(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, each key's number among them, occurrences) of whole numbers below ``bound``."""
    if bound <= 4 * len(keys) + (1 << 20):
        counts = np.bincount(keys, minlength=1)
        distinct = np.flatnonzero(counts)
        number = np.zeros(len(counts), np.int64)
        number[distinct] = np.arange(len(distinct))
        return distinct, number[keys], counts[distinct]
    return np.unique(keys, return_inverse=True, return_counts=True)


def _words(batch: pa.RecordBatch):
    """(number of each word's distinct (language, word), the next word stands in the same piece, languages, words,
    occurrences) with a language and a word number for each distinct one, and the dictionaries."""
    at, data = _buffers(batch.column("text"))
    data, at = data[at[0]:at[-1]], at - at[0]
    kind = _KIND[data]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    first[edges] = inside[edges]  # a text's first word begins, and the last word before it ends, at its edge
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return None
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
    encoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(_LOWER[data[inside]]))]).dictionary_encode()
    ids, words = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary
    text = np.searchsorted(at, starts, side="right") - 1
    piece = np.cumsum(kind == _END, dtype=np.int32)[starts]
    joined = np.append((piece[1:] == piece[:-1]) & (text[1:] == text[:-1]), False)
    langs = batch.column("lang").dictionary_encode()
    lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
    units, unit, counts = _distinct(lang * len(words) + ids, len(langs.dictionary) * len(words))
    return unit, joined, units // len(words), units % len(words), counts, langs.dictionary, words


def _named(length: int, langs: pa.Array, words: pa.Array, lang: np.ndarray, parts: list, n: np.ndarray) -> pa.RecordBatch:
    taken = [words.take(pa.array(p)) for p in parts]
    phrase = taken[0] if length == 1 else pc.binary_join_element_wise(*taken, pa.scalar(b" ", pa.large_binary()))
    return _batch(length, langs.take(pa.array(lang)).cast(pa.string()), phrase.cast(pa.large_string()).cast(pa.string()),
                  pa.array(n.astype(np.int64)), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary()))


def _batch(length: int, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), length, np.int8)), *columns], ["len", "lang", "phrase", "n", "bucket", "cells"])


def _packed(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted cells as differences, byte plane by byte plane (the upper ones are nearly all zero), then the counts."""
    steps = np.diff(cells, prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 5
    planes = np.frombuffer(data, np.uint8)
    steps = np.ascontiguousarray(planes[:4 * n].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32), planes[4 * n:].astype(np.int64)


def _cells(hashed: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    buckets = np.uint64(buckets)
    return (hashed % buckets).astype(np.int64), ((hashed // buckets) & _CELLS).astype(np.uint32)


def _slots(bucket: np.ndarray, cell: np.ndarray, slots: int) -> np.ndarray:
    return (mix64((bucket.astype(np.uint64) << np.uint64(32)) | cell.astype(np.uint64)) % np.uint64(slots)).astype(np.int64)


def _trial(length: int, bucket: np.ndarray, cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((cell, bucket))
    bucket, cell, n = bucket[order], cell[order], n[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    runs = [_packed(cell[i:j], n[i:j]) for i, j in zip(edges[:-1], edges[1:])]
    none = len(runs)
    return _batch(length, pa.nulls(none, pa.string()), pa.nulls(none, pa.string()), pa.nulls(none, pa.int64()),
                  pa.array(bucket[edges[:-1]].astype(np.int32)), pa.array(runs, pa.binary()))


def _count(batch: pa.RecordBatch, scan: int, shards: int, buckets: int, word_starts: np.ndarray, pair_starts: np.ndarray):
    """What a slice adds in this scan: cells of phrases on trial, and occurrences of those counted by name."""
    found = _words(batch)
    if found is None:
        return
    unit, joined, unit_lang, unit_word, counts, langs, words = found

    def runs(start):
        return (start <= scan) & (scan < start.astype(np.int64) + shards)

    def counted(length, hashed, starts, tested, counts, lang, parts):
        """Each phrase's start by name, ``tested`` (the scan its trial starts with) at the earliest, as another phrase
        of its slot may have gone on before; rows of those on trial or by name in this scan."""
        bucket, cell = _cells(hashed, buckets)
        start = np.maximum(starts[_slots(bucket, cell, len(starts))], tested)
        tried, named = runs(tested) & (start > scan), runs(start)
        rows = [_trial(length, bucket[tried], cell[tried], counts[tried])] if tried.any() else []
        if named.any():
            rows.append(_named(length, langs, words, lang[named], [p[named] for p in parts], counts[named]))
        return start, rows

    hashed = mix64(_hashes(words)[unit_word] ^ mix64(_hashes(langs)[unit_lang] + _BASE))
    if scan < shards:  # all words of each language, in rows of length 0
        total = np.bincount(unit_lang, weights=counts, minlength=len(langs)).astype(np.int64)
        own = np.flatnonzero(total)
        yield _batch(0, langs.take(pa.array(own)).cast(pa.string()), pa.array([""] * len(own)), pa.array(total[own]),
                     pa.nulls(len(own), pa.int32()), pa.nulls(len(own), pa.binary()))
    start, rows = counted(1, hashed, word_starts, np.zeros(len(hashed), np.uint8), counts, unit_lang, [unit_word])
    yield from rows
    ready = start[unit] <= scan
    at = np.flatnonzero(joined[:-1] & ready[:-1] & ready[1:])  # where a phrase of two frequent words begins
    if not len(at):
        return
    pairs, pair, counts = _distinct(unit[at] * len(unit_lang) + unit[at + 1], len(unit_lang) ** 2)
    one, two = pairs // len(unit_lang), pairs % len(unit_lang)
    pair_start, rows = counted(2, mix64(hashed[one] * _BASE + mix64(hashed[two])), pair_starts, np.maximum(start[one], start[two]),
                               counts, unit_lang[one], [unit_word[one], unit_word[two]])
    yield from rows
    follows = np.flatnonzero(np.diff(at) == 1)  # the next phrase begins one word later
    follows = follows[runs(np.maximum(pair_start[pair[follows]], pair_start[pair[follows + 1]]))]
    if len(follows):
        triples, _, counts = _distinct(pair[follows] * len(unit_lang) + unit[at[follows] + 2], len(pairs) * len(unit_lang))
        first, third = triples // len(unit_lang), triples % len(unit_lang)
        yield _named(3, langs, words, unit_lang[third], [unit_word[one[first]], unit_word[two[first]], unit_word[third]], counts)


# ---- scans -----------------------------------------------------------------------------------------------
def _merged(runs: pa.Table, least: int, slots: dict[int, int]) -> pa.Table:
    """One bucket's runs as one: cells below ``least``, and the slots of those that reached it."""
    length, bucket = runs.column("len")[0].as_py(), runs.column("bucket")[0].as_py()
    cells, counts = (np.concatenate(x) for x in zip(*map(_unpacked, runs.column("cells").to_pylist())))
    cells, which = np.unique(cells, return_inverse=True)
    counts = np.bincount(which, weights=counts).astype(np.int64)
    reached = cells[counts >= least]
    rest = _packed(cells[counts < least], counts[counts < least])
    slot = _slots(np.full(len(reached), bucket), reached, slots[length]).astype(np.int32)
    return pa.table({"len": pa.array([length], pa.int8()), "bucket": pa.array([bucket], pa.int32()), "cells": pa.array([rest], pa.binary()),
                     "slots": pa.array([slot], pa.list_(pa.int32()))})


def _reached(merged: DataFrame, starts: dict[int, np.ndarray], scan: int) -> None:
    """Slots with a cell that reached the threshold count by name from the next scan on."""
    bitmaps = merged.selectExpr("len", "explode(slots) as at").groupBy("len", F.expr("bitmap_bucket_number(at + 1) as part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(at + 1)) as bits"))
    for length, part, bits in bitmaps.collect():  # at most slots / 8 bytes
        marked = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) + (part - 1) * _BITMAP
        new = marked[starts[length][marked] == NEVER]
        starts[length][new] = scan + 1


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, shards: int = SHARDS,
                  word_slots: int = WORD_SLOTS, pair_slots: int = PAIR_SLOTS) -> tuple[DataFrame, DataFrame]:
    """(len, lang, phrase, n of every phrase of 1 to 3 words with ``least`` occurrences; lang, words of every language
    with a word), as written tables. ``least`` is at most 255 (trial counts are bytes)."""
    if not 1 <= least <= 255:
        raise ValueError(f"least must be in 1..255, got {least}")
    spark: SparkSession = docs.sparkSession
    root = scratch_path(spark, "collocation-shards")
    docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                (F.monotonically_increasing_id() % shards).cast("int").alias("shard")).write.partitionBy("shard").parquet(root)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(root)
    buckets = 64 + (dealt.agg(F.expr("sum(octet_length(text))")).first()[0] or 0) // BUCKET_BYTES
    starts = {1: np.full(word_slots, NEVER, np.uint8), 2: np.full(pair_slots, NEVER, np.uint8)}
    sizes = {1: word_slots, 2: pair_slots}
    tables, waiting, scan = [], None, 0

    def last(length):
        """The last scan in which a cycle that starts with a slot of phrases of this length runs."""
        return int(starts[length][starts[length] != NEVER].max(initial=0)) + shards - 1

    while scan < shards or scan <= max(last(1), last(2)):
        shared = spark.sparkContext.broadcast((starts[1], starts[2]))

        def run(batches, scan=scan, shared=shared):
            for part in slices(batches, rows=SLICE_ROWS, size=SLICE_BYTES):
                yield from _count(part, scan, shards, buckets, *shared.value)

        tables.append(written(dealt.where(f"shard = {scan % shards}").select("lang", "text").mapInArrow(run, _COUNTS), f"collocations-{scan}"))
        shared.destroy()
        if scan < shards or scan <= last(1):  # trials run
            trials = tables[-1][0].where("bucket is not null").select("len", "bucket", "cells")
            if waiting:
                trials = trials.unionByName(waiting[0].select("len", "bucket", "cells").where("len > 1" if scan >= shards else "true"))
            merged = written(trials.groupBy("len", "bucket").applyInArrow(lambda runs: _merged(runs, least, sizes), _TRIALS), "collocations-waiting")
            _reached(merged[0], starts, scan)
            if waiting:
                remove(spark, waiting[1])
            waiting = merged
        scan += 1
    named = functools.reduce(DataFrame.unionByName, [t[0] for t in tables]).where("bucket is null")
    langs, _ = written(named.where("len = 0").groupBy("lang").agg(F.expr("sum(n) as words")), "collocations-languages", 1)
    totals, _ = written(named.where("len > 0").groupBy("len", "lang", "phrase").agg(F.expr("sum(n) as n")).where(f"n >= {least}"), "collocations-totals")
    for path in [root, waiting[1], *[t[1] for t in tables]]:
        remove(spark, path)
    return totals, langs


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, shards: int = SHARDS,
                 word_slots: int = WORD_SLOTS, pair_slots: int = PAIR_SLOTS) -> DataFrame:
    """The ``top`` phrases of each language by how much oftener they occur than their parts would together: lang, rank,
    phrase, a, l, r (occurrences of the phrase and of the two parts at its weakest cut), n (words of the language), score."""
    totals, langs = phrase_counts(docs, text_col, lang_col, least, shards, word_slots, pair_slots)
    candidates = totals.where("len > 1").selectExpr("len", "lang", "phrase", "n as a", "split(phrase, ' ') as w")
    inside = totals.where("len = 3").selectExpr("lang as in_lang", "n as longer", "split(phrase, ' ') as w").selectExpr(
        "in_lang", "longer", "explode(array(concat_ws(' ', w[0], w[1]), concat_ws(' ', w[1], w[2]))) as part").groupBy("in_lang", "part").agg(
        F.expr("max(longer) as longer"))
    kept = candidates.join(inside, F.expr("lang = in_lang and phrase = part"), "left").where(f"coalesce(100 * longer < {COVERED} * a, true)")
    cuts = kept.selectExpr("lang", "phrase", "a", "w", "len", "explode(sequence(1, int(len) - 1)) as k").selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') as first", "array_join(slice(w, k + 1, len), ' ') as rest")
    part = lambda name, n: totals.selectExpr(f"lang as {name}_lang", f"phrase as {name}_phrase", f"n as {n}")
    cuts = cuts.join(part("l", "l"), F.expr("lang = l_lang and first = l_phrase")).join(part("r", "r"), F.expr("lang = r_lang and rest = r_phrase"))
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    scored = cuts.selectExpr("lang", "phrase", "a", f"struct(({wide('a')} * {wide('a')} * 1000000) div ({wide('l')} * {wide('r')}) as score, k, l, r) as cut")
    weakest = scored.groupBy("lang", "phrase").agg(F.expr("max(a) as a"), F.expr("min(cut) as cut"))
    ranked = weakest.withColumn("rank", F.expr("row_number() over (partition by lang order by cut.score desc, a desc, phrase)")).where(f"rank <= {top}")
    return ranked.join(langs.withColumnRenamed("lang", "of"), F.expr("lang = of")).selectExpr(
        "lang", "bigint(rank) as rank", "phrase", "a", "cut.l as l", "cut.r as r", "words as n", "cut.score as score")
