"""Operator 7: benchmark decontamination by latent semantic retrieval.

Passages longer than the longest window are cut into pieces of at most its length, which are searched one by one.
The benchmark is taken in blocks of at most BLOCK pieces, each with a latent space of its own, with a dimension for each piece:

1. Every document's words are written as numbers of the block's terms, from which the document frequencies of these
   are counted.
2. A distributed randomised SVD of TF-IDF passages - the block's own, and those of PASSAGE words of all
   documents - gives the latent space. The columns are the block's terms: no other term has a part in a product with a
   benchmark passage. Tasks multiply the Gram matrix of their rows with a sparse random basis, the sums have a fixed size; the
   space is taken from that one product (Nystroem's method).
3. Every document is cut into overlapping windows of three lengths, STRIDE words apart; a window's latent
   vector is a sum of its words' vectors, so its products with the pieces are sums of its words' products,
   which are worked out once. The window's norm counts all its words, so a shared word or two do not make a
   candidate; the threshold follows the part of the piece that the latent space holds, and where the window
   outweighs the piece, the piece's norm, so that other words around a short passage do not hide it.
4. A candidate is confirmed by the longest common subsequence of words with the whole passage: at least LCS of
   the passage's words, or, for paraphrases, at least LOOSE of them together with its answer (its last
   sentence, or its last five words if it has one sentence only). Passages under SHORT words in windows below
   the plain cosine must keep to a stretch a quarter longer than themselves.

Words are compared in lower case without the marks around them. Defined results: null and empty texts
match nothing; passages without words match nothing, passages under five words must be found whole; of
repeated rows (equal document and passage ids) one result row stays; null ids keep their matches; an
empty table gives an empty result; other columns are ignored or, in :func:`without_leaks`, kept.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SLICE_BYTES, remove, slices, written

BLOCK, PASSAGE, STRIDE, PARTS, EXTRA = 256, 48, 12, 8, 8
#: Bytes of word numbers in a slice; passages multiplied at once.
CODE_BYTES, GROUP = SLICE_BYTES // 4, 1024
#: Windows in strides, and from how many words on a passage is searched with them.
LENGTHS = ((2, 0), (3, 22), (5, 38))
COSINE, LCS, LOOSE = 0.28, 0.75, 0.5
SHORT = 2 * STRIDE
PAD = 5 * STRIDE  # words of the longest window
_MARKS = ".,;:!?\"'()[]{}<>*#%$&|~`_-–—…“”‘’«»"


def _split(column: pa.Array) -> pa.Array:
    """The raw words of each text (nulls: none)."""
    column = column.cast(pa.string()).fill_null("")
    if pc.any(pc.match_substring_regex(column, "[\\x1c-\\x1f]")).as_py():  # separators, but no white space to Unicode
        column = pc.replace_substring_regex(column, "[\\x1c-\\x1f]", " ")
    return pc.utf8_split_whitespace(column)


def _bare(raw: pa.Array) -> pa.Array:
    """Words in lower case without the marks around them (the splitting may leave white space at a text's end)."""
    return pc.utf8_trim(pc.utf8_trim_whitespace(pc.utf8_lower(raw)), characters=_MARKS)


def words_of(text: str) -> list[str]:
    return [w for w in _bare(_split(pa.array([text])).flatten()).to_pylist() if w]


def common_length(item: list[int], region: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel steps over the region."""
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in region.tolist():
        if (m := where.get(w)) is not None:
            u = row & m
            row = (row + u | row - u) & full
    return len(item) - row.bit_count()


def piece_count(words: int) -> int:
    return -(-words // PAD)


class Passages:
    """One block of the benchmark: terms, their weights and the latent space; picklable.

    ``items``: (id, text) or, for some of a passage's pieces, (id, text, first piece, end).
    """

    def __init__(self, items: list[tuple]):
        kept = [(i, t, words_of(t or ""), slice(*part or (None,))) for i, t, *part in items]
        kept = [k for k in kept if k[2]]
        self.ids = [i for i, *_ in kept]
        self.terms: dict[str, int] = {}
        self.items = [[self.terms.setdefault(x, len(self.terms)) for x in w] for _, _, w, _ in kept]
        cut = [np.array_split(np.array(item), piece_count(len(item)))[part] for item, (*_, part) in zip(self.items, kept)]
        self.pieces = [p for parts in cut for p in parts]
        self.owner = np.repeat(np.arange(len(cut)), [len(parts) for parts in cut])
        self.answers = []
        for (_, text, *_), item in zip(kept, self.items):
            parts = [p for p in re.split(r"(?<=[.?!])\s+", text.strip()) if words_of(p)]
            last = len(words_of(parts[-1])) if len(parts) > 1 else 5
            self.answers.append(item[-min(last, len(item)):])

    def coded(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers of the words of all texts (nulls: empty), -1 for other words, and where each text's begin, with
        the end; tokens of marks only are left out. Each distinct word of the column is looked up once."""
        lists = _split(column)
        at = lists.offsets.to_numpy().astype(np.int64)
        encoded = lists.flatten().dictionary_encode()
        bare = _bare(encoded.dictionary)
        known = pc.index_in(bare, value_set=pa.array(self.terms, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        known[pc.equal(bare, "").to_numpy(zero_copy_only=False)] = -2
        codes = known[encoded.indices.to_numpy(zero_copy_only=False)] if len(bare) else np.empty(0, np.int64)
        kept = codes > -2
        return codes[kept], np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])[at - at[0]]

    def codes(self, text: str) -> np.ndarray:
        return self.coded(pa.array([text]))[0]

    def rows(self, codes: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit TF-IDF rows of the texts' consecutive passages of ``length`` words: (row, term, value), by row."""
        sizes = np.diff(at)
        count = -(-sizes // length)
        place = np.arange(len(codes)) - np.repeat(at[:-1] - at[0], sizes)
        row, known = np.repeat(np.cumsum(count) - count, sizes) + place // length, codes >= 0
        key, n = np.unique(row[known] * len(self.terms) + codes[known], return_counts=True)
        row, term = key // len(self.terms), key % len(self.terms)
        value = n * self.idf[term]
        return row, term, value / np.sqrt(np.bincount(row, value * value))[row]

    def set_frequencies(self, counts: np.ndarray, documents: int):
        self.idf = np.log((documents + 1) / (counts + 0.5)).clip(0.05)
        self.other = float(np.median(self.idf))  # the weight of words outside the block, in norms only

    def own_rows(self) -> np.ndarray:
        sizes = [len(p) for p in self.pieces]
        row, term, value = self.rows(np.concatenate(self.pieces), np.cumsum([0, *sizes]), max(sizes))
        out = np.zeros((len(sizes), len(self.terms)))
        out[row, term] = value
        return out

    def add_products(self, sums: np.ndarray, codes: np.ndarray, at: np.ndarray, bucket: np.ndarray, sign: np.ndarray):
        """Add the product of the Gram matrix of all passages of the texts with the basis that holds, for each term, ``sign``
        in column ``bucket``: every two words of a passage add to one of the sums."""
        row, term, value = self.rows(codes, at, PASSAGE)
        width = sums.shape[1]
        for first in range(0, int(row[-1]) + 1 if len(row) else 0, GROUP):
            i, j = np.searchsorted(row, [first, first + GROUP])
            t, v, n = term[i:j], value[i:j], np.bincount(row[i:j] - first, minlength=GROUP)
            start, n = np.repeat(np.cumsum(n) - n, n), np.repeat(n, n)
            one = np.repeat(np.arange(j - i), n)
            two = np.arange(len(one)) - np.repeat(np.cumsum(n) - n - start, n)
            sums += np.bincount(t[one] * width + bucket[t[two]], v[one] * (v * sign[t])[two], sums.size).reshape(sums.shape)

    def set_space(self, basis: np.ndarray):
        """``basis``: terms x rank, orthonormal columns."""
        own = self.own_rows() @ basis
        self.held = np.linalg.norm(own, axis=1).astype(np.float32)  # how much of each piece the space holds
        latent = own / np.maximum(self.held[:, None], 1e-9)
        self.norms = np.sqrt([sum(n * n * self.idf[t] ** 2 for t, n in Counter(p.tolist()).items()) for p in self.pieces]).astype(np.float32)
        # A word's products with the pieces, over the part that the space holds, and its squared weight: the last place
        # stands for padding, the one before for other words.
        table = np.zeros((len(self.terms) + 2, len(own)), np.float32)
        table[:-2] = basis * self.idf[:, None] @ latent.T / self.held.clip(1e-9)
        self.squares = np.r_[self.idf ** 2, self.other ** 2, 0.0].astype(np.float32)
        sizes = np.array([len(p) for p in self.pieces])
        self.by_length = []
        for k, (strides, least) in enumerate(LENGTHS):
            most = LENGTHS[k + 1][1] if k + 1 < len(LENGTHS) else 1 << 30
            pieces = np.flatnonzero((sizes >= least) & (sizes < most))
            if len(pieces):  # a word's greatest product with any of them bounds what a window can reach
                own_table = np.ascontiguousarray(table[:, pieces])
                self.by_length.append((strides, pieces, own_table, own_table.max(1).clip(0), float(self.norms[pieces].min())))

    def candidates(self, docs: list[np.ndarray]) -> list[tuple[int, int, int, float]]:
        """(document, item, first word of the window, cosine) of all windows that come near a piece of an item."""
        found: list[tuple[int, int, int, float]] = []
        pad, other = len(self.terms) + 1, len(self.terms)
        start = 0
        while start < len(docs):  # documents are handled together up to about 40,000 words
            stop, held = start, 0
            while stop < len(docs) and (stop == start or held + len(docs[stop]) < 40_000):
                held += len(docs[stop])
                stop += 1
            for first in range(0, max(held, 1), 120_000) if stop == start + 1 else (0,):
                group = docs[start:stop] if stop > start + 1 else [docs[start][first:first + 120_000 + 2 * PAD]]
                self._search(group, start, first, pad, other, found)
            start = stop
        return found

    def _search(self, group, number, offset, pad, other, found):
        parts, owner, place = [], [], []
        for k, codes in enumerate(group):
            n = -len(codes) % STRIDE + PAD
            parts += [np.where(codes < 0, other, codes), np.full(n, pad)]
            blocks = (len(codes) + n) // STRIDE
            owner.append(np.full(blocks, number + k))
            place.append(np.arange(blocks) * STRIDE + offset)
        codes, owner, place = np.concatenate(parts), np.concatenate(owner), np.concatenate(place)
        blocks = codes.reshape(-1, STRIDE)
        weights = self.squares[blocks].sum(1)
        for strides, pieces, table, most, least in self.by_length:
            count = len(blocks) - strides + 1
            if count <= 0:
                continue
            bound = most[blocks].sum(1)
            weight, reach = (sum(x[k:k + count] for k in range(strides)) for x in (weights, bound))
            norm = np.sqrt(weight)
            # Products with all pieces are worked out for the windows only that can come near one at all.
            able = np.flatnonzero(reach * 1.0001 + 1e-5 >= COSINE * np.minimum(norm, least))
            for i in range(0, len(able), 256):
                at = able[i:i + 256]
                near = table[blocks[at[:, None] + np.arange(strides)].reshape(len(at), -1)].sum(1)
                row, which = np.nonzero(near >= COSINE * np.minimum(norm[at, None], self.norms[pieces]) + 1e-6)
                at = at[row]
                found += zip(owner[at].tolist(), self.owner[pieces[which]].tolist(), place[at].tolist(), (near[row, which] / norm[at]).tolist())

    def _stretches(self, item: list[int], region: np.ndarray, least: float):
        """Parts of the region, a quarter longer than the item, that hold enough of its words; those with most of them first."""
        size = min(len(item) + len(item) // 4, len(region))
        held = np.cumsum(np.r_[0, np.isin(region, item)])
        held = held[size:] - held[:-size]
        for at in np.argsort(-held, kind="stable").tolist():
            if held[at] < least * len(item):
                return
            yield region[at:at + size]

    def leaks(self, codes: np.ndarray, at: np.ndarray) -> list[tuple[int, int, float, float, bool]]:
        """(document, item, cosine, share of the item's words, answer found) of confirmed matches."""
        docs = [codes[i:j] for i, j in zip(at[:-1], at[1:])]
        best: dict[tuple[int, int], tuple] = {}
        tried = set()
        for d, i, first, cosine in sorted(self.candidates(docs), key=lambda c: -c[3]):
            if (d, i) in best:
                continue
            item, slack = self.items[i], max(PAD, len(self.items[i]))
            step = slack // 2 if slack > PAD else 1  # the many windows near a long passage share a few regions
            first -= first % step
            if (d, i, first) in tried:
                continue
            tried.add((d, i, first))
            region, least = docs[d][max(0, first - slack):first + step - 1 + 2 * slack], 1.0 if len(item) < 5 else LOOSE
            present = np.zeros(len(self.terms) + 1, bool)
            present[region] = True  # -1, other words, falls on the last place
            if present[item].sum() < least * len(item):  # a subsequence can't be longer
                continue
            for part in self._stretches(item, region, least) if cosine < COSINE and len(item) < SHORT else (region,):
                share = common_length(item, part) / len(item)
                if share < least:
                    continue
                answer = common_length(self.answers[i], part) >= 0.8 * len(self.answers[i])
                if share >= LCS or answer:
                    best[d, i] = (cosine, share, answer)
                    break
        return [(d, i, *v) for (d, i), v in sorted(best.items())]


def _summed(strips: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.float32).astype(float) for x in strips.column("sum"))
    return pa.table({"strip": strips.column("strip")[:1], "sum": pa.array([total.tobytes()], pa.binary())})


def _number(block: Passages) -> type:
    """The narrowest type for the numbers of a block's terms."""
    return np.int16 if len(block.terms) < 1 << 15 else np.int32


def _packed(codes: np.ndarray, at: np.ndarray, kind: type) -> pa.Array:
    """Each text's word numbers as bytes."""
    ends = (at * np.dtype(kind).itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(ends), pa.py_buffer(codes.astype(kind))])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64), np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])


def prepare(docs: DataFrame, items: list[tuple]) -> tuple[Passages, DataFrame, str] | None:
    """One block with its frequencies and latent space; the documents (doc_id, codes) in its numbers, as a written
    table, and the path of that."""
    block = Passages(items)
    if not block.items:
        return None
    spark, kind = docs.sparkSession, _number(block)
    shared = spark.sparkContext.broadcast(block)

    def encode(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _packed(*shared.value.coded(part.column("text")), kind)], ["doc_id", "codes"])

    named = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    coded, path = written(named.mapInArrow(encode, f"doc_id {dict(docs.dtypes)['doc_id']}, codes binary"), "decontam-codes")
    terms = len(block.terms)

    def count(batches):
        n, counts = 0, np.zeros(terms, np.int64)
        for part in slices(batches, "codes", size=CODE_BYTES):
            codes, at = _unpacked(part.column("codes"), kind)
            text = np.repeat(np.arange(part.num_rows), np.diff(at))[codes >= 0]
            seen = np.unique(text * terms + codes[codes >= 0])  # each term once a text
            counts += np.bincount(seen % terms, minlength=terms)
            n += part.num_rows
        yield pa.RecordBatch.from_pydict({"term": pa.array([*range(terms), -1], pa.int32()), "n": pa.array([*counts, n], pa.int64())})

    rows = coded.select("codes").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = dict(zip(rows.column("term").to_pylist(), rows.column("n").to_pylist()))  # one row for each term
    shared.destroy()
    block.set_frequencies(np.array([counts.get(t, 0) for t in range(terms)], float), counts.get(-1, 0))

    rank = min(len(block.pieces), terms)
    width, random = min(rank + EXTRA, terms), np.random.default_rng(23)
    bucket = random.permutation(terms) % width
    sign = random.choice([-1.0, 1.0], terms) / np.sqrt(np.bincount(bucket))[bucket]  # the basis has orthonormal columns
    basis = np.zeros((terms, width))
    basis[np.arange(terms), bucket] = sign
    cut = np.array_split(np.arange(terms), min(terms, max(PARTS, coded.rdd.getNumPartitions() // 4)))
    shared = spark.sparkContext.broadcast((block, bucket, sign))

    def multiply(batches):
        m, *of = shared.value
        out = np.zeros((terms, width))
        for part in slices(batches, "codes", size=CODE_BYTES):
            m.add_products(out, *_unpacked(part.column("codes"), kind), *of)
        yield pa.RecordBatch.from_pydict({"strip": pa.array(range(len(cut)), pa.int32()),
                                          "sum": pa.array([out[k].astype(np.float32).tobytes() for k in cut], pa.binary())})

    # Each task's sums are cut into strips, the more the more tasks there are, which are added up on the executors; one matrix comes back.
    strips = coded.select("codes").mapInArrow(multiply, "strip int, sum binary").groupBy("strip").applyInArrow(_summed, "strip int, sum binary")
    parts = {r.strip: np.frombuffer(r["sum"]) for r in strips.toLocalIterator()}
    product = np.concatenate([parts[k] for k in sorted(parts)]).reshape(basis.shape) if parts else np.zeros(basis.shape)
    shared.destroy()
    block.set_space(space(basis, product, block.own_rows(), rank))
    return block, coded, path


def space(basis: np.ndarray, product: np.ndarray, own: np.ndarray, rank: int) -> np.ndarray:
    """The first ``rank`` principal directions of the documents' Gram matrix, known by its ``product`` with the basis, and that of
    the benchmark's rows, which weigh as much as all documents together, so its passages shape the space."""
    ours = own.T @ (own @ basis)
    product = product / max(np.trace(basis.T @ product), 1e-9) + ours / max(np.trace(basis.T @ ours), 1e-9) * len(own)
    middle = basis.T @ product
    values, turn = np.linalg.eigh((middle + middle.T) / 2)
    kept = values > 1e-8 * values[-1]
    return np.linalg.svd(product @ (turn[:, kept] / np.sqrt(values[kept])), full_matrices=False)[0][:, :rank]


def _blocks(benchmark: DataFrame):
    """Blocks of at most BLOCK pieces of passages, one after the other through the driver."""
    rows = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("text")).orderBy("item_id", "text")
    held, room = [], BLOCK
    for r in rows.toLocalIterator():
        at, end = 0, piece_count(len(words_of(r.text or "")))
        while at < end:
            n = min(room, end - at)
            held.append((r.item_id, r.text, at, at + n))
            at, room = at + n, room - n
            if not room:
                yield held
                held, room = [], BLOCK
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Confirmed matches: doc_id, item_id, cosine, lcs_share, answer."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, item_id long, cosine double, lcs_share double, answer boolean"
    found = spark.createDataFrame([], schema)
    for items in _blocks(benchmark):
        if (ready := prepare(docs, items)) is None:
            continue
        block, coded, path = ready
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared, number=_number(block)):
            for part in slices(batches, "codes", size=CODE_BYTES):
                if not (rows := shared.value.leaks(*_unpacked(part.column("codes"), number))):
                    continue
                d, i, cosine, share, answer = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(pa.array(d)), "item_id": pa.array([shared.value.ids[k] for k in i], pa.int64()),
                    "cosine": pa.array(cosine, pa.float64()), "lcs_share": pa.array(share, pa.float64()), "answer": pa.array(answer, pa.bool_())})

        found = found.unionByName(written(coded.mapInArrow(search, schema), "decontam-found")[0])
        shared.destroy()
        remove(spark, path)
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs_share").alias("lcs_share"), F.max("answer").alias("answer"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, with their columns as they were."""
    out = docs
    for items in _blocks(benchmark):
        if (ready := prepare(docs, items)) is not None:
            block, _, path = ready
            remove(docs.sparkSession, path)
            out = out.where(F.arrow_udf(_clean(docs.sparkSession.sparkContext.broadcast(block)), "boolean")(out["text"]))
    return out


def _clean(shared):
    def clean(text: pa.Array) -> pa.Array:
        keep, at = np.ones(len(text), bool), 0
        for part in slices([pa.RecordBatch.from_arrays([text], ["text"])]):
            for d, *_ in shared.value.leaks(*shared.value.coded(part.column("text"))):
                keep[at + d] = False
            at += part.num_rows
        return pa.array(keep)

    return clean
