"""Operator 2: co-training quality classifier.

Two logistic classifiers see different views of a document: the text view has hashed words and word
shapes (relative frequencies) and repeated neighbours, the page view has the declared metadata alone
(language, source, both together, recorded length). Neither sees the other's evidence. Both start from the
labelled rows; in each round each view hands the unlabelled rows it is sure of (probability SURE or more)
to the other view as pseudo-labels, weighted so that the classes keep their proportion; while it is sure of
no row of one class, or was not right about labelled rows in the same way (cross-validation), it hands over none. At the end each view is calibrated
on labelled rows that took no part in training (Platt scaling; with under ENOUGH rows of a class, on the training rows),
and a logistic combination fitted on the same rows scores every document.

Every labelled row serves and every other document is unlabelled and takes part in every round. Features are written
once. A bitmap of the labelled ids, of fixed size, tells most unlabelled rows at once; it passes every labelled row, and what
it passes meets the labels in a shuffled join, at any size of the labels, and is written anew, the labelled rows apart from the others. A view is fitted by accelerated steps in the metric of its Gram matrix, which bounds the curvature of
its loss: each step sums the gradients of all models of a stage (both views, with and without each fold) over the labelled rows on Spark. A round broadcasts the
weights of both views, tasks sum the loss gradient of the rows handed over and a diagonal bound of its
curvature, and the driver gets those sums (a fixed number of rows, whatever the table's size), with which it
refits each view: the labelled loss plus a quadratic that lies above the pseudo-labelled loss. The sums are
whole numbers (steps of 1/UNIT), so their order changes nothing. Scoring runs without a shuffle: over the written
features where the ids alone are asked for, else over every document as an Arrow function.

Defined results: null or empty texts are scored as empty texts; a null language, source or length is a
value of its own; labels that are null or whose id has no document are not used; of repeated labels
the majority counts (a tie is good); of documents that share a labelled id one is taken; documents without id
are unlabelled; without rows of both classes nothing is rejected (score 1); an empty table gives an empty
result; all other columns are kept as they are.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SLICE_ROWS, fresh, hold, remove, slices, written
from strata.session import scratch_path

#: Rounds of co-training, probability from which a view is sure.
ROUNDS, SURE = 3, 0.9
#: Steps of a fit and of a refit in a round, folds of the cross-validation, l2 of the views.
STEPS, AGAIN, FOLDS, L2 = 20, 8, 5, 1e-3
#: Labelled rows of each class from which a fifth is kept out of training, for calibration alone.
ENOUGH = 50
WORD_DIM, SHAPE_DIM, NAME_DIM = 512, 256, 64
TEXT_DIM, PAGE_DIM, PAGE_CODES = WORD_DIM + SHAPE_DIM + 1, 4 * NAME_DIM, 4
#: Steps of a whole in the sums of a round; bytes of codes and texts that a task holds at once; words it remembers.
UNIT, HELD_BYTES, REMEMBERED = 1 << 20, 1 << 20, 200_000
#: Words by which every text counts as longer, so that a few words alone decide little.
FEW = 6
#: Bits of the bitmap of labelled ids, and of one of its rows.
ID_BITS, ROW_BITS = 25, 15
_MARKS = ".,;:!?\"'()"
_PLAIN = {c: "A" if chr(c).isupper() else "a" if chr(c).isalpha() else "9" if chr(c).isdigit() else chr(c) for c in range(128)}
_RUNS = re.compile(r"(.)\1+", re.S)


def _shape(word: str) -> str:
    out = ""
    for c in word[:40]:
        s = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if out[-1:] != s:
            out += s
    return out


class _Shapes(dict):
    """Shape bucket of ASCII words by their first 40 characters' kinds, filled on demand (bounded like _Words)."""

    def __missing__(self, kinds):
        if len(self) > REMEMBERED // 4:
            self.clear()
        self[kinds] = found = zlib.crc32(_RUNS.sub(r"\1", kinds).encode()) % SHAPE_DIM
        return found


_SHAPES = _Shapes()


class _Words(dict):
    """Word bucket * SHAPE_DIM + shape bucket of each word, filled on demand (emptied when it has grown)."""

    def __missing__(self, word):
        if len(self) > REMEMBERED:
            self.clear()
        shape = _SHAPES[word[:40].translate(_PLAIN)] if word.isascii() else zlib.crc32(_shape(word).encode()) % SHAPE_DIM
        self[word] = found = zlib.crc32(word.lower().strip(_MARKS).encode()) % WORD_DIM * SHAPE_DIM + shape
        return found


_WORDS = _Words()


def _forget() -> None:
    _WORDS.clear()
    _SHAPES.clear()


def text_views(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words of each text, codes of all their words, share of words equal to the one before in each text)."""
    words, length = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = (text or "").split()
        words += own
        length[i] = len(own)
    codes = np.fromiter(map(_WORDS.__getitem__, words), np.int32, len(words))
    doc = np.repeat(np.arange(len(texts)), length)
    again = doc[1:][(codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])]
    return length, codes, np.bincount(again, minlength=len(texts)) / np.maximum(length - 1, 1)


def text_view(text: str) -> tuple[np.ndarray, float]:
    """(codes of the words, share of words equal to the one before)."""
    _, codes, same = text_views([text])
    return codes.astype(np.int64), float(same[0])


def packed(length: np.ndarray, codes: np.ndarray) -> pa.Array:
    """The codes of each text as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(np.r_[0, 4 * length.cumsum()].astype(np.int32)), pa.py_buffer(codes)])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of words of each text, codes of all their words) of a column that :func:`packed` made."""
    n, column = len(column), column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    data = column.buffers()[2] if n and ends[-1] > ends[0] else None
    return np.diff(ends) // 4, np.frombuffer(data, np.int32)[ends[0] // 4:ends[-1] // 4] if data else np.zeros(0, np.int32)


def page_view(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """The page view's features that are 1: language, source, both, half octave of the recorded length."""
    size = 0 if n_chars is None else 1 + min(int(2 * np.log2(1 + max(0, n_chars))), NAME_DIM - 2)
    names = [zlib.crc32(f"{k}{v}".encode()) % NAME_DIM for k, v in (("l", lang), ("s", source), ("p", (lang, source)))]
    return [i * NAME_DIM + v for i, v in enumerate([*names, size])]


def _dense(codes: np.ndarray, same: float) -> np.ndarray:
    x = np.zeros(TEXT_DIM, np.float32)
    if len(codes):
        x[:WORD_DIM] = np.bincount(codes // SHAPE_DIM, minlength=WORD_DIM)
        x[WORD_DIM:-1] = np.bincount(codes % SHAPE_DIM, minlength=SHAPE_DIM)
        x *= 10 / (len(codes) + FEW)
    x[-1] = same * 4
    return x


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    """Weights of both views and of their combination; picklable."""

    def __init__(self, text: np.ndarray, page: np.ndarray, platt: list[np.ndarray], both: np.ndarray):
        self.text, self.page, self.platt, self.both = text, page, platt, both
        # A text's margin is a sum over its words.
        self.words, self.shapes = 10 * text[:WORD_DIM], 10 * text[WORD_DIM:WORD_DIM + SHAPE_DIM]

    def all_margins(self, length: np.ndarray, codes: np.ndarray, same: np.ndarray, pages: np.ndarray) -> np.ndarray:
        """Margins (text, page) of texts with so many words and these codes, their shares of repeated words and page codes."""
        weight = (self.words[:, None] + self.shapes).ravel()
        total = np.bincount(np.repeat(np.arange(len(length)), length), weight[codes], len(length))
        return np.stack([self.text[-1] + self.text[-2] * same * 4 + total / (length + FEW), self.page[pages].sum(1) + self.page[-1]], 1)

    def margins(self, text: str, lang, source, n_chars) -> tuple[float, float]:
        return tuple(self.all_margins(*text_views([text]), np.array([page_view(lang, source, n_chars)]))[0].tolist())

    def scores(self, margins: np.ndarray) -> np.ndarray:
        """(p_text, p_page, score) columns from the margins of both views."""
        z = np.stack([margins[:, k] * self.platt[k][0] + self.platt[k][1] for k in (0, 1)], 1)
        return np.hstack([sigmoid(z), sigmoid(z @ self.both[:-1] + self.both[-1])[:, None]])


def features(docs: DataFrame, labelled=None) -> DataFrame:
    """doc_id, id, codes (4-byte numbers of all words), same, page (codes of the page view) of every document; with a
    broadcast bitmap of :func:`id_map`, maybe: 1 for ids that the bitmap has, else 0."""

    def make(batches):
        hold("quality", _forget)
        for part in slices(batches, size=HELD_BYTES):
            length, codes, same = text_views(part.column("text").to_pylist())
            pages = map(page_view, *(part.column(c).to_pylist() for c in ("lang", "source", "n_chars")))
            out = {"doc_id": part.column("doc_id"), "id": part.column("id"), "codes": packed(length, codes),
                   "same": pa.array(same, pa.float64()), "page": pa.array(list(pages), pa.list_(pa.int32()))}
            if labelled:
                at = _places(part.column("id"))
                out["maybe"] = pa.array((labelled.value[at >> 3] >> (at & 7).astype(np.uint8)) & (at >= 0), pa.int32())
            yield pa.RecordBatch.from_pydict(out)

    frame = docs.select(docs["doc_id"], docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"), docs["lang"].cast("string").alias("lang"),
                        docs["source"].cast("string").alias("source"), docs["n_chars"].cast("long").alias("n_chars"))
    made = f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, id long, codes binary, same double, page array<int>"
    return frame.mapInArrow(make, made + ", maybe int" if labelled else made)


def _places(ids: pa.Array) -> np.ndarray:
    """Bits of ids in the bitmap, as Spark's xxhash64 places them; -1 for null."""
    mask = (1 << ID_BITS) - 1
    return np.array([-1 if i is None else xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42) & mask for i in ids.to_pylist()], np.int64)


def id_map(ids: DataFrame) -> np.ndarray:
    """Bitmap of hashed ids (column label_id), in bytes; built by Spark in rows of 2^ROW_BITS bits."""
    place = F.xxhash64("label_id").bitwiseAND(F.lit((1 << ID_BITS) - 1))
    out = np.zeros(1 << ID_BITS - 3, np.uint8)
    rows = ids.groupBy(F.shiftright(place, ROW_BITS).alias("line")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << ROW_BITS) - 1))).alias("bits")).collect()  # at most 2^(ID_BITS - ROW_BITS) rows
    for r in rows:
        out[r.line << ROW_BITS - 3:r.line + 1 << ROW_BITS - 3] = np.frombuffer(r.bits, np.uint8)
    return out


def handed_over(table: DataFrame, labelled: dict[int, int], text: np.ndarray, page: np.ndarray) -> dict[tuple[int, int], tuple]:
    """One round's sums over all rows of a :func:`features` table but those with an id in ``labelled``: for each (view that learns, class) the
    number of rows that the other view is sure of, the gradient of their summed loss and its curvature bound."""
    shared = table.sparkSession.sparkContext.broadcast((np.array(sorted(labelled), np.int64), text, page))
    dims = TEXT_DIM + 1, PAGE_DIM + 1

    def run(batches):
        ids, wt, wp = shared.value
        words, shapes = wt[:WORD_DIM], wt[WORD_DIM:WORD_DIM + SHAPE_DIM]
        sums = {(k, c): [0, np.zeros(dims[k]), np.zeros(dims[k])] for k in (0, 1) for c in (0, 1)}
        for part in slices(batches, "codes", size=HELD_BYTES):
            known = np.array([i is not None for i in part.column("id").to_pylist()])
            own = known & np.isin(part.column("id").fill_null(0).to_numpy(zero_copy_only=False), ids)
            part = part.filter(pa.array(~own))
            n = part.num_rows
            if not n:
                continue
            (length, codes), same = unpacked(part.column("codes")), 4 * part.column("same").to_numpy()
            doc, word, shape = np.repeat(np.arange(n), length), codes // SHAPE_DIM, codes % SHAPE_DIM
            weight = 10 / (length + FEW)
            pages = part.column("page").flatten().to_numpy().reshape(n, PAGE_CODES)
            p = [sigmoid(np.bincount(doc, words[word] + shapes[shape], n) * weight + same * wt[-2] + wt[-1]),
                 sigmoid(wp[pages].sum(1) + wp[-1])]
            bound = [0.25 * (2 * weight * length + same + 1), np.full(n, 0.25 * (PAGE_CODES + 1))]
            for (k, c), held in sums.items():
                sure = (p[1 - k] if c else 1 - p[1 - k]) >= SURE
                held[0] += int(sure.sum())
                for total, per_row in ((held[1], np.where(sure, p[k] - c, 0.0)), (held[2], np.where(sure, bound[k], 0.0))):
                    total[-1] += per_row.sum()
                    if k:
                        total[:-1] += np.bincount(pages.ravel(), np.repeat(per_row, PAGE_CODES), PAGE_DIM)
                    else:
                        by_word = (per_row * weight)[doc]
                        total[:WORD_DIM] += np.bincount(word, by_word, WORD_DIM)
                        total[WORD_DIM:-2] += np.bincount(shape, by_word, SHAPE_DIM)
                        total[-2] += per_row @ same
        for (k, c), (rows, g, d) in sums.items():
            if rows:
                yield pa.RecordBatch.from_pydict({
                    "view": np.full(len(g), k, np.int32), "class": np.full(len(g), c, np.int32), "at": np.arange(len(g), dtype=np.int32),
                    "rows": np.full(len(g), rows, np.int64), "g": np.rint(g * UNIT).astype(np.int64), "d": np.rint(d * UNIT).astype(np.int64)})

    found = table.mapInArrow(run, "view int, class int, at int, rows long, g long, d long").groupBy("view", "class", "at").agg(
        *(F.sum(c).alias(c) for c in ("rows", "g", "d"))).collect()  # at most 2 * (sum of dims) rows
    shared.destroy()
    out = {(k, c): [0, np.zeros(dims[k]), np.zeros(dims[k])] for k in (0, 1) for c in (0, 1)}
    for r in found:
        held = out[r["view"], r["class"]]
        held[0], held[1][r["at"]], held[2][r["at"]] = r["rows"], r["g"] / UNIT, r["d"] / UNIT
    return {key: tuple(held) for key, held in out.items()}


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in rows.column("sum"))
    return pa.table({"key": rows.column("key")[:1], "sum": pa.array([total.tobytes()], pa.binary())})


def sums(table: DataFrame, make, size: str | None = "codes") -> dict[int, np.ndarray]:
    """Sums of the arrays that ``make`` gives for each slice of the rows as (key, array); a fixed number of keys."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        cut = slices(batches, size, size=HELD_BYTES) if size else (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS))
        for part in cut:
            for key, values in make(part):
                held[key] = held.get(key, 0.0) + np.asarray(values, float)
        if held:
            yield pa.RecordBatch.from_pydict({"key": pa.array(list(held), pa.int32()),
                                              "sum": pa.array([np.rint(v * UNIT).astype(np.int64).tobytes() for v in held.values()], pa.binary())})

    found = table.mapInArrow(run, "key int, sum binary").groupBy("key").applyInArrow(_added, "key int, sum binary").toArrow()
    return {k: np.frombuffer(v, np.int64) / UNIT for k, v in zip(found.column("key").to_pylist(), found.column("sum").to_pylist())}


def matrix(part: pa.RecordBatch, view: int) -> np.ndarray:
    """A view's features of the rows of a :func:`features` table, and a last column of ones."""
    n = part.num_rows
    x = np.zeros((n, (TEXT_DIM, PAGE_DIM)[view] + 1), np.float32)
    x[:, -1] = 1
    if view:
        np.put_along_axis(x, part.column("page").flatten().to_numpy().reshape(n, PAGE_CODES), 1, 1)
        return x
    length, codes = unpacked(part.column("codes"))
    doc = np.repeat(np.arange(n), length)
    x[:, :WORD_DIM] = np.bincount(doc * WORD_DIM + codes // SHAPE_DIM, minlength=n * WORD_DIM).reshape(n, -1)
    x[:, WORD_DIM:-2] = np.bincount(doc * SHAPE_DIM + codes % SHAPE_DIM, minlength=n * SHAPE_DIM).reshape(n, -1)
    x[:, :-2] *= (10 / (length + FEW)).astype(np.float32)[:, None]
    x[:, -2] = part.column("same").to_numpy() * 4
    return x


def training(part: np.ndarray, split: bool) -> np.ndarray:
    """Rows of these parts that take part in training."""
    return part % FOLDS > 0 if split else np.ones(len(part), bool)


class Labelled:
    """The labelled rows: a written table of id, codes, same, page, good (0 or 1) and part (0 .. FOLDS * FOLDS - 1, by a hash
    of the id). Rows of a part divisible by FOLDS are kept out of training, for calibration, if each class has ENOUGH."""

    def __init__(self, table: DataFrame):
        self.table = table

        def look(part):
            for k in (0, 1):
                x = matrix(part, k)
                yield from ((k << 16 | i, row) for i, row in enumerate(x.T @ x))
            yield -1, np.bincount(part.column("good").to_numpy() * FOLDS ** 2 + part.column("part").to_numpy(), minlength=2 * FOLDS ** 2)

        found = sums(table, look)
        self.counts = np.rint(found.pop(-1, np.zeros(2 * FOLDS ** 2))).reshape(2, FOLDS, FOLDS)  # class, fold, kept out if 0
        rows = [[found[key] for key in sorted(found) if key >> 16 == k] for k in (0, 1)]
        self.gram = [np.stack(r) if r else np.zeros((0, 0)) for r in rows]
        per_class = self.counts.sum((1, 2))
        self.split = bool(per_class.min() >= ENOUGH and (self.counts[:, :, 1:].sum((1, 2)) > 0).all() and (self.counts[:, :, 0].sum(1) > 0).all())
        self.share = per_class / max(per_class.sum(), 1)

    def size(self, out: int | None) -> np.ndarray:
        """Training rows of each class, those of a fold left out."""
        counts = self.counts[:, :, 1:] if self.split else self.counts
        return counts.sum((1, 2)) - (0 if out is None else counts[:, out].sum(1))

    def fit(self, models: list[tuple], steps: int = STEPS) -> list[np.ndarray]:
        """Weights and bias (last) of logistic regressions: (view, fold left out or None, first weights, what was handed over). The
        last is None, or the gradient of the pseudo-labelled loss at the first weights and a bound of its curvature."""
        n = [self.size(out).sum() for _, out, *_ in models]
        first = [np.array(at, float) for _, _, at, _ in models]
        free = [np.r_[np.full(len(at) - 1, L2), 0.0] for at in first]
        handed = [h or (np.zeros(len(at)), np.zeros(len(at))) for at, (*_, h) in zip(first, models)]
        metric = [np.linalg.inv(0.25 * self.gram[k] / m + np.diag(f + bend)) for (k, *_), m, f, (_, bend) in zip(models, n, free, handed)]
        last, now = first, first
        views, outs = [m[0] for m in models], [m[1] for m in models]
        wanted = sorted(set(views))
        table = self.table.select(*(["codes", "same"] if 0 in wanted else []), "page", "good", "part")
        split = self.split
        for t in range(steps):

            def slope(part, now=now):
                fold = part.column("part").to_numpy()
                y, use, x = part.column("good").to_numpy(), training(fold, split), {k: matrix(part, k) for k in wanted}
                for j, (k, out) in enumerate(zip(views, outs)):
                    miss = (sigmoid(x[k] @ now[j].astype(np.float32)) - y) * (use if out is None else use & (fold // FOLDS != out))
                    yield j, x[k].T @ miss.astype(np.float32)

            found = sums(table, slope, "codes" if 0 in wanted else None)
            new = []
            for j, (v, at, f, (g, bend)) in enumerate(zip(now, first, free, handed)):
                new.append(v - metric[j] @ (found[j] / n[j] + f * v + g + bend * (v - at)))
            now = [w + t / (t + 3) * (w - before) for w, before in zip(new, last)]
            last = new
        return last

    def proven(self, without: dict[tuple[int, int], np.ndarray]) -> list[bool]:
        """For each view: are the rows that it is sure of, judged without their own fold, of the class it says with
        probability SURE (one right and one wrong row added)? ``without``: weights by view and fold left out."""
        split = self.split

        def judge(part):
            fold = part.column("part").to_numpy()
            y, use = part.column("good").to_numpy(), training(fold, split)
            for k in (0, 1):
                x, p = matrix(part, k), np.full(part.num_rows, 0.5)
                for (view, out), w in without.items():
                    if view == k:
                        own = fold // FOLDS == out
                        p[own] = sigmoid(x[own] @ w.astype(np.float32))
                sure = [((p if c else 1 - p) >= SURE) & use for c in (0, 1)]
                yield k, np.array([n for c in (0, 1) for n in (((y == c) & sure[c]).sum(), sure[c].sum())])

        found = sums(self.table, judge)
        return [all((found[k][2 * c] + 1) / (found[k][2 * c + 1] + 2) >= SURE for c in (0, 1)) for k in (0, 1)]

    def margins(self, w: list[np.ndarray]) -> DataFrame:
        """Margins of both views (text, page) of the rows for calibration, and good."""
        split = self.split

        def run(batches):
            for part in slices(batches, "codes", size=HELD_BYTES):
                part = part.filter(pa.array(~training(part.column("part").to_numpy(), split))) if split else part
                if part.num_rows:
                    text, page = (matrix(part, k) @ w[k] for k in (0, 1))
                    yield pa.RecordBatch.from_pydict({"text": pa.array(text, pa.float64()), "page": pa.array(page, pa.float64()), "good": part.column("good")})

        return self.table.mapInArrow(run, "text double, page double, good int")


def newton(table: DataFrame, inputs: list[np.ndarray], target: np.ndarray, l2: float, steps: int = 40) -> list[np.ndarray]:
    """Weights and bias (last) of small logistic regressions on both margins; ``inputs``: for each, the matrix that makes its
    inputs from (text, page, 1); ``target``: what is aimed at for rows of each class."""
    w = [np.zeros(a.shape[1]) for a in inputs]
    best, step, settled = [np.inf] * len(w), [np.zeros(len(v)) for v in w], [False] * len(w)
    for _ in range(steps):

        def look(part, w=w):
            m = np.stack([part.column("text").to_numpy(), part.column("page").to_numpy(), np.ones(part.num_rows)], 1)
            y = target[part.column("good").to_numpy()]
            for j, (v, a) in enumerate(zip(w, inputs)):
                x = m @ a
                z = np.clip(x @ v, -40, 40)
                p = sigmoid(z)
                yield j, np.r_[len(y), (np.logaddexp(0, z) - y * z).sum(), x.T @ (p - y), (x.T @ (x * (p * (1 - p))[:, None])).ravel()]

        found = sums(table, look, None)
        new = []
        for j, v in enumerate(w):
            (n, loss), d, free = found[j][:2], len(v), np.r_[np.full(len(v) - 1, l2), 0.0]
            loss = loss / n + (free * v * v).sum() / 2
            if settled[j]:
                new.append(v)
                continue
            if loss > best[j] + 1e-7:  # too far: half the step back
                step[j] = step[j] / 2
                new.append(v + step[j])
                continue
            slope, bend = found[j][2:2 + d] / n + free * v, found[j][2 + d:].reshape(d, d) / n + np.diag(free)
            best[j], step[j] = loss, np.linalg.solve(bend + 1e-9 * np.eye(d), slope)
            settled[j] = bool(np.abs(step[j]).max() < 1e-5)
            new.append(v - step[j])
        w = new
        if all(settled):
            break
    return w


def co_train(rows: Labelled, exchange, rounds: int = ROUNDS) -> Model | None:
    """Both views of the labelled rows; ``exchange(text, page)`` gives a round's sums (:func:`handed_over`)."""
    if not rows.counts.sum((1, 2)).all():
        return None
    start = [np.zeros(d + 1) for d in (TEXT_DIM, PAGE_DIM)]
    folds = [(k, f) for k in (0, 1) for f in range(FOLDS) if rows.size(f).all()]
    fitted = rows.fit([(k, None, start[k], None) for k in (0, 1)] + [(k, f, start[k], None) for k, f in folds])
    w = fitted[:2]
    trusted = rows.proven(dict(zip(folds, fitted[2:])))
    for _ in range(rounds if any(trusted) else 0):
        handed, learning = exchange(*w), []
        for k in (0, 1):
            if trusted[1 - k] and all(handed[k, c][0] for c in (0, 1)):
                learning.append((k, None, w[k], tuple(sum(rows.share[c] * handed[k, c][i] / handed[k, c][0] for c in (0, 1)) for i in (1, 2))))
        if learning:
            for (k, *_), new in zip(learning, rows.fit(learning, AGAIN)):
                w[k] = new
    table, path = written(rows.margins(w), "quality-margins")
    n = rows.counts[:, :, 0].sum(1) if rows.split else rows.counts.sum((1, 2))
    target = np.array([1 / (n[0] + 2), (n[1] + 1) / (n[1] + 2)])  # Platt's: no row is beyond doubt
    platt = newton(table, [np.eye(3)[:, [k, 2]] for k in (0, 1)], target, 1e-4)
    both = np.array([[platt[0][0], 0, 0], [0, platt[1][0], 0], [platt[0][1], platt[1][1], 1]])
    (combined,) = newton(table, [both], target, 1e-3)
    remove(table.sparkSession, path)
    return Model(w[0], w[1], platt, combined)


def learned(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rounds: int = ROUNDS) -> tuple[Model | None, DataFrame, list[str]]:
    """The model fitted on all rows of ``labels`` and on all other rows of ``docs`` (doc_id, text, lang, source, n_chars);
    the features of all rows of ``docs`` (doc_id, codes, same, page); the folders that hold them."""
    spark = docs.sparkSession
    known, known_path = written(labels.select(labels["doc_id"].cast("long").alias("label_id"), labels[label_col].alias("good"))
                                .where("label_id is not null and good is not null").groupBy("label_id").agg((F.avg("good") >= 0.5).cast("int").alias("good")), "quality-labels")
    shared = spark.sparkContext.broadcast(id_map(known))
    all_path, path = scratch_path(spark, "quality-features"), scratch_path(spark, "quality-met")

    def kept(rows: DataFrame, by: str, to: str) -> DataFrame:
        rows.write.partitionBy(by).option("compression", "zstd").parquet(to)
        return spark.read.schema(rows.drop(by).schema.add(by, "integer")).parquet(to)

    found = kept(features(docs, shared), "maybe", all_path)
    # Labels grow with the documents: a merge join whatever their size, so that disk and time grow in proportion.
    met = found.where("maybe = 1").drop("maybe").join(known.hint("merge"), F.expr("id = label_id"), "left").drop("label_id")
    table = kept(met.withColumn("labelled", F.col("good").isNotNull().cast("int")), "labelled", path)
    remove(spark, f"{all_path}/maybe=1")
    others = spark.read.schema(found.schema).parquet(all_path).where("maybe = 0")
    shared.destroy()
    some, again = table.where("labelled = 1").drop("labelled"), None
    if not some.groupBy("id").count().where("count > 1").isEmpty():  # one of the documents that share an id
        some, again = written(some.dropDuplicates(["id"]), "quality-labelled")
    part = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(FOLDS ** 2)).cast("int")
    columns = ["doc_id", "id", "codes", "same", "page"]
    free = others.select(columns).unionByName(table.where("labelled = 0").select(columns))
    model = co_train(Labelled(some.withColumn("part", part)), lambda text, page: handed_over(free, {}, text, page), rounds)
    for old in (known_path, again):
        if old:
            remove(spark, old)
    return model, others.select(columns).unionByName(table.select(columns)), [all_path, path]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rounds: int = ROUNDS) -> Model | None:
    """The model of :func:`learned` alone."""
    model, _, paths = learned(docs, labels, label_col, rounds)
    for path in paths:
        remove(docs.sparkSession, path)
    return model


def score(docs: DataFrame, model: Model | None, out: str) -> DataFrame:
    """``docs`` with a struct column ``out`` of p_text, p_page and score."""

    def rate(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        margins = [np.zeros((0, 2))]
        hold("quality", _forget)
        for part in slices([pa.RecordBatch.from_arrays([text, lang, source, n_chars], ["text", "lang", "source", "n_chars"])], size=HELD_BYTES):
            t, *page = (c.to_pylist() for c in part.columns)
            margins.append(model.all_margins(*text_views(t), np.array(list(map(page_view, *page)))))
        p = model.scores(np.concatenate(margins))
        return pa.StructArray.from_arrays([pa.array(p[:, k]) for k in range(3)], ["p_text", "p_page", "score"])

    if model is None:
        return docs.withColumn(out, F.struct(*(F.lit(1.0).alias(c) for c in ("p_text", "p_page", "score"))))
    rated = F.arrow_udf(rate, "p_text double, p_page double, score double")
    return docs.withColumn(out, rated(docs["text"], docs["lang"].cast("string"), docs["source"].cast("string"), docs["n_chars"].cast("long")))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, p_text, p_page, score, keep (score >= 0.5)."""
    model, table, _ = learned(docs, labels)

    def rate(batches):
        for part in slices(batches, "codes", size=HELD_BYTES):
            pages = part.column("page").flatten().to_numpy().reshape(part.num_rows, PAGE_CODES)
            p = model.scores(model.all_margins(*unpacked(part.column("codes")), part.column("same").to_numpy(), pages)) if model else np.ones((part.num_rows, 3))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(p[:, k]) for k in range(3))], ["doc_id", "p_text", "p_page", "score"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.select("doc_id", "codes", "same", "page").mapInArrow(rate, f"doc_id {kind}, p_text double, p_page double, score double") \
        .withColumn("keep", F.col("score") >= 0.5)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their columns as they were."""
    (held,) = fresh(docs, "rated")
    return score(docs, train(docs, labels), held).where(F.col(f"{held}.score") >= 0.5).drop(held)
