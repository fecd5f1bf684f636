"""Operator 8: token counts from pre-token frequencies, without materialising ids.

A byte-level BPE splits a text into pre-tokens and merges inside each of them only, so a text's token
count is the sum over its distinct pre-tokens of frequency times pieces. Pieces are counted once per
distinct pre-token:

* hot pre-tokens - those with a share of at least 1/HOT_BOUND of all pre-tokens, hence at most
  HOT_BOUND of them whatever the corpus holds - are found in a first pass (a pre-token with such a
  share overall has it in some part of some task, so each task reports only its own hot ones), counted
  once by a Spark job and broadcast;
* every other (pre-token, document, frequency) row meets its pre-token's piece count by a shuffle on
  the pre-token. No key can be hot there: all rows of such a key together are below 1/HOT_BOUND.

Defined results: null and empty texts have 0 bytes and 0 tokens; a special token's string inside a
text counts as the library's default says, as one token; repeated rows and null ids keep one result
row each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, texts, written

#: Most pre-tokens that are broadcast (about 20 bytes each); a proven bound, see above.
HOT_BOUND = 1 << 19
#: Distinct pre-tokens a task holds before it reports its hot ones and starts anew.
PART_DISTINCT = 300_000

# Letters, numbers and white space below U+0250 (fixed values of Unicode's categories L, N and White_Space).
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼½¾"
_S = "\\t-\\r \\x85\\xa0"
_LATIN = re.compile(f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_L}{_N}{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND = re.compile("[^\x00-ɏ]")


class PreTokens:
    """The pre-token split and the piece counts of one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def split(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, special tokens) of a text."""
        parts, n = [text], 0
        if self.special and (parts := self.special.split(text)):
            n = len(parts) - 1
        out: list[str] = []
        for part in parts:
            if _BEYOND.search(part):
                out += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
            else:
                out += _LATIN.findall(part)
        return out, n

    def pieces(self, words: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


_LOADED: dict[str, PreTokens] = {}


def pre_tokens(path: str) -> PreTokens:
    if path not in _LOADED:
        _LOADED[path] = PreTokens(path)
    return _LOADED[path]


def hot_pre_tokens(frame: DataFrame, path: str, bound: int = HOT_BOUND) -> dict[str, int]:
    """Pieces of at most ``bound`` pre-tokens: all with a share of 1/bound and none far below it."""

    def local(batches):
        seen, total, everything = Counter(), 0, 0

        def hot():
            return [(w, n) for w, n in seen.items() if n * bound >= total]

        for part in slices(batches):
            for text in texts(part):
                found, _ = pre_tokens(path).split(text)
                seen.update(found)
                total += len(found)
            if len(seen) > PART_DISTINCT:
                yield _rows(hot(), None)
                everything += total
                seen, total = Counter(), 0
        yield _rows(hot(), everything + total)

    def _rows(pairs, total):
        words = [w for w, _ in pairs] + [None] * (total is not None)
        counts = [n for _, n in pairs] + [total] * (total is not None)
        return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(counts, pa.int64())})

    found, _ = written(frame.select("text").mapInArrow(local, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")), "hot-pretokens")
    total = found.where("word is null").agg(F.sum("n")).first()[0] or 0
    # What was reported is at most the true count, so at most ``bound`` words pass.
    share = found.where(F.col("word").isNotNull() & (F.col("n") * bound >= total)).select("word")
    return dict(_counted(share, path).select("word", "pieces").toPandas().itertuples(index=False, name=None))


def _counted(words: DataFrame, path: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"word": batch.column(0),
                                              "pieces": pa.array(pre_tokens(path).pieces(names), pa.int64())})

    return words.mapInArrow(run, "word string, pieces long")


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, bound: int = HOT_BOUND) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    spark = docs.sparkSession
    frame = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    kind = dict(frame.dtypes)["id"]
    shared = spark.sparkContext.broadcast(hot_pre_tokens(frame, path, bound))

    def frequencies(batches):
        hot = shared.value.get
        for part in slices(batches):
            rows = part.column("row").to_pylist()
            words, at, counts, sums, sizes = [], [], [], [], []
            for row, text in zip(rows, texts(part)):
                found, total = pre_tokens(path).split(text)
                for word, n in Counter(found).items():
                    pieces = hot(word)
                    if pieces is None:
                        words.append(word)
                        at.append(row)
                        counts.append(n)
                    else:
                        total += pieces * n
                sums.append(total)
                sizes.append(len(text.encode()))
            none = pa.nulls(len(words))
            yield pa.RecordBatch.from_pydict({
                "word": pa.concat_arrays([pa.array(words, pa.string()), pa.nulls(len(rows), pa.string())]),
                "row": pa.concat_arrays([pa.array(at, pa.int64()), part.column("row").cast(pa.int64())]),
                "n": pa.array(counts + sums, pa.int64()),
                "n_bytes": pa.concat_arrays([none.cast(pa.int64()), pa.array(sizes, pa.int64())]),
                "id": pa.concat_arrays([none.cast(part.column("id").type), part.column("id")])})

    def times_pieces(batches):
        last = (None, 0)  # a word's rows stand together, so only one may have begun in the batch before
        for batch in batches:
            coded = batch.column("word").dictionary_encode()
            names = coded.dictionary.to_pylist()
            new = [w for w in names if w != last[0]]
            pieces = dict(zip(new, pre_tokens(path).pieces(new)))
            if names and names[0] == last[0]:
                pieces[last[0]] = last[1]
            if names:
                last = (names[-1], pieces[names[-1]])
            each = pa.array([pieces[w] for w in names] or [0], pa.int64())
            factor = pc.fill_null(each.take(coded.indices), 1)
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "n": pc.multiply(batch.column("n"), factor),
                "n_bytes": batch.column("n_bytes"), "id": batch.column("id")})

    columns = f"row long, n long, n_bytes long, id {kind}"
    rows = frame.mapInArrow(frequencies, f"word string, {columns}")
    place = F.when(F.col("word").isNull(), F.xxhash64("row")).otherwise(F.xxhash64("word"))
    placed = rows.withColumn("place", place).repartition("place").drop("place").sortWithinPartitions("word")
    return placed.mapInArrow(times_pieces, columns).groupBy("row").agg(
        F.max("id").alias(id_col), F.sum("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens")).select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
