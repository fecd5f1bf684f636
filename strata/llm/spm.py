"""Operator 10: exact SentencePiece BPE encoding and decoding by backtracking.

A BPE vocabulary whose merges join any two neighbours that form a piece has one property that makes
left-to-right encoding possible: a tokenisation is the one the merges give if and only if each pair
of neighbouring tokens is what the merges make of those two tokens' text. So the encoder takes the
longest piece that an Aho-Corasick scan finds at a position, checks it against the token before it
by re-merging the two, and on failure goes on to the next shorter piece, or steps back; a bitfield
marks positions from which no valid rest was found, so each position fails once.

Every text is handled whole. Segments (a run of spaces with the word after it) never share a merge,
because no piece holds a space after another character; each distinct segment is encoded once per
Python worker and kept in a bounded two-generation cache.

Defined results: null and empty texts give no ids and decode to the empty string; repeated rows give
repeated results; ids of null are null; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from strata.llm.common import hold, per_batch, texts

SPACE = "▁"
#: Segments kept in each of the two generations of a worker's cache, and the longest kept.
CACHE, CACHED_CHARS = 250_000, 64


class PieceModel:
    """Pieces, ids and merge ranks of a SentencePiece BPE model file with byte fallback, identity
    normalisation and a dummy prefix (checked when the file is loaded)."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.piece_of = [sp.id_to_piece(i) for i in range(size)]
        self.bytes_of: dict[int, int] = {}
        self.rank: dict[str, tuple[float, int]] = {}
        self.silent: set[int] = set()
        for i, piece in enumerate(self.piece_of):
            if sp.is_byte(i):
                self.bytes_of[i] = int(piece[3:5], 16)
            elif sp.is_control(i) or sp.is_unknown(i):
                self.silent.add(i)
            elif not sp.is_unused(i):
                self.rank[piece] = (-sp.get_score(i), i)
        self.id_of = {p: i for p, (_, i) in self.rank.items()}
        self.byte_id = {b: i for i, b in self.bytes_of.items()}
        probe = "é ﬁ  Q\t x"
        if sp.decode(sp.encode(probe)) != probe or len(self.byte_id) != 256 or sp.encode("a") == sp.encode(" a"):
            raise ValueError("the model must be a BPE model with byte fallback, identity normalisation and a dummy prefix")
        if any(SPACE in p[1:] and set(p) != {SPACE} for p in self.rank):
            raise ValueError("a piece holds a space after another character: segments would not be independent")
        if any(c not in self.rank for p in self.rank for c in p):
            raise ValueError("a piece holds a character that is not a piece")
        # Runs of spaces merge last (their scores are the lowest); words use the other pieces only.
        self.words = {p: r for p, r in self.rank.items() if p == SPACE or p[-1] != SPACE}
        self.scan = ahocorasick.Automaton()
        for p in self.words:
            if self.merged(p, self.words) == [p]:  # a piece that the merges never leave whole can't be a token
                self.scan.add_word(p, p)
        self.scan.make_automaton()
        self.tokens, self.longest = set(self.scan.keys()), max(map(len, self.words))
        self.chars = {p for p in self.rank if len(p) == 1}
        self.fits: dict[tuple[str, str], bool] = {}
        self.runs: dict[int, list[str]] = {}
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.odd: dict[str, str] = {}
        outside = "".join(re.escape(c) for c in "\n\t\r" if c not in self.rank)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{outside}]*|[^{SPACE}{outside}]+" + (f"|[{outside}]" if outside else ""))

    @staticmethod
    def merged(text: str, rank: dict) -> list[str]:
        """The merges themselves: best rank first, leftmost among equals. Used on pieces, pairs and runs."""
        n = len(text)
        parts, after, before = list(text), list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(rank[text[i:i + 2]][0], i, text[i:i + 2]) for i in range(n - 1) if text[i:i + 2] in rank]
        heapq.heapify(queue)
        while queue:
            _, i, whole = heapq.heappop(queue)
            j = after[i] if parts[i] else n
            if j >= n or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j], after[i] = whole, "", after[j]
            if after[i] < n:
                before[after[i]] = i
                if (pair := whole + parts[after[i]]) in rank:
                    heapq.heappush(queue, (rank[pair][0], i, pair))
            if before[i] >= 0 and (pair := parts[before[i]] + whole) in rank:
                heapq.heappush(queue, (rank[pair][0], before[i], pair))
        return [p for p in parts if p]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side."""
        key = (left, right)
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > 400_000:
                self.fits.clear()
            known = self.fits[key] = self.merged(left + right, self.words) == [left, right]
        return known

    def backtrack(self, word: str) -> list[str]:
        """Pieces of a stretch whose characters are all pieces."""
        out = [piece for _, piece in self.scan.iter_long(word)]  # the longest match from each token's end on
        fits, compatible = self.fits, self.compatible
        if all(fits.get(pair) or compatible(*pair) for pair in zip(out, out[1:])):
            return out
        n, tokens, longest = len(word), self.tokens, self.longest
        failed = bytearray(n // 8 + 1)  # a bit for each position from which no valid rest exists
        out, at, length = [], 0, min(longest, n)
        while at < n:
            last = out[-1] if out else None
            while length:
                to = at + length
                piece = word[at:to]
                if piece in tokens and not failed[to >> 3] >> (to & 7) & 1 and (last is None or compatible(last, piece)):
                    break
                length -= 1
            if length:
                out.append(piece)
                at, length = to, min(longest, n - to)
            else:  # nothing fits here: mark the position and shorten the token before it
                failed[at >> 3] |= 1 << (at & 7)
                length = len(out.pop()) - 1
                at -= length + 1
        return out

    def run(self, n: int) -> list[str]:
        """Pieces of n spaces that no word has taken."""
        if n not in self.runs:
            pieces = self.merged(SPACE * n, {p: r for p, r in self.rank.items() if p[-1] == SPACE})
            if n > 4096:
                return pieces
            self.runs[n] = pieces
        return self.runs[n]

    def segment_ids(self, segment: str) -> list[int]:
        word = segment.lstrip(SPACE)
        spaces = len(segment) - len(word)
        head = SPACE if spaces else ""
        pieces: list[str | int] = []
        if self.chars.issuperset(word):
            pieces += self.backtrack(head + word)
        else:
            stretch = head
            for c in word:
                if c in self.chars:
                    stretch += c
                else:
                    pieces += [*self.backtrack(stretch), *(self.byte_id[b] for b in c.encode())]
                    stretch = ""
            pieces += self.backtrack(stretch)
        if spaces:
            lone = spaces if pieces[0] == SPACE else spaces - 1
            pieces = [*self.run(lone), *pieces[pieces[0] == SPACE:]]
        ids = self.id_of
        return [p if isinstance(p, int) else ids[p] for p in pieces]

    def decode(self, ids: list[int], start: bool = True) -> str:
        """Text of ids: pieces joined, byte tokens as UTF-8, the dummy prefix taken off at the start."""
        raw = bytearray()
        for i in ids:
            raw += bytes([self.bytes_of[i]]) if i in self.bytes_of else b"" if i in self.silent else self.piece_of[i].encode()
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if start and text.startswith(" ") else text

    def forget(self):
        self.young, self.old, self.odd = {}, {}, {}
        self.fits.clear()

    def lookup(self, segment: str) -> str:
        """Decimal ids of a segment, each followed by a comma."""
        if (ids := self.old.get(segment)) is None:
            tokens = self.segment_ids(segment)
            ids = ",".join(map(str, tokens)) + ","
            if "".join(map(self.piece_of.__getitem__, tokens)) != segment:  # byte tokens among them, or a change
                if (plain := self.decode(tokens, start=False)) != segment.replace(SPACE, " "):
                    self.odd[segment] = plain
        if len(segment) <= CACHED_CHARS:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[segment] = ids
        return ids

    def encode(self, text: str) -> tuple[str, str]:
        """(decimal ids joined by commas, text decoded from them)."""
        if not text:
            return "", ""
        segments = self.cut.findall(SPACE + text.replace(" ", SPACE))
        known = list(map(self.young.get, segments))
        if None in known:
            known = [k if k is not None else self.lookup(s) for s, k in zip(segments, known)]
        if self.odd:
            plain = "".join(self.odd.get(s) or s.replace(SPACE, " ") for s in segments)
        else:
            plain = "".join(segments).replace(SPACE, " ")
        return "".join(known)[:-1], plain[1:]


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids (array<int>, only with ``with_ids``), ids_sha256, decoded_sha256,
    round_trip (the decoded text equals the text)."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens long, " + ("ids array<int>, " * with_ids) + \
        "ids_sha256 string, decoded_sha256 string, round_trip boolean"

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = model(model_path)
        hold("spm", m.forget)
        counts, flat, ids_sha, text_sha, same = [], [], [], [], []
        for text in texts(batch):
            ids, plain = m.encode(text)
            counts.append(ids.count(",") + 1 if ids else 0)
            if with_ids:
                flat.append(ids)
            ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
            text_sha.append(hashlib.sha256(plain.encode()).hexdigest())
            same.append(plain == text)
        columns = {id_col: batch.column(0), "n_tokens": pa.array(counts, pa.int64())}
        if with_ids:
            values = pa.array(np.fromstring(",".join(filter(None, flat)), np.int32, sep=",") if any(flat) else np.zeros(0, np.int32))
            columns["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), values)
        return pa.RecordBatch.from_pydict(columns | {
            "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string()),
            "round_trip": pa.array(same, pa.bool_())})

    frame = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    return per_batch(frame, make, schema)


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from ids; null ids decode to the empty string."""
    kind = dict(encoded.dtypes)[id_col]

    def run(batches):
        for batch in batches:
            m = model(model_path)
            plain = [m.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "text": pa.array(plain, pa.string())})

    return encoded.select(encoded[id_col].alias(id_col), encoded[ids_col].alias("ids")).mapInArrow(
        run, f"`{id_col}` {kind}, text string")
