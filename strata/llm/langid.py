"""Operator 5: language identification by Bayesian fusion of evidence.

For each page and language, log posterior = TEMPER * log P(text | language) + log P(declared | language)
+ log P(address | language) + log P(language | host):

* text: hashed byte trigrams of the visible text (scripts, styles, navigation and footers left out),
  under models counted over all labelled documents; TEMPER < 1 as overlapping trigrams are not independent;
* declared: the primary language tag of the markup; address: top-level suffix and a two-letter path
  segment. Their likelihoods are smoothed towards the marginal;
* host: prior smoothed hierarchically, host towards domain towards suffix towards all pages.

The tables of the last three are grouped aggregates of the pages' text-only posteriors. Each page's own
share is taken out again before they are applied to it, so a page never confirms itself. Aggregates
combine map-side and meet the pages by joins whose both sides are written tables, so a host with a
third of all pages is split by adaptive execution.

Defined results: null or empty html has no text and no declared tag, a null or broken address no host
(all such share one empty host); equal posteriors go to the first language in order; repeated rows get a
row each; documents without language or text teach nothing; without any language lang is null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import per_batch, slices, texts, written

BUCKETS, TEMPER, SMOOTH = 1 << 14, 0.2, 5.0
_TAG = re.compile(r"(<!--.*?-->|<[^<>]*>)", re.S)
_NAME = re.compile(r"</?([a-zA-Z0-9]+)")
_SKIP = {"script", "style", "noscript", "template", "nav", "footer", "aside"}
_LANG = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", re.I)
_META = re.compile(r"<meta\b[^<>]*?content-language[^<>]*?content\s*=\s*[\"']?([A-Za-z]{2,8})", re.I)


def trigrams(text: str) -> np.ndarray:
    """Hash buckets of the byte trigrams of a text, A-Z lower-cased, runs of digits and marks left as they are."""
    raw = np.frombuffer(b" " + " ".join(text.split()).lower().encode() + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def visible(html: str) -> str:
    """The text between tags, outside the elements of _SKIP."""
    out, inside = [], None
    for i, part in enumerate(_TAG.split(html)):
        if i % 2 == 0:
            if not inside:
                out.append(part)
            continue
        name = _NAME.match(part)
        name = name[1].lower() if name else ""
        if inside:
            inside = None if name == inside and part[1] == "/" else inside
        elif name in _SKIP and part[1] != "/" and part[-2] != "/":
            inside = name
    return " ".join(out)


def declared(html: str) -> str | None:
    found = _LANG.search(html[:html.find("<body")] if "<body" in html else html) or _META.search(html)
    return found[1].lower() if found else None


def address(url: str) -> tuple[str, str, str, str]:
    """(host, domain, suffix, suffix with a two-letter path segment)."""
    try:
        parts = urlsplit(url)
        host, path = (parts.hostname or "").lower(), parts.path
    except ValueError:
        host, path = "", ""
    labels = host.split(".")
    segment = next((s.lower() for s in path.split("/") if re.fullmatch("[A-Za-z]{2}", s)), "")
    return host, ".".join(labels[-2:]), labels[-1], f"{labels[-1]}/{segment}"


def text_models(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, their log probabilities of trigram buckets), counted over all documents."""

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for part in slices(batches):
            for lang, text in zip(part.column("lang").to_pylist(), texts(part)):
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, np.int64)
                held[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()),
                                              "n": pa.array(n[at], pa.int64())})

    rows = docs.select("lang", "text").where("lang is not null and text is not null").mapInArrow(
        count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x BUCKETS rows
    langs = sorted(rows.lang.unique())
    counts = np.zeros((len(langs), BUCKETS))
    counts[rows.lang.map({la: i for i, la in enumerate(langs)}).to_numpy(int), rows.bucket.to_numpy()] = rows.n
    return langs, np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS))


def _normal(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Per page: page_id, lang, posterior, text_lang, declared, host."""
    langs, model = text_models(docs)
    frame = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), pages["html"].alias("html"))
    if not langs:
        return frame.selectExpr("page_id", "cast(null as string) lang", "cast(null as double) posterior", "cast(null as string) text_lang",
                                "cast(null as string) declared", "cast(null as string) host")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, like = [], np.zeros((batch.num_rows, len(langs)))
        for i, (ident, url, html) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))):
            grams = trigrams(visible(html or ""))
            like[i] = TEMPER * shared.value[:, grams].sum(1)
            host, domain, suffix, where = address(url or "")
            rows.append((ident, host, domain, suffix, where, declared(html or "")))
        own = _normal(like)
        columns = list(zip(*rows))
        return pa.RecordBatch.from_pydict({
            "page_id": pa.array(columns[0], pa.int64()), **{c: pa.array(v, pa.string()) for c, v in zip(_KEYS, columns[1:])},
            "likely": pa.array(list(like - like.max(1, keepdims=True)), pa.list_(pa.float64())), "own": pa.array(list(own), pa.list_(pa.float64()))})

    _KEYS = ("host", "domain", "suffix", "address", "declared")
    seen, _ = written(per_batch(frame, look, "page_id long, " + ", ".join(f"{k} string" for k in _KEYS)
                                + ", likely array<double>, own array<double>", column="html"), "langid-pages")
    total = [F.sum(F.col("own")[i]).alias(f"t{i}") for i in range(len(langs))]
    everyone = np.array(seen.agg(*(F.coalesce(t, F.lit(0.0)).alias(f"t{i}") for i, t in enumerate(total))).first(), float)
    full = seen
    for key in _KEYS:
        table, _ = written(seen.where(F.col(key).isNotNull()).groupBy(key).agg(*total).select(
            key, F.array(*(f"t{i}" for i in range(len(langs)))).alias(f"by_{key}")), f"langid-{key}")
        full = full.join(table, key, "left")

    def fuse(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = lambda c: np.array([r if r is not None else [0.0] * len(langs) for r in batch.column(c).to_pylist()], float)
            own, z = matrix("own"), matrix("likely")
            rest = lambda c: np.maximum(matrix(c) - own, 0.0)  # noqa: E731 - what the other pages say
            others = np.maximum(everyone - own, 0.0)
            prior = (others + 1.0) / (others + 1.0).sum(1, keepdims=True)
            for key in ("suffix", "domain", "host"):
                n = rest(f"by_{key}")
                prior = (n + SMOOTH * prior) / (n.sum(1, keepdims=True) + SMOOTH)
            z += np.log(prior)
            for key in ("declared", "address"):
                n = rest(f"by_{key}")
                marginal = n.sum(1, keepdims=True) / np.maximum(others.sum(1, keepdims=True), 1.0)
                given = (n + SMOOTH * np.maximum(marginal, 1e-9)) / (others + SMOOTH)
                known = (matrix(f"by_{key}").sum(1) > 0)[:, None]
                z += np.where(known, np.log(given), 0.0)
            p = _normal(z)
            best = p.argmax(1)
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "lang": pa.array([langs[b] for b in best], pa.string()),
                "posterior": pa.array(p[np.arange(len(p)), best], pa.float64()), "text_lang": pa.array([langs[b] for b in own.argmax(1)], pa.string()),
                "declared": batch.column("declared"), "host": batch.column("host")})

    return full.mapInArrow(fuse, "page_id long, lang string, posterior double, text_lang string, declared string, host string")
