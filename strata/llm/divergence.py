"""Operator 11: quality rules by distribution divergence, as DataFrame expressions only.

Each document is described by two histograms: characters by class (lower-case, white space, upper-case, digits,
symbols, other ASCII punctuation, everything else) and words by the common words of its language (a word that
makes up at least 1/200 of the language's words, so at most 200 of them) with one bin for all other words. Both
are compared with the language's reference, the same histograms summed over all its documents of some length, by the
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1). A document far from its language in either
histogram is rejected. Guards: a histogram of fewer than ``min_words`` words (``min_chars`` characters) says little and
decides nothing, and neither does a language with fewer than ``min_reference`` words.

Beside the verdict stand the counts of plain rules: words, characters in words, symbols, repeated lines, and words
inside three-word windows that the text holds more than once. Windows are compared by a hash first (sorted with their
places), and those whose hash meets again by their words.

Two scans, no shuffle of documents: the first sums the references' words (combined map-side, one row per distinct word
and language after it), the second meets each document with the one-row reference of its language and writes its
counts, a few numbers a document; the character references are sums over those. Both joins are broadcast by the
planner's own size check on written tables; beyond it adaptive execution splits a hot language.

Defined results: null texts count as empty (0 words, ``base_failed``); a null language is the language ``und``;
repeated rows get equal results; an empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

#: A word is common from this share of its language's words on: at most ``COMMON_SHARE`` words a language.
COMMON_SHARE = 200
#: Jensen-Shannon distances from the reference up to which a document is kept.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.40
MIN_WORDS, MIN_CHARS, MIN_REFERENCE = 50, 200, 2000
UNDETERMINED = "und"

_SPACE, _SYMBOLS = r"[ \t-\r]+", r"[#*$%&|<>]+"
#: Classes taken out of the text one after the other, the most frequent first; what is left is the last class.
_CLASSES = ("[a-z]+", _SPACE, "[A-Z]+", "[0-9]+", _SYMBOLS, r"[!-/:-@\[-`{-~]+")


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def class_counts(text: str) -> str:
    """SQL: the number of characters of each class."""
    names = [f"rest{i}" for i in range(len(_CLASSES) + 1)]
    counts = [f"length({a}) - length({b})" for a, b in zip(names, names[1:])] + [f"length({names[-1]})"]
    out = f"transform(array({', '.join(counts)}), n -> bigint(n))"
    for i in reversed(range(len(_CLASSES))):
        out = _let(names[i + 1], f"regexp_replace({names[i]}, r'{_CLASSES[i]}', '')", out)
    return _let(names[0], text, out)


def words(text: str) -> str:
    """SQL: the words; cut at one character, which needs no pattern matching."""
    for other in (r"\n", r"\t", r"\r", r"\u000B", r"\u000C"):
        text = f"replace({text}, '{other}', ' ')"
    return f"array_remove(split({text}, ' '), '')"


def repeated_lines(text: str) -> str:
    """SQL: lines with a word that equal an earlier line."""
    return _let("ls", rf"filter(split({text}, '\n'), l -> l rlike r'[^ \t-\r]')", "size(ls) - size(array_distinct(ls))")


def repeated_words(w: str) -> str:
    """SQL: words of ``w`` inside three-word windows that occur more than once."""
    window = "{0}[i], {0}[i + 1], {0}[i + 2]".format(w)
    again = "{k} <=> {before} or {k} <=> {after}"
    hashed = f"sort_array(transform(sequence(0, size({w}) - 3), i -> shiftleft(bigint(hash({window})), 32) + i))"
    met = "filter(hs, (x, j) -> " + again.format(k="shiftright(x, 32)", before="shiftright(get(hs, j - 1), 32)", after="shiftright(get(hs, j + 1), 32)") + ")"
    exact = f"sort_array(transform(ms, m -> {_let('i', 'int(m & 4294967295)', f'struct(struct({window}) as w, i as i)')}))"
    places = "sort_array(transform(filter(es, (x, j) -> " + again.format(k="x.w", before="get(es, j - 1).w", after="get(es, j + 1).w") + "), x -> x.i))"
    covered = "aggregate(transform(ps, (p, j) -> least(3, coalesce(get(ps, j + 1) - p, 3))), 0, (s, x) -> s + x)"
    return f"if(size({w}) < 4, 0, {_let('hs', hashed, _let('ms', met, f'if(size(ms) = 0, 0, {_let(chr(101) + chr(115), exact, _let(chr(112) + chr(115), places, covered))})'))})"


def _term(p: str, q: str) -> str:
    """SQL: what one bin adds to twice the divergence."""
    return f"if({p} = 0, 0d, {p} * log2(2 * {p} / ({p} + {q}))) + if({q} = 0, 0d, {q} * log2(2 * {q} / ({p} + {q})))"


def _distance(total: str) -> str:
    return f"sqrt(greatest(0d, 0.5d * ({total})))"


def char_distance(counts: str, shares: str) -> str:
    terms = f"zip_with(transform({counts}, n -> n / total), {shares}, (p, q) -> {_term('p', 'q')})"
    return _let("total", f"aggregate({counts}, 0L, (s, n) -> s + n)", _distance(f"aggregate({terms}, 0d, (s, x) -> s + x)"))


def word_distance(w: str, common: str, shares: str) -> str:
    """SQL: sorted numbers of the common words met; each run of one number is a bin. The bins that are not met add their
    whole share."""
    met = f"sort_array(array_remove(transform({w}, x -> array_position({common}, x)), 0L))"
    ends = "filter(sequence(0, size(met) - 1), j -> not (met[j] <=> get(met, j + 1)))"
    run = f"struct((e + 1 - if(k = 0, 0, ends[k - 1] + 1)) / size({w}) as p, {shares}[int(met[e] - 1)] as q)"
    parts = f"if(size(met) = 0, array(), {_let('ends', ends, f'transform(ends, (e, k) -> {run})')})"
    seen = f"aggregate(bins, struct(0d as t, 0d as q), (s, b) -> struct(s.t + {_term('b.p', 'b.q')} as t, s.q + b.q as q))"
    all_q = f"aggregate({shares}, 0d, (s, x) -> s + x)"
    total = _let("o", f"struct(1 - size(met) / size({w}) as p, 1 - {all_q} as q)", f"seen.t + ({all_q} - seen.q) + {_term('o.p', 'o.q')}")
    bins = f"cast({parts} as array<struct<p: double, q: double>>)"
    return _let("met", met, _let("bins", bins, _let("seen", seen, _distance(total))))


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per language: reference_lang, reference_words, common (words, most frequent first), word_shares; over all
    documents of at least ``min_chars`` characters. Input: lang, text (no nulls)."""
    by_word = docs.where(f"length(text) >= {min_chars}").selectExpr("lang", f"explode({words('text')}) as word").groupBy(
        "lang", "word").agg(F.expr("count(1) as n"))
    by_word, _ = written(by_word, "divergence-words")
    # Written, so that its size is known and the join needs no shuffle of the words by language.
    totals, _ = written(by_word.groupBy("lang").agg(F.expr("sum(n) as total")), "divergence-totals", 1)
    common = by_word.join(totals, "lang").where(f"n * {COMMON_SHARE} >= total").groupBy("lang").agg(
        F.expr("sort_array(collect_list(struct(-n as m, word as word))) as top"))
    return totals.join(common, "lang", "left").selectExpr(
        "lang as reference_lang", "total as reference_words", "coalesce(transform(top, t -> t.word), cast(array() as array<string>)) as common",
        "coalesce(transform(top, t -> -t.m / total), cast(array() as array<double>)) as word_shares")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_chars: float = MAX_CHAR_DISTANCE, max_words: float = MAX_WORD_DISTANCE, min_words: int = MIN_WORDS,
          min_chars: int = MIN_CHARS, min_reference: int = MIN_REFERENCE) -> DataFrame:
    """``id_col``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance,
    word_distance (null where a guard applies) of every document."""
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.coalesce(F.col(lang_col), F.lit(UNDETERMINED)).alias("lang"))
    refs, _ = written(references(plain.drop("id"), min_chars), "divergence-words-by-language", 1)
    by_word = _let("w", words("text"), "struct(size(w) as n, " + f"{repeated_words('w')} as again, if(size(w) >= {min_words} and "
                   f"reference_words >= {min_reference}, {word_distance('w', 'common', 'word_shares')}, null) as far)")
    counted, _ = written(plain.join(refs, F.expr("lang = reference_lang"), "left").selectExpr(
        "id", "lang", "reference_words", "length(text) as n_chars", f"{by_word} as by_word", f"{class_counts('text')} as classes",
        f"{repeated_lines('text')} as dup_lines"), "divergence-counts")
    sums = ", ".join(f"sum(classes[{i}])" for i in range(len(_CLASSES) + 1))
    shares = counted.where(f"n_chars >= {min_chars}").groupBy("lang").agg(F.expr(f"array({sums}) as c")).selectExpr(
        "lang as reference_lang", "transform(c, n -> n / aggregate(c, 0L, (s, x) -> s + x)) as char_shares")
    base = counted.join(shares, F.expr("lang = reference_lang"), "left").selectExpr(
        "id", "bigint(by_word.n) as n_words", "bigint(n_chars - classes[1]) as word_chars", "classes[4] as n_symbols",
        "bigint(dup_lines) as n_dup_lines", "bigint(by_word.again) as n_repeat_words", "by_word.far as word_distance",
        f"if(n_chars >= {min_chars} and reference_words >= {min_reference}, {char_distance('classes', 'char_shares')}, null) as char_distance")
    failed = f"(n_words < {min_words} or 100 * n_repeat_words > 50 * n_words)"
    far = f"(coalesce(char_distance > {max_chars}d, false) or coalesce(word_distance > {max_words}d, false))"
    return base.selectExpr(f"id as `{id_col}`", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           f"{failed} as base_failed", f"not {failed} and not {far} as kept", "char_distance", "word_distance")
