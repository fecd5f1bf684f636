"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from strata.llm import collocations, divergence

_TERM = "CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END"
_CLASS_SQL = ("[a-z]", r"[ \t-\r]", "[A-Z]", "[0-9]", r"[#*$%&|<>]", r"""[!"'()+,\-./:;=?@\[\\\]^_`{}~]""")


def _class_columns() -> str:
    counts = [f"length(t) - length(regexp_replace(t, '{c.replace(chr(39), chr(39) * 2)}', '', 'g'))" for c in _CLASS_SQL]
    return ", ".join(f"{c} AS c{i}" for i, c in enumerate(counts)) + f", length(t) - ({' + '.join(f'({c})' for c in counts)}) AS c{len(counts)}"


_N = len(_CLASS_SQL) + 1

DIVERGENCE = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(lang, 'und') AS lang FROM documents),
s AS (SELECT rid, doc_id, lang, t, length(t) AS chars, [x for x in string_split_regex(t, '[ \t-\r]+') if x <> ''] AS w,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^ \t-\r]')] AS lines, {_class_columns()} FROM d),
ones AS (SELECT rid, lang, chars, len(w) AS n, unnest(w) AS word FROM s),
total AS (SELECT lang, count(*) AS n FROM ones WHERE chars >= {divergence.MIN_CHARS} GROUP BY lang),
common AS (SELECT o.lang, o.word, count(*) / any_value(t.n) AS q FROM ones o JOIN total t USING (lang) WHERE chars >= {divergence.MIN_CHARS}
    GROUP BY o.lang, o.word HAVING count(*) * {divergence.COMMON_SHARE} >= any_value(t.n)),
met AS (SELECT o.rid, c.q, count(*) / any_value(o.n) AS p FROM ones o JOIN common c USING (lang, word) GROUP BY o.rid, o.lang, o.word, c.q),
bins AS (SELECT rid, sum({_TERM}) AS far, sum(p) AS p, sum(q) AS q FROM met GROUP BY rid),
share AS (SELECT lang, sum(q) AS q FROM common GROUP BY lang),
rest AS (SELECT s.rid, coalesce(b.far, 0) + coalesce(h.q, 0) - coalesce(b.q, 0) AS far, 1 - coalesce(b.p, 0) AS p, 1 - coalesce(h.q, 0) AS q
    FROM s LEFT JOIN bins b USING (rid) LEFT JOIN share h USING (lang)),
far_words AS (SELECT rid, sqrt(greatest(0, 0.5 * (far + {_TERM}))) AS far FROM rest),
ref AS (SELECT lang, {', '.join(f'sum(c{i}) / sum(chars) AS q{i}' for i in range(_N))} FROM s WHERE chars >= {divergence.MIN_CHARS} GROUP BY lang),
cells AS (SELECT s.rid, unnest([{', '.join(f'c{i} / chars' for i in range(_N))}]) AS p, unnest([{', '.join(f'q{i}' for i in range(_N))}]) AS q
    FROM s JOIN ref USING (lang) WHERE chars >= {divergence.MIN_CHARS}),
far_chars AS (SELECT rid, sqrt(greatest(0, 0.5 * sum({_TERM}))) AS far FROM cells GROUP BY rid),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM s)),
again AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows), range(3) AS ks(k)
    WHERE c > 1 GROUP BY rid),
base AS (SELECT s.rid, s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(chars - c1 AS BIGINT) AS word_chars, CAST(c4 AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(a.n, 0) AS n_repeat_words, t.n AS ref_words
    FROM s LEFT JOIN again a USING (rid) LEFT JOIN total t USING (lang)),
judged AS (SELECT *, n_words < {divergence.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
    AND NOT coalesce(ref_words >= {divergence.MIN_REFERENCE} AND w.far > {divergence.MAX_WORD_DISTANCE}, false)
    AND NOT coalesce(ref_words >= {divergence.MIN_REFERENCE} AND c.far > {divergence.MAX_CHAR_DISTANCE}, false) AS kept
FROM judged LEFT JOIN far_words w USING (rid) LEFT JOIN far_chars c USING (rid)"""

_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER_SQL}, '[.,;:!?\n-\r]')) AS piece FROM documents),
lists AS (SELECT lang, [x for x in string_split_regex(piece, '[ \t]+') if x <> ''] AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
phrases AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM placed, range(1, 4) AS ks(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM phrases GROUP BY lang, k, phrase),
langs AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= {collocations.LEAST}),
longer AS (SELECT lang, part AS phrase, max(a) AS most FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM cand WHERE k = 3)
    GROUP BY lang, part),
kept AS (SELECT c.* FROM cand c LEFT JOIN longer o USING (lang, phrase) WHERE o.most IS NULL OR 100 * o.most < {collocations.COVERED} * c.a),
cuts AS (SELECT lang, phrase, a, c.cut, array_to_string(w[1:c.cut], ' ') AS head, array_to_string(w[c.cut + 1:k], ' ') AS tail
    FROM kept, range(1, 3) AS c(cut) WHERE c.cut < k),
scored AS (SELECT x.*, x.cut AS place, h.n AS l, t.n AS r, CAST(1000000::HUGEINT * a * a // (h.n::HUGEINT * t.n) AS BIGINT) AS score
    FROM cuts x JOIN f h ON h.lang = x.lang AND h.phrase = x.head JOIN f t ON t.lang = x.lang AND t.phrase = x.tail),
weakest AS (SELECT DISTINCT ON (lang, phrase) lang, phrase, a, l, r, score FROM scored ORDER BY lang, phrase, score, place),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT x.lang, rank, phrase, a, l, r, g.n, score FROM ranked x JOIN langs g ON g.lang = x.lang WHERE rank <= {collocations.TOP}"""

_BASE32 = ("array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, (i // 4) * 5 + 1, 5) AS BIGINT) "
           ">> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1) for i in range(32)], '')")

WARC = f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS h FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM h)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to FROM r"""

_REACH = """reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

LATTICE = f"""WITH RECURSIVE v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
nodes AS (SELECT id FROM v),
good AS (SELECT id, label, len(e) AS dim, e, sqrt(list_sum([x * x for x in e])) AS norm FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0),
links AS (SELECT x.id AS a, y.id AS b FROM good x JOIN good y ON x.label = y.label AND x.dim = y.dim AND x.id <> y.id
    WHERE x.norm > 0 AND y.norm > 0 AND list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
{_REACH},
n AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT v.id AS vec_id, coalesce(n.n, 0) AS n_links, component_id, v.id = component_id AS kept FROM v JOIN comp USING (id) LEFT JOIN n USING (id)"""

MINHASH = rf"""WITH RECURSIVE w AS (SELECT doc_id AS id, [x for x in string_split_regex({_LOWER_SQL}, '[ \t-\r]+') if x <> ''] AS w FROM documents),
nodes AS (SELECT id FROM w),
sh AS (SELECT DISTINCT id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
met AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.id <> y.id GROUP BY x.id, y.id),
links AS (SELECT a, b FROM met JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
{_REACH}
SELECT w.id AS doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.id = component_id AS kept FROM w JOIN comp USING (id) LEFT JOIN n USING (id)"""

ORACLES = {"op1_warc": WARC, "op3_lattice_near_dup": LATTICE, "op6_minhash_near_dup": MINHASH,
           "op11_distribution_divergence": DIVERGENCE, "op13_collocations": COLLOCATIONS}
