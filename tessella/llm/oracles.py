"""DuckDB SQL for the queries of the numbered operators that SQL can express, by the contracts' definitions.

op6 is rounded to six digits on both sides, as sums of logarithms depend on their order in the last ones.
"""

from tessella.llm import fingerprints, lm_scoring

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _bits(text: str) -> str:
    """The bits of an ASCII string, the lowest of each byte first."""
    return f"list_transform(range(8 * length({text})), lambda i: (ascii(substr({text}, 1 + i // 8, 1)) >> (i % 8)) & 1)"


def crc32(text: str) -> str:
    step = "xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_transform(list_prepend(4294967295, {_bits(text)}), lambda x: CAST(x AS BIGINT)), lambda c, b: {step}), 4294967295)"


# a list's strings that are not the other's, each once; what both have
_EXCEPT = "list_filter(list_distinct({0}), lambda x: NOT list_contains({1}, x))"
_BOTH = "list_filter(list_distinct({0}), lambda x: list_contains({1}, x))"
_PARAGRAPHS = "string_split(coalesce(array_to_string({}, ''), ''), '.')"
_LEAVES = "list_distinct(regexp_extract_all(coalesce(array_to_string({}, ''), ''), '[^.]{{8}}'))"
_WEIGHT = "length(replace(coalesce(array_to_string({}, ''), ''), '.', '')) // 8"


def _likeness(a: str, b: str) -> str:
    x, y = _PARAGRAPHS.format(_EXCEPT.format(f"{a}.parts", f"{b}.parts")), _PARAGRAPHS.format(_EXCEPT.format(f"{b}.parts", f"{a}.parts"))
    open_x, open_y = _EXCEPT.format(x, y), _EXCEPT.format(y, x)
    k, l = _LEAVES.format(open_x), _LEAVES.format(open_y)  # noqa: E741
    w = f"({_WEIGHT.format(_BOTH.format(f'{a}.parts', f'{b}.parts'))} + {_WEIGHT.format(_BOTH.format(x, y))})"
    both = f"(2 * {w} + len({k}) + len({l}))"
    return f"CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE WHEN {both} = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * ({w} + len({_BOTH.format(k, l)})) / {both} END", f"len(list_filter({open_x}, lambda x: x <> ''))"


_LIKE_EDITED, _OPEN = _likeness("a", "b")
_LIKE_NEXT, _ = _likeness("a", "c")
_JOIN = "coalesce(array_to_string({}, ''), '')"
_RUNS = f"list_filter(string_split({_JOIN.format(chr(123) + chr(125))}, chr(10)), lambda x: x <> '')"

OP5 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, length(t) AS n_chars, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nx FROM d),
e AS (SELECT *, substr(t, 1, n_chars - n_chars // 2) || substr(nx, 1, n_chars // 2) AS edited FROM n),
texts AS (SELECT doc_id, 'a' AS k, t FROM e UNION ALL SELECT doc_id, 'b', edited FROM e UNION ALL SELECT doc_id, 'c', nx FROM e),
words AS (SELECT doc_id, k, list_transform(string_split(t, chr(10)), lambda p: regexp_extract_all(p, '{fingerprints.WORD}')) AS x FROM texts),
runs AS (SELECT doc_id, k, list_transform(x, lambda p: {_RUNS.format("list_transform(p, lambda w: w || CASE WHEN substr(md5(w), 1, 1) < '4' THEN chr(10) ELSE '' END)")}) AS x FROM words),
leaves AS (SELECT doc_id, k, list_transform(x, lambda p: list_transform(p, lambda y: sha256('l' || y))) AS x FROM runs),
hashed AS (SELECT doc_id, k, x, list_transform(x, lambda p: sha256('p' || {_JOIN.format("p")})) AS h FROM leaves),
joined AS (SELECT doc_id, k, array_to_string(list_transform(h, lambda y: y || CASE WHEN y[1] = '0' THEN ';' ELSE '' END), '') AS whole,
 array_to_string(list_transform(range(1, len(h) + 1), lambda i: {_JOIN.format("list_transform(x[i], lambda y: substr(y, 1, 8))")} || '.' || CASE WHEN h[i][1] = '0' THEN ';' ELSE '' END), '') AS short FROM hashed),
tree AS (SELECT doc_id, k, sha256('r' || array_to_string(list_transform(list_filter(string_split(whole, ';'), lambda y: y <> ''), lambda y: sha256('s' || y)), '')) AS root,
 list_filter(string_split(short, ';'), lambda y: y <> '') AS parts FROM joined)
SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, a.root || '/' || array_to_string(a.parts, ';') AS fingerprint, b.root || '/' || array_to_string(b.parts, ';') AS edited_fingerprint,
 {_LIKE_EDITED} AS near_edited, {_LIKE_NEXT} AS near_next, {_OPEN} AS n_edited_paragraphs
FROM e JOIN tree a ON a.doc_id = e.doc_id AND a.k = 'a' JOIN tree b ON b.doc_id = e.doc_id AND b.k = 'b' JOIN tree c ON c.doc_id = e.doc_id AND c.k = 'c'"""

OP6 = f"""WITH d AS (SELECT doc_id, {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 2 AS held_out, list_append(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}'), chr(10)) AS ws FROM documents),
t AS (SELECT doc_id, held_out, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, unnest(list_concat([chr(10)], ws[:-2])) AS v, unnest(list_concat([NULL, chr(10)], ws[:-3])[:len(ws)]) AS u FROM d),
c1 AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1),
c2 AS (SELECT v, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1, 2),
c3 AS (SELECT u, v, w, count(*) AS c FROM t WHERE NOT held_out AND u IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT coalesce(sum(c), 0)::DOUBLE AS n, count(*)::DOUBLE AS v, count_if(c = 1)::DOUBLE AS once, count_if(c = 2)::DOUBLE AS twice FROM c1),
k AS (SELECT *, least(greatest(CASE WHEN once + twice > 0 THEN once / (once + 2 * twice) ELSE 0.5 END, 0.1), 0.9) AS disc FROM s),
p AS (SELECT t.doc_id, t.held_out, coalesce(a.c, 0)::DOUBLE AS a, coalesce(b.c, 0)::DOUBLE AS b, coalesce(x.c, 0)::DOUBLE AS x, coalesce(ha.c, 0)::DOUBLE AS ha, CASE WHEN t.u IS NULL THEN 0.0 ELSE coalesce(hb.c, 0)::DOUBLE END AS hb, k.*
 FROM t CROSS JOIN k LEFT JOIN c1 a ON a.w = t.w LEFT JOIN c2 b ON b.v = t.v AND b.w = t.w LEFT JOIN c3 x ON x.u = t.u AND x.v = t.v AND x.w = t.w LEFT JOIN c1 ha ON ha.w = t.v LEFT JOIN c2 hb ON hb.v = t.u AND hb.w = t.v),
q AS (SELECT *, CASE WHEN n = 0 THEN 1.0 WHEN a > 0 THEN (a - disc) / n ELSE disc * v / n END AS p1 FROM p),
r AS (SELECT *, (b + {lm_scoring.STRENGTHS[0]} * p1) / (ha + {lm_scoring.STRENGTHS[0]}) AS p2 FROM q)
SELECT doc_id, held_out, count(*) AS n_tokens, CAST(count_if(a > 0) AS BIGINT) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens, round(sum(log10((a + 1) / (n + v + 1))), 6) AS base_score,
 round(sum(log10((x + {lm_scoring.STRENGTHS[1]} * p2) / (hb + {lm_scoring.STRENGTHS[1]}))), 6) AS score FROM r GROUP BY doc_id, held_out"""


def _op8() -> str:
    """Fences 6 quartile distances beyond the quartiles of a language and source with 200 documents, else of a language with as many, else of all; the numbers stand here on their own."""
    value = {
        "symbol_rate": "n_symbols / w", "capital_rate": "n_capitals / greatest(word_chars, 1)", "line_rate": "n_dup_lines / greatest(n_lines, 1)",
        "same_rate": "n_same_words / w", "word_length": "word_chars / w",
    }
    least = {"symbol_rate": "3 / greatest({n_words}, 1)", "capital_rate": "4 / greatest({word_chars}, 1)", "line_rate": "0.5 / greatest({n_lines}, 1)", "same_rate": "2 / greatest({n_words}, 1)", "word_length": "0.05::DOUBLE * {word_length}"}
    quart = ", ".join([f"quantile_disc({k}, {q}) AS {k}_{n}" for k in value for q, n in ((0.25, "a"), (0.75, "b"))] + [f"quantile_disc({k}::DOUBLE, 0.5) AS {k}_m" for k in ("n_words", "word_chars", "n_lines", "word_length")])
    levels = ("g", "count(*) AS n, lang, source", "lang, source"), ("l", "count(*) AS n, lang", "lang"), ("o", "count(*) AS n", "")
    ctes = ",\n".join(f"{t} AS (SELECT {c}, {quart} FROM fit" + (f" GROUP BY {by}" if by else "") + ")" for t, c, by in levels)
    own = lambda k, n: f"CASE WHEN g.n >= 200 THEN g.{k}_{n} WHEN l.n >= 200 THEN l.{k}_{n} ELSE o.{k}_{n} END"
    out = []
    for k, unit in least.items():
        width = f"greatest(({own(k, 'b')}) - ({own(k, 'a')}), {unit.format(**{c: '(' + own(c, 'm') + ')' for c in ('n_words', 'word_chars', 'n_lines', 'word_length')})})"
        out.append(f"coalesce(r.{k} <= ({own(k, 'b')}) + 6::DOUBLE * {width}" + (f" AND r.{k} >= ({own(k, 'a')}) - 6::DOUBLE * {width}" if k == "word_length" else "") + ", true)")
    n = 8
    return f"""WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
m AS (SELECT *, len(ws) AS n_words, list_transform(range(1, len(ws) - {n} + 2), lambda i: array_to_string(ws[i:i + {n - 1}], ' ')) AS win FROM w),
wins AS (SELECT doc_id, unnest(win) AS g, unnest(range(1, len(win) + 1)) AS i FROM m),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1),
rep AS (SELECT doc_id, sum(least({n}, coalesce(nxt - i, {n}))) AS n FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id),
c AS (SELECT m.doc_id, lang, source, n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
 length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
 length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS n_capitals, len(ls) AS n_lines, len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_same_words
 FROM m LEFT JOIN rep ON rep.doc_id = m.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, greatest(n_words, 1) AS w FROM c),
r AS (SELECT *, {", ".join(f"{v} AS {k}" for k, v in value.items())} FROM f),
fit AS (SELECT * FROM r WHERE NOT base_failed),
{ctes}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(out)} AS kept, n_capitals, n_lines
FROM r LEFT JOIN g ON g.lang IS NOT DISTINCT FROM r.lang AND g.source IS NOT DISTINCT FROM r.source LEFT JOIN l ON l.lang IS NOT DISTINCT FROM r.lang CROSS JOIN o"""


OP10 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS ws FROM documents),
s AS (SELECT doc_id, list_sort(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END) AS g FROM w),
c AS (SELECT g, min(doc_id) AS rep, len(g) AS n FROM s GROUP BY g),
u AS (SELECT rep, n, unnest(g) AS x FROM c),
e AS (SELECT a.rep AS a, b.rep AS b FROM u a JOIN u b ON a.x = b.x AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
ties AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(a, b) AS (SELECT rep, rep FROM c UNION SELECT reach.a, ties.b FROM reach JOIN ties ON ties.a = reach.b),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, c.n AS n_shingles, CASE WHEN c.n = 0 THEN s.doc_id ELSE lowest.b END AS component_id, s.doc_id = CASE WHEN c.n = 0 THEN s.doc_id ELSE lowest.b END AS kept
FROM s JOIN c ON c.g = s.g JOIN lowest ON lowest.a = c.rep"""

OP13 = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS w, [CAST('0x' || h[8 * k + 1:8 * k + 8] AS BIGINT) FOR k IN range(4)] AS g FROM d),
c AS (SELECT *, least(g[1] % (len(w) + 1), g[2] % (len(w) + 1)) AS a, greatest(g[1] % (len(w) + 1), g[2] % (len(w) + 1)) AS b,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 50 THEN 'plain' WHEN g[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS pre, coalesce(array_to_string(w[a + 1:b], ''), '') AS mid, coalesce(array_to_string(w[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

ORACLE_SQL = {"op5_document_fingerprints": OP5, "op6_lm_scoring": OP6, "op8_quality_rules": _op8(), "op10_minhash_near_dedup": OP10, "op13_fill_in_middle": OP13}
