"""DuckDB SQL of the operators that SQL can express.

Each builder takes the name of a documents-like table and returns the common table
expressions that lead to ``<prefix>_out``; the pipeline chains them.
"""

from __future__ import annotations

from tilth.llm.chat import CHATML, START
from tilth.llm.common import LOWER, UPPER
from tilth.llm.quality import BASE_RULES, RULES, SIGNALS, STOP_WORDS

SPACE = r"[\x20\x09-\x0D]"
FOLD = f"translate({{0}}, '{UPPER}', '{LOWER}')"


def fold(expr: str) -> str:
    return FOLD.format(expr)


def _words(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '{SPACE}+'), lambda x: x <> '')"


def statement(ctes: list[str], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + final


def quality(src: str, p: str = "q") -> list[str]:
    stops = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
    trimmed = f"regexp_replace(x, '^{SPACE}+', '')"
    bullets = " OR ".join(f"starts_with({trimmed}, '{b}')" for b in ("-", "*", "•", "·", "–"))
    ends = f"regexp_replace(x, '{SPACE}+$', '')"
    kept = " AND ".join(f"NOT ({r.sql()})" for r in BASE_RULES + RULES)
    failed = " OR ".join(f"({r.sql()})" for r in BASE_RULES)
    return [
        f"""{p}_w AS (SELECT doc_id, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM {src})""",
        f"""{p}_tri AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM {p}_w))""",
        f"""{p}_rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM {p}_tri) WHERE k > 1)""",
        f"""{p}_cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM {p}_rep CROSS JOIN (VALUES (0), (1), (2)) v(o) GROUP BY doc_id)""",
        f"""{p}_sig AS (SELECT x.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  (length(t) - length(regexp_replace(t, '[!?]', '', 'g')))::BIGINT AS n_shouts,
  len(list_filter(string_split_regex({fold('t')}, '[\\x20\\x09-\\x0D.,;:!?]+'), lambda x: list_contains({stops}, x)))::BIGINT AS n_stop_words,
  len(l)::BIGINT AS n_lines,
  len(list_filter(l, lambda x: {bullets}))::BIGINT AS n_bullet_lines,
  len(list_filter(l, lambda x: ends_with({ends}, '...') OR ends_with({ends}, '…')))::BIGINT AS n_ellipsis_lines
  FROM {p}_w x LEFT JOIN {p}_cov c ON x.doc_id = c.doc_id)""",
        f"""{p}_out AS (SELECT doc_id, {', '.join(SIGNALS)}, ({failed}) AS base_failed, ({kept}) AS kept FROM {p}_sig)""",
    ]


def lines(src: str, p: str = "l") -> list[str]:
    return [
        f"""{p}_ln AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {src}))""",
        f"""{p}_key AS (SELECT *, regexp_replace(regexp_replace({fold('line')}, '^{SPACE}+', ''), '{SPACE}+$', '') AS key FROM {p}_ln)""",
        f"""{p}_dup AS (SELECT key, min(doc_id) AS keeper FROM {p}_key WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2)""",
        f"""{p}_out AS (SELECT k.doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> k.doc_id)::BIGINT AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = k.doc_id), '') AS kept_text
  FROM {p}_key k LEFT JOIN {p}_dup d ON k.key = d.key GROUP BY k.doc_id)""",
    ]


def near_duplicates(src: str, p: str = "n", width: int = 4, percent: int = 80) -> list[str]:
    return [
        f"""{p}_w AS (SELECT doc_id, {_words("coalesce(" + fold('text') + ", '')")} AS w FROM {src})""",
        f"""{p}_sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {width - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {width - 2}) + (CASE WHEN len(w) < {width} THEN 1 ELSE 0 END))) AS i
        FROM {p}_w WHERE len(w) > 0))""",
        f"""{p}_size AS (SELECT doc_id, count(*) AS n FROM {p}_sh GROUP BY doc_id)""",
        f"""{p}_both AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM {p}_sh a JOIN {p}_sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id)""",
        f"""{p}_link AS (SELECT a, b FROM {p}_both JOIN {p}_size x ON x.doc_id = a JOIN {p}_size y ON y.doc_id = b
  WHERE 100 * {p}_both.n >= {percent} * (x.n + y.n - {p}_both.n))""",
        f"""{p}_reach AS (SELECT doc_id AS a, doc_id AS b FROM {src} UNION
  SELECT r.a, k.b FROM {p}_reach r JOIN {p}_link k ON r.b = k.a)""",
        f"""{p}_out AS (SELECT r.a AS doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, min(b) = r.a AS kept
  FROM {p}_reach r LEFT JOIN {p}_size z ON z.doc_id = r.a GROUP BY r.a)""",
    ]


def contamination(src: str, items: str = "benchmark", p: str = "c", window: int = 10) -> list[str]:
    found = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    def cut(table: str, size: str) -> str:
        return f"unnest(range(1, len({table}.w) - {size} + 2))"
    return [
        f"""{p}_item AS (SELECT CAST(item_id AS VARCHAR) AS item, {found.format("coalesce(" + fold('text') + ", '')")} AS w FROM {items})""",
        f"""{p}_win AS (SELECT DISTINCT item, z, array_to_string(w[i:i + z - 1], ' ') AS words
  FROM (SELECT item, w, least({window}, len(w)) AS z, {cut(p + '_item', f'least({window}, len(w))')} AS i FROM {p}_item WHERE len(w) > 0))""",
        f"""{p}_doc AS (SELECT doc_id, {found.format("coalesce(" + fold('text') + ", '')")} AS w FROM {src})""",
        f"""{p}_z AS (SELECT DISTINCT z FROM {p}_win)""",
        f"""{p}_run AS (SELECT doc_id, z, i, array_to_string(w[i:i + z - 1], ' ') AS words
  FROM (SELECT doc_id, w, z, {cut('d', 'z')} AS i FROM {p}_doc d, {p}_z WHERE len(w) >= z))""",
        f"""{p}_occ AS (SELECT r.doc_id, r.z, r.i, x.item FROM {p}_run r JOIN {p}_win x ON r.z = x.z AND r.words = x.words)""",
        f"""{p}_hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + z)) AS place FROM {p}_occ) GROUP BY doc_id)""",
        f"""{p}_ids AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM {p}_occ GROUP BY doc_id)""",
        f"""{p}_out AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
  FROM {p}_doc d LEFT JOIN {p}_hit h ON d.doc_id = h.doc_id LEFT JOIN {p}_ids j ON d.doc_id = j.doc_id)""",
    ]


def mixing(src: str, p: str = "m", seed: str = "mix", epochs: int = 3) -> list[str]:
    taken = " + ".join(
        f"greatest(0, least(size, floor(target)::BIGINT - ({e} * source_size + done - size)))" for e in range(epochs))
    return [
        f"""{p}_s AS (SELECT doc_id, source, len({_words("coalesce(text, '')")})::BIGINT AS size,
  ('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 10))::BIGINT AS k FROM {src})""",
        f"""{p}_src AS (SELECT source, sum(size)::BIGINT AS source_size FROM {p}_s GROUP BY source)""",
        f"""{p}_wt AS (SELECT *, {epochs} * source_size AS lim,
  [1, 2, 3][((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 + 1]::BIGINT AS weight FROM {p}_src)""",
        f"""{p}_fill AS (SELECT *,
  (sum(source_size) OVER () - coalesce(sum(lim) OVER o, 0))::BIGINT AS rest,
  (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::BIGINT AS weights_left
  FROM {p}_wt WINDOW o AS (ORDER BY lim / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        f"""{p}_cap AS (SELECT *, rest::HUGEINT * weight >= lim::HUGEINT * weights_left AS capped FROM {p}_fill)""",
        f"""{p}_tgt AS (SELECT source, source_size, CASE WHEN capped THEN CAST(lim AS DOUBLE) ELSE
  CAST(max(CASE WHEN NOT capped THEN rest END) OVER () AS DOUBLE) * weight
    / max(CASE WHEN NOT capped THEN weights_left END) OVER () END AS target FROM {p}_cap)""",
        f"""{p}_q AS (SELECT s.doc_id, s.source, size, source_size, target,
  (sum(size) OVER (PARTITION BY s.source ORDER BY k, s.doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS done
  FROM {p}_s s JOIN {p}_tgt t ON s.source IS NOT DISTINCT FROM t.source)""",
        f"""{p}_out AS (SELECT doc_id, source, size, source_size, target, ({taken})::BIGINT AS taken FROM {p}_q)""",
    ]


def chats() -> str:
    esc = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"
    moves = ", ".join(f"('{a}', '{r}', '{b}')" for (a, r), b in CHATML.moves.items())
    final = ", ".join(f"'{x}'" for x in CHATML.final)
    return f"""WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
f AS (SELECT *, length('<|im_start|>' || replace({esc.format('role')}, chr(10), '<\\n>') || chr(10)
    || {esc.format('text')} || '<|im_end|>' || chr(10)) AS chars FROM t),
o AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
machine AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, '{START}' AS state, 0::BIGINT AS errors FROM t
  UNION ALL SELECT m.conv_id, o.i, coalesce(v.b, m.state), m.errors + (v.b IS NULL)::BIGINT
  FROM machine m JOIN o ON o.conv_id IS NOT DISTINCT FROM m.conv_id AND o.i = m.i + 1
  LEFT JOIN (VALUES {moves}) v(a, r, b) ON v.a = m.state AND v.r = o.role),
last AS (SELECT conv_id, arg_max(state, i) AS state, max(errors) AS errors FROM machine GROUP BY conv_id)
SELECT f.conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, any_value(errors = 0 AND state IN ({final})) AS valid_order, any_value(errors) AS n_order_errors
FROM f JOIN last ON last.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY f.conv_id"""


def collocations(low: int = 30, top: int = 2000) -> str:
    cut = """SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, z)) AS k FROM cand) c
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.z], ' ')"""
    return f"""WITH p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({fold("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
s AS (SELECT lang, w, z, unnest(range(1, len(w) - z + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) v(z) WHERE len(w) >= z),
g AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, z, count(*) AS f FROM s GROUP BY ALL),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE z >= 2 AND f >= {low}),
cut AS ({cut}),
best AS (SELECT lang, phrase, a, arg_min({{'l': l, 'r': r, 'score': score}}, score * 10 + k) AS b FROM cut GROUP BY ALL),
around AS (SELECT lang, array_to_string(w[i:i + y - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, w, f, y, unnest(range(1, z - y + 2)) AS i FROM cand, (VALUES (2), (3)) v(y) WHERE z > y) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY b.score DESC, a DESC, phrase) AS rank, phrase, a,
  b.l AS l, b.r AS r, b.score AS score FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""


def ranked(top: int = 20) -> str:
    found = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format("coalesce(" + fold('text') + ", '')")
    return f"""WITH d AS (SELECT doc_id, {found} AS w FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
tot AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0),
m AS (SELECT doc_id, 75 + (25 * len(w) * n_docs) // n_words AS m FROM d, tot WHERE len(w) > 0),
wt AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, tot GROUP BY term, n_docs),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({found}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {top}"""


def repeated_bytes(length: int = 400) -> str:
    """Windows by the hash of their hex digits, spans as islands, what is left glued together."""
    return f"""WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, hash(substr(h, 2 * i + 1, {2 * length})) AS k FROM (SELECT r, h, unnest(range(0, len(h) // 2 - {length - 1})) AS i FROM d WHERE len(h) >= {2 * length})),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
isl AS (SELECT r, i, sum(b) OVER (PARTITION BY r ORDER BY i) AS g FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= {length} THEN 0 ELSE 1 END AS b FROM rep)),
sp AS (SELECT r, min(i) AS a, max(i) + {length} AS z FROM isl GROUP BY r, g),
gaps AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS lo, a AS hi FROM sp
  UNION ALL SELECT r, max(z), NULL FROM sp GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, 2 * lo + 1, 2 * (coalesce(hi, len(h) // 2) - lo)), '' ORDER BY lo) AS k FROM gaps JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM sp GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)"""
