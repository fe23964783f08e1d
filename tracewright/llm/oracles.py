"""SQL for DuckDB for the queries that SQL can express; windows are compared as text, nothing is hashed."""

from __future__ import annotations

from tracewright.llm import contamination as c
from tracewright.llm import licences
from tracewright.llm import mixing as m
from tracewright.llm import pseudonyms as p


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TOKENS = r"regexp_extract_all(text, '[0-9]+(?:[.,:/][0-9]+)*|(?:[.!?:\n][^\p{L}\p{M}0-9]*)?[\p{L}\p{M}]+')"
_START = "regexp_matches(w, '^[.!?:\\n]')"
_BARE = "regexp_replace(w, '^[^\\p{L}\\p{M}]+', '')"
_UNITS = ", ".join(map(quoted, c.UNITS))
_TEMPLATE = f"""list_transform(toks, lambda w, i: CASE WHEN {_START} THEN lower({_BARE}) WHEN regexp_matches(w, '^[0-9]') THEN '{c.NUMBER}'
 WHEN lower(w) IN ({_UNITS}) AND i > 1 AND regexp_matches(toks[i - 1], '^[0-9]') THEN '{c.UNIT}' WHEN lower(w) <> w AND i > 1 AND upper(w) <> w THEN '{c.NAME}' ELSE lower(w) END)"""


def _sentence(text: str) -> str:
    return f"array_to_string(regexp_extract_all(lower({text}), '[0-9]+|[\\p{{L}}\\p{{M}}]+'), ' ')"


def _described(table: str, key: str) -> str:
    return f"""SELECT {key}, list_transform(toks, lambda w: CASE WHEN {_START} THEN {_BARE} ELSE w END) AS words, {_TEMPLATE} AS tmpl FROM (SELECT {key}, {_TOKENS} AS toks FROM {table})"""


_PLAIN = f"list_transform(tmpl, lambda t, i: CASE WHEN t = '{c.NAME}' THEN lower(words[i]) ELSE t END)"
CONTAMINATION = f"""WITH items0 AS ({_described("(SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)", "item_id")}),
 items AS (SELECT *, len(tmpl) AS n, CASE WHEN len(tmpl) >= {c.WINDOW} THEN {c.WINDOW} ELSE {c.SHORT_WINDOW} END AS size, {_PLAIN} AS plain FROM items0 WHERE len(tmpl) >= {c.SHORT_WINDOW}),
 starts AS (SELECT item_id, size, n, unnest(range(1, n - size + 2)) AS item_at, tmpl, plain FROM items),
 windows AS (SELECT DISTINCT item_id, size, item_at, array_to_string(form[item_at:item_at + size - 1], ' ') AS w FROM (SELECT *, tmpl AS form FROM starts UNION ALL SELECT *, plain FROM starts)),
 docs AS ({_described("(SELECT doc_id, text FROM documents WHERE text IS NOT NULL)", "doc_id")}),
 doc_windows AS (SELECT DISTINCT doc_id, size, spot, array_to_string(form[spot:spot + size - 1], ' ') AS w FROM (SELECT doc_id, form, size, unnest(range(1, len(form) - size + 2)) AS spot FROM (SELECT doc_id, tmpl AS form FROM docs UNION ALL SELECT doc_id, {_PLAIN} FROM docs), (SELECT DISTINCT size FROM items))),
 hits AS (SELECT d.doc_id, w.item_id, w.size, w.item_at, d.spot - w.item_at AS shift FROM doc_windows d JOIN windows w ON d.w = w.w AND d.size = w.size),
 diagonals AS (SELECT doc_id, item_id, shift, list_sort(list_distinct(flatten(list(range(item_at, item_at + size))))) AS under FROM hits GROUP BY 1, 2, 3),
 long AS (SELECT g.*, i.n, i.words, i.tmpl, d.words AS dwords FROM diagonals g JOIN items i USING (item_id) JOIN docs d USING (doc_id) WHERE len(under) >= least({c.COVERED}, i.n - 1)),
 slotted AS (SELECT doc_id, item_id, n, len(under) AS covered, list_transform(list_filter(under, lambda j: tmpl[j] IN ('{c.NUMBER}', '{c.NAME}', '{c.UNIT}')), lambda j: [tmpl[j], lower(words[j]), lower(dwords[j + shift])]) AS slots FROM long),
 good AS (SELECT *, len(list_filter(slots, lambda s: s[2] <> s[3])) AS changed FROM slotted WHERE len(list_distinct(slots)) = len(list_distinct(list_transform(slots, lambda s: s[1:2])))
 AND len(list_distinct(list_filter(slots, lambda s: s[1] = '{c.NAME}'))) = len(list_distinct(list_transform(list_filter(slots, lambda s: s[1] = '{c.NAME}'), lambda s: s[3]))))
 , sentences AS (SELECT DISTINCT doc_id, {_sentence("s")} AS s FROM (SELECT doc_id, unnest(string_split_regex(text, '[.!?:]+\\s|[.!?:]+$|\\n+')) AS s FROM documents)),
 few AS (SELECT item_id, len(tmpl)::INT AS n, {_sentence("array_to_string(words, ' ')")} AS s FROM items0 WHERE len(tmpl) < {c.SHORT_WINDOW})
 SELECT doc_id, item_id, n AS covered, n AS item_words, 0 AS slots, 0 AS changed_slots FROM sentences JOIN few USING (s) WHERE s <> '' UNION ALL
 SELECT doc_id, item_id, covered::INT AS covered, n::INT AS item_words, len(slots)::INT AS slots, changed::INT AS changed_slots FROM good QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY covered DESC, changed, len(slots) DESC, n DESC) = 1"""

_PAIRS = "list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"
_WORDS = "regexp_extract_all(replace(lower({0}), '_', ' '), '[\\p{{L}}\\p{{N}}]+')"
_BREAKS = "string_split_regex(regexp_replace(text, '([.!?;])\\s+', '\\1' || chr(1), 'g'), chr(1) || '|\\n+')"
_GRAMS = "list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])"
_ENOUGH = "len(list_intersect({0}, t.grams)) >= {1} * len(t.grams) - 1e-6"
LICENCES = f"""WITH templates AS (SELECT licence, body, {_PAIRS} AS grams FROM (SELECT licence, body, {_WORDS.format('body')} AS ws FROM (VALUES {', '.join(f'({quoted(n)}, {quoted(t)})' for n, t in licences.templates_of())}) t(licence, body))),
 whole AS (SELECT doc_id, {_GRAMS} AS seq, {_PAIRS} AS grams FROM (SELECT doc_id, {_WORDS.format('text')} AS ws FROM (SELECT DISTINCT doc_id, text FROM documents))),
 possible AS (SELECT doc_id, licence, t.body, t.grams, seq FROM whole w JOIN templates t ON {_ENOUGH.format('w.grams', licences.THRESHOLD / (2 - licences.THRESHOLD))}),
 held AS (SELECT doc_id, licence, body, len(grams) AS m, grams AS tgrams, unnest(seq) AS g, unnest(range(len(seq))) AS j FROM possible),
 marked AS (SELECT doc_id, licence, body, m, j, list_contains(tgrams, g) AS shared, coalesce(lag(j) OVER same, -1) AS before, coalesce(lead(j) OVER same, 1000000000) AS after FROM held WINDOW same AS (PARTITION BY doc_id, licence, body, g ORDER BY j)),
 grown AS (SELECT a.doc_id, a.licence, a.m, count(*) FILTER (b.before < a.j) OVER run AS n, count(*) FILTER (b.before < a.j AND b.shared) OVER run AS hits
 FROM marked a JOIN marked b ON a.doc_id = b.doc_id AND a.licence = b.licence AND a.body = b.body AND b.j >= a.j AND b.j < a.after WHERE a.shared WINDOW run AS (PARTITION BY a.doc_id, a.licence, a.body, a.j ORDER BY b.j)),
 windows AS (SELECT doc_id, licence, max(2 * hits / (n + m)) AS dice FROM grown GROUP BY 1, 2),
 parts AS (SELECT DISTINCT doc_id, part FROM (SELECT doc_id, text AS part FROM documents UNION ALL SELECT doc_id, unnest(string_split_regex(text, '\\n\\s*\\n')) FROM documents UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents
 UNION ALL SELECT doc_id, unnest({_BREAKS}) FROM documents)), grams AS (SELECT doc_id, {_PAIRS} AS grams FROM (SELECT doc_id, {_WORDS.format('part')} AS ws FROM parts SEMI JOIN possible USING (doc_id))),
 pairs AS (SELECT doc_id, licence, g.grams AS g, t.grams AS t FROM grams g JOIN templates t ON len(g.grams) > 0 AND 2.0 * least(len(g.grams), len(t.grams)) >= {licences.THRESHOLD} * (len(g.grams) + len(t.grams)) - 1e-6),
 scored AS (SELECT doc_id, licence, 2 * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice FROM pairs UNION ALL SELECT doc_id, licence, dice FROM windows),
 best AS (SELECT doc_id, licence, max(dice) AS dice FROM scored WHERE dice >= {licences.THRESHOLD} GROUP BY 1, 2),
 firsts AS (SELECT doc_id, licence, dice, count(*) OVER (PARTITION BY doc_id) AS n FROM best QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, licence) = 1)
 SELECT doc_id, licence, coalesce(dice, 0.0)::DOUBLE AS dice, coalesce(n, 0)::INT AS n_licences FROM documents LEFT JOIN firsts USING (doc_id)"""


def _pseudonyms() -> str:
    """Mail addresses, keys, secrets, hex strings, addresses, phones and cards; RE2 has no look-around, so borders are
    left out, and the other kinds are left to the tests."""
    key = p.KEY
    by = dict(p.PATTERNS)
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "key": by["key"], "secret": by["secret"], "hex": by["hex"], "ip": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}",
        "phone": r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}", "card": "[0-9]{13,19}",
    }
    every = quoted("|".join(f"(?:{x})" for x in kinds.values()))
    kind = "CASE " + " ".join(f"WHEN regexp_full_match(m, {quoted(x)}) THEN '{k}'" for k, x in kinds.items()) + " END"
    luhn = lambda x: f"CAST((10 - list_sum(list_transform(range(0, len({x})), lambda i: CASE WHEN i % 2 = 1 THEN CAST({x}[len({x}) - i] AS INT) WHEN CAST({x}[len({x}) - i] AS INT) > 4 THEN CAST({x}[len({x}) - i] AS INT) * 2 - 9 ELSE CAST({x}[len({x}) - i] AS INT) * 2 END)) % 10) % 10 AS VARCHAR)"
    octet = lambda i: f"CAST(split_part(m, '.', {i}) AS BIGINT)"
    hashed = lambda tag, value, n: f"substr(repeat(sha256('{key}|{tag}|' || {value}) || sha256('{key}|{tag}|2|' || {value}), CAST(ceil({n} / 128.0) AS BIGINT)), 1, {n})"
    rounds = "halves"
    for r in range(p.ROUNDS):
        here, there, size = ("a", "b", "sa") if r % 2 == 0 else ("b", "a", "sb")
        added = f"(CAST({here} AS HUGEINT) + CAST('0x' || substr(sha256('{key}|' || kind || '|' || sa || '|' || sb || '|{r}|' || {there}), 1, 15) AS BIGINT)) % {size}"
        rounds = f"(SELECT * REPLACE (CASE WHEN sa IS NOT NULL THEN CAST({added} AS BIGINT) END AS {here}) FROM {rounds})"
    value = "regexp_extract(m, '([A-Za-z0-9_+/-]+)$', 1)"
    ip = "concat_ws('.', a // 256, a % 256, b // 256, b % 256)"
    made = f"""CASE kind WHEN 'email' THEN 'u' || {hashed('email', 'lower(m)', 12)} || '@' || {hashed('domain', "lower(split_part(m, '@', 2))", 8)} || '.invalid'
 WHEN 'key' THEN 'AKIA' || upper({hashed('key', 'm', 16)}) WHEN 'secret' THEN left(m, len(m) - len({value})) || {hashed('secret', value, f'len({value})')}
 WHEN 'hex' THEN CASE WHEN regexp_matches(m, '[A-F]') THEN upper({hashed('hex', 'lower(m)', 'len(m)')}) ELSE {hashed('hex', 'lower(m)', 'len(m)')} END
 WHEN 'ip' THEN CASE WHEN sa IS NOT NULL THEN {ip} END WHEN 'phone' THEN array_to_string(list_transform(range(1, len(m) + 1), lambda i: CASE WHEN regexp_matches(m[i], '[0-9]') THEN n[len(regexp_replace(substr(m, 1, i), '[^0-9]', '', 'g'))] ELSE m[i] END), '')
 WHEN 'card' THEN CASE WHEN ok THEN n || {luhn('n')} END END"""
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce(regexp_extract_all(text, {every}), []) AS ms, string_split_regex(text, {every}) AS gaps FROM documents),
 found AS (SELECT r, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i FROM docs), typed AS (SELECT *, {kind} AS kind, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM found),
 checked AS (SELECT *, kind = 'card' AND right(d, 1) = {luhn('left(d, len(d) - 1)')} AS ok, CASE kind WHEN 'card' THEN substr(d, 2, len(d) - 2) WHEN 'phone' THEN right(d, 10) END AS body FROM typed),
 halves AS (SELECT *, CASE WHEN kind = 'ip' THEN {octet(1)} * 256 + {octet(2)} WHEN body IS NOT NULL THEN CAST(left(body, len(body) // 2) AS BIGINT) END AS a, CASE WHEN kind = 'ip' THEN {octet(3)} * 256 + {octet(4)} WHEN body IS NOT NULL THEN CAST(substr(body, len(body) // 2 + 1) AS BIGINT) END AS b,
 CASE WHEN kind = 'ip' THEN CASE WHEN greatest({octet(1)}, {octet(2)}, {octet(3)}, {octet(4)}) < 256 THEN 65536 END WHEN body IS NOT NULL THEN CAST(pow(10, len(body) // 2) AS BIGINT) END AS sa, CASE WHEN kind = 'ip' THEN 65536 WHEN body IS NOT NULL THEN CAST(pow(10, len(body) - len(body) // 2) AS BIGINT) END AS sb FROM checked),
 permuted AS (SELECT *, CASE WHEN body IS NOT NULL THEN left(d, CASE kind WHEN 'card' THEN 1 ELSE len(d) - 10 END) || lpad(CAST(a AS VARCHAR), CAST(len(body) // 2 AS INT), '0') || lpad(CAST(b AS VARCHAR), CAST(len(body) - len(body) // 2 AS INT), '0') END AS n FROM {rounds}),
 news AS (SELECT r, i, m, kind, {made} AS new FROM permuted), lists AS (SELECT r, list(coalesce(new, m) ORDER BY i) AS vs, count(new) AS n, list_sort(list_distinct(list(kind) FILTER (new IS NOT NULL))) AS ks FROM news GROUP BY r)
 SELECT doc_id, CASE WHEN vs IS NULL THEN text ELSE array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce(vs[i], '')), '') END AS text, coalesce(n, 0)::INT AS n_replaced, coalesce(array_to_string(ks, ','), '') AS kinds FROM docs LEFT JOIN lists USING (r)"""


PSEUDONYMS = _pseudonyms()


def _key(*parts: str) -> str:
    """32 bits of the MD5 of the parts."""
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8))::BIGINT"


def _keys(name: str, n: str) -> str:
    h = lambda what: _key(str(m.SEED), name, "r", quoted(what))
    return f"""list_transform(range(1, {m.ROUNDS + 1}), lambda r: {{'x': ({h("k")} * {1 << 31} + {h("l")}) % greatest({n}, 1), 'a': {h("a")} % {m.PRIME}, 'b': {h("b")} % {m.PRIME}, 'c': {h("c")} % {m.PRIME}}})"""


def _permuted(x: str, n: str, keys: str) -> str:
    other = f"((k.x - s.x) % {n} + {n}) % {n}"
    most = f"greatest(s.x, {other})"
    bit = f"(({most} // {1 << 31}) * k.a + ({most} % {1 << 31} % {m.PRIME}) * k.b + k.c) % {m.PRIME} > {m.PRIME // 2}"
    return f"list_reduce({keys}, lambda s, k: {{'x': CASE WHEN {bit} THEN {other} ELSE s.x END, 'a': k.a, 'b': k.b, 'c': k.c}}, {{'x': {x}, 'a': 0::BIGINT, 'b': 0::BIGINT, 'c': 0::BIGINT}}).x"


MIXING = f"""WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
ranked AS (SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sizes GROUP BY source),
weighed AS (SELECT *, ({list(m.WEIGHTS)})[sid % {len(m.WEIGHTS)} + 1]::BIGINT AS w FROM ranked),
rest AS (SELECT *, sum(size) OVER () - coalesce(sum({m.MOST} * size) OVER lower, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER lower, 0) AS free FROM weighed
 WINDOW lower AS (ORDER BY size / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
held AS (SELECT *, w * rest > {m.MOST} * size * free AS over FROM rest),
shared AS (SELECT (sum(size) - coalesce(sum({m.MOST} * size) FILTER (over), 0))::DOUBLE AS rest, greatest(sum(w) FILTER (NOT over), 1)::DOUBLE AS free FROM held),
aimed AS (SELECT sid, source, size, CASE WHEN over THEN ({m.MOST} * size)::DOUBLE ELSE w * shared.rest / shared.free END AS target, ceil(size / {m.BLOCK})::BIGINT AS blocks FROM held, shared),
counted AS (SELECT *, CASE WHEN size > 0 THEN floor(target * blocks / size + 0.5) ELSE 0 END::BIGINT AS slots FROM aimed),
sources AS (SELECT *, coalesce(sum(slots) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM counted),
docs AS (SELECT d.doc_id, d.size, s.sid, s.size AS source_size, s.target, coalesce(sum(d.size) OVER (PARTITION BY s.sid
 ORDER BY {_key(str(m.SEED), "d.doc_id", "d.size")} % (SELECT greatest(1, round_even(sqrt(count(*)), 0))::BIGINT FROM sizes), d.doc_id NULLS LAST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
 FROM sizes d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source),
mixed AS (SELECT sum(slots)::BIGINT AS n FROM sources),
drawn AS (SELECT i // {m.SHARD} AS shard, {_permuted("i", "n", "made")} AS spot FROM (SELECT n, {_keys("'mix'", "n")} AS made, unnest(range(n)) AS i FROM mixed)),
counts AS (SELECT shard, sid, count(*) AS n FROM drawn JOIN sources ON first <= spot AND spot < first + slots GROUP BY shard, sid),
runs AS (SELECT sid, n, coalesce(sum(n) OVER (PARTITION BY sid ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo FROM counts),
indexes AS (SELECT sid, unnest(range(lo, lo + n)) AS i FROM runs),
passes AS (SELECT sid, blocks, pass, {_keys("concat_ws('/', sid, pass)", "blocks")} AS made FROM (SELECT sid, blocks, unnest(range((slots - 1) // blocks + 1)) AS pass FROM sources WHERE slots > 0)),
used AS (SELECT sid, block, count(*) AS times FROM (SELECT i.sid, {_permuted("i.i % p.blocks", "p.blocks", "p.made")} AS block FROM indexes i JOIN passes p ON i.sid = p.sid AND i.i // p.blocks = p.pass) GROUP BY ALL),
pieces AS (SELECT *, unnest(range(start // {m.BLOCK}, (start + size - 1) // {m.BLOCK} + 1)) AS block FROM docs WHERE size > 0),
taken AS (SELECT p.sid, p.start, sum((least((p.block + 1) * {m.BLOCK}, p.start + p.size) - greatest(p.block * {m.BLOCK}, p.start)) * u.times) AS taken FROM pieces p JOIN used u ON p.sid = u.sid AND p.block = u.block GROUP BY p.sid, p.start)
SELECT d.doc_id, d.size, d.source_size, d.target, coalesce(t.taken, 0)::BIGINT AS taken FROM docs d LEFT JOIN taken t ON d.sid = t.sid AND d.start = t.start AND d.size > 0"""
