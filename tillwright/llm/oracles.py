"""SQL texts that DuckDB runs on the same tables, for the operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
dp AS (
  SELECT r, l, w, unnest(range(1, len(w) - l + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT l FROM iw) WHERE len(w) >= l
),
dw AS (SELECT r, l, i, array_to_string(list_slice(w, i, i + l - 1), ' ') AS win FROM dp),
hit AS (SELECT r, l, i, item_id FROM dw JOIN iw USING (l, win)),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

LINE_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
h AS (
  SELECT r, doc_id, w, list_transform(w, lambda x: CAST('0x' || substr(md5(x), 1, 8) AS BIGINT)) AS h FROM d
),
c AS (
  SELECT r, doc_id, w, list_concat([[0]], list_transform(
    list_filter(range(1, len(w)), lambda i: ((h[i] % 2147483647) * 1000003 + h[i + 1]) % 2147483647 % 2 = 0), lambda i: [i])
  ) AS c FROM h
),
cuts AS (
  SELECT r, doc_id, w, list_reduce(c, lambda a, x: CASE WHEN x[1] - a[-1] >= 2 THEN list_concat(a, x) ELSE a END) AS c FROM c
),
chunks AS (
  SELECT r, doc_id, c[k] AS pos, coalesce(c[k + 1], len(w)) - c[k] AS n,
    array_to_string(list_slice(w, c[k] + 1, coalesce(c[k + 1], len(w))), chr(10)) AS chunk
  FROM (SELECT *, unnest(range(1, len(c) + 1)) AS k FROM cuts)
),
firsts AS (
  SELECT chunk, min(struct_pack(doc_id := doc_id, pos := pos)) AS first FROM chunks
  WHERE n >= 2 AND length(replace(replace(chunk, chr(10), ''), ' ', '')) > 0 GROUP BY chunk
),
kept AS (
  SELECT r, n, pos, chunks.chunk,
    n < 2 OR first IS NULL OR first IS NOT DISTINCT FROM struct_pack(doc_id := doc_id, pos := pos) AS stays
  FROM chunks LEFT JOIN firsts USING (chunk)
),
texts AS (
  SELECT r, sum(n) AS n_lines, coalesce(sum(n) FILTER (NOT stays), 0) AS n_removed,
    coalesce(string_agg(chunk, chr(10) ORDER BY pos) FILTER (stays), '') AS text
  FROM kept GROUP BY r
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, length(text) AS n_chars,
  sha256(text) AS text_sha256
FROM d JOIN texts USING (r)
"""

_COUNTS = {
    "words@1": r"[^\x20\x09-\x0D]+",
    "pieces@1": r"[A-Za-z]+|[0-9]{1,3}|[^\x00-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]",
}

# Where all documents have come to: what is left, shortened, moved and restored.
TOKEN_COUNTS = f"""
WITH d AS (SELECT source, lang, coalesce(text, '') AS text, length(coalesce(text, '')) AS size FROM documents),
e AS (
  SELECT CASE WHEN size % 10 = 3 THEN source || '-moved' ELSE source END AS source, lang,
    CASE WHEN size % 10 = 2 THEN substr(text, 1, CAST(floor(size / 2) AS BIGINT)) ELSE text END AS text
  FROM d WHERE size % 10 <> 1 OR size % 20 = 1
),
n AS (
  {" UNION ALL ".join(
    f"SELECT source, lang, '{name}' AS tokenizer, len(regexp_extract_all(text, '{pattern}')) AS n FROM e"
    for name, pattern in _COUNTS.items()
  )}
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM n GROUP BY source, lang, tokenizer
"""

CHAT = """
WITH m AS (
  SELECT DISTINCT conv_id, turn, role, text, coalesce(text, '') AS t, length(coalesce(text, '')) AS size FROM conversations
),
calls AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, size, turn % 8 >= 2 AS needs,
    CASE size % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'note' END AS name, t
  FROM m WHERE role = 'user'
),
results AS (
  SELECT conv_id, 'call_' || conv_id || '_' || (turn - 1) AS call_id, turn, text AS content FROM m WHERE role = 'assistant'
),
linked AS (
  SELECT c.*, r.call_id IS NOT NULL AS answered, r.content, p.call_id IS NOT NULL AS known,
    '"after":["call_' || c.conv_id || '_' || (c.turn - 2) || '"]' AS after
  FROM calls c LEFT JOIN results r USING (conv_id, call_id)
  LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2
),
args AS (
  SELECT *, '{' || array_to_string(list_filter(CASE name
      WHEN 'search' THEN [CASE WHEN needs THEN after END, '"limit":' || (size % 50), '"query":' || to_json(t)]
      WHEN 'lookup' THEN [CASE WHEN needs THEN after END,
        CASE WHEN size % 5 <> 0 THEN '"key":' || to_json(split_part(t, ' ', 1)) END, '"strict":true']
      ELSE [CASE WHEN needs THEN after END, CASE WHEN size % 7 = 0 THEN '"draft":true' END, '"text":' || to_json(t)]
    END, lambda x: x IS NOT NULL), ',') || '}' AS arguments,
    list_sort(list_filter([
      CASE WHEN name = 'search' AND size % 50 NOT BETWEEN 1 AND 40 THEN 'limit:out_of_range' END,
      CASE WHEN name = 'lookup' AND size % 5 = 0 THEN 'key:missing' END,
      CASE WHEN name = 'note' AND size % 7 = 0 THEN 'draft:unknown' END,
      CASE WHEN NOT answered THEN 'no_result' END,
      CASE WHEN needs AND NOT known THEN 'unknown_dependency' END
    ], lambda x: x IS NOT NULL)) AS errors
  FROM linked
),
rows AS (
  SELECT conv_id, call_id, turn, name, arguments, errors, content,
    CASE WHEN NOT (needs AND known) THEN 0
      WHEN NOT (SELECT b.needs AND b.known FROM linked b WHERE b.conv_id = args.conv_id AND b.turn = args.turn - 2) THEN 1
      WHEN NOT (SELECT b.needs AND b.known FROM linked b WHERE b.conv_id = args.conv_id AND b.turn = args.turn - 4) THEN 2
      ELSE 3 END AS level
  FROM args
  UNION ALL
  SELECT conv_id, call_id, turn, NULL, NULL, ['no_call'], content, NULL
  FROM results ANTI JOIN calls USING (conv_id, call_id)
)
SELECT conv_id, call_id, turn, CAST(level AS INTEGER) AS level, len(errors) = 0 AS valid,
  array_to_string(errors, ',') AS errors,
  '{"arguments":' || coalesce(arguments, 'null') || ',"errors":' || CAST(to_json(errors) AS VARCHAR) || ',"id":'
    || coalesce(CAST(to_json(call_id) AS VARCHAR), 'null') || ',"name":' || coalesce(CAST(to_json(name) AS VARCHAR), 'null')
    || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS json
FROM rows
"""

JACCARD_JOIN = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT r, doc_id, list_distinct(list_transform(
    range(1, greatest(len(w) - 3, least(len(w), 1)) + 1), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')
  )) AS s FROM d
),
n AS (SELECT r, doc_id, len(s) AS n FROM s),
sets AS (SELECT list_sort(s) AS s, min(r) AS g, any_value(len(s)) AS n FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
member AS (SELECT r, g FROM s JOIN sets ON list_sort(s.s) = sets.s),
one AS (SELECT g, n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.g AS a, b.g AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM one a JOIN one b ON a.x = b.x AND a.g < b.g AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.g, b.g
),
linked AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (
  SELECT g, g AS h FROM sets
  UNION
  SELECT reach.g, both_ways.b FROM reach JOIN both_ways ON reach.h = both_ways.a
),
least_doc AS (SELECT g, min(doc_id) AS doc_id FROM member JOIN d USING (r) GROUP BY g),
component AS (SELECT reach.g, min(doc_id) AS component_id FROM reach JOIN least_doc ON reach.h = least_doc.g GROUP BY reach.g)
SELECT n.doc_id, n.n AS n_shingles, CASE WHEN member.g IS NULL THEN n.doc_id ELSE component_id END AS component_id
FROM n LEFT JOIN member USING (r) LEFT JOIN component USING (g)
"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, half a byte at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    digit = lambda at: f"strpos('0123456789ABCDEF', substr(hex(encode({text})), CAST({at} AS BIGINT), 1)) - 1"
    # each byte, then a zero: two steps of four bits
    halves = (
        f"list_transform(range(0, 2 * octet_length(encode({text}))), "
        f"lambda k: CASE WHEN k % 2 = 0 THEN 16 * ({digit('k + 1')}) + {digit('k + 2')} ELSE 0 END)"
    )
    step = f"lambda c, v: xor(CAST({table} AS BIGINT[])[(xor(c, v) & 15) + 1], xor(c, v) >> 4)"
    steps = f"list_concat([CAST(4294967295 AS BIGINT)], CAST({halves} AS BIGINT[]))"
    return f"xor(list_reduce({steps}, {step}), CAST(4294967295 AS BIGINT))"


SPELLING_VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{_UPPER}', '{_UPPER.lower()}') AS run
  FROM documents
),
counted AS (SELECT id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY id, run),
hashed AS (SELECT run, c, {_crc32("id || ':' || run")} AS h FROM counted),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
  FROM hashed
),
vocabulary AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
),
deleted AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM vocabulary)
),
near AS (
  SELECT a.word, b.word AS other FROM deleted a JOIN deleted b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, rest FROM deleted WHERE rest IN (SELECT word FROM vocabulary)
  UNION SELECT rest, word FROM deleted WHERE rest IN (SELECT word FROM vocabulary)
),
best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY v.n DESC, other) AS other
  FROM near JOIN vocabulary v ON v.word = other GROUP BY near.word
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN f.n >= 5 * w.n THEN other END AS form,
    CASE WHEN f.n >= 5 * w.n THEN f.n END AS form_n
  FROM vocabulary w LEFT JOIN best USING (word) LEFT JOIN vocabulary f ON f.word = best.other
),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT chain.word, form FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NOT NULL
)
SELECT forms.word, forms.form, chain.root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN chain ON chain.word = forms.word JOIN forms ends ON ends.word = chain.root WHERE ends.form IS NULL
"""


def _repair() -> str:
    """Best edits from the last row to the first, for each state (0 nothing yet, 1 after s, 2 after u, 3 after a).

    A value is the cost in six digits and the edits' initials, so that the least text is the cheapest.
    """

    def plus(value: str, cost: str, edit: str) -> str:
        return f"(lpad(CAST(CAST(substr({value}, 1, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || '{edit}' || substr({value}, 7))"

    following = {0: 2, 1: 2, 2: 3, 3: 2}
    edited = []
    for p in range(4):
        kept = [plus(f"f{p}", "4", "D")]
        for initial, states, to in (("s", (0,), 1), ("u", (0, 1, 3), 2), ("a", (2,), 3)):
            if p in states:
                kept.append(f"CASE WHEN stays AND left(role, 1) = '{initial}' THEN {plus(f'f{to}', 'cut', 'K')} END")
                if initial != "s":
                    kept.append(f"CASE WHEN stays THEN {plus(f'f{to}', 'cut + 3', 'R')} END")
        edited.append(f"least({', '.join(kept)}) AS b{p}")
    closed = []
    for p in range(4):
        once, twice = f"b{following[p]}", f"b{following[following[p]]}"
        closed.append(f"least(b{p}, {plus(once, '3', 'I')}, {plus(plus(twice, '3', 'I'), '3', 'I')}) AS f{p}")
    return f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM raw WHERE fault <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM damaged
),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'sound' END AS kind,
    coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) NOT IN ('su', 'ua', 'au'), FALSE) AS breaks
  FROM placed
),
edits AS (
  SELECT *, kind NOT IN ('blank', 'duplicate') AS stays, CASE WHEN kind = 'truncated' THEN 3 ELSE 0 END AS cut FROM judged
),
counted AS (
  SELECT conv_id, max(pos) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
    count(*) FILTER (kind = 'truncated') AS truncated, count(*) FILTER (breaks) AS illegal
  FROM judged GROUP BY conv_id
),
ahead AS (
  SELECT conv_id, size + 1 AS pos, '000000' AS f0, '000006II' AS f1, '000003I' AS f2, '000000' AS f3 FROM counted
  UNION ALL
  SELECT conv_id, pos, {", ".join(closed)} FROM (
    SELECT ahead.conv_id, ahead.pos - 1 AS pos, {", ".join(edited)}
    FROM ahead JOIN edits ON edits.conv_id IS NOT DISTINCT FROM ahead.conv_id AND edits.pos = ahead.pos - 1
  )
),
least_cost AS (SELECT conv_id, CAST(substr(f0, 1, 6) AS BIGINT) AS cost, substr(f0, 7) AS audit FROM ahead WHERE pos = 1),
walk AS (
  SELECT conv_id, audit, 0 AS k, 0 AS pos, '' AS before, '' AS text, 0 AS rows FROM least_cost
  UNION ALL
  SELECT conv_id, audit, k + 1, pos + CASE WHEN edit = 'I' THEN 0 ELSE 1 END, CASE WHEN edit = 'D' THEN before ELSE left(now, 1) END,
    CASE WHEN edit = 'D' THEN text ELSE text || CASE WHEN rows > 0 THEN chr(10) ELSE '' END || now || ':' || own END,
    rows + CASE WHEN edit = 'D' THEN 0 ELSE 1 END
  FROM (
    SELECT walk.*, substr(audit, k + 1, 1) AS edit, CASE WHEN substr(audit, k + 1, 1) = 'I' THEN '' ELSE edits.text END AS own,
      CASE WHEN substr(audit, k + 1, 1) = 'K' THEN role WHEN before = 'u' THEN 'assistant' ELSE 'user' END AS now
    FROM walk LEFT JOIN edits ON edits.conv_id IS NOT DISTINCT FROM walk.conv_id AND edits.pos = walk.pos + 1
    WHERE k < length(audit)
  )
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(least_cost.audit, '') AS audit, sha256(coalesce(walk.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN least_cost ON least_cost.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM c.conv_id AND k = length(walk.audit)
"""


CONVERSATION_REPAIR = _repair()
