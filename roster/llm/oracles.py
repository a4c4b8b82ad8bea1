"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

# Removed bytes: every window of 100 bytes, as hexadecimal text, with its earlier places.
_REPEATS = """
WITH docs AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS hx, length(hx) // 2 AS n FROM documents
),
windows AS (
  SELECT doc_id, p, substr(hx, 2 * p + 1, 200) AS w
  FROM (SELECT doc_id, hx, unnest(range(greatest(n - 99, 0))) AS p FROM docs)
),
again AS (
  SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1
),
marked AS (
  SELECT doc_id, p, coalesce(p > 100 + lag(p) OVER (PARTITION BY doc_id ORDER BY p), true) AS fresh FROM again
),
numbered AS (
  SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked
),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY ALL),
gaps AS (
  SELECT doc_id, span, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b, b - a AS removed, b AS upto
  FROM (SELECT doc_id, span, a, b FROM spans)
),
parts AS (
  SELECT doc_id, count(*) AS n_spans, max(upto) AS upto,
    string_agg(substr(hx, (2 * a + 1)::BIGINT, (2 * (b - a))::BIGINT), '' ORDER BY a) AS front
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
),
sizes AS (SELECT doc_id, sum(b - a) AS n_removed FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(hx, (2 * coalesce(upto, 0) + 1)::BIGINT))) AS kept_sha256
FROM docs LEFT JOIN parts USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

# Sets of shingles, all pairs that share one, and the smallest id that links reach.
def _similar(words: int, percent: int, more: str = "") -> str:
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * pairs.n >= {percent} * (x.n + y.n - pairs.n)
),
reached AS (
  SELECT a, b FROM links
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id{more}
FROM documents LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reached GROUP BY a) USING (doc_id)"""


def _tree(text: str) -> str:
    """Hashes of sentences by paragraph; a sentence ends before the white space behind its stop."""
    sentences = f"regexp_replace(line, '([.!?])([ \\t\\n\\x0B\\f\\r])', '\\1' || chr(57344) || '\\2', 'g')"
    leaves = f"array_to_string(list_transform(string_split({sentences}, chr(57344)), lambda s: md5(s)), '.')"
    paragraphs = f"array_to_string(list_transform(string_split({text}, chr(10)), lambda line: {leaves}), '/')"
    return f"regexp_replace({paragraphs}, '([01])/', '\\1|', 'g')"


def _print(tree: str) -> str:
    section = "array_to_string(list_transform(string_split(section, '/'), lambda p: sha256(p)), '/')"
    root = f"sha256(array_to_string(list_transform(string_split({tree}, '|'), lambda section: sha256({section})), '|'))"
    return f"{root} || ':' || regexp_replace({tree}, '([0-9a-f]{{16}})[0-9a-f]{{16}}', '\\1', 'g')"


def _likeness(a: str, b: str) -> str:
    leaves = [f"list_distinct(string_split_regex(split_part({x}, ':', 2), '[./|]'))" for x in (a, b)]
    common = f"len(list_intersect({leaves[0]}, {leaves[1]}))"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * {common} / (len({leaves[0]}) + len({leaves[1]})) END"


_FINGERPRINTS = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents
),
following AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM docs
),
edited AS (
  SELECT *, left(text, n_chars - n_chars // 2) || left(next_text, n_chars // 2) AS edited FROM following
),
trees AS (
  SELECT *, {_tree("text")} AS t, {_tree("edited")} AS e, {_tree("next_text")} AS x FROM edited
),
prints AS (
  SELECT *, {_print("t")} AS fingerprint, {_print("e")} AS edited_fingerprint, {_print("x")} AS next_fingerprint FROM trees
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
  {_likeness("fingerprint", "edited_fingerprint")} AS near_edited,
  {_likeness("fingerprint", "next_fingerprint")} AS near_next
FROM prints"""

# CRC-32 of ASCII texts, from its table.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"""

_STATE = "STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR)"


def _edit(state: str, cost: str, letter: str, line: str = "''", when: str = "true") -> str:
    """A state after one more edit; nothing where there is no such state."""
    more = f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'lines': {state}.lines || {line}}}"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {more}::{_STATE} END"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"chr(10) || '{role}:'")


def _stay(state: str, role: str) -> str:
    """A turn that becomes one of ``role``: kept if it has the initial, else reroled."""
    kept = _edit(state, "(fault = 'truncated')::INT", "K", "chr(10) || role || ':' || text", f"stays AND left(role, 1) = '{role[0]}'")
    if role == "system":
        return kept
    line = f"chr(10) || '{role}:' || text"
    reroled = _edit(state, "(fault = 'truncated')::INT + 2", "R", line, f"stays AND left(role, 1) <> '{role[0]}'")
    return f"coalesce({kept}, {reroled})"


_CONVERSATIONS = f"""
WITH RECURSIVE constants AS (SELECT {_CRC_TABLE} AS crc_table),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM (SELECT *, {_CRC} % 20 AS kind FROM keyed, constants) WHERE kind <> 0
),
placed AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM damaged
),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS wrong,
    fault NOT IN ('blank', 'duplicate') AS stays
  FROM placed
),
steps AS (
  SELECT conv_id, 0::BIGINT AS k, {{'cost': 0, 'audit': '', 'lines': ''}}::{_STATE} AS e, NULL::{_STATE} AS s,
    {{'cost': 2, 'audit': 'I', 'lines': chr(10) || 'user:'}}::{_STATE} AS u,
    {{'cost': 4, 'audit': 'II', 'lines': chr(10) || 'user:' || chr(10) || 'assistant:'}}::{_STATE} AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, k, e, s, u, {_least("a0", _insert("u", "assistant"))} AS a
  FROM (
    SELECT conv_id, k, e, s, a0, {_least("u0", _insert("e", "user"), _insert("s", "user"), _insert("a0", "user"))} AS u
    FROM (
      SELECT steps.conv_id, faulty.k, {_edit("e", "3", "D")} AS e, {_least(_edit("s", "3", "D"), _stay("e", "system"))} AS s,
        {_least(_edit("u", "3", "D"), *[_stay(x, "user") for x in ("e", "s", "a")])} AS u0,
        {_least(_edit("a", "3", "D"), _stay("u", "assistant"))} AS a0
      FROM steps JOIN faulty ON faulty.conv_id IS NOT DISTINCT FROM steps.conv_id AND faulty.k = steps.k + 1
    )
  )
),
ends AS (
  SELECT conv_id, {_least("e", "a")} AS best FROM steps
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
    count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated, count_if(wrong) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT ends.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  best.cost AS cost, best.audit AS audit, sha256(substr(best.lines, 2)) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id"""

ORACLES = {
    "op1_suffix_dedup": _REPEATS,
    "op4_jaccard_join": _similar(4, 85),
    "op9_fingerprints": _FINGERPRINTS,
    "op12_conversation_repair": _CONVERSATIONS,
    "op13_minhash_dedup": _similar(2, 80, ", doc_id = component_id AS kept"),
}
