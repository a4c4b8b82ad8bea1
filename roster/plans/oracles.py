"""The queries again as SQL, for an independent check with DuckDB."""

from roster.plans.queries import MESSAGE

# The 29 code points of white space.
_POINTS = """9 10 11 12 13 28 29 30 31 32 133 160 5760 8192 8193 8194 8195 8196 8197 8198 8199 8200 8201 8202
8232 8233 8239 8287 12288""".split()
_SPACES = " || ".join(f"chr({point})" for point in _POINTS)
_GAP = "[,." + "".join(rf"\x{{{int(point):x}}}" for point in _POINTS) + "]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _clean(c: str) -> str:
    cell = f"trim(coalesce({c}, ''), {_SPACES})"
    return (
        f"CASE WHEN starts_with({cell}, '=\"') AND ends_with({cell}, '\"')"
        f" THEN substr({cell}, 3, greatest(length({cell}) - 3, 0)) ELSE {cell} END"
    )


def _name_part(c: str) -> str:
    return f"trim(regexp_replace({_clean(c)}, '{_GAP}', ' ', 'g'))"


def _joined(*parts: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({p}, '')" for p in parts) + ")"


def _tel(c: str) -> str:
    digits = f"regexp_replace(coalesce({c}, ''), '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN {digits} = '' THEN '' WHEN length({digits}) = 10"
        f" THEN 'tel:+1' || {digits} ELSE 'tel:+' || {digits} END"
    )


_FULL_NAME = _joined(_name_part("first_name"), _name_part("middle_name"), _name_part("last_name"))
_ADDRESS = _joined(*[_clean(c) for c in ("addr1", "addr2", "city", "state", "zip")])

_RAW = """
raw AS (
  SELECT o_orderkey AS ordinal, o_orderdate AS odate,
    '="' || o_orderkey || '"' AS license_number,
    'Customer.' AS first_name,
    CASE WHEN o_custkey % 3 = 0 THEN '' ELSE '  J.,  Q ' END AS middle_name,
    substr(c_name, 10) AS last_name,
    '="' || o_custkey || '"' AS npn_number,
    ' ' || lower(o_orderpriority) AS license_desc,
    CASE WHEN o_custkey % 7 = 0 THEN '' WHEN o_custkey % 11 = 0 THEN NULL
         ELSE 'c' || o_custkey || '@example.com' END AS email,
    CASE o_custkey % 4 WHEN 0 THEN '(305) 555-0123' WHEN 1 THEN '+1 305 555 0123' WHEN 2 THEN 'n/a' END AS phone,
    (o_custkey % 900) || ' Main St' AS addr1,
    CASE WHEN o_custkey % 2 = 0 THEN 'APT 3' ELSE '' END AS addr2,
    lower(n_name) AS city,
    CASE o_orderstatus WHEN 'F' THEN ' fl ' WHEN 'P' THEN '="FL"' ELSE 'GA' END AS state,
    '="33101"' AS zip
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_CITIES = """
cities AS (
  SELECT n_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AFRICA'
  UNION
  SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA'
)"""

_KEPT = f"""
kept AS (
  SELECT * FROM raw
  WHERE upper({_clean("state")}) = 'FL'
    AND upper({_clean("city")}) IN (SELECT city FROM cities)
    AND upper({_clean("license_desc")}) IN ('1-URGENT', '2-HIGH')
)"""

_NORMALISED = f"""
normalised AS (
  SELECT nullif({_clean("license_number")}, '') AS license_number,
    nullif({_FULL_NAME}, '') AS full_name,
    nullif({_clean("npn_number")}, '') AS npn_number,
    nullif(upper({_clean("license_desc")}), '') AS license_type,
    nullif({_clean("email")}, '') AS business_email,
    nullif({_clean("phone")}, '') AS business_phone,
    nullif({_ADDRESS}, '') AS mailing_address,
    CAST(NULL AS VARCHAR) AS personal_email,
    false AS checked,
    ordinal, odate
  FROM kept
)"""

_COLUMNS = """license_number, full_name, npn_number, license_type, business_email, business_phone,
    mailing_address, checked, personal_email"""

_LICENCES = f"""
licences AS (
  SELECT ordinal AS id, * EXCLUDE (checked, ordinal, odate), ordinal % 3 = 0 AS checked FROM normalised
)"""

_EDITED = """
edited AS (
  SELECT * REPLACE (CASE WHEN business_email IS NULL AND id % 2 = 0 THEN '' ELSE business_email END
    AS business_email) FROM licences
)"""

_OLD = """
old AS (SELECT * FROM edited WHERE id IN (SELECT ordinal FROM raw WHERE odate < DATE '1997-01-01'))"""


def _first(name: str, source: str, order: str, keys: str = "full_name, business_email") -> str:
    return (
        f"\n{name} AS (SELECT * FROM {source} QUALIFY row_number() OVER"
        f" (PARTITION BY {keys} ORDER BY {order}) = 1)"
    )


_BATCH = _first("batch", "(SELECT * FROM normalised WHERE odate >= DATE '1997-01-01')", "ordinal")

_FRESH = """
fresh AS (
  SELECT b.* FROM batch b WHERE NOT EXISTS (
    SELECT 1 FROM old t WHERE coalesce(t.full_name, '') = coalesce(b.full_name, '')
      AND coalesce(t.business_email, '') = coalesce(b.business_email, ''))
)"""

_LOADED = f"""
loaded AS (
  SELECT id, {_COLUMNS} FROM old
  UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY ordinal) AS id, {_COLUMNS}
  FROM fresh
)"""

# Two loads into an empty table: identities of the first drop in its order, then the others.
_TWO_LOADS = f"""
first_drop AS (
  SELECT *, 1 AS drop_no FROM normalised WHERE odate < DATE '1997-01-01'
  QUALIFY row_number() OVER (PARTITION BY full_name, business_email ORDER BY ordinal) = 1
),
second_drop AS (
  SELECT *, 2 AS drop_no FROM (
    SELECT * FROM normalised WHERE odate >= DATE '1997-01-01'
    QUALIFY row_number() OVER (PARTITION BY full_name, business_email ORDER BY ordinal) = 1) s
  WHERE NOT EXISTS (SELECT 1 FROM first_drop f WHERE f.full_name IS NOT DISTINCT FROM s.full_name
    AND f.business_email IS NOT DISTINCT FROM s.business_email)
)
SELECT row_number() OVER (ORDER BY drop_no, ordinal) AS id, {_COLUMNS}
FROM (SELECT * FROM first_drop UNION ALL SELECT * FROM second_drop)"""

_OPEN = """
open_rows AS (
  SELECT id, full_name, business_email FROM {source}
  WHERE NOT checked AND business_email IS NOT NULL AND business_email <> ''
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _open(source: str) -> str:
    return _OPEN.format(source=source)


_TO_NORMALISED = (_RAW, _CITIES, _KEPT, _NORMALISED)
_TO_LICENCES = (*_TO_NORMALISED, _LICENCES)
_TO_EDITED = (*_TO_LICENCES, _EDITED)
_TO_FRESH = (*_TO_EDITED, _OLD, _BATCH, _FRESH)
_TO_OPEN = (*_TO_LICENCES, _open("licences"))


def _page(status: str, page: int) -> str:
    """The page, clamped; size 50."""
    return f"""
shown AS (SELECT * FROM licences WHERE {status}),
page AS (SELECT least({page}, greatest(1, (count(*) + 49) // 50)) AS page FROM shown)
SELECT {_COLUMNS}, {_tel("business_phone")} AS phone_href
FROM (SELECT *, row_number() OVER (ORDER BY id) AS place FROM shown), page
WHERE place > (page - 1) * 50 AND place <= page * 50"""


def _outbox(source: str, delay: float) -> str:
    template = _text(MESSAGE["template"])
    name = f"coalesce(nullif(full_name, ''), {_text(MESSAGE['nameless'])})"
    return f"""
SELECT id, {_text(MESSAGE["sender"])} AS from_addr, business_email AS to_addr,
  {_text(MESSAGE["subject"])} AS subject, replace({template}, '{{name}}', {name}) AS body,
  CAST((row_number() OVER (ORDER BY id) - 1) * {delay} AS DOUBLE) AS offset_seconds
FROM {source}"""


_CELLS = """license_number first_name middle_name last_name npn_number license_desc email phone addr1 addr2 city
state zip""".split()
_BATCH_ROWS = "license_number, full_name, npn_number, license_type, business_email, business_phone, mailing_address, personal_email, checked"

ORACLES: dict[str, str] = {
    "raw_registry": _with(_RAW) + " SELECT * FROM raw",
    "registry_roundtrip": _with(_RAW)
    + """ SELECT row_number() OVER (ORDER BY ordinal) AS place, * EXCLUDE (ordinal, odate)
      REPLACE (nullif(middle_name, '') AS middle_name, nullif(email, '') AS email, nullif(addr2, '') AS addr2)
      FROM raw""",
    "clean_cells": _with(_RAW)
    + " SELECT ordinal, "
    + ", ".join(
        f"{_clean(c)} AS {c}"
        for c in _CELLS
    )
    + " FROM raw",
    "clean_documents": f"SELECT doc_id, {_clean('text')} AS cell, {_name_part('text')} AS name_part,"
    f" {_tel('text')} AS tel FROM documents",
    "full_name": _with(_RAW) + f" SELECT ordinal, {_FULL_NAME} AS full_name FROM raw",
    "mailing_address": _with(_RAW) + f" SELECT ordinal, {_ADDRESS} AS mailing_address FROM raw",
    "city_union": _with(_CITIES) + " SELECT city FROM cities",
    "filter_target": _with(_RAW, _CITIES, _KEPT) + " SELECT * FROM kept",
    "normalise_registry": _with(*_TO_NORMALISED) + f" SELECT {_BATCH_ROWS}, ordinal FROM normalised",
    "scan_metrics": _with(_RAW, _CITIES, _KEPT)
    + " SELECT (SELECT count(*) FROM raw) AS rows_read, (SELECT count(*) FROM kept) AS rows_matched",
    "dedupe_batch": _with(*_TO_NORMALISED, _first("staged", "normalised", "ordinal"))
    + f" SELECT {_BATCH_ROWS}, ordinal FROM staged",
    "first_events": "SELECT * FROM events QUALIFY row_number() OVER"
    " (PARTITION BY user_id, event_type ORDER BY event_id) = 1",
    "insert_new": _with(*_TO_FRESH) + f" SELECT {_BATCH_ROWS}, ordinal FROM fresh",
    "load_result": _with(*_TO_FRESH, _LOADED) + " SELECT * FROM loaded",
    "load_report": _with(*_TO_FRESH, _LOADED)
    + """ SELECT (SELECT count(*) FROM old) AS rows_before, (SELECT count(*) FROM loaded) AS rows_after,
      (SELECT count(*) FROM fresh) AS rows_added""",
    "stored_load": _with(*_TO_NORMALISED, _TWO_LOADS),
    "repair_duplicates": _with(*_TO_EDITED)
    + f""" SELECT id, {_COLUMNS} FROM edited WHERE id IN
      (SELECT min(id) FROM edited GROUP BY full_name, business_email)""",
    "duplicate_ids": _with(*_TO_EDITED)
    + """ SELECT id FROM edited WHERE id NOT IN
      (SELECT min(id) FROM edited GROUP BY full_name, business_email)""",
    "status_tallies": _with(*_TO_LICENCES)
    + """ SELECT count(*) AS count_all, count(*) FILTER (WHERE checked) AS count_checked,
      count(*) FILTER (WHERE NOT checked) AS count_unchecked FROM licences""",
    "status_filter": _with(*_TO_LICENCES) + f" SELECT id, {_COLUMNS} FROM licences WHERE NOT checked",
    "status_page": _with(*_TO_LICENCES, _page("NOT checked", 2)),
    "status_page_last": _with(*_TO_LICENCES, _page("checked", 999999999)),
    "page_info": _with(*_TO_LICENCES)
    + """ SELECT count(*) AS total, greatest(1, (count(*) + 49) // 50) AS total_pages,
      least(3, greatest(1, (count(*) + 49) // 50)) AS page FROM licences WHERE checked""",
    "tel_link": _with(_RAW) + f" SELECT ordinal, {_tel('phone')} AS tel FROM raw",
    "outreach_candidates": _with(*_TO_EDITED, _open("edited")) + " SELECT * FROM open_rows ORDER BY id LIMIT 5",
    "outreach_candidates_wide": _with(*_TO_EDITED, _open("edited"))
    + " SELECT * FROM open_rows ORDER BY id LIMIT 100",
    "outreach_candidates_resumed": _with(*_TO_OPEN)
    + " SELECT * FROM open_rows WHERE id % 5 = 0 ",
    "outbox": _with(*_TO_OPEN) + _outbox("(SELECT * FROM open_rows ORDER BY id LIMIT 20)", 8.0),
    "outbox_wide": _with(*_TO_OPEN) + _outbox("open_rows", 5.0),
    "mark_checked": _with(*_TO_OPEN)
    + f""" SELECT id, {_COLUMNS.replace("checked", "checked OR id IN (SELECT id FROM open_rows WHERE id % 5 <> 0) AS checked")}
      FROM licences""",
    "outreach_summary": _with(*_TO_OPEN)
    + """ SELECT count(*) AS candidates, count(*) FILTER (WHERE id % 5 <> 0) AS sent,
      count(*) FILTER (WHERE id % 5 = 0) AS failed FROM open_rows""",
    "snapshot_roundtrip": _with(*_TO_LICENCES) + f" SELECT id, {_COLUMNS} FROM licences",
    "export_candidates": _with(*_TO_OPEN) + " SELECT * FROM open_rows",
}
ORACLES["csv_roundtrip"] = _with(*_TO_NORMALISED, _first("staged", "normalised", "ordinal")) + (
    f" SELECT {_BATCH_ROWS} FROM staged"
)
ORACLES["missing_columns"] = _with(_RAW) + " SELECT " + ", ".join(
    f"CASE WHEN odate < DATE '1997-01-01' THEN NULL ELSE nullif({c}, '') END AS {c}"
    if c in ("email", "city")
    else f"nullif({c}, '') AS {c}"
    for c in _CELLS
) + " FROM raw"
ORACLES["staged_count"] = _with(*_TO_NORMALISED) + """ SELECT count(*) AS rows_staged FROM
  (SELECT DISTINCT full_name, business_email FROM normalised)"""
ORACLES["load_counts"] = _with(*_TO_NORMALISED) + """,
numbers AS (
  SELECT (SELECT count(*) FROM raw WHERE odate < DATE '1997-01-01') AS read_1,
    (SELECT count(*) FROM raw WHERE odate >= DATE '1997-01-01') AS read_2,
    (SELECT count(*) FROM normalised WHERE odate < DATE '1997-01-01') AS matched_1,
    (SELECT count(*) FROM normalised WHERE odate >= DATE '1997-01-01') AS matched_2,
    (SELECT count(*) FROM (SELECT DISTINCT full_name, business_email FROM normalised WHERE odate < DATE '1997-01-01')) AS staged_1,
    (SELECT count(*) FROM (SELECT DISTINCT full_name, business_email FROM normalised WHERE odate >= DATE '1997-01-01')) AS staged_2,
    (SELECT count(*) FROM (SELECT DISTINCT full_name, business_email FROM normalised)) AS people
)
SELECT 0 AS place, read_1 AS rows_read, matched_1 AS rows_matched, staged_1 AS rows_staged, 0 AS rows_before,
  staged_1 AS rows_after, staged_1 AS rows_added FROM numbers
UNION ALL
SELECT unnest([1, 2]), read_2, matched_2, staged_2, staged_1, people, people - staged_1 FROM numbers"""
ORACLES["staff_edits"] = _with(*_TO_LICENCES) + f""" SELECT id,
  {_COLUMNS.replace("checked, personal_email", "CASE WHEN id % 8 = 0 THEN false WHEN id % 4 = 0 THEN true ELSE checked END AS checked")},
  CASE WHEN id % 8 = 0 AND id % 5 = 0 THEN 'second@example.com' WHEN id % 12 = 0 THEN 'first' || id
    ELSE personal_email END AS personal_email
FROM licences"""
ORACLES["status_page_marked"] = _with(
    *_TO_LICENCES,
    _open("licences"),
    """
marked AS (SELECT * REPLACE (checked OR id IN (SELECT id FROM open_rows WHERE id % 5 <> 0) AS checked) FROM licences)""",
    _page("checked", 3).replace("FROM licences", "FROM marked"),
)
ORACLES["stored_repair"] = ORACLES["repair_duplicates"]
# Three drops: the second and third are newer, the first comes last.
ORACLES["stream_load"] = _with(*_TO_NORMALISED) + f"""
SELECT row_number() OVER (ORDER BY drop_no, ordinal) AS id, {_COLUMNS} FROM (
  SELECT *, CASE WHEN odate < DATE '1993-01-01' THEN 3 WHEN odate < DATE '1997-01-01' THEN 1 ELSE 2 END AS drop_no
  FROM normalised
  QUALIFY row_number() OVER (PARTITION BY full_name, business_email ORDER BY drop_no, ordinal) = 1)"""
ORACLES["registry_multiline"] = ORACLES["registry_roundtrip"].replace(
    "REPLACE (",
    """REPLACE (CASE WHEN ordinal % 3 = 0 THEN addr1 || chr(10) || '"Suite", 2' || chr(10) || chr(10) || ordinal ELSE addr1 END AS addr1, """,
)
ORACLES["rejected_records"] = _with(_RAW) + ''',
numbered AS (
  SELECT ordinal % 10 AS kind, '"=""' || ordinal || '"""' AS number, last_name AS name, coalesce(email, '') AS email FROM raw
),
faulty AS (
  SELECT CASE kind WHEN 1 THEN 'short' WHEN 2 THEN 'long' ELSE 'badly_quoted' END AS fault,
    CASE kind WHEN 1 THEN 2 WHEN 2 THEN 5 ELSE 3 END AS cells,
    CASE kind WHEN 1 THEN number || ',' || name WHEN 2 THEN number || ',' || name || ',' || email || ',x,"y,z"'
      ELSE number || ',"' || name || '"tail,' || email END AS record
  FROM numbered WHERE kind IN (1, 2, 3)
)
SELECT *, count(*) FILTER (WHERE fault = 'short') OVER () AS rows_short, count(*) FILTER (WHERE fault = 'long') OVER () AS rows_long,
  count(*) FILTER (WHERE fault = 'badly_quoted') OVER () AS rows_badly_quoted
FROM faulty'''
ORACLES["insert_new_indexed"] = ORACLES["insert_new"]
ORACLES["insert_new_bucketed"] = ORACLES["insert_new"]
ORACLES["repair_incremental"] = ORACLES["repair_duplicates"]
ORACLES["stored_repair_bucketed"] = ORACLES["repair_duplicates"]
ORACLES["snapshot_incremental"] = ORACLES["snapshot_roundtrip"]
ORACLES["mark_checked_stream"] = ORACLES["mark_checked"]
# Of every person the first row, with the status that edits and the send log leave; sent to were all but every fifth candidate.
_CHANGED = """
changed AS (
  SELECT * REPLACE ((CASE WHEN id % 8 = 0 THEN false WHEN id % 4 = 0 THEN true ELSE checked END)
    OR id IN (SELECT id FROM open_rows WHERE id % 5 <> 0) AS checked,
    CASE WHEN id % 8 = 0 AND id % 5 = 0 THEN 'second@example.com' WHEN id % 12 = 0 THEN 'first' || id ELSE personal_email END AS personal_email)
  FROM licences QUALIFY row_number() OVER (PARTITION BY full_name, business_email ORDER BY id) = 1
)"""
ORACLES["tallies_maintained"] = _with(*_TO_OPEN, _CHANGED) + """ SELECT count(*) AS count_all,
  count(*) FILTER (WHERE checked) AS count_checked, count(*) FILTER (WHERE NOT checked) AS count_unchecked FROM changed"""
ORACLES["status_page_indexed"] = _with(*_TO_OPEN, _CHANGED, _page("checked", 3).replace("FROM licences", "FROM changed"))
ORACLES["stream_progress"] = _with(*_TO_NORMALISED) + """,
numbered AS (SELECT (odate < DATE '1993-01-01')::BIGINT AS batch_id, * FROM raw),
matched AS (SELECT (odate < DATE '1993-01-01')::BIGINT AS batch_id, * FROM normalised),
added AS (SELECT min(batch_id) AS batch_id FROM matched GROUP BY full_name, business_email)
SELECT b.batch_id, 2 - b.batch_id AS drops, true AS has_files,
  (SELECT count(*) FROM numbered n WHERE n.batch_id = b.batch_id) AS rows_read,
  (SELECT count(*) FROM matched m WHERE m.batch_id = b.batch_id) AS rows_matched,
  (SELECT count(*) FROM added a WHERE a.batch_id = b.batch_id) AS rows_added
FROM (SELECT unnest([0::BIGINT, 1::BIGINT]) AS batch_id) b"""
