"""SQL equivalents of the queries, written from the source columns rather than the operators.

The texts run on any engine with the given tables registered as views.
"""

from __future__ import annotations

import json

from pagetally import fixed
from pagetally.operators.scoring import RUBRIC

ORACLES: dict[str, str] = {}

EDUCATION = """
CASE WHEN o_orderpriority = '1-URGENT' THEN 'Doctoral or professional degree'
     WHEN o_orderpriority = '2-HIGH' THEN 'Master''s degree'
     WHEN o_orderpriority = '3-MEDIUM' THEN 'Bachelor''s degree'
     WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'Associate''s degree'
     WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 'Some college, no degree'
     WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Postsecondary nondegree award'
     WHEN o_orderstatus = 'F' THEN 'No formal educational credential'
     WHEN o_orderstatus = 'O' THEN 'High school diploma or equivalent'
     ELSE 'See How to Become One' END"""

REC = f"""
WITH lines AS (
  SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS jobs FROM lineitem GROUP BY l_orderkey),
rec AS (
  SELECT o_orderkey AS ord, 'Order ' || o_orderkey AS title, CAST(o_orderkey AS VARCHAR) AS slug,
         o_orderstatus AS category,
         CASE WHEN o_totalprice >= 5000 THEN CAST(floor(o_totalprice) AS BIGINT) END AS pay,
         jobs,
         CASE WHEN o_custkey % 31 <> 0 THEN o_custkey % 65 - 15 END AS outlook,
         {EDUCATION} AS education,
         CASE WHEN o_custkey % 13 <> 0 THEN o_orderkey % 11 + CASE WHEN o_custkey % 17 = 0
             AND o_orderkey % 11 < 10 THEN 0.5::DOUBLE ELSE 0 END END AS exposure,
         o_orderpriority || '|' || o_orderstatus || chr(10) || o_custkey AS rationale
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey)
"""


def _values(rows) -> str:
    def shown(cell):
        if cell is None:
            return "NULL"
        return "'" + cell.replace("'", "''") + "'" if isinstance(cell, str) else str(cell)
    return ", ".join("(" + ", ".join(shown(cell) for cell in row) + ")" for row in rows)


TIERS = _values((i, *tier) for i, tier in enumerate(fixed.TIERS))
BANDS = _values((i, *band) for i, band in enumerate(fixed.PAY_BANDS))
GROUPS = _values((i, name, member) for i, (name, members) in enumerate(fixed.EDUCATION_GROUPS)
                 for member in members)
SHORT = _values(fixed.EDUCATION_SHORT.items())


def magnitude(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN '?' WHEN {x} >= 1000000 THEN printf('%.1fM', {x} / 1e6) "
            f"WHEN {x} >= 1000 THEN printf('%.0fK', {x} / 1e3) ELSE CAST({x} AS VARCHAR) END")


def money(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '?' ELSE '$' || format('{{:,}}', {x}) END"


def signed(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '?' ELSE printf('%+d%%', {x}) END"


MEAN = "coalesce(CAST(sum(exposure * jobs) FILTER (WHERE exposure IS NOT NULL AND jobs <> 0) AS DOUBLE)" \
       " / sum(jobs) FILTER (WHERE exposure IS NOT NULL AND jobs <> 0), 0.0)"

# --- report aggregates --------------------------------------------------------------------

ORACLES["headline"] = REC + f"""
SELECT count(*) AS n, CAST(coalesce(sum(jobs), 0) AS BIGINT) AS jobs,
       CAST(coalesce(sum(jobs * pay), 0) AS BIGINT) AS wages,
       round({MEAN}, 6) AS mean_exposure
FROM rec"""

TIER_TABLE = f"""
tiers(ord, name, lo, hi) AS (VALUES {TIERS}),
totals AS (SELECT sum(jobs) AS all_jobs, sum(jobs * pay) AS all_wages FROM rec),
tiered AS (
  SELECT t.ord, t.name, count(r.ord) AS n, CAST(coalesce(sum(jobs), 0) AS BIGINT) AS jobs,
         CAST(coalesce(sum(jobs * pay), 0) AS BIGINT) AS wages
  FROM tiers t LEFT JOIN rec r ON r.exposure BETWEEN t.lo AND t.hi GROUP BY t.ord, t.name)
"""
ORACLES["tier_summary"] = REC + "," + TIER_TABLE + """
SELECT ord, name, n, jobs, round(jobs / all_jobs::DOUBLE * 100, 6) AS jobs_share, wages,
       round(wages / all_wages::DOUBLE * 100, 6) AS wages_share,
       CASE WHEN jobs = 0 THEN 0 ELSE wages // jobs END AS avg_pay
FROM tiered, totals"""

BAND_TABLE = f"""
bands(ord, name, lo, hi) AS (VALUES {BANDS}),
banded AS (
  SELECT b.ord, b.name, sum(exposure * jobs)::DOUBLE / sum(jobs) AS mean_exposure,
         CAST(sum(jobs) AS BIGINT) AS jobs
  FROM rec r JOIN bands b ON r.pay >= b.lo AND (b.hi IS NULL OR r.pay < b.hi)
  WHERE pay <> 0 AND jobs <> 0 AND exposure IS NOT NULL GROUP BY b.ord, b.name)
"""
ORACLES["band_means"] = REC + "," + BAND_TABLE + """
SELECT ord, name, round(mean_exposure, 6) AS mean_exposure, jobs FROM banded"""

GROUP_TABLE = f"""
grps(ord, name, member) AS (VALUES {GROUPS}),
grouped AS (
  SELECT g.ord, g.name, sum(exposure * jobs)::DOUBLE / sum(jobs) AS mean_exposure,
         CAST(sum(jobs) AS BIGINT) AS jobs
  FROM rec r JOIN grps g ON r.education = g.member
  WHERE jobs <> 0 AND exposure IS NOT NULL GROUP BY g.ord, g.name)
"""
ORACLES["group_means"] = REC + "," + GROUP_TABLE + """
SELECT ord, name, round(mean_exposure, 6) AS mean_exposure, jobs FROM grouped"""

ORACLES["band_join"] = REC + f""", bands(ord, name, lo, hi) AS (VALUES {BANDS})
SELECT r.ord, b.ord AS band_ord, b.name AS band
FROM rec r JOIN bands b ON r.pay >= b.lo AND (b.hi IS NULL OR r.pay < b.hi)"""

ORACLES["group_join"] = REC + f""", grps(ord, name, member) AS (VALUES {GROUPS})
SELECT r.ord, g.ord AS group_ord, g.name AS group_name
FROM rec r JOIN grps g ON r.education = g.member"""

RECORD_ORDER = "coalesce(exposure, 0) DESC, coalesce(jobs, 0) DESC, ord"
for _name, _test, _order in (("movers_down", "outlook < 0", "outlook"),
                             ("movers_up", "outlook >= 10", "outlook DESC")):
    ORACLES[_name] = REC + f"""
SELECT row_number() OVER (ORDER BY {_order}, {RECORD_ORDER}) AS n, title, exposure, outlook,
       {signed('outlook')} AS outlook_text, {magnitude('jobs')} AS jobs_text
FROM rec WHERE {_test}"""

ORACLES["rating_groups"] = REC + """
SELECT CAST(exposure AS INTEGER) AS exposure, count(*) AS n,
       CAST(coalesce(sum(jobs), 0) AS BIGINT) AS jobs
FROM rec WHERE exposure BETWEEN 0 AND 10 AND exposure = floor(exposure) GROUP BY 1"""

LISTING = f"""
short(name, brief) AS (VALUES {SHORT}),
listing AS (
  SELECT CAST(exposure AS INTEGER) AS exposure,
         row_number() OVER (PARTITION BY exposure ORDER BY coalesce(jobs, 0) DESC, ord) AS n,
         title, {money('pay')} AS pay_text, {magnitude('jobs')} AS jobs_text,
         {signed('outlook')} AS outlook_text, coalesce(brief, education, '?') AS education_text,
         replace(replace(rationale, '|', '/'), chr(10), ' ') AS rationale
  FROM rec LEFT JOIN short ON name = education
  WHERE exposure BETWEEN 0 AND 10 AND exposure = floor(exposure))
"""
ORACLES["rating_listing"] = REC + "," + LISTING + "SELECT * FROM listing"

ORACLES["histogram"] = REC + """
SELECT exposure, count(*) AS n, repeat('█', count(*)) AS bar
FROM rec WHERE exposure IS NOT NULL GROUP BY exposure"""

ORACLES["mean_rating"] = REC + """
SELECT count(exposure) AS n, round(avg(exposure), 6) AS mean FROM rec"""

# --- report text --------------------------------------------------------------------------

_HEADINGS = [
    (0, ["# {title}", ""]),
    (1, ["## Aggregate statistics", ""]),
    (2, [fixed.HEADINGS["tiers"], "",
         "| Tier | Occupations | Jobs | % of jobs | Wages | % of wages | Avg pay |",
         "|------|-------------|------|-----------|-------|------------|---------|"]),
    (3, [fixed.HEADINGS["bands"], "", "| Pay band | Avg exposure | Jobs |",
         "|----------|-------------|------|"]),
    (4, [fixed.HEADINGS["groups"], "", "| Education | Avg exposure | Jobs |",
         "|-----------|-------------|------|"]),
    (5, [fixed.HEADINGS["down"], "", "| Occupation | Exposure | Outlook | Jobs |",
         "|-----------|----------|---------|------|"]),
    (6, [fixed.HEADINGS["up"], "", "| Occupation | Exposure | Outlook | Jobs |",
         "|-----------|----------|---------|------|"]),
]
LAST = 2 ** 62


def _heading_rows(title: str) -> str:
    rows = [(section, row, line.format(title=title))
            for section, lines in _HEADINGS for row, line in enumerate(lines)]
    rows += [(section, LAST, "") for section in range(1, 7)]
    return "SELECT CAST(a AS INTEGER) AS section, CAST(b AS BIGINT) AS row, c AS line FROM (VALUES " \
        + _values(rows) + ") v(a, b, c)"


SUMMARY = f"""
t AS (SELECT count(*) AS n, sum(jobs) AS jobs, sum(jobs * pay) AS wages, {MEAN} AS mean FROM rec),
summary AS (
  SELECT 1 AS section, CAST(100 AS BIGINT) AS row, '- Total occupations: ' || n AS line FROM t
  UNION ALL SELECT 1, 101, '- Total jobs: ' || format('{{:,}}', jobs) || printf(' (%.0fM)', jobs / 1e6) FROM t
  UNION ALL SELECT 1, 102, printf('- Total annual wages: $%.1fT', wages / 1e12) FROM t
  UNION ALL SELECT 1, 103, printf('- Job-weighted average AI exposure: %.1f/10', mean) FROM t
  UNION ALL SELECT 2, 100 + ord, '| ' || name || ' | ' || n || ' | ' || {magnitude('jobs')} || ' | '
    || printf('%.1f%%', jobs / all_jobs::DOUBLE * 100) || ' | ' || printf('$%.1fT', wages / 1e12)
    || ' | ' || printf('%.1f%%', wages / all_wages::DOUBLE * 100) || ' | '
    || {money('(CASE WHEN jobs = 0 THEN 0 ELSE wages // jobs END)')} || ' |' FROM tiered, totals
  UNION ALL SELECT 3, 100 + ord, '| ' || name || ' | ' || printf('%.1f', mean_exposure) || ' | '
    || {magnitude('jobs')} || ' |' FROM banded
  UNION ALL SELECT 4, 100 + ord, '| ' || name || ' | ' || printf('%.1f', mean_exposure) || ' | '
    || {magnitude('jobs')} || ' |' FROM grouped
  UNION ALL SELECT 7, 100, '## All ' || n || ' occupations' FROM t
  UNION ALL SELECT 7, 101, '' FROM t
  UNION ALL SELECT 7, 102, '{fixed.HEADINGS['order']}' FROM t
  UNION ALL SELECT 7, 103, '' FROM t)
"""

HEADS = f"""
heads AS (
  SELECT 18 - CAST(exposure AS INTEGER) AS section, CAST(exposure AS INTEGER) AS e, count(*) AS n,
         CAST(coalesce(sum(jobs), 0) AS BIGINT) AS jobs
  FROM rec WHERE exposure BETWEEN 0 AND 10 AND exposure = floor(exposure) GROUP BY exposure),
listed AS (
  SELECT section, CAST(0 AS BIGINT) AS row, '### Exposure ' || e || '/10 (' || n || ' occupations, '
         || {magnitude('jobs')} || ' jobs)' AS line FROM heads
  UNION ALL SELECT section, 1, '' FROM heads
  UNION ALL SELECT section, 2, '| # | Occupation | Pay | Jobs | Outlook | Education | Rationale |' FROM heads
  UNION ALL SELECT section, 3, '|---|-----------|-----|------|---------|-----------|-----------|' FROM heads
  UNION ALL SELECT section, {LAST}, '' FROM heads
  UNION ALL SELECT 18 - exposure, 100 + n, '| ' || n || ' | ' || title || ' | ' || pay_text || ' | '
    || jobs_text || ' | ' || outlook_text || ' | ' || education_text || ' | ' || rationale || ' |'
  FROM listing)
"""

_PARTS = REC + "," + ",".join([TIER_TABLE, BAND_TABLE, GROUP_TABLE, LISTING, SUMMARY, HEADS])


def _mover_lines(section: int, test: str, order: str) -> str:
    return f"""
SELECT {section}, 100 + row_number() OVER (ORDER BY {order}, {RECORD_ORDER}),
       '| ' || title || ' | ' || coalesce(CASE WHEN exposure = floor(exposure) THEN CAST(CAST(exposure AS BIGINT) AS VARCHAR)
            ELSE CAST(exposure AS VARCHAR) END, '?') || '/10 | '
       || {signed('outlook')} || ' | ' || {magnitude('jobs')} || ' |'
FROM rec WHERE {test}"""


ORACLES["report_lines"] = _PARTS + f"""
{_heading_rows(fixed.HEADINGS['title'])}
UNION ALL SELECT * FROM summary
UNION ALL {_mover_lines(5, 'outlook < 0', 'outlook')}
UNION ALL {_mover_lines(6, 'outlook >= 10', 'outlook DESC')}
UNION ALL SELECT * FROM listed"""

ORACLES["report_text"] = _PARTS + f"""
, everything AS ({_heading_rows('Report')} UNION ALL SELECT * FROM summary)
SELECT section, string_agg(line, chr(10) ORDER BY row) AS text
FROM everything WHERE section < 5 GROUP BY section"""

_whole = ORACLES["report_lines"]
_start = _whole.rindex(_PARTS) + len(_PARTS)
ORACLES["report_file"] = f"""{_PARTS}
SELECT row_number() OVER (ORDER BY section, row) AS n, line FROM ({_whole[_start:]})"""

# --- joins and keyed rows -----------------------------------------------------------------------

ORACLES["build_compact"] = """
SELECT source || ' ' || d.doc_id AS title, CAST(d.doc_id AS VARCHAR) AS slug, lang AS category,
       n_chars AS pay, CASE WHEN source <> 'src3' THEN n_chars END AS jobs,
       CASE WHEN n_chars <= 500 THEN CAST(-3 AS BIGINT) END AS outlook, source AS outlook_desc,
       lang AS education, CAST(quality * 7 + toxic * 3 AS DOUBLE) AS exposure,
       'quality ' || quality AS exposure_rationale,
       'https://example.com/d/' || d.doc_id AS url
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

ORACLES["build_records"] = """
WITH scores AS (
  SELECT user_id, arg_max(CAST(floor(value) AS BIGINT) % 11, event_id) AS exposure,
         arg_max(event_type, event_id) AS rationale
  FROM events GROUP BY user_id)
SELECT o_orderkey AS ord, 'Order ' || o_orderkey AS title, CAST(o_custkey AS VARCHAR) AS slug,
       CASE WHEN c_custkey IS NULL THEN o_orderstatus WHEN c_mktsegment = 'BUILDING' THEN ''
            ELSE c_mktsegment END AS category,
       CAST(floor(c_acctbal) AS BIGINT) AS pay,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS BIGINT) END AS jobs,
       CAST(-c_nationkey AS BIGINT) AS outlook, coalesce(c_name, '') AS outlook_desc,
       coalesce(c_mktsegment, '') AS education, exposure, coalesce(rationale, '') AS rationale,
       o_orderpriority AS url
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN scores ON o_custkey = user_id"""

DOCUMENT_MASTER = """
SELECT doc_id AS ord, CAST(doc_id AS VARCHAR) AS slug, source || ' ' || doc_id AS title,
       lang AS category, 'https://example.com/d/' || doc_id AS url FROM documents"""
ORACLES["with_corpus"] = DOCUMENT_MASTER + " WHERE doc_id IN (SELECT doc_id FROM labels)"
ORACLES["without_corpus"] = DOCUMENT_MASTER + " WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
ORACLES["pending"] = ORACLES["without_corpus"]

ORACLES["first_wins"] = """
SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type,
       arg_min(value, event_id) AS value FROM events GROUP BY user_id"""
ORACLES["last_wins"] = """
SELECT user_id, min(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       arg_max(value, event_id) AS value FROM events GROUP BY user_id"""

ORACLES["upsert"] = """
SELECT CAST(d.doc_id AS VARCHAR) AS slug,
       CAST(quality * 7 + toxic * 3 AS DOUBLE) AS exposure,
       CASE WHEN l.doc_id IS NULL THEN source || ' ' || d.doc_id END AS note
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

ORACLES["merge_on_read"] = ORACLES["upsert"]
ORACLES["resolve_aliases"] = """
WITH seen AS (
  SELECT p_name AS title, '/' || replace(p_name, ' ', '-') AS url, min(p_partkey) AS ord
  FROM part WHERE p_type <> 'LARGE' GROUP BY p_name)
SELECT url, title, ord, row_number() OVER (ORDER BY lower(title), ord) AS n FROM seen"""
ORACLES["index_to_master"] = """
WITH seen AS (
  SELECT p_name AS title, '/' || replace(p_name, ' ', '-') AS url, min(p_partkey) AS ord
  FROM part WHERE p_type <> 'LARGE' GROUP BY p_name)
SELECT row_number() OVER (ORDER BY lower(title), ord) - 1 AS ord, title, url FROM seen"""
ORACLES["index_to_aliases"] = """
SELECT p_brand AS alias, p_name AS canonical, '/' || replace(p_name, ' ', '-') AS url
FROM part WHERE p_type = 'PROMO'"""
ORACLES["alias_entries"] = """
SELECT p_partkey AS ord, p_brand AS alias, p_name AS canonical,
       '/' || replace(p_name, ' ', '-') AS url
FROM part WHERE p_type = 'PROMO'"""

# --- order, slices, samples ---------------------------------------------------------------------

_PART = "SELECT p_partkey AS ord, p_name, p_size"
ORACLES["slice_rows"] = _PART + " FROM part WHERE p_partkey >= 25 AND p_partkey < 175"
ORACLES["slice_from_end"] = _PART + """
FROM part, (SELECT count(*) AS n FROM part) WHERE p_partkey >= n - 150 AND p_partkey < n - 25"""
ORACLES["head_tail"] = """
(SELECT p_partkey AS ord, p_name, p_size, 'head' AS part FROM part ORDER BY p_partkey LIMIT 20)
UNION ALL
(SELECT p_partkey AS ord, p_name, p_size, 'tail' AS part FROM part ORDER BY p_partkey DESC LIMIT 10)"""

ORACLES["with_defaults"] = """
SELECT doc_id AS ord, source || ' ' || doc_id AS title, lang AS category, CAST(doc_id AS VARCHAR) AS slug,
       '' AS soc_code, CAST(n_chars AS VARCHAR) AS median_pay_annual, '' AS median_pay_hourly,
       lang AS entry_education, '' AS work_experience, '' AS training,
       CASE WHEN source = 'src3' THEN '' ELSE CAST(n_chars AS VARCHAR) END AS num_jobs_2024,
       '' AS projected_employment_2034, CASE WHEN n_chars > 500 THEN 'See page' ELSE '-3' END AS outlook_pct,
       CASE WHEN source = 'src3' THEN '' ELSE source END AS outlook_desc, '' AS employment_change,
       'https://example.com/d/' || doc_id AS url
FROM documents"""

# --- text and number rules --------------------------------------------------------------------------

SPACE = (r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
         r"\x{205f}\x{3000}]+")


def clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


ORACLES["clean_text"] = f"SELECT doc_id, {clean('text')} AS clean FROM documents"
ORACLES["document_sizes"] = """
SELECT doc_id, length(text) AS chars, strlen(text) AS bytes,
       CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines FROM documents"""

ORACLES["parse_pay"] = """
WITH o AS (
  SELECT o_orderkey, o_orderpriority AS p, CAST(floor(o_totalprice) AS BIGINT) AS annual,
         CAST(floor(o_totalprice) AS BIGINT) % 20000 + 700 AS cents FROM orders)
SELECT o_orderkey,
       CASE WHEN p IN ('1-URGENT', '3-MEDIUM', '5-LOW') THEN CAST(annual AS VARCHAR) ELSE '' END AS annual,
       CASE WHEN p IN ('1-URGENT', '2-HIGH', '5-LOW')
            THEN (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') ELSE '' END AS hourly
FROM o"""

ORACLES["parse_outlook"] = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey % 65 - 15 AS VARCHAR) END AS pct,
       CASE o_orderstatus WHEN 'F' THEN 'Change (see note ' || o_orderpriority || ')' WHEN 'O' THEN ''
            ELSE 'About ' || (o_custkey % 65 - 15) || ' to 70%' END AS outlook_desc
FROM orders"""

ORACLES["parse_number"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'See ' || o_orderpriority
       ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) - 9000 AS VARCHAR) END AS number
FROM orders"""

ORACLES["impute_pay"] = """
WITH o AS (
  SELECT o_orderkey, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS pay,
         (o_custkey % 180 + 7) || '.' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS hour
  FROM orders)
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN printf('%.0f', CAST(hour AS DOUBLE) * 2080)
            ELSE CAST(pay AS VARCHAR) END AS annual,
       CASE WHEN o_orderstatus = 'P' THEN hour ELSE printf('%.2f', pay / 2080.0::DOUBLE) END AS hourly
FROM o"""

ORACLES["fmt_money"] = REC + f"SELECT ord, {money('pay')} AS pay_text FROM rec"
ORACLES["fmt_magnitude"] = REC + f"""
SELECT ord, {magnitude('pay')} AS pay_size, {magnitude('(jobs * (pay // 100) * 50)')} AS wage_size
FROM rec"""
ORACLES["fmt_signed"] = REC + f"SELECT ord, {signed('outlook')} AS outlook_text FROM rec"

_TYPED = """
WITH e AS (
  SELECT event_id, nullif(event_type, 'error') AS title, user_id AS jobs, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS exposure, value AS hourly
  FROM events)
"""
ORACLES["typed_records"] = _TYPED + """
SELECT event_id, title, jobs, exposure, hourly FROM e
WHERE event_type NOT IN ('error', 'click') AND exposure <= 80"""
ORACLES["rejected_records"] = _TYPED + """
SELECT event_id, concat_ws('; ',
         CASE WHEN event_type = 'error' THEN 'title is missing' END,
         CASE WHEN event_type = 'click' THEN 'jobs is no valid number' END,
         CASE WHEN exposure > 80 THEN 'exposure is out of range' END) AS problems
FROM e WHERE event_type IN ('error', 'click') OR exposure > 80"""

# --- replies and ratings ---------------------------------------------------------------------------------

_REPLY = """
WITH e AS (
  SELECT event_id, event_type, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events),
r AS (SELECT *, '{"exposure": ' || k || ', "rationale": "' || event_type || '", "user": ' || user_id || '}' AS body
      FROM e)
"""
ORACLES["strip_fence"] = _REPLY + """
SELECT event_id, CASE event_type WHEN 'view' THEN body WHEN 'click' THEN body
       WHEN 'purchase' THEN body || ' trailing' WHEN 'error' THEN '{"exposure": "' || k || '"}' END AS body
FROM r"""
ORACLES["parse_reply"] = _REPLY + """
SELECT event_id,
       CASE WHEN event_type IN ('view', 'click') THEN 'scored' ELSE 'failed' END AS status,
       CASE event_type WHEN 'purchase' THEN 'not one JSON object' WHEN 'error' THEN 'exposure is no number'
            WHEN 'signup' THEN 'no reply body' END AS reason,
       CASE WHEN event_type IN ('view', 'click') THEN CAST(k AS DOUBLE) END AS exposure,
       CASE WHEN event_type IN ('view', 'click') THEN event_type END AS rationale,
       CASE WHEN event_type IN ('view', 'click') THEN '{"user":' || user_id || '}' END AS extras
FROM r"""

_RUBRIC = json.dumps(RUBRIC).replace("'", "''")
ORACLES["score_requests"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS slug,
       '{{"model":"example/model","messages":[{{"role":"system","content":{_RUBRIC}}},{{"role":"user","content":'
       || CAST(to_json(text) AS VARCHAR) || '}}],"temperature":0.2}}' AS request
FROM documents"""
ORACLES["score_table"] = """
SELECT CAST(doc_id AS VARCHAR) AS slug,
       '{"exposure": ' || (length(text) % 11) || ', "rationale": "' || length(text) || ' characters"}' AS reply
FROM documents WHERE text <> ''"""
ORACLES["score_documents"] = """
SELECT CAST(doc_id AS VARCHAR) AS slug, CASE WHEN length(text) % 7 <> 0 THEN
       '{"exposure": ' || (length(text) % 11) || ', "rationale": "' || length(text) || ' characters"}' END AS reply,
       CASE WHEN length(text) % 7 = 0 THEN 'refused' END AS error
FROM documents WHERE text <> ''"""
ORACLES["score_incremental"] = """
SELECT CAST(d.doc_id AS VARCHAR) AS slug,
       CASE WHEN l.doc_id IS NULL THEN source || ' ' || d.doc_id ELSE 'old' END AS title,
       CASE WHEN l.doc_id IS NULL THEN CAST(length(text) % 11 AS DOUBLE)
            ELSE CAST(quality * 7 + toxic * 3 AS DOUBLE) END AS exposure,
       CASE WHEN l.doc_id IS NULL THEN length(text) || ' characters' ELSE 'quality ' || quality END AS rationale,
       CAST(NULL AS VARCHAR) AS extras
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NOT NULL OR text <> ''"""
ORACLES["scoring_stats"] = """
SELECT CASE WHEN l.doc_id IS NOT NULL THEN 'cached' WHEN text <> '' THEN 'scored' ELSE 'no_input' END AS status,
       count(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1"""

# --- steps and state -----------------------------------------------------------------------------------------

ORACLES["run_stats"] = """
SELECT CASE WHEN length(text) <= 100 THEN 'missing' WHEN l.doc_id IS NOT NULL THEN 'cached'
            ELSE 'processed' END AS status, count(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1"""
ORACLES["run_incremental"] = f"""
SELECT CAST(d.doc_id AS VARCHAR) AS slug,
       CASE WHEN l.doc_id IS NOT NULL THEN 'quality ' || quality ELSE {clean('text')} END AS text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

ORACLES["run_into"] = ORACLES["run_incremental"]
ORACLES["checkpoint_save"] = """
SELECT DISTINCT event_type AS step, CAST(user_id AS VARCHAR) AS slug FROM events WHERE event_type <> 'view'
UNION ALL SELECT DISTINCT 'view', CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase'"""
ORACLES["checkpoint_load"] = """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS slug FROM events WHERE event_type = 'purchase'"""
ORACLES["checkpoint_completed"] = """
SELECT CAST(c_custkey AS VARCHAR) AS slug, c_name FROM customer
WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'click')"""
ORACLES["checkpoint_summary"] = """
SELECT event_type AS step, count(DISTINCT user_id) AS completed
FROM (SELECT event_type, user_id FROM events WHERE event_type <> 'view'
      UNION ALL SELECT 'view', user_id FROM events WHERE event_type = 'purchase') GROUP BY 1"""
ORACLES["checkpoint_clear"] = f"""
SELECT * FROM ({ORACLES['checkpoint_summary']}) WHERE step <> 'click'"""

# --- pages -----------------------------------------------------------------------------------------------------

ORACLES["html_nodes"] = r"""
WITH bare AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '<script>.*?</script>', '<script>', 'gs'),
                                 '<!--.*?-->', '', 'gs') AS html FROM pages),
tags AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM bare)
SELECT page_id, tag, count(*) AS n FROM tags GROUP BY page_id, tag"""


def unescape(x: str) -> str:
    """Named entities as browsers read them: the closing semicolon may be missing."""
    for entity, mark in (("&quot", '"'), ("&middot", "·"), ("&copy", "©"), ("&lt", "<"),
                         ("&gt", ">"), ("&amp", "&")):
        x = f"regexp_replace({x}, '{entity};?', '{mark}', 'g')"
    return x


_H1 = clean(unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')"))
ORACLES["page_header"] = f"""
SELECT page_id, {_H1} AS title, CAST(NULL AS VARCHAR) AS canonical FROM pages"""
ORACLES["page_markdown"] = f"""
SELECT page_id, '# ' || {_H1} || chr(10) AS text FROM pages"""
ORACLES["index_entries"] = f"""
WITH nav AS (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS box FROM pages),
items AS (
  SELECT page_id, unnest(regexp_extract_all(box, '<li>(.*?)</li>', 1)) AS item,
         generate_subscripts(regexp_extract_all(box, '<li>(.*?)</li>', 1), 1) - 1 AS entry FROM nav)
SELECT page_id, CAST(entry AS INTEGER) AS entry, {unescape("regexp_extract(item, '>([^<]*)</a>', 1)")} AS names,
       {unescape("regexp_extract(item, 'href=.([^>]*).>', 1)")} AS hrefs,
       {unescape("regexp_extract(item, '>([^<]*)</a>', 1)")} AS text
FROM items"""

_ORDER_FACTS = f"""
WITH o AS (
  SELECT *, CAST(o_orderkey AS VARCHAR) AS slug, CAST(floor(o_totalprice) AS BIGINT) AS price,
         o_custkey % 65 - 15 AS pct, {EDUCATION} AS education,
         (CAST(floor(o_totalprice) AS BIGINT) % 150 + 7) || '.'
           || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') AS rate
  FROM orders),
w AS (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN pct || '% (Change (see note ' || o_orderpriority || '))'
                 WHEN 'O' THEN pct || '%' ELSE 'About ' || pct || ' to 70%' END AS outlook_text,
         CASE WHEN o_orderstatus = 'F' THEN CAST(price AS VARCHAR)
              ELSE printf('%.0f', CAST(rate AS DOUBLE) * 2080) END AS annual,
         CASE WHEN o_orderstatus = 'F' THEN printf('%.2f', price / 2080.0::DOUBLE) ELSE rate END AS hourly,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(pct AS VARCHAR) END AS outlook_pct,
         CASE o_orderstatus WHEN 'F' THEN 'Change (see note ' || o_orderpriority || ')' WHEN 'O' THEN ''
              ELSE 'About ' || pct || ' to 70%' END AS outlook_desc,
         CASE WHEN o_custkey = 0 THEN '-0' ELSE CAST(-7 * o_custkey AS VARCHAR) END AS change_text,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE '15-' || o_custkey END AS soc,
         CAST(o_custkey * 1000 AS VARCHAR) AS projected
  FROM o)
"""
ORACLES["facts"] = _ORDER_FACTS + """
SELECT slug, 0 AS at, '2024 Median Pay' AS field,
       CASE WHEN o_orderstatus = 'F' THEN '$' || format('{:,}', price) || ' per year'
            ELSE '$' || rate || ' per hour' END AS value FROM w
UNION ALL SELECT slug, 1, 'Typical entry-level education', education FROM w
UNION ALL SELECT slug, 2, 'Work experience in a related occupation', 'None & none' FROM w
UNION ALL SELECT slug, 3, 'On-the-job Training', o_orderpriority FROM w
UNION ALL SELECT slug, 4, 'Number of Jobs, 2024', format('{:,}', price) FROM w
UNION ALL SELECT slug, 5, 'Job Outlook, 2024-34', outlook_text FROM w
UNION ALL SELECT slug, 6, 'Employment Change, 2024-34', '-' || format('{:,}', 7 * o_custkey) FROM w"""
_WIDE = """slug, annual AS median_pay_annual, hourly AS median_pay_hourly, education AS entry_education,
       'None & none' AS work_experience, o_orderpriority AS training,
       CAST(price AS VARCHAR) AS num_jobs_2024, outlook_pct, outlook_desc,
       change_text AS employment_change"""
ORACLES["facts_to_wide"] = _ORDER_FACTS + f"SELECT {_WIDE} FROM w"
ORACLES["first_row_cells"] = _ORDER_FACTS + """
SELECT slug, soc AS soc_code, projected AS projected_employment_2034 FROM w"""
ORACLES["pages_to_table"] = _ORDER_FACTS + f"""
SELECT o_orderkey AS ord, 'Order ' || o_orderkey AS title, o_orderstatus AS category, {_WIDE},
       soc AS soc_code, projected AS projected_employment_2034,
       'https://example.com/o/' || o_orderkey AS url
FROM w"""
ORACLES["run_steps"] = _ORDER_FACTS + """
SELECT 'Order ' || o_orderkey AS title, slug, o_orderstatus AS category, CAST(annual AS BIGINT) AS pay,
       price AS jobs, CASE WHEN o_orderstatus <> 'P' THEN pct END AS outlook, education,
       CASE WHEN o_custkey % 13 <> 0 THEN o_orderkey % 11 + CASE WHEN o_custkey % 17 = 0
           AND o_orderkey % 11 < 10 THEN 0.5::DOUBLE ELSE 0 END END AS exposure,
       'https://example.com/o/' || o_orderkey AS url, outlook_desc,
       o_orderpriority || '|' || o_orderstatus || chr(10) || o_custkey AS exposure_rationale
FROM w"""

_PART_PAGE = "CAST(floor(p_retailprice) AS BIGINT)"
ORACLES["sections"] = """
SELECT p_partkey, 'tab-2' AS tab, 'About ' || p_name AS title FROM part
UNION ALL SELECT p_partkey, 'tab-5', 'Pay' FROM part
UNION ALL SELECT p_partkey, 'tab-6', 'Outlook' FROM part"""
ORACLES["blocks"] = """
SELECT p_partkey, 'tab-2' AS tab, 0 AS at, 'p' AS kind, p_brand || ' ' || p_type AS text FROM part
UNION ALL SELECT p_partkey, 'tab-2', 1, 'p', '' FROM part
UNION ALL SELECT p_partkey, 'tab-2', 2, 'h3', 'Size ' || p_size FROM part
UNION ALL SELECT p_partkey, 'tab-2', 3, 'ul', p_brand || p_type FROM part
UNION ALL SELECT p_partkey, 'tab-2', 4, 'table', 'KeyValue' || p_size FROM part"""
ORACLES["chart_items"] = f"""
SELECT p_partkey, 'Price of ' || p_name AS subtitle, 0 AS at, p_name AS label,
       '$' || {_PART_PAGE} AS value FROM part
UNION ALL SELECT p_partkey, 'Price of ' || p_name, 1, 'share', p_size || '%' FROM part"""
ORACLES["table_rows"] = """
SELECT p_partkey, 0 AS at, 'Key|Value' AS cells FROM part
UNION ALL SELECT p_partkey, 1, p_size || '|' FROM part"""
ORACLES["labelled_cells"] = """
SELECT p_partkey, 0 AS at, 'Occupational Title' AS label, p_name AS value FROM part
UNION ALL SELECT p_partkey, 1, 'SOC Code', p_brand FROM part
UNION ALL SELECT p_partkey, 2, 'Employment 2024', format('{:,}', p_partkey) FROM part
UNION ALL SELECT p_partkey, 3, 'Change % 2024-34', CAST(p_size AS VARCHAR) FROM part"""
ORACLES["pages_to_markdown"] = f"""
SELECT p_partkey, concat_ws(chr(10),
  '# ' || p_name || ' no. ' || p_partkey, '',
  '## About ' || p_name, '', p_brand || ' ' || p_type, '', '### Size ' || p_size, '',
  '- ' || p_brand || p_type, '- ' || p_type, '',
  '| --- | --- |', '| Key | Value |', '| ' || p_size || ' |  |', '',
  '## Pay', '', '*Price of ' || p_name || '*', '',
  '- **' || p_name || '**: $' || {_PART_PAGE}, '- **share**: ' || p_size || '%', '',
  '## Outlook', '', '### Employment Projections', '',
  '- **Occupational Title:** ' || p_name, '- **SOC Code:** ' || p_brand,
  '- **Employment 2024:** ' || format('{{:,}}', p_partkey), '- **Change % 2024-34:** ' || p_size, '',
  '---', '*Last modified ' || p_size || '*', '') AS text
FROM part"""
ORACLES["documents_to_markdown"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS slug, '# Document ' || doc_id || chr(10) || chr(10) || '## Text' || chr(10)
  || coalesce((SELECT string_agg(chr(10) || line || chr(10), '' ORDER BY place)
      FROM (SELECT {clean('part')} AS line, place
            FROM (SELECT unnest(string_split(text, chr(10))) AS part,
                         generate_subscripts(string_split(text, chr(10)), 1) AS place))
      WHERE line <> ''), '') AS text
FROM documents"""

# --- checks ---------------------------------------------------------------------------------------------------------

ORACLES["check_required"] = """
SELECT 'master_list' AS "check", false AS is_valid,
       'Missing required fields in row: ' || min(o_orderkey) AS message, '' AS details
FROM orders WHERE o_orderstatus = 'P'"""
ORACLES["check_required_fields"] = """
SELECT 'site_data' AS "check", false AS is_valid,
       'Site data missing required fields: ' || count(*) || ' items' AS message,
       'missing=' || (SELECT string_agg(o_orderkey || ': category', ', ' ORDER BY o_orderkey)
                      FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5)) AS details
FROM orders"""
ORACLES["check_corpus"] = """
SELECT 'markdown_files' AS "check", false AS is_valid,
       'Found ' || count(*) || ' empty Markdown files' AS message,
       'empty_files=' || (SELECT string_agg(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), ', ' ORDER BY o_orderkey)
          FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 5)) AS details
FROM orders WHERE o_orderstatus = 'P'"""
ORACLES["check_columns"] = """
SELECT 'csv' AS "check", true AS is_valid, 'CSV valid: ' || count(*) || ' rows' AS message,
       'columns=ord, title, slug, category, url; count=' || count(*) AS details
FROM orders"""
ORACLES["check_range"] = REC + """
, bad AS (SELECT ord, slug FROM rec WHERE category = 'P' AND exposure > 9)
SELECT 'scores' AS "check", false AS is_valid,
       'Found ' || count(*) || ' scores with invalid exposure values' AS message,
       'invalid=' || (SELECT string_agg(slug, ', ' ORDER BY ord)
                      FROM (SELECT * FROM bad ORDER BY ord LIMIT 5)) AS details
FROM bad"""

_COUNTS = """(SELECT count(*) AS orders, count(*) FILTER (WHERE o_custkey % 13 <> 0) AS rated FROM orders) o,
(SELECT count(*) AS pages FROM pages) p, (SELECT count(*) AS docs FROM documents) d,
(SELECT count(*) AS labels FROM labels) l"""
_RESULTS = f"""
results AS (
  SELECT unnest([
    {{'ord': 0, 'check': 'master_list', 'is_valid': true, 'message': 'Master list valid: ' || orders || ' rows',
      'details': ['count=' || orders]}},
    {{'ord': 1, 'check': 'html_files', 'is_valid': true, 'message': 'HTML files valid: ' || pages || ' files',
      'details': ['count=' || pages]}},
    {{'ord': 2, 'check': 'markdown_files', 'is_valid': true, 'message': 'Markdown files valid: ' || docs || ' files',
      'details': ['count=' || docs]}},
    {{'ord': 3, 'check': 'csv', 'is_valid': true, 'message': 'CSV valid: ' || docs || ' rows',
      'details': ['columns=ord, title, category, slug, url, median_pay_annual, num_jobs_2024, outlook_pct, outlook_desc, entry_education',
                  'count=' || docs]}},
    {{'ord': 4, 'check': 'scores', 'is_valid': true,
      'message': 'Scores valid: ' || orders || ' entries (' || rated || ' with exposure)',
      'details': ['count=' || orders, 'with_exposure=' || rated]}},
    {{'ord': 5, 'check': 'site_data', 'is_valid': true,
      'message': 'Site data valid: ' || orders || ' entries (' || rated || ' with exposure)',
      'details': ['count=' || orders, 'with_exposure=' || rated]}},
    {{'ord': 6, 'check': 'archive', 'is_valid': false, 'message': 'Failed to load archive: PATH_NOT_FOUND',
      'details': []}}
  ], recursive := false) AS r FROM {_COUNTS})
"""
ORACLES["validate_all"] = "WITH" + _RESULTS + """
SELECT r.ord AS ord, r."check" AS "check", r.is_valid AS is_valid, r.message AS message,
       array_to_string(r.details, '; ') AS details FROM results"""
ORACLES["checks_while_writing"] = "WITH" + _RESULTS + """
SELECT CASE r."check" WHEN 'scores' THEN 0 ELSE 1 END AS ord, r."check" AS "check",
       r.is_valid AS is_valid, r.message AS message, array_to_string(r.details, '; ') AS details
FROM results WHERE r."check" IN ('scores', 'site_data')"""
ORACLES["quality_report"] = "WITH" + _RESULTS + """
, lines AS (
  SELECT r.ord + 1 AS section, unnest(list_concat(
      [CASE WHEN r.is_valid THEN '[OK] ' ELSE '[FAIL] ' END
       || CASE r."check" WHEN 'master_list' THEN 'Master List' WHEN 'html_files' THEN 'Html Files'
               WHEN 'markdown_files' THEN 'Markdown Files' WHEN 'csv' THEN 'Csv' WHEN 'scores' THEN 'Scores'
               WHEN 'site_data' THEN 'Site Data' ELSE 'Archive' END || ': ' || r.message],
      list_transform(r.details, lambda x: '    ' || regexp_replace(x, '=', ': ')))) AS line,
    generate_subscripts(list_concat([''], r.details), 1) - 1 AS place
  FROM results)
SELECT 0 AS section, CAST(0 AS BIGINT) AS row, 'Data Validation Report' AS line
UNION ALL SELECT 0, 1, repeat('=', 50)
UNION ALL SELECT section, place, line FROM lines"""
ORACLES["status"] = f"""
SELECT 0 AS ord, 'Master list' AS component, 'OK' AS state, orders || ' occupations' AS details FROM {_COUNTS}
UNION ALL SELECT 1, 'HTML files', 'OK', pages || ' files' FROM {_COUNTS}
UNION ALL SELECT 2, 'Markdown files', 'OK', docs || ' files' FROM {_COUNTS}
UNION ALL SELECT 3, 'CSV', 'OK', docs || ' rows' FROM {_COUNTS}
UNION ALL SELECT 4, 'Scores', 'OK', labels || ' entries (' || labels || ' with exposure)' FROM {_COUNTS}
UNION ALL SELECT 5, 'Site data', 'OK', orders || ' entries (' || rated || ' with exposure)' FROM {_COUNTS}
UNION ALL SELECT 6, 'Archive', 'FAIL', 'not found'"""
ORACLES["corpus_inventory"] = """
SELECT 'markdown' AS component, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_empty FROM orders
UNION ALL SELECT 'html', count(*), count(*) FILTER (WHERE html = '') FROM pages"""

# --- files ------------------------------------------------------------------------------------------------------------

ORACLES["io_roundtrip_json"] = """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name END AS c_name, c_mktsegment FROM customer"""
ORACLES["io_roundtrip_csv"] = """
SELECT 'say "' || c_mktsegment || '",' || chr(10) || c_name AS title,
       CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END AS category,
       CAST(c_custkey AS VARCHAR) AS slug, '' AS url FROM customer"""
ORACLES["record_list"] = """
SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS ord, p_name AS title, CAST(p_partkey AS VARCHAR) AS slug,
       p_type AS category, p_brand AS url FROM part"""
ORACLES["corpus_table"] = """
SELECT CAST(page_id AS VARCHAR) AS slug, html AS text, strlen(html) AS bytes FROM pages"""
ORACLES["read_corpus"] = """
SELECT CAST(page_id AS VARCHAR) AS slug, html AS text FROM pages"""
ORACLES["empty_files"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS slug, CASE WHEN s_acctbal > 0 THEN s_name ELSE '' END AS text,
       NOT s_acctbal > 0 AS empty FROM supplier"""
ORACLES["compact_output"] = ORACLES["build_compact"]
ORACLES["corpus_paths"] = """
SELECT doc_id AS ord, '/corpus/' || doc_id || '.html' AS path, CAST(doc_id AS VARCHAR) AS slug FROM documents"""

# tables that are kept from changes equal those of the records as they are
for _name, _kept in (("headline", "headline"), ("tiers", "tier_summary"), ("bands", "band_means"),
                     ("groups", "group_means")):
    ORACLES[f"{_name}_from_changes"] = ORACLES[_kept]
