"""The registered queries in the checking engine's SQL (DuckDB dialect)."""

from __future__ import annotations


import re

from .. import vocabulary as V
from ..functions.identifiers import DOI_MIN_LENGTH
from ..operators import classify, search, tagging
from ..operators.ranges import CHUNK_YEARS, YEAR_SPAN_DAYS
from ..operators.screening import REQUEST_FIELDS
from ..schema import TRACKS
from . import queries as Q
from . import tables as T

SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def doi(x: str) -> str:
    bare = f"regexp_replace({strip(x)}, '^(?i:https?://(?:dx\\.)?doi\\.org/|doi:)', '')"
    return strip(f"lower({bare})")


def valid(x: str) -> str:
    return f"(length({x}) >= {DOI_MIN_LENGTH} AND regexp_matches({x}, '^10\\.[0-9]{{4,9}}/[^{SPACE}]+$'))"


def title(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^{WORD}]+', ' ', 'g'))"


def pub(x: str) -> str:
    raw = strip(x)
    year = f"regexp_extract({raw}, '((?:20|19)[0-9]{{2}})', 1)"
    number = f"regexp_extract({raw}, {year} || '[-/.]([0-9]{{1,2}})', 1)"
    months = " ".join(
        f"WHEN contains(lower({raw}), '{name}') THEN {year} || '-{position:02d}'"
        for position, name in enumerate(V.MONTH_ABBREVIATIONS, 1)
    )
    return (
        f"CASE WHEN {raw} = '' THEN '' WHEN {year} = '' THEN lower({raw}) {months} "
        f"WHEN {number} <> '' THEN {year} || '-' || lpad({number}, 2, '0') ELSE {year} END"
    )


def sanitize(x: str) -> str:
    return (
        f"CASE WHEN lower(coalesce({x}, '')) = 'nan' THEN '' ELSE "
        f"replace(replace(coalesce({x}, ''), chr(13) || chr(10), chr(10)), chr(13), ' ') END"
    )


def year_of(x: str) -> str:
    head = f"substring({strip(x)}, 1, 4)"
    return (
        f"CASE WHEN regexp_matches({head}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
        f"THEN CAST(trunc(CAST({head} AS DOUBLE)) AS INTEGER) END"
    )


def leading_year(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({strip(x)}, '^([0-9]{{4}})', 1), '') AS INTEGER)"


def pattern(p: str) -> str:
    """A search pattern with Unicode word edges, for existence tests only."""
    if p == V.CLEANER_COVER_PATTERN:
        return p[:-1] + r"\n?$"
    out = f"(?:^|[^{WORD}])" + p[2:] if p.startswith(r"\b") else p
    return out[:-2] + f"(?:$|[^{WORD}])" if out.endswith(r"\b") else out


def found(x: str, patterns) -> str:
    joined = "|".join(f"(?:{pattern(p)})" for p in patterns)
    return f"regexp_matches({x}, {lit('(?i)' + joined)})"


def has_any(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(t)})" for t in terms) + ")"


RECORDS = f"records AS ({T.RECORDS_SQL})"


def known_sql() -> str:
    parts = " UNION ALL ".join(T.KNOWN_SQL.values())
    return f"SELECT DISTINCT {doi('doi')} AS doi FROM ({parts}) WHERE {doi('doi')} <> ''"


def _over(columns: str, where: str = "", ctes: str = "") -> str:
    tail = f" WHERE {where}" if where else ""
    more = f", {ctes}" if ctes else ""
    return f"WITH {RECORDS}{more} SELECT {columns} FROM records{tail}"


# --- cleaner --------------------------------------------------------------------------


def cleaner_case(prefixes=V.CLEANER_TITLE_PREFIXES, journal=True, numeric=True, words=4, min_year=None, nanozyme=False) -> str:
    low = "lower(title)"
    arms = []
    if journal:
        types = "replace(lower(publication_types), '-', ' ')"
        arms.append((f"publication_types <> '' AND NOT contains({types}, 'journal article')", "non_journal_article"))
    arms.append(("(" + " OR ".join(f"starts_with({low}, {lit(p.lower())})" for p in prefixes) + ")", "title_prefix"))
    arms.append((found(low, V.CLEANER_TITLE_PATTERNS), "title_regex"))
    if nanozyme:
        arms.append((f"contains({low}, 'nanozyme')", "nanozyme_in_title"))
    conference = f"{has_any(low, V.CLEANER_CONFERENCE_WORDS)} OR {has_any('lower(doi)', V.CLEANER_CONFERENCE_WORDS)}"
    arms.append((conference, "conference_keyword"))
    arms.append((found("lower(doi)", V.CLEANER_DOI_PATTERNS), "doi_pattern"))
    if numeric:
        arms.append(("regexp_matches(title, '^[0-9]')", "numeric_title_start"))
    arms.append((f"len(regexp_extract_all(title, '[^{SPACE}]+')) < {words}", "short_title"))
    arms.append((found(low, [V.CLEANER_COVER_PATTERN]), "cover_suffix"))
    if min_year:
        arms.append((f"coalesce({leading_year('pub_date')} < {min_year}, FALSE)", "pub_year_before_min"))
    return "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for cond, name in arms) + " ELSE '' END"


def override_case() -> str:
    track = f"lower({strip('track')})"
    return (
        f"CASE {track} WHEN 'enzymatic' THEN ({cleaner_case(journal=False, words=2)}) "
        f"WHEN 'hybrid' THEN ({cleaner_case(prefixes=('an ', 'the '), numeric=False)}) "
        f"WHEN 'chemical' THEN ({cleaner_case(min_year=2019, nanozyme=True)}) "
        f"ELSE ({cleaner_case()}) END"
    )


# --- title keywords ---------------------------------------------------------------------


def hits(words) -> str:
    padded = "(' ' || lower(title) || ' ')"
    return f"list_filter({lits(words)}, lambda k: contains({padded}, ' ' || lower(k) || ' '))"


TITLE_HITS = f"""{RECORDS}, hits AS (SELECT *, {hits(V.TITLE_NEGATIVE_WORDS)} AS neg, {hits(V.TITLE_POSITIVE_WORDS)} AS pos
  FROM records), tagged AS (SELECT *, concat_ws('; ',
  CASE WHEN len(neg) > 0 THEN 'neg:' || array_to_string(neg, ', ') END,
  CASE WHEN len(pos) = 0 THEN 'pos:missing' ELSE 'pos:' || array_to_string(pos, ', ') END) AS title_filter_hits,
  CASE WHEN len(neg) = 0 AND len(pos) > 0 THEN 'true' ELSE 'false' END AS title_filter_pass FROM hits)"""


# --- deduplication -----------------------------------------------------------------------


def dedup_ctes(records: str = "records", known: str | None = None, by_title=True, by_date=True) -> str:
    """CTEs ending in ``labels``: rounds of accepting whoever is first at both keys."""
    if by_title:
        second = "CASE WHEN t = '' THEN '#' || ingest_seq ELSE t END"
    elif by_date:
        second = "CASE WHEN t = '' OR pub = '' THEN '#' || ingest_seq ELSE t || chr(1) || pub END"
    else:
        second = "'#' || ingest_seq"
    is_known = f"doi IN (SELECT doi FROM ({known}))" if known else "FALSE"
    if by_title and by_date:
        rest = (
            "WHEN k.pub <> '' AND k.pub = b.pub THEN 'skipped_duplicate_title_date' "
            "ELSE 'skipped_duplicate_title'"
        )
    else:
        rest = "ELSE 'skipped_duplicate_title'" if by_title else "ELSE 'skipped_duplicate_title_date'"
    return f"""
parts AS (SELECT ingest_seq, doi AS raw, {doi('doi')} AS doi, {title('title')} AS t, {pub('pub_date')} AS pub FROM {records}),
keys AS (SELECT *, {second} AS second, {is_known} AS known,
  CASE WHEN raw = '' THEN 'skipped_no_doi' WHEN NOT {valid('doi')} THEN 'skipped_invalid_doi' END AS early FROM parts),
step AS (
  SELECT ingest_seq, doi, second, 0 AS state, 0 AS round FROM keys WHERE early IS NULL AND NOT known
  UNION ALL
  SELECT ingest_seq, doi, second,
    CASE WHEN state <> 0 THEN state WHEN taken THEN 2 WHEN ingest_seq = at_doi AND ingest_seq = at_second THEN 1 ELSE 0 END,
    round + 1
  FROM (SELECT *, (bool_or(state = 1) OVER (PARTITION BY doi) OR bool_or(state = 1) OVER (PARTITION BY second)) AS taken,
      min(CASE WHEN state = 0 THEN ingest_seq END) OVER (PARTITION BY doi) AS at_doi,
      min(CASE WHEN state = 0 THEN ingest_seq END) OVER (PARTITION BY second) AS at_second,
      bool_or(state = 0) OVER () AS going
    FROM step) WHERE going),
accepted AS (SELECT DISTINCT s.ingest_seq, s.doi, s.second, k.pub FROM step s JOIN keys k USING (ingest_seq) WHERE s.state = 1),
labels AS (SELECT k.ingest_seq, k.doi, CASE WHEN k.early IS NOT NULL THEN k.early
    WHEN a.ingest_seq = k.ingest_seq THEN 'kept'
    WHEN a.ingest_seq < k.ingest_seq THEN 'skipped_duplicate_in_batch'
    WHEN k.known THEN 'skipped_duplicate_in_master'
    {rest} END AS reason
  FROM keys k LEFT JOIN accepted a ON a.doi = k.doi LEFT JOIN accepted b ON b.second = k.second)"""


# --- tagging -----------------------------------------------------------------------------


def alias_hits() -> str:
    """One branch per alias, so that every pattern is a constant."""
    escape = lambda a: re.sub(r"([^0-9A-Za-z\u0080-\U0010ffff])", r"\\\1", a)
    branches = []
    for rank, (alias, canonical) in enumerate(tagging.ranked_aliases(Q.aliases())):
        pattern_ = f"(?i)(?:^|[^a-zA-Z0-9-]){escape(alias)}(?:$|[^a-zA-Z0-9-])"
        branches.append(
            f"SELECT ingest_seq, {lit(canonical)} AS canonical, {rank} AS rank FROM texts "
            f"WHERE contains(low, {lit(alias)}) AND regexp_matches(body, {lit(pattern_)})"
        )
    return " UNION ALL ".join(branches)


def tag_ctes(records: str = "records") -> str:
    return f"""
texts AS MATERIALIZED (SELECT *, lower(body) AS low FROM (SELECT ingest_seq, concat_ws(' ', nullif(title, ''), nullif(abstract, '')) AS body FROM {records})),
hit AS MATERIALIZED (SELECT ingest_seq, canonical, min(rank) AS rank FROM ({alias_hits()}) GROUP BY ingest_seq, canonical),
tagged AS (SELECT ingest_seq, string_agg(canonical, ', ' ORDER BY rank) AS compounds FROM hit GROUP BY ingest_seq)"""


# --- classification ------------------------------------------------------------------------


def marker(x: str) -> str:
    return has_any(f"(' ' || lower({x}) || ' ')", [m.lower() for m in classify.markers()])


def track_case(x: str) -> str:
    """All signals of every track, in priority order (the shared compounds included)."""
    arms = " ".join(
        f"WHEN {has_any(f'lower({x})', [s.lower() for s in (*V.KEY_COMPOUNDS, *V.METHOD_SIGNALS[t])])} THEN '{t}'"
        for t in V.TRACK_PRIORITY
    )
    return f"CASE WHEN NOT {marker(x)} THEN NULL {arms} ELSE 'pathway' END"


def domain_counts(source: str, column: str) -> str:
    rows = ", ".join(f"('{t}')" for t in TRACKS)
    return (
        f"SELECT d.track, count(s.track) AS n FROM (VALUES {rows}) AS d(track) "
        f"LEFT JOIN (SELECT {column} AS track FROM {source}) s ON s.track = d.track GROUP BY d.track"
    )


def resolved(track: str, category: str) -> str:
    domain = ", ".join(lit(t) for t in TRACKS)
    a, b = f"lower({strip(track)})", f"lower({strip(category)})"
    return f"CASE WHEN {a} IN ({domain}) THEN {a} WHEN {b} IN ({domain}) THEN {b} ELSE 'pathway' END"


def library_ctes() -> str:
    low, high = int(Q.MIN_YEAR[:4]), int(Q.MAX_YEAR[:4])
    year = year_of("pub_date")
    return f"""{RECORDS}, lib AS ({T.LIBRARY_SQL}),
meta AS (SELECT 'https://doi.org/10.5555/LIB.' || ingest_seq AS raw, title, journal, pub_date FROM records),
written AS (SELECT '10.5555/lib.' || (s_suppkey * 6) AS doi FROM supplier),
scan AS (SELECT {doi('m.raw')} AS doi, {strip('m.title')} AS title, 'master_library' AS source,
    {track_case('m.title')} AS track, {strip('m.journal')} AS journal, {strip('m.pub_date')} AS pub_date, 'true' AS local_has_pdf
  FROM lib JOIN meta m ON lib.doi = m.raw
  WHERE {marker('m.title')} AND ({year} IS NULL OR {year} BETWEEN {low} AND {high})),
fresh AS (SELECT * FROM scan WHERE doi NOT IN (SELECT doi FROM written))"""


# --- screening -------------------------------------------------------------------------------


def track_valid(x: str = "track") -> str:
    domain = ", ".join(lit(t) for t in TRACKS)
    return f"CASE WHEN lower({strip(x)}) IN ({domain}) THEN lower({strip(x)}) ELSE '' END"


def batch_ctes() -> str:
    rank = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TRACKS))
    return f"""{RECORDS}, ranked AS (SELECT *, {doi('doi')} AS nd, {track_valid()} AS vt,
    CASE {track_valid()} {rank} ELSE {len(TRACKS)} END AS tr FROM records),
numbered AS (SELECT *, row_number() OVER (ORDER BY tr, nd, ingest_seq) - 1 AS row_index FROM ranked),
batched AS (SELECT *, row_index // {Q.BATCH_SIZE} AS batch_id FROM numbered)"""


def request_struct() -> str:
    cells = ", ".join(f"{name} := {sanitize(name)}" for name, _ in REQUEST_FIELDS)
    return f"struct_pack({cells})"


def one_of(x: str, domain) -> str:
    values = ", ".join(lit(d) for d in domain)
    v = f"lower({strip(f'coalesce({x}, chr(32))')})"
    return f"CASE WHEN {v} IN ({values}) THEN {v} ELSE '' END"


def merged_ctes() -> str:
    label = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in V.TYPE_LABELS_ZH.items())
    return f"""{RECORDS}, judged AS ({T.JUDGEMENTS_SQL}),
latest AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ingest_seq DESC) = 1),
failed AS (SELECT '10.5555/doc.' || doc_id AS doi FROM labels WHERE toxic = 1),
joined AS (SELECT r.ingest_seq, r.track, j.*, j.doi IS NOT NULL AS has, f.doi IS NOT NULL AS broken
  FROM (SELECT *, {doi('doi')} AS nd FROM records) r LEFT JOIN latest j ON j.doi = r.nd LEFT JOIN failed f ON f.doi = r.nd),
merged AS (SELECT ingest_seq, track,
  CASE WHEN broken THEN '' ELSE coalesce(article_type, '') END AS ai_article_type,
  CASE WHEN broken THEN '' ELSE lower(coalesce(domain_relevant, '')) END AS ai_domain_relevant,
  CASE WHEN broken THEN '' ELSE coalesce(has_experiment, '') END AS ai_has_experiment,
  CASE WHEN broken OR coalesce(pass_filter = 'true', FALSE) THEN 'true' ELSE 'false' END AS ai_pass,
  CASE WHEN broken THEN 'batch_api_error_kept' WHEN NOT has THEN 'ai_missing_judgment'
    ELSE substring({strip("replace(rationale_zh, chr(10), ' ')")}, 1, 500) END AS ai_rationale_zh,
  CASE WHEN broken THEN '其他' ELSE CASE lower({strip("coalesce(article_type, '')")}) {label} ELSE '其他' END END AS lit_type_zh,
  CASE WHEN broken THEN '' ELSE {one_of('category', V.CATEGORIES)} END AS ai_category,
  CASE WHEN broken THEN '' ELSE {one_of('synthesis_method', V.SYNTHESIS_METHODS)} END AS ai_synthesis_method,
  CASE WHEN broken THEN '' ELSE {one_of('has_pathway_or_synthesis', V.YES_NO)} END AS ai_has_pathway_or_synthesis,
  CASE WHEN broken THEN '' ELSE substring({sanitize('compound_name')}, 1, 200) END AS ai_compound
  FROM joined)"""


def repair_sql() -> str:
    return f"""WITH {RECORDS}, judged AS ({T.JUDGEMENTS_SQL}),
out AS (SELECT ingest_seq, lower(CASE WHEN ingest_seq % 11 = 0 THEN 'bad' ELSE doi END) AS doi, pass_filter, rationale_zh FROM judged),
latest AS (SELECT * FROM out WHERE {valid('doi')} QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ingest_seq DESC) = 1)
SELECT r.ingest_seq, r.doi, r.title, CASE WHEN l.doi IS NOT NULL THEN l.pass_filter ELSE 'old' END AS ai_pass,
  CASE WHEN l.doi IS NOT NULL THEN l.rationale_zh ELSE '' END AS ai_rationale_zh,
  CASE WHEN l.doi IS NOT NULL THEN 'true' ELSE '' END AS local_has_pdf
FROM (SELECT *, {doi('doi')} AS nd FROM records) r LEFT JOIN latest l ON l.doi = r.nd WHERE r.nd <> ''"""


def merge_sql() -> str:
    return f"""WITH {RECORDS}, judged AS ({T.JUDGEMENTS_SQL})
SELECT doi, title, journal, '2024-01-01 00:00:00' AS fetched_at, '' AS ai_compound FROM records
UNION ALL SELECT doi, '', '', '2024-02-01 00:00:00', {sanitize('compound_name')} FROM judged"""


# --- sources -----------------------------------------------------------------------------------


JSON_SQL = """
WITH pages_ AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t FROM pages WHERE page_id % 9 <> 0)
SELECT page_id, 'crossref' AS source, '' AS pmid, '10.5555/Page.' || page_id AS doi,
  replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS title,
  CASE WHEN page_id % 4 = 0 THEN '' ELSE 'A & B' END AS journal,
  CASE WHEN page_id % 5 = 0 THEN '' ELSE concat_ws('-', CAST(2000 + page_id % 25 AS VARCHAR),
    CASE WHEN page_id % 3 = 0 THEN NULL ELSE CAST(1 + page_id % 12 AS VARCHAR) END,
    CASE WHEN page_id % 2 = 0 THEN NULL ELSE CAST(1 + page_id % 28 AS VARCHAR) END) END AS pub_date,
  '' AS abstract, 'journal article' AS publication_types
FROM pages_
"""


def xml_sql() -> str:
    clean = lambda c: f"regexp_replace({c}, '[\\x00-\\x08\\x0b\\x0c\\x0d\\x0e-\\x1f\\x{{fffe}}\\x{{ffff}}]', '', 'g')"
    body = strip(clean("abstract"))
    return f"""WITH {RECORDS}
SELECT ingest_seq, 'pubmed' AS source, CAST(ingest_seq AS VARCHAR) AS pmid,
  CASE WHEN ingest_seq % 4 <> 0 THEN {strip(clean('doi'))} ELSE '' END AS doi,
  {strip(f"('On E. coli ' || {clean('title')})")} AS title,
  {clean('journal')} AS journal,
  CASE ingest_seq % 3 WHEN 0 THEN concat(2000 + ingest_seq % 20, '-Mar') WHEN 1 THEN ''
    ELSE concat('2010-', 1 + ingest_seq % 12, '-05') END AS pub_date,
  'Journal Article; ' || {strip(clean('publication_types'))} AS publication_types,
  md5('AIM: Foo 2 bar' || CASE WHEN {body} = '' THEN '' ELSE chr(10) || {body} END) AS abstract_md5
FROM records"""


# --- windows -----------------------------------------------------------------------------------


WINDOWS_SQL = """
WITH dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
rows_ AS (SELECT unnest(['explicit', 'from_min_date', 'rolling', 'this_month', 'prev_month', 'incremental', 'last_month']) AS mode, d,
  CASE WHEN day(d) % 2 = 0 THEN CAST(d + CAST(day(d) - 20 AS INTEGER) AS DATE) END AS last_run FROM dates),
w AS (SELECT mode, d AS date_to, CASE mode WHEN 'explicit' THEN DATE '1992-01-01' WHEN 'from_min_date' THEN DATE '1995-06-15'
    WHEN 'rolling' THEN least(d - 730, DATE '1995-06-15')
    WHEN 'this_month' THEN CAST(date_trunc('month', d) AS DATE)
    WHEN 'incremental' THEN coalesce(least(last_run, CASE WHEN last_run IS NOT NULL THEN d END), d - 30)
    ELSE CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) END AS window_from,
  CASE WHEN mode IN ('prev_month', 'last_month') THEN CAST(date_trunc('month', d) AS DATE) - 1 ELSE d END AS window_to FROM rows_)
SELECT mode, date_to, window_from, window_to, CASE WHEN mode = 'incremental' THEN window_to + 1 END AS next_run FROM w
"""

MONTHS_SQL = """
WITH r AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS date_from, CAST(max(o_orderdate) AS DATE) AS date_to FROM orders GROUP BY o_custkey),
m AS (SELECT *, CAST(unnest(generate_series(date_trunc('month', date_from), date_trunc('month', date_to), INTERVAL 1 MONTH)) AS DATE) AS mon FROM r)
SELECT o_custkey, date_from, date_to, greatest(date_from, mon) AS segment_from, least(date_to, last_day(mon)) AS segment_to FROM m
"""

SEGMENTS_SQL = f"""
WITH daily AS (SELECT o_orderpriority AS query, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL),
span AS (SELECT query, min(day) AS f, max(day) AS l, CAST(sum(n) AS BIGINT) AS total FROM daily GROUP BY query),
chunks AS (SELECT query, f, l, total, CASE WHEN l - f > {YEAR_SPAN_DAYS} THEN greatest(f, make_date(y, 1, 1)) ELSE f END AS cf,
    CASE WHEN l - f > {YEAR_SPAN_DAYS} THEN least(l, make_date(y + {CHUNK_YEARS - 1}, 12, 31)) ELSE l END AS ct
  FROM (SELECT *, unnest(CASE WHEN l - f > {YEAR_SPAN_DAYS} THEN generate_series(CAST(year(f) AS BIGINT), CAST(year(l) AS BIGINT), {CHUNK_YEARS}) ELSE [CAST(year(f) AS BIGINT)] END) AS y FROM span)),
counted AS (SELECT c.*, (SELECT CAST(sum(n) AS BIGINT) FROM daily d WHERE d.query = c.query AND d.day BETWEEN c.cf AND c.ct) AS cn FROM chunks c),
months AS (SELECT query, cf, ct, CAST(unnest(generate_series(date_trunc('month', cf), date_trunc('month', ct), INTERVAL 1 MONTH)) AS DATE) AS mon
  FROM counted WHERE total > 1200 AND cn > 1200),
seg AS (SELECT query, 'whole' AS level, f AS a, l AS b FROM span WHERE total <= 1200
  UNION ALL SELECT query, 'chunk', cf, ct FROM counted WHERE total > 1200 AND cn <= 1200
  UNION ALL SELECT query, 'month', greatest(cf, mon), least(ct, last_day(mon)) FROM months)
SELECT s.query, s.level, s.a AS segment_from, s.b AS segment_to, CAST(sum(d.n) AS BIGINT) AS n, sum(d.n) > 1200 AS truncated
FROM seg s JOIN daily d ON d.query = s.query AND d.day BETWEEN s.a AND s.b GROUP BY ALL
"""


# --- search expressions ----------------------------------------------------------------------------


def capped_sql() -> str:
    rows = []
    for track in TRACKS:
        tail = [f"{term} {signal}" for term in V.GENERIC_TERMS for signal in V.METHOD_SIGNALS[track]]
        tail += list(V.HYBRID_EXTRA_QUERIES) if track == "hybrid" else []
        tail = list(V.METHOD_SIGNALS[track]) if track == "gce" else tail
        rows += [f"('{track}', {i}, {lit(q)})" for i, q in enumerate(tail)]
    return f"""WITH names AS (SELECT p_partkey AS ord, p_name AS query FROM part),
own AS (SELECT unnest({lits([t for t in TRACKS if t != 'gce'])}) AS track, ord, query FROM names
  UNION ALL SELECT 'gce', row_number() OVER (ORDER BY ord) - 1, query FROM names WHERE ord % 7 = 0),
size AS (SELECT track, max(ord) + 1 AS n FROM own GROUP BY track),
tail(track, pos, query) AS (VALUES {', '.join(rows)}),
everything AS (SELECT * FROM own UNION ALL SELECT track, pos + n, query FROM tail JOIN size USING (track))
SELECT track, CAST(ord AS BIGINT) AS ord, query, 'none' AS cap FROM everything
UNION ALL SELECT track, CAST(ord AS BIGINT), query, '150' FROM everything WHERE ord < 150"""


def replies_sql() -> str:
    return """WITH l AS (SELECT doc_id, '10.5555/doc.' || doc_id AS doi, quality, toxic FROM labels)
SELECT doi, 'judged' AS state, 'review' AS article_type, CASE WHEN quality = 1 THEN 'true' ELSE 'false' END AS pass_filter,
  CAST(toxic AS VARCHAR) AS domain_relevant FROM l WHERE doc_id % 8 NOT IN (2, 3)
UNION ALL SELECT doi, 'failed', '', '', '' FROM l WHERE doc_id % 8 IN (2, 3)"""


def pipeline_sql() -> str:
    cleaned = f"""{RECORDS}, cleaned AS (SELECT * FROM records
  WHERE NOT ({strip('publication_types')} <> '' AND {found('publication_types', V.TYPE_EXCLUDE_PATTERNS)})
  AND {cleaner_case()} = '')"""
    master = f"SELECT DISTINCT {doi('doi')} AS doi FROM ({T.KNOWN_SQL['master']})"
    return f"""WITH RECURSIVE {cleaned}, {dedup_ctes('cleaned', known_sql())}, {tag_ctes('cleaned')},
kept AS (SELECT c.ingest_seq, l.doi, c.title, c.track, {hits(V.TITLE_NEGATIVE_WORDS)} AS neg
  FROM cleaned c JOIN labels l USING (ingest_seq) WHERE l.reason = 'kept')
SELECT k.ingest_seq, k.doi, k.title, k.track, '' AS title_filter_hits, 'true' AS title_filter_pass,
  CASE WHEN m.doi IS NOT NULL THEN 'true' ELSE 'false' END AS local_has_pdf, coalesce(t.compounds, '') AS compounds
FROM kept k LEFT JOIN ({master}) m ON m.doi = k.doi LEFT JOIN tagged t USING (ingest_seq) WHERE len(k.neg) = 0"""


def table_signature_sql() -> str:
    limb = lambda start: f"coalesce(sum(CAST(('0x' || substring(h, {start}, 12)) AS UBIGINT)), 0)"
    return f"""WITH {RECORDS}, d AS (SELECT DISTINCT {doi('doi')} AS nd FROM records WHERE {doi('doi')} <> ''),
h AS (SELECT sha256(nd) AS h FROM d),
s AS (SELECT count(*) AS record_count, {limb(1)} AS a, {limb(13)} AS b FROM h)
SELECT record_count, substring(sha256(concat_ws('|', record_count, a, b)), 1, 16) AS signature FROM s"""


def oracle_sql() -> dict[str, str]:
    nd = doi("doi")
    excluded = f"({strip('publication_types')} <> '' AND {found('publication_types', V.TYPE_EXCLUDE_PATTERNS)})"
    year = year_of("pub_date")
    low, high = int(Q.MIN_YEAR[:4]), int(Q.MAX_YEAR[:4])
    breaks = "replace(abstract, '. ', '.' || CASE WHEN ingest_seq % 2 = 0 THEN chr(13) || chr(10) ELSE chr(13) END)"
    pmid = "CASE ingest_seq % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN NULL ELSE pmid END"
    known = known_sql()
    full = f"WITH RECURSIVE {RECORDS}, {dedup_ctes('records', known)}"
    master = f"SELECT DISTINCT {nd} AS doi FROM ({T.KNOWN_SQL['master']})"
    outputs = f"SELECT DISTINCT {nd} AS doi FROM ({T.KNOWN_SQL['outputs']})"
    tagged = f"WITH {RECORDS}, {tag_ctes()}"
    tag_rows = f"{tagged} SELECT ingest_seq, coalesce(compounds, '') AS compounds FROM records LEFT JOIN tagged USING (ingest_seq)"
    signal_rows = ", ".join(f"({i}, {lit(s)})" for i, s in enumerate(V.METHOD_SIGNALS["enzymatic"]))
    return {
        "normalize_doi": _over(f"ingest_seq, {nd} AS doi_norm"),
        "valid_doi": _over(f"ingest_seq, {valid(nd)} AS doi_valid"),
        "normalize_title": _over(
            f"ingest_seq, {title('title')} AS title_norm, md5({title('abstract')}) AS text_norm_md5"
        ),
        "normalize_pub_date": _over(f"ingest_seq, {pub('pub_date')} AS date_norm"),
        "sanitize_text": _over(f"ingest_seq, md5({sanitize(breaks)}) AS text_md5, {sanitize(pmid)} AS pmid_clean"),
        "year_range_filter": _over(
            f"ingest_seq, {year} AS year, {leading_year('pub_date')} AS leading_year",
            f"{year} IS NULL OR {year} BETWEEN {low} AND {high}",
        ),
        "type_filter": _over("ingest_seq, publication_types", f"NOT {excluded}"),
        "type_filter_stats": _over(
            f"count(*) AS input, count(*) FILTER (WHERE {excluded}) AS dropped, count(*) FILTER (WHERE NOT {excluded}) AS kept"
        ),
        "cleaner_reason": _over(f"ingest_seq, {cleaner_case()} AS drop_reason"),
        "cleaner_reason_counts": f"WITH {RECORDS} SELECT reason, count(*) AS n FROM (SELECT {cleaner_case()} AS reason FROM records) WHERE reason <> '' GROUP BY reason",
        "cleaner_track_overrides": _over(f"ingest_seq, {override_case()} AS drop_reason"),
        "title_filter_hits": f"WITH {TITLE_HITS} SELECT ingest_seq, title_filter_hits, title_filter_pass FROM tagged",
        "title_filter_stats": f"""WITH {TITLE_HITS} SELECT count(*) AS input, count(*) FILTER (WHERE title_filter_pass = 'false') AS dropped,
            count(*) FILTER (WHERE title_filter_pass = 'true') AS kept, count(*) FILTER (WHERE len(neg) > 0) AS tagged,
            count(*) FILTER (WHERE len(pos) = 0) AS positive_miss FROM tagged""",
        "blank_query_elimination": f"SELECT conv_id, turn, text AS query FROM conversations WHERE turn % 2 <> 1 AND {strip('text')} <> ''",
        "known_doi_union": known,
        "known_doi_difference": f"SELECT doi FROM ({outputs}) WHERE doi NOT IN (SELECT doi FROM ({master}))",
        "known_doi_antijoin": _over(
            f"ingest_seq, {nd} AS doi_norm", f"{nd} <> '' AND {nd} NOT IN (SELECT doi FROM ({known}))"
        ),
        "local_flag": _over(
            f"ingest_seq, CASE WHEN {nd} IN (SELECT doi FROM ({master})) THEN 'true' ELSE 'false' END AS local_has_pdf"
        ),
        "dedup_greedy": f"{full} SELECT ingest_seq, doi, reason FROM labels",
        "dedup_reason_counts": f"{full} SELECT reason, count(*) AS n FROM labels GROUP BY reason",
        "dedup_doi_only": f"WITH RECURSIVE {RECORDS}, {dedup_ctes('records', known, False, False)} SELECT ingest_seq, doi, reason FROM labels",
        "dedup_title_date": f"WITH RECURSIVE {RECORDS}, {dedup_ctes('records', None, False, True)} SELECT ingest_seq, doi, reason FROM labels",
        "keep_first_by_doi": _over("ingest_seq, doi", "doi <> '' QUALIFY row_number() OVER (PARTITION BY lower(doi) ORDER BY ingest_seq) = 1"),
        "keep_first_by_pmid": _over("ingest_seq, pmid", "pmid <> '' QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY ingest_seq) = 1"),
        "keep_last_by_doi": _over(
            f"ingest_seq, {nd} AS doi_norm",
            f"{valid(nd)} QUALIFY row_number() OVER (PARTITION BY {nd} ORDER BY ingest_seq DESC) = 1",
        ),
        "compound_tag": tag_rows,
        "compound_tag_table": tag_rows,
        "tag_frequency": f"{tagged} SELECT canonical AS tag, count(*) AS n FROM hit GROUP BY canonical",
        "track_classify": _over(f"ingest_seq, coalesce({track_case('title')}, '') AS assigned_track"),
        "track_partition": _over(
            f"ingest_seq, {resolved('track', 'CASE WHEN ingest_seq % 2 = 0 THEN chr(72) || chr(121) || $$brid$$ ELSE $$neither$$ END')} AS bucket"
        ),
        "track_counts": f"WITH {RECORDS} " + domain_counts("records", f"lower({strip('track')})"),
        "library_join": f"""WITH {RECORDS}, lib AS ({T.LIBRARY_SQL}) SELECT lib.doi AS "DOI", count(*) AS n, max(title) AS title
            FROM lib JOIN records ON lib.doi = 'https://doi.org/10.5555/LIB.' || ingest_seq GROUP BY lib.doi""",
        "library_import": f"WITH {library_ctes()} SELECT doi, title, source, track, journal, pub_date, local_has_pdf FROM fresh",
        "library_import_counts": f"WITH {library_ctes()} " + domain_counts("fresh", "track"),
        "query_pairs": f"""SELECT p_type AS grp, p_partkey AS term_ord, CAST(s.i AS INTEGER) AS signal_ord, p_name || ' ' || s.signal AS expression
            FROM part, (VALUES {signal_rows}) AS s(i, signal)""",
        "query_build_capped": capped_sql(),
        "query_blocks": f"""SELECT CAST(p_partkey % 7 AS VARCHAR) AS grp, p_partkey // 7 // {search.BLOCK_TERMS} AS block_ord,
            string_agg(p_name || '[Title/Abstract]', ' OR ' ORDER BY p_partkey // 7, p_name) AS block FROM part GROUP BY 1, 2""",
        "query_signature": "SELECT doc_id, substring(sha256('2024-01-01|2026-06-25|' || text), 1, 16) AS signature FROM documents",
        "screen_batches": f"WITH {batch_ctes()} SELECT ingest_seq, row_index, batch_id FROM batched",
        "batch_payload": f"""WITH {batch_ctes()} SELECT batch_id, first(vt ORDER BY row_index) AS track, CAST(count(*) AS INTEGER) AS batch_rows,
            CAST(to_json(list({request_struct()} ORDER BY row_index)) AS VARCHAR) AS payload FROM batched GROUP BY batch_id""",
        "content_signature": f"""WITH {batch_ctes()} SELECT batch_id,
            substring(sha256(coalesce(string_agg(DISTINCT nd, chr(10) ORDER BY nd) FILTER (WHERE nd <> ''), '')), 1, 16) AS signature FROM batched GROUP BY batch_id""",
        "table_signature": table_signature_sql(),
        "pending_batches": f"""WITH {batch_ctes()} SELECT DISTINCT batch_id FROM batched
            WHERE nd <> '' AND nd NOT IN (SELECT nd FROM ranked WHERE track NOT IN ('chemical', 'GCE '))""",
        "reply_parse": replies_sql(),
        "reply_stats": """SELECT count(*) AS ai_batches, count(*) FILTER (WHERE doc_id % 8 IN (2, 3)) AS ai_errors,
            count(*) FILTER (WHERE doc_id % 8 > 3) AS ai_mended, count(*) FILTER (WHERE doc_id % 8 IN (5, 6)) AS ai_broken_items FROM labels""",
        "screening_resume": f"""WITH {RECORDS}, firsts AS (SELECT * FROM records WHERE {nd} <> ''
            QUALIFY row_number() OVER (PARTITION BY {nd} ORDER BY ingest_seq) = 1)
            SELECT ingest_seq, 'title of ' || length({sanitize('title')}) AS ai_article_type,
            CASE WHEN length({sanitize('abstract')}) % 2 = 0 THEN 'true' ELSE 'false' END AS ai_pass, '' AS ai_rationale_zh FROM firsts""",
        "judgement_last_wins": f"""SELECT doi, ingest_seq, pass_filter, rationale_zh FROM ({T.JUDGEMENTS_SQL})
            QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ingest_seq DESC) = 1""",
        "judgement_merge": f"WITH {merged_ctes()} SELECT * EXCLUDE (track) FROM merged",
        "screening_stats": f"""WITH {merged_ctes()} SELECT count(*) AS ai_input, count(*) FILTER (WHERE ai_pass <> 'true') AS ai_dropped,
            count(*) FILTER (WHERE ai_pass = 'true') AS ai_kept,
            count(*) FILTER (WHERE ai_rationale_zh = 'batch_api_error_kept') AS ai_failed_records FROM merged""",
        "usable_by_track": f"WITH {merged_ctes()} "
        + domain_counts(
            "merged WHERE ai_pass = 'true' AND ai_rationale_zh <> 'batch_api_error_kept'",
            resolved("track", "ai_category"),
        ),
        "repair_overlay": repair_sql(),
        "merge_outputs": merge_sql(),
        "record_union": f"WITH {RECORDS} SELECT source, {strip('track')} AS track, count(*) AS n FROM records GROUP BY ALL",
        "json_record_parse": JSON_SQL,
        "xml_record_parse": xml_sql(),
        "json_landed_scan": f"SELECT * EXCLUDE (page_id) FROM ({JSON_SQL})",
        "xml_landed_scan": f"SELECT * EXCLUDE (ingest_seq) FROM ({xml_sql()})",
        "track_files": f"""WITH {RECORDS} SELECT {resolved('track', "''")} AS track, doi, {sanitize('title')} AS title,
            md5({sanitize('abstract')}) AS abstract_md5, pmid, '' AS missing, '2024-05-06 07:08:09' AS fetched_at FROM records""",
        "key_results": f"WITH {merged_ctes()}, counts AS ("
        + domain_counts(
            "merged WHERE ai_pass = 'true' AND ai_rationale_zh <> 'batch_api_error_kept'",
            resolved("track", "ai_category"),
        )
        + ") SELECT track, n, n AS file_rows FROM counts",
        "date_windows": WINDOWS_SQL,
        "month_segments": MONTHS_SQL,
        "segment_plan": SEGMENTS_SQL,
        "search_pipeline": pipeline_sql(),
        "head_in_order": f"WITH {batch_ctes()} SELECT ingest_seq FROM batched ORDER BY row_index LIMIT 50",
        "incremental_ingest": f"WITH RECURSIVE {RECORDS}, {dedup_ctes('records', None)} SELECT l.ingest_seq, l.doi, r.title FROM labels l JOIN records r USING (ingest_seq) WHERE reason = 'kept'",
    }
