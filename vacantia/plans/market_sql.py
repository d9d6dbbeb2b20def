"""DuckDB SQL saying the same as the queries of ``vacantia.plans.market``."""

from __future__ import annotations

from vacantia.functions import lookup, text
from vacantia.operators import dashboard
from vacantia.plans import market
from vacantia.plans.problems import JOBS_SQL, items_sql, unwrapped_sql
from vacantia.schemas import METHODS, PERIODS


def _q(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(column: str, table: dict, other: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {other} END"


_CUR = _case("upper(country)", lookup.CURRENCIES)
_DASH = """WITH dash AS (SELECT title, company, country, posted_at, posting_url, salary_annual_eur_p50, salary_imputed, salary_period, isco_code, isco_match_method,
  isco_match_score, substr(isco_code, 1, 1) AS isco_major, source FROM postings WHERE salary_annual_eur_p50 IS NULL OR salary_annual_eur_p50 > 0)"""
_CHOSEN = f"""{_DASH}, chosen AS (SELECT * FROM dash WHERE country = '{market.CHOSEN["country"]}' AND (salary_annual_eur_p50 IS NULL OR salary_annual_eur_p50 >= {market.CHOSEN["low"]})
  AND (salary_annual_eur_p50 IS NULL OR salary_annual_eur_p50 <= {market.CHOSEN["high"]}) AND posted_at >= TIMESTAMPTZ '{market.CHOSEN["since"]} 00:00:00+00')"""
_RATES = "(SELECT currency, max(rate) AS rate FROM fx_rates GROUP BY currency)"
_EUROS = f"""SELECT p.*, p.salary_min_eur / r.rate AS lo, p.salary_max_eur / r.rate AS hi, p.salary_annual_eur_p50 / r.rate AS mid FROM postings p
  LEFT JOIN {_RATES} r ON r.currency = {_CUR.replace("country", "p.country")}"""
_BENCH = "bench AS (SELECT isco_code, country, quantile_cont(salary_annual_eur_p50, 0.5) AS median_eur FROM postings WHERE isco_code IS NOT NULL AND salary_annual_eur_p50 IS NOT NULL GROUP BY ALL)"

_B = r"[\t\n\v\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"


_STRAY = "regexp_replace(replace({x}, '+', ' '), '%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)', '%25\\1', 'g')"
_ENC = "replace(url_encode(url_decode({x})), '%20', '+')"
_URLS = rf"""
parts AS (SELECT *, regexp_extract({_strip("coalesce(posting_url, '')")}, '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$', ['scheme', 'host', 'path', 'query']) AS u FROM postings),
urls AS (SELECT * EXCLUDE u, CASE WHEN u.scheme <> '' THEN lower(u.scheme) || ':' ELSE '' END || CASE WHEN u.host <> '' THEN '//' || lower(u.host) ELSE '' END
  || regexp_replace(u.path, '/+$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url
  FROM (SELECT *, list_transform(list_filter(list_filter(string_split(u.query, '&'), lambda p: p <> ''), lambda p: NOT starts_with(lower(url_decode({_STRAY.format(x="split_part(p, '=', 1)")})), 'utm_')
    AND lower(url_decode({_STRAY.format(x="split_part(p, '=', 1)")})) NOT IN ({_q(text.TRACKING)})),
    lambda p: {_ENC.format(x=_STRAY.format(x="split_part(p, '=', 1)"))} || '=' || {_ENC.format(x=_STRAY.format(x="CASE WHEN contains(p, '=') THEN substr(p, strpos(p, '=') + 1) ELSE '' END"))}) AS kept FROM parts))"""
_KEY = f"sha1(CASE WHEN url <> '' THEN 'url:' || url ELSE 'tcc:' || lower({_strip("coalesce(title, '')")}) || '|' || coalesce(company, '') || '|' || coalesce(country, '') END)"
_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '\([^)]*\)', ' ', 'g'), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g'))"


def _tells(x: str, names) -> str:
    return "(" + " OR ".join(f"contains({x}, '{n}')" for n in names) + ")"


def _match(place: str) -> tuple[str, str]:
    low = f"lower(coalesce({place}, ''))"
    real = [c for c in market.ALLOWED if c in text.COUNTRY_NAMES]
    named = "CASE " + " ".join(f"WHEN {_tells(low, text.COUNTRY_NAMES[c])} THEN '{c.upper()}'" for c in real) + " END"
    far = " OR ".join(_tells(low, text.REMOTE_NAMES[c]) for c in market.ALLOWED if c in text.REMOTE_NAMES)
    return f"coalesce({named}, CASE WHEN {far} THEN '{real[0].upper()}' END)", f"(({named}) IS NULL AND ({far}))"


_PLACE, _REMOTE = _match("location_raw")
_KEYWORD = _tells("lower(title)", market.KEYWORDS)
_LABELS = f"""
once AS (SELECT isco_code, lower(label) AS l, min(struct_pack(k := label_kind, label := label)) AS m FROM isco_labels GROUP BY ALL),
listed AS (SELECT isco_code, m.label AS label, row_number() OVER (ORDER BY isco_code, m.k, m.label) AS label_idx, {_CLEAN.format(x="m.label")} AS key FROM once)"""
_TOKENS = "list_distinct(string_split({x}, ' '))"


def _some(*xs: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({_strip(x)}, '')" for x in xs) + ")"


_LEVELS = "CASE " + " ".join(f"WHEN regexp_matches(coalesce({c}, ''), '{p}', 'i') THEN '{k}'" for c in ("title", "raw_payload") for k, p in dashboard.LEVELS.items()) + " END"
_HOW = "CASE " + " ".join(f"WHEN regexp_matches(coalesce({c}, ''), '{p}', 'i') THEN '{m}'" for c, m in (("title", "title"), ("raw_payload", "description")) for k, p in dashboard.LEVELS.items()) + " ELSE 'none' END"
_ARRANGED = "CASE WHEN remote THEN 'remote' " + " ".join(f"WHEN regexp_matches(coalesce({c}, ''), '{p}', 'i') THEN '{k}'" for c in ("location_raw", "title", "raw_payload") for k, p in dashboard.ARRANGEMENTS.items()) + " END"

_RULES = {
    **{f"{c} not null": f"{c} IS NULL" for c in ("posting_id", "source", "title", "country", "posted_at", "ingested_at", "posting_url")},
    "title length": "length(title) NOT BETWEEN 1 AND 500",
    "country length": "length(country) <> 2",
    **{f"{c} range": f"{c} NOT BETWEEN 0 AND 1e7" for c in ("salary_min_eur", "salary_max_eur", "salary_annual_eur_p50")},
    "salary_period values": f"salary_period NOT IN ({_q(PERIODS)})",
    "posting_url prefix": "NOT starts_with(posting_url, 'http')",
    "isco_code form": "NOT regexp_matches(isco_code, '^[0-9]{4}$')",
    "isco_match_method values": f"isco_match_method NOT IN ({_q(METHODS)})",
    "isco_match_score range": "isco_match_score NOT BETWEEN 0 AND 1",
}

_OFFICE = _some("j.location.name", "j.offices[1].location", "j.offices[1].name")
_NOTION_PLACE = _some("j->>'$.location'", "j->>'$.locationName'")
_FACTOR = "CASE lower(trim(p->>'$.interval')) " + " ".join(f"WHEN '{k}' THEN {lookup.PER_YEAR[v]}" for k, v in lookup.INTERVALS.items()) + " END"
_HOME_CUR = _case("c", lookup.CURRENCIES)

# The zones that short names stand for in the engine.
_ZONES = {"UTC": "UTC", "GMT": "UTC", "CET": "CET", "EST": "Etc/GMT+5", "PST": "America/Los_Angeles", "CST": "America/Chicago", "BST": "Asia/Dhaka"}


def _seconds(v: str) -> str:
    """Seconds since 1970 of an ISO text, with or without time and zone; null for other texts."""
    m = rf"regexp_extract({_strip(v)}, '^(\d{{4}}-\d\d-\d\d)(?:[T ](\d\d:\d\d(?::\d\d)?)(?:\.\d+)?(?: ?(Z|[+-]\d\d(?::?\d\d)?|{'|'.join(_ZONES)}))?)?$', ['d', 't', 'z'])"
    wall = f"try_cast({m}.d || ' ' || CASE length({m}.t) WHEN 0 THEN '00:00:00' WHEN 5 THEN {m}.t || ':00' ELSE {m}.t END AS TIMESTAMP)"
    off = f"CASE WHEN {m}.z IN ('', 'Z') THEN 0 ELSE (CASE {m}.z[1] WHEN '-' THEN -1 ELSE 1 END) * (CAST({m}.z[2:3] AS INT) * 3600 + CAST(coalesce(nullif(replace({m}.z, ':', '')[4:5], ''), '0') AS INT) * 60) END"
    return f"CAST(CASE WHEN {m}.z ~ '^[A-Y]' THEN epoch(timezone({_case(m + '.z', _ZONES, 'NULL')}, {wall})) ELSE epoch({wall}) - {off} END AS BIGINT)"


_NOW_S = f"CAST(epoch(TIMESTAMPTZ '{market.NOW}+00') AS BIGINT)"
_COUNTED = "coded AS (SELECT *, CAST(year(posted_at) AS VARCHAR) AS y FROM postings WHERE isco_code IS NOT NULL AND posted_at IS NOT NULL)"
_BUCKET = "CASE WHEN substr(isco_code, 1, 1) IN ('1', '2', '3') THEN '1' WHEN substr(isco_code, 1, 1) IN ('4', '5') THEN '2' WHEN substr(isco_code, 1, 1) IN ('6', '7', '8', '9') THEN '3' END"

SQL = {
    "fx_convert": f"SELECT posting_id, lo AS salary_min_eur, hi AS salary_max_eur, mid AS salary_annual_eur_p50 FROM ({_EUROS})",
    "fx_unresolved": f"SELECT array_to_string(list_sort(list(DISTINCT coalesce({_CUR}, '?'))), ',') AS currencies, count(*) AS n_rows FROM postings WHERE coalesce({_CUR}, '?') NOT IN ('EUR', 'GBP')",
    "midpoint": "SELECT posting_id, (salary_min_eur + salary_max_eur) / 2 AS salary_annual_eur_p50 FROM postings",
    "recency_floor": f"SELECT posting_id, posted_at FROM postings WHERE posted_at >= TIMESTAMPTZ '{market.NOW}+00' - INTERVAL 180 DAY",
    "normalised": f"WITH {_URLS}, keyed AS (SELECT *, {_KEY} AS k FROM urls WHERE posted_at >= TIMESTAMPTZ '{market.NOW}+00' - INTERVAL 180 DAY) "
    f"SELECT posting_id, posting_url, (k.salary_min_eur / r.rate + k.salary_max_eur / r.rate) / 2 AS salary_annual_eur_p50 FROM (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY ingested_at, posting_id) = 1) k LEFT JOIN {_RATES} r ON r.currency = {_CUR}",
    "benchmark_fx": f"WITH {_BENCH} SELECT isco_code, country, 'EUR' AS currency, median_eur / r.rate AS median_eur FROM bench JOIN {_RATES} r ON r.currency = {_CUR} WHERE r.currency <> 'SGD'",
    "benchmark_overlay": f"WITH {_BENCH} SELECT posting_id, p.isco_code, p.country, b.median_eur AS own_median_eur FROM postings p LEFT JOIN bench b ON p.isco_code = b.isco_code AND p.country = b.country",
    "year_month": "SELECT posting_id, strftime(posted_at, '%Y-%m') AS year_month FROM postings",
    "dashboard_extract": f"{_DASH} SELECT * FROM dash",
    "filter_global": f"{_CHOSEN} SELECT title, company, salary_annual_eur_p50 FROM chosen WHERE isco_major = '1'",
    "distinct_country": f"{_DASH} SELECT DISTINCT country FROM dash WHERE country IS NOT NULL",
    "distinct_major": f"{_DASH} SELECT DISTINCT isco_major FROM dash WHERE isco_major IS NOT NULL",
    "date_span": f"{_DASH} SELECT min(posted_at) AS first_posted, max(posted_at) AS last_posted FROM dash",
    "live_kpi": f"{_DASH} SELECT count(*)::INT AS n_postings, count(salary_annual_eur_p50)::INT AS n_salary, count(isco_code)::INT AS n_isco FROM dash",
    "salary_rows": f"{_DASH} SELECT salary_annual_eur_p50 FROM dash WHERE salary_annual_eur_p50 IS NOT NULL",
    "salary_histogram": f"{_DASH} SELECT CAST(floor(salary_annual_eur_p50 / 10000) AS INT) AS bin, count(*) AS n FROM dash WHERE salary_annual_eur_p50 >= 0 AND salary_annual_eur_p50 < 240000 GROUP BY 1",
    "median_by_country": f"{_DASH} SELECT country, quantile_cont(salary_annual_eur_p50, 0.5) AS p50, count(salary_annual_eur_p50)::INT AS n FROM dash WHERE country IS NOT NULL AND (salary_annual_eur_p50 IS NULL OR salary_annual_eur_p50 BETWEEN 0 AND 250000) GROUP BY 1",
    "top_titles": f"{_DASH} SELECT title, count(*) AS n FROM dash WHERE title IS NOT NULL GROUP BY 1 ORDER BY n DESC, title LIMIT 15",
    "isco_mix": f"{_DASH} SELECT coalesce(isco_major, '∅') AS isco_major, count(*) AS n FROM dash GROUP BY 1",
    "isco_labelled": f"{_DASH} SELECT CASE WHEN isco_major IS NULL THEN 'Unclassified' ELSE {_case('isco_major', lookup.MAJORS, "'ISCO ' || isco_major")} END AS major, n FROM (SELECT isco_major, count(*) AS n FROM dash GROUP BY 1)",
    "heatmap_having": f"{_DASH} SELECT country, isco_major, quantile_cont(salary_annual_eur_p50, 0.5) AS p50, count(*)::INT AS n FROM dash WHERE country IS NOT NULL AND isco_major IS NOT NULL AND salary_annual_eur_p50 IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3",
    "weekly_cadence": f"{_DASH} SELECT date_trunc('week', posted_at)::DATE AS week, count(*)::INT AS n FROM dash WHERE posted_at IS NOT NULL GROUP BY 1",
    "source_counts": f"{_DASH} SELECT source, count(*) AS n FROM dash GROUP BY 1",
    "coverage": f"{_DASH} SELECT round(100 * count(salary_annual_eur_p50) / count(*))::INT AS pct_salary, round(100 * count(isco_code) / count(*))::INT AS pct_isco, round(100 * count(*) FILTER (coalesce(isco_match_method, 'none') <> 'none') / count(*))::INT AS pct_method FROM dash",
    "manifest_counts": " UNION ALL ".join(f"SELECT '{k}' AS kind, {k} AS value, count(*) AS n FROM postings WHERE {k} IS NOT NULL GROUP BY {k}" for k in ("source", "country", "isco_match_method")),
    "match_rate": "SELECT count(isco_code) AS matched, count(*) AS total, round(count(isco_code) / count(*), 6) AS share FROM postings",
    "validate_counts": " UNION ALL ".join([*(f"SELECT '{n}' AS rule, count(*) FILTER ({c}) AS n_rows FROM postings" for n, c in _RULES.items()), "SELECT 'posting_id unique', count(*) - count(DISTINCT posting_id) FROM postings"]),
    "canonical_url": f"WITH {_URLS} SELECT posting_id, url FROM urls",
    "dedupe_keys": f"WITH {_URLS} SELECT posting_id, {_KEY} AS dedupe_key FROM urls",
    "dedupe_keep_first": f"WITH {_URLS}, keyed AS (SELECT *, {_KEY} AS k FROM urls) SELECT posting_id, ingested_at FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY ingested_at, posting_id) = 1",
    "keep_first_id": "SELECT posting_id, title, ingested_at FROM postings QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY ingested_at, title) = 1",
    "posting_id_sha1": "SELECT id, slug, sha1('lever:' || coalesce(slug, '') || ':' || coalesce(id, '')) AS posting_id FROM postings_palantir",
    "title_clean": f"SELECT posting_id, {_CLEAN.format(x='title')} AS title FROM postings",
    "keyword_filter": f"SELECT posting_id, title FROM postings WHERE {_KEYWORD}",
    "match_country": f"SELECT posting_id, location_raw, {_PLACE} AS matched, {_REMOTE} AS remote FROM postings",
    "token_subset_match": f"WITH {_LABELS}, titles AS (SELECT DISTINCT {_CLEAN.format(x='title')} AS key FROM postings) SELECT t.key, l.label FROM titles t, listed l WHERE t.key <> '' AND l.key <> '' AND (list_has_all({_TOKENS.format(x='t.key')}, {_TOKENS.format(x='l.key')}) OR list_has_all({_TOKENS.format(x='l.key')}, {_TOKENS.format(x='t.key')}))",
    "label_order": f"WITH {_LABELS} SELECT isco_code, label, label_idx FROM listed WHERE key <> ''",
    "label_stats": "SELECT count(*) AS n_labels, count(DISTINCT isco_code) AS n_codes, count(*) FILTER (label_kind = 'preferred') AS n_preferred, count(*) FILTER (NOT regexp_matches(isco_code, '^[0-9]{4}$')) AS n_bad FROM isco_labels",
    "wage_buckets": "SELECT DISTINCT isco_code, CASE WHEN substr(isco_code, 1, 1) IN ('1', '2', '3') THEN '1' WHEN substr(isco_code, 1, 1) IN ('4', '5') THEN '2' WHEN substr(isco_code, 1, 1) IN ('6', '7', '8', '9') THEN '3' END AS bucket FROM isco_labels",
    "search_rows": f"WITH r AS (SELECT slug, unnest(results) AS r FROM search_page1) SELECT DISTINCT sha1('adzuna:' || r.id) AS posting_id, {_strip('r.title')} AS title, r.company.display_name AS company, upper(regexp_extract(slug, '([a-z]{{2}})$', 1)) AS country, r.salary_min AS salary_min_eur, (r.salary_min + r.salary_max) / 2 AS salary_annual_eur_p50, try_cast(r.salary_is_predicted AS INT) <> 0 AS salary_imputed, r.redirect_url AS posting_url, {_seconds('r.created')} AS posted_s FROM r WHERE {_strip('r.id')} <> '' AND starts_with(r.redirect_url, 'http')",
    "intercom_rows": f"WITH j AS (SELECT slug, unnest(jobs) AS j FROM board_intercom), p AS (SELECT slug, j, {_OFFICE} AS location_raw FROM j WHERE j.id IS NOT NULL), m AS (SELECT *, {_PLACE} AS country, {_REMOTE} AS remote FROM p) SELECT DISTINCT sha1('greenhouse:' || coalesce(slug, '') || ':' || j.id) AS posting_id, j.title AS title, location_raw, country, remote, j.absolute_url AS posting_url, coalesce({_seconds('j.updated_at')}, {_NOW_S}) AS posted_s FROM m WHERE country IS NOT NULL AND starts_with(j.absolute_url, 'http') AND {_tells('lower(j.title)', market.KEYWORDS)}",
    "palantir_rows": f"WITH p AS (SELECT *, categories.location AS location_raw, coalesce(nullif(hostedUrl, ''), applyUrl) AS posting_url FROM postings_palantir WHERE {_strip('id')} <> ''), m AS (SELECT *, {_PLACE} AS country, {_REMOTE} AS remote FROM p) SELECT DISTINCT sha1('lever:' || coalesce(slug, '') || ':' || id) AS posting_id, text AS title, location_raw, country, remote, posting_url, coalesce(CAST(floor(try_cast(CASE WHEN regexp_full_match({_strip('createdAt')}, '[0-9]+') THEN {_strip('createdAt')} END AS BIGINT) / 1000) AS BIGINT), {_seconds('createdAt')}, {_NOW_S}) AS posted_s FROM m WHERE country IS NOT NULL AND starts_with(posting_url, 'http')",
    "notion_rows": f"""WITH {JOBS_SQL}, o AS (SELECT slug, j, {_NOTION_PLACE} AS location_raw, {unwrapped_sql("json_extract(j, '$.compensation')")} AS pay FROM jobs WHERE json_type(j) = 'OBJECT' AND {_strip("j->>'$.id'")} <> ''),
      m AS (SELECT *, {_PLACE} AS c, {_REMOTE} AS far FROM o), t AS (SELECT *, {items_sql("json_extract(pay, '$.compensationTiers')")} AS tiers FROM m WHERE c IS NOT NULL AND starts_with(j->>'$.jobUrl', 'http')),
      p AS (SELECT * EXCLUDE tiers, flatten(list_transform(tiers, lambda t: {items_sql("json_extract(t, '$.components')")})) AS parts FROM t),
      f AS (SELECT *, list_filter(parts, lambda p: lower(trim(p->>'$.componentType')) IN ('salary', 'base salary') AND upper(p->>'$.currencyCode') = {_HOME_CUR} AND {_FACTOR} IS NOT NULL AND try_cast(p->>'$.minValue' AS DOUBLE) IS NOT NULL AND try_cast(p->>'$.maxValue' AS DOUBLE) IS NOT NULL)[1] AS p FROM p)
      SELECT DISTINCT sha1('ashby:' || coalesce(slug, '') || ':' || (j->>'$.id')) AS posting_id, j->>'$.title' AS title, c AS country, coalesce(try_cast(j->>'$.isRemote' AS BOOLEAN), false) OR far AS remote,
        try_cast(p->>'$.minValue' AS DOUBLE) * {_FACTOR} AS salary_min_eur, try_cast(p->>'$.maxValue' AS DOUBLE) * {_FACTOR} AS salary_max_eur, CASE WHEN p IS NOT NULL THEN false END AS salary_imputed, coalesce({_seconds("j->>'$.publishedAt'")}, {_seconds("j->>'$.updatedAt'")}, {_NOW_S}) AS posted_s FROM f""",
    "union_by_name": "SELECT slug, text AS title, hostedUrl AS url FROM postings_palantir UNION ALL BY NAME SELECT slug, j.title AS title, j.location.name AS place FROM (SELECT slug, unnest(jobs) AS j FROM board_intercom)",
    "redaction": r"""SELECT posting_id, regexp_replace(posting_url || '&app_id=abc&APP_KEY=x''y', '(?i)\b(app_id|app_key|api_key|api-key)=[^&\s''"]+', '\1=REDACTED', 'g') AS url FROM postings""",
    "cube_decode": "SELECT country, substr(isco_code, 1, 1) AS major, CAST(year(posted_at) AS VARCHAR) AS year, count(*) AS n FROM postings WHERE isco_code IS NOT NULL GROUP BY ALL",
    "history_first_last_seen": "SELECT posting_id, min(delivered_at) AS first_seen_at, max(delivered_at) AS last_seen_at, max(struct_pack(d := delivered_at, t := title, c := country)).t AS title, max(struct_pack(d := delivered_at, t := title, c := country)).c AS country FROM posting_snapshots WHERE posting_id IS NOT NULL AND delivered_at IS NOT NULL GROUP BY 1",
    "closed_postings": "SELECT posting_id FROM posting_snapshots WHERE posting_id IS NOT NULL GROUP BY 1 HAVING max(delivered_at) < (SELECT CAST(max(snapshot_date) || ' 00:00:00+00' AS TIMESTAMPTZ) FROM posting_snapshots)",
    "new_since_previous": "WITH days AS (SELECT DISTINCT snapshot_date AS day FROM posting_snapshots ORDER BY 1 DESC LIMIT 2) SELECT DISTINCT posting_id FROM posting_snapshots WHERE snapshot_date = (SELECT max(day) FROM days) AND posting_id NOT IN (SELECT posting_id FROM posting_snapshots WHERE snapshot_date = (SELECT min(day) FROM days))",
    "experience_level": f"SELECT posting_id, {_LEVELS} AS experience_level, {_HOW} AS experience_method FROM postings",
    "work_arrangement": f"SELECT posting_id, {_ARRANGED} AS work_arrangement FROM postings",
    "skill_pay": "WITH s AS (SELECT unnest([" + _q(market.SKILLS) + "]) AS skill) SELECT skill, quantile_cont(salary_annual_eur_p50, 0.5) AS p50, count(*) AS n FROM postings, s WHERE salary_annual_eur_p50 IS NOT NULL AND regexp_matches(lower(raw_payload), '(^|[^\\p{L}\\p{N}])' || skill || '($|[^\\p{L}\\p{N}])') GROUP BY 1",
    "concept_walk": "SELECT isco_code, label, label_kind FROM isco_labels WHERE regexp_full_match(isco_code, '[0-9]{4}') AND trim(label) <> '' AND label_kind IN ('preferred', 'alt') QUALIFY row_number() OVER (PARTITION BY isco_code, lower(label) ORDER BY label_kind, label) = 1",
    "cso_rows": f"WITH {_COUNTED}, q AS (SELECT y || quarter(posted_at) AS period, {_BUCKET} AS bucket FROM coded), n AS (SELECT bucket, period, count(*) AS n FROM q WHERE period = (SELECT max(period) FROM q) GROUP BY ALL) SELECT isco_code, 'IE' AS country, period, 'EUR' AS currency, n * 52.0 AS median_eur, 'cso' AS source FROM (SELECT DISTINCT isco_code, {_BUCKET} AS bucket FROM isco_labels) JOIN n USING (bucket)",
    "eurostat_rows": f"WITH {_COUNTED} SELECT isco_code, country, y AS period, 'EUR' AS currency, CAST(count(*) AS DOUBLE) AS median_eur, 'eurostat' AS source FROM coded WHERE y = (SELECT max(y) FROM coded WHERE country IS NOT NULL) AND lower(country) IN ({_q([c for c in market.ALLOWED if len(c) == 2])}) AND regexp_full_match(isco_code, '[0-9]{{4}}') GROUP BY ALL",
    "oecd_rows": f"WITH {_COUNTED}, c AS (SELECT isco_code, country, y, {_CUR} AS cur, count(*) AS n FROM coded WHERE country IS NOT NULL GROUP BY ALL) SELECT isco_code, country, y AS period, 'EUR' AS currency, round(n / CASE cur WHEN 'EUR' THEN 1.0 ELSE r.rate END, 6) AS median_eur, 'oecd' AS source FROM c LEFT JOIN {_RATES} r ON r.currency = cur WHERE cur IS NOT NULL AND (cur = 'EUR' OR r.rate > 0) AND regexp_full_match(isco_code, '[0-9]{{4}}')",
    "prebaked": f"{_DASH} SELECT country, isco_major, date_trunc('week', posted_at)::DATE AS week, count(*) AS n, count(salary_annual_eur_p50) AS n_salary, round(sum(salary_annual_eur_p50), 2) AS sum_salary FROM dash GROUP BY ALL",
}
