"""Queries of the general (not llm) problems over the tables of a data folder, with their SQL where SQL can say it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.operators import instants
from vacantia.operators import nested_tables as nt
from vacantia.operators import units
from vacantia.operators.snapshot_diff import posting_changes
from vacantia.runtime import cut_lineage, table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """snapshot_date, posting_id, change of every consecutive pair of snapshots."""
    return posting_changes(table(spark, d, "posting_snapshots"))


def _trees(spark: SparkSession, d: str, whole: bool = True) -> DataFrame:
    return nt.board_trees(table(spark, d, "board_notion"), table(spark, d, "board_intercom"), whole)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Tiers, components, offices and departments of all boards, linked to envelope, job and parent."""
    return nt.flat_children(_trees(spark, d, whole=False))


def p2_objects(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct object of the boards, once."""
    return nt.objects(_trees(spark, d))


def p2_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Links from distinct objects to their children."""
    return nt.bridge(_trees(spark, d))


def p2_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """The topmost object of every envelope."""
    return nt.occurrences(_trees(spark, d))


def p2_jobs(spark: SparkSession, d: str) -> DataFrame:
    """board, envelope_id, n_jobs: jobs that are reached from each envelope's topmost object by the bridges."""
    trees = cut_lineage(_trees(spark, d))
    links = nt.bridge(trees).filter("path = 'jobs'").select(F.col("parent_hash").alias("hash"), F.greatest("ordinal", F.lit(0)).alias("job_no"))
    return nt.occurrences(trees).join(links, "hash").select("board", "envelope_id", "job_no").distinct().groupBy("board", "envelope_id").agg(F.count("*").alias("n_jobs"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """source_table, record_id, epoch_us of everything dated in the four sources."""
    return instants.record_instants(spark, d)


def p6_units(spark: SparkSession, d: str) -> DataFrame:
    """Every recorded bound with its unit, stated or inferred with its posterior, in euros per year."""
    return units.salary_units(table(spark, d, "postings"), table(spark, d, "fx_rates"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """posting_id, bound, eur_per_year of the bounds whose period is stated and that aren't plain euros a year."""
    plain = "currency = 'EUR' AND period = 'annual' AND scale = 1.0"
    return p6_units(spark, d).filter(f"stated AND eur_per_year IS NOT NULL AND NOT ({plain})").select("posting_id", "bound", "eur_per_year")


QUERIES = {"p6_found": p6_found, "p6_units": p6_units, "p5_found": p5_found, "p2_found": p2_found, "p2_objects": p2_objects, "p2_bridge": p2_bridge, "p2_occurrences": p2_occurrences, "p2_jobs": p2_jobs, "p4_found": p4_found}

#: White space as in ``vacantia.runtime.BLANKS``, in DuckDB's notation.
_WS = r"[\t\n\v\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def unwrapped_sql(x: str) -> str:
    return rf"""CASE WHEN json_type({x}) = 'VARCHAR' AND regexp_matches({x}->>'$', '^\s*[\[{{]') AND json_valid({x}->>'$') THEN CAST({x}->>'$' AS JSON) ELSE {x} END"""


def items_sql(x: str) -> str:
    """A JSON value as list of JSON, one object standing for a list of one; in DuckDB."""
    return f"CASE json_type({unwrapped_sql(x)}) WHEN 'ARRAY' THEN CAST({unwrapped_sql(x)} AS JSON[]) WHEN 'OBJECT' THEN [{unwrapped_sql(x)}] ELSE CAST([] AS JSON[]) END"


def _numbered(source: str, keys: str, values: str, no: str, to: str) -> str:
    """``source`` with each element of the list ``values`` as ``to`` and its position as ``no``."""
    return f"SELECT {keys}, unnest(range(len({values}))) AS {no}, unnest({values}) AS {to} FROM {source}"


JOBS_SQL = f"""
envelopes AS (SELECT DISTINCT envelope_id, slug, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS p FROM board_notion),
lists AS (SELECT envelope_id, slug, {items_sql("json_extract(p, '$.jobs')")} AS jobs FROM envelopes),
jobs AS ({_numbered("lists", "envelope_id, slug", "jobs", "job_no", "j")})"""

_P2 = f"""
WITH {JOBS_SQL},
pay AS (SELECT envelope_id, job_no, {unwrapped_sql("json_extract(j, '$.compensation')")} AS c FROM jobs),
tier_lists AS (SELECT envelope_id, job_no, {items_sql("json_extract(c, '$.compensationTiers')")} AS tiers FROM pay),
tiers AS (SELECT envelope_id, job_no, tier_no, {unwrapped_sql("t")} AS t FROM ({_numbered("tier_lists", "envelope_id, job_no", "tiers", "tier_no", "t")})),
part_lists AS (SELECT envelope_id, job_no, tier_no, {items_sql("json_extract(t, '$.components')")} AS parts FROM tiers WHERE json_type(t) = 'OBJECT'),
parts AS (SELECT envelope_id, job_no, tier_no, part_no, {unwrapped_sql("c")} AS c FROM ({_numbered("part_lists", "envelope_id, job_no, tier_no", "parts", "part_no", "c")})),
inter AS (SELECT DISTINCT envelope_id, jobs FROM board_intercom),
ij AS ({_numbered("inter", "envelope_id", "jobs", "job_no", "j")}),
offices AS ({_numbered("ij", "envelope_id, job_no", "j.offices", "no", "o")}),
departments AS ({_numbered("ij", "envelope_id, job_no", "j.departments", "no", "o")})
SELECT DISTINCT * FROM (
  SELECT 'board_notion' AS board, envelope_id, CAST(job_no AS INT) AS job_no, 'tier' AS child, CAST(tier_no AS INT) AS child_no, -1 AS component_no, coalesce(t->>'$.tierSummary', '') AS item FROM tiers WHERE json_type(t) = 'OBJECT'
  UNION ALL
  SELECT 'board_notion', envelope_id, CAST(job_no AS INT), 'component', CAST(tier_no AS INT), CAST(part_no AS INT), coalesce(c->>'$.componentType', '') FROM parts WHERE json_type(c) = 'OBJECT'
  UNION ALL
  SELECT 'board_intercom', envelope_id, CAST(job_no AS INT), 'office', CAST(no AS INT), -1, coalesce(o.location, '') FROM offices WHERE o IS NOT NULL
  UNION ALL
  SELECT 'board_intercom', envelope_id, CAST(job_no AS INT), 'department', CAST(no AS INT), -1, coalesce(o.name, '') FROM departments WHERE o IS NOT NULL
)"""

_GROUPS = re.findall(r"\(\?<(\w+)>", instants.PATTERN)


def _first_of(*groups: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(g.{x}, '')" for x in groups) + ")"


def _part(name: str, kind: str = "BIGINT") -> str:
    return f"CAST({_first_of(*instants.PARTS[name], *instants.PARTS[name][:1])} AS {kind})"


_CASES = " ".join(f"WHEN '{k.lower()}' THEN {v}" for k, v in instants.ABBREVIATIONS.items() if k != "IST")
_MONTH = "CASE lower(" + _part("n", "VARCHAR") + "[:3]) " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(instants.MONTHS, 1)) + " END"

_P5 = f"""
WITH {JOBS_SQL},
rows AS (
  SELECT 'postings_palantir' AS source_table, id AS record_id, slug, createdAt AS v FROM postings_palantir
  UNION ALL SELECT 'board_notion', j->>'$.id', slug, j->>'$.publishedAt' FROM jobs
  UNION ALL SELECT 'board_intercom', CAST(j.id AS VARCHAR), slug, j.updated_at FROM (SELECT slug, unnest(jobs) AS j FROM board_intercom)
  UNION ALL SELECT 'search_page1', r.id, slug, r.created FROM (SELECT slug, unnest(results) AS r FROM search_page1)
), found AS (
  SELECT source_table, record_id, zone, day_first, regexp_extract(regexp_replace(v, '^{_WS}+|{_WS}+$', '', 'g'), '{instants.PATTERN.replace("(?<", "(?P<")}', {_GROUPS}) AS g
  FROM rows JOIN board_zones USING (slug) WHERE trim(record_id) <> '' AND v IS NOT NULL
), parts AS (
  SELECT source_table, record_id, {_part("nu")} AS nu, {_part("nf", "VARCHAR")} AS nf, {_part("y")} AS y,
    coalesce({_part("m")}, {_MONTH}, CASE WHEN day_first THEN {_part("q")} ELSE {_part("p")} END) AS m,
    coalesce({_part("d")}, CASE WHEN day_first THEN {_part("p")} ELSE {_part("q")} END) AS d,
    coalesce({_part("h")}, 0) AS h, coalesce({_part("i")}, 0) AS i, coalesce({_part("s")}, 0) AS s,
    CAST(rpad(coalesce({_part("f", "VARCHAR")}, '')[:6], 6, '0') AS BIGINT) AS f, lower({_part("ap", "VARCHAR")}) AS ap,
    {_part("os", "VARCHAR")} AS os, {_part("oh")} AS oh, coalesce({_part("om")}, 0) AS om, lower({_part("ab", "VARCHAR")}) AS ab,
    coalesce({_part("rg", "VARCHAR")}, zone) AS wall, zone
  FROM found
), placed AS (
  SELECT *, CASE WHEN os IS NOT NULL THEN (CASE os WHEN '-' THEN -1 ELSE 1 END) * (oh * 60 + om)
      WHEN ab = 'ist' THEN CASE zone WHEN 'Europe/Dublin' THEN 60 ELSE 330 END ELSE CASE ab {_CASES} END END AS minutes,
    CASE WHEN ap IS NULL THEN h WHEN h BETWEEN 1 AND 12 THEN h % 12 + CASE ap WHEN 'pm' THEN 12 ELSE 0 END END AS hour
  FROM parts
), walls AS (
  SELECT *, CASE WHEN d <= day(last_day(make_date(CASE WHEN y >= 1 AND m BETWEEN 1 AND 12 THEN y END, CASE WHEN m BETWEEN 1 AND 12 THEN m END, 1))) AND d >= 1 AND hour <= 23 AND i <= 59 AND s <= 59
    THEN epoch_us(make_date(y, m, 1)) + ((d - 1) * 86400 + hour * 3600 + i * 60 + s) * 1000000 + f END AS local
  FROM placed
), offsets AS (
  SELECT *, local - (epoch_us(timezone(wall, to_timestamp((local - 86400000000) // 1000000))) - (local - 86400000000) // 1000000 * 1000000) AS before,
    local - (epoch_us(timezone(wall, to_timestamp((local + 86400000000) // 1000000))) - (local + 86400000000) // 1000000 * 1000000) AS after
  FROM walls
), done AS (
  SELECT source_table, record_id, CASE
    WHEN nu IS NOT NULL THEN CASE WHEN abs(nu) < 100000000000 THEN nu * 1000000 + CAST(rpad(coalesce(nf, '')[:6], 6, '0') AS BIGINT)
      WHEN abs(nu) < 100000000000000 THEN nu * 1000 + CAST(rpad(coalesce(nf, '')[:3], 3, '0') AS BIGINT) WHEN abs(nu) < 100000000000000000 THEN nu END
    WHEN os IS NOT NULL OR ab IS NOT NULL THEN local - minutes * 60000000
    WHEN epoch_us(timezone(wall, make_timestamptz(before))) = local THEN before
    WHEN epoch_us(timezone(wall, make_timestamptz(after))) = local THEN after ELSE before END AS epoch_us
  FROM offsets
)
SELECT DISTINCT source_table, record_id, epoch_us FROM done WHERE epoch_us IS NOT NULL"""

SQL = {
    "p2_found": _P2,
    "p2_jobs": f"""WITH {JOBS_SQL}, every AS (
  SELECT 'board_notion' AS board, envelope_id, job_no FROM (SELECT *, {unwrapped_sql("j")} AS o FROM jobs) WHERE json_type(o) = 'OBJECT'
  UNION SELECT 'board_intercom', envelope_id, job_no FROM ({_numbered("board_intercom", "envelope_id", "jobs", "job_no", "j")}) WHERE j IS NOT NULL)
SELECT board, envelope_id, count(*) AS n_jobs FROM every GROUP BY ALL""",
    "p5_found": _P5,
    "p4_found": rf"""
WITH newest AS (
  SELECT snapshot_date, posting_id, arg_max(struct_pack(t := title, s := salary_annual_eur_p50), delivered_at) AS v
  FROM posting_snapshots WHERE posting_id IS NOT NULL AND snapshot_date IS NOT NULL GROUP BY ALL
), rows AS (
  SELECT snapshot_date, posting_id, trim(regexp_replace(v.t, '{_WS}+', ' ', 'g')) AS title, round(v.s * 100) AS cents FROM newest
), days AS (
  SELECT snapshot_date AS this, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS next FROM (SELECT DISTINCT snapshot_date FROM rows)
), new AS (
  SELECT rows.* FROM rows JOIN days ON snapshot_date = next
), old AS (
  SELECT next AS snapshot_date, posting_id, title, cents FROM rows JOIN days ON snapshot_date = this WHERE next IS NOT NULL
)
SELECT coalesce(n.snapshot_date, o.snapshot_date) AS snapshot_date, coalesce(n.posting_id, o.posting_id) AS posting_id,
       CASE WHEN o.posting_id IS NULL THEN 'added' WHEN n.posting_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM new n FULL JOIN old o ON n.snapshot_date = o.snapshot_date AND n.posting_id = o.posting_id
WHERE n.posting_id IS NULL OR o.posting_id IS NULL OR n.title IS DISTINCT FROM o.title OR n.cents IS DISTINCT FROM o.cents""",
}
