"""Problem 7: freely typed titles mapped to the entries of a label list, in SQL only.

Method: a partition-based pigeonhole join. A label that may differ by k edits is cut into k + 1 segments; any
string within k edits contains one of them unchanged, near its place. Labels and titles meet by equality of
such substrings (with the label's length and the segment's number), candidates are verified with the built-in
levenshtein, and titles left over are reported through an anti-join. A typed title is split at its separators
into phrases, and a phrase must match a label as a whole: seniority, subject and team are phrases of their own,
so that a glacier guide is no glazier. Of phrases parted by commas the first counts, and neighbours count
together, in the orders in which names are inverted ("Guide, Glacier"), so that neither is one alone.

Distinct titles are matched, not postings. A title may be that of very many postings, so results return to
postings through a salt: each title carries the shares of postings (of ``SALTS``) in which it occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SALTS = 16
# Words of seniority and of advertising, which say nothing on the occupation.
SENIORITY = ("senior", "sr", "snr", "junior", "jr", "jnr", "lead", "graduate", "grad", "principal", "princ")
IDLE = ("ref", "new", "the")
# Abbreviations of words in occupations.
ABBREVIATIONS = {
    "eng": "engineer", "engr": "engineer", "mgr": "manager", "mngr": "manager", "tech": "technician", "techn": "technician", "spec": "specialist",
    "admin": "administrator", "dev": "developer", "devel": "developer", "op": "operator", "coord": "coordinator", "rep": "representative", "repr": "representative",
    "asst": "assistant", "arch": "architect", "acct": "accountant",
}
# Letters with marks and the plain letters read for them.
MARKED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿßąćęłńśźż", "aaaaaaceeeeiiiinoooooouuuuyysacelnszz"


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_FULL = "map(" + ", ".join(f"'{a}', '{b}'" for a, b in ABBREVIATIONS.items()) + ")"


def words_sql(text: str, drop: tuple[str, ...] = (*SENIORITY, *IDLE)) -> str:
    """The words of a lower-case SQL text as an array: abbreviations written out, ``drop`` left out."""
    kept = f"w NOT IN ({_quoted(drop)})" if drop else "w <> ''"
    return rf"filter(transform(regexp_extract_all({text}, '\\p{{L}}+', 0), w -> coalesce(try_element_at({_FULL}, w), w)), w -> {kept})"


def plain_sql(text: str) -> str:
    """A SQL text with joined words parted at their capitals, in plain lower-case letters."""
    return rf"translate(lower(regexp_replace({text}, '(?<=\\p{{Ll}})(?=\\p{{Lu}})', ' ')), '{MARKED}', '{PLAIN}')"


#: Most edits allowed, by the label's length; 'chef' and its like also pass with two letters swapped.
_ALLOWED = "CASE WHEN n <= 5 THEN 1 WHEN n <= 11 THEN 2 WHEN n <= 15 THEN 3 ELSE 4 END"

_MATCHES = rf"""
WITH labels AS (
  SELECT isco_code, label, label_kind, key, length(key) AS n
  FROM (SELECT isco_code, label, label_kind, array_join({words_sql(plain_sql("label"), ())}, '') AS key FROM @labels@ WHERE isco_code IS NOT NULL AND label IS NOT NULL)
  WHERE key <> ''
), allowed AS (
  SELECT *, {_ALLOWED} AS most, greatest({_ALLOWED}, least(2, n - 1)) AS k FROM labels
), pieces AS (
  SELECT isco_code, label, label_kind, key AS lkey, n, most, k, i, substring(key, CAST(n * i DIV (k + 1) AS INT) + 1, CAST(n * (i + 1) DIV (k + 1) - n * i DIV (k + 1) AS INT)) AS piece
  FROM (SELECT *, explode(sequence(0, k)) AS i FROM allowed)
), lengths AS (SELECT DISTINCT n, k FROM allowed),
typed AS (
  SELECT title, collect_set(salt) AS salts
  FROM (SELECT title, pmod(xxhash64(posting_id), {SALTS}) AS salt FROM @postings@ WHERE isco_code IS NULL AND title IS NOT NULL) GROUP BY title
), chunks AS (
  SELECT title, explode(split({plain_sql("title")}, '[\\s ]+[-–—]+|[-–—]+[\\s ]+|[–—:|/;()\\[\\]{{}}#*0-9]+')) AS chunk FROM typed
), phrases AS (
  SELECT title, filter(transform(split(chunk, ','), p -> array_join({words_sql("p")}, '')), p -> p <> '') AS p FROM chunks
), keys AS (
  SELECT DISTINCT title, explode(concat(slice(p, 1, 1), flatten(transform(sequence(1, size(p)), i -> filter(array(
    concat(get(p, i), get(p, i - 1)), concat(get(p, i - 1), get(p, i)),
    concat(get(p, i + 1), get(p, i - 1), get(p, i)), concat(get(p, i - 1), get(p, i), get(p, i + 1))), k -> k IS NOT NULL))))) AS key
  FROM phrases WHERE size(p) > 0
), probes AS (
  SELECT key, n, k, i, substring(key, CAST(n * i DIV (k + 1) AS INT) + 1 + d, CAST(n * (i + 1) DIV (k + 1) - n * i DIV (k + 1) AS INT)) AS piece
  FROM (
    SELECT key, n, k, i, explode(sequence(greatest(-i, length(key) - n - (k - i)), least(i, length(key) - n + (k - i)))) AS d
    FROM (SELECT key, n, k, explode(sequence(0, k)) AS i FROM (
      SELECT key, n, k FROM (SELECT key, explode(sequence(greatest(length(key) - 4, 1), length(key) + 4)) AS n FROM (SELECT DISTINCT key FROM keys)) JOIN lengths USING (n) WHERE abs(length(key) - n) <= k))
    WHERE greatest(-i, length(key) - n - (k - i)) <= least(i, length(key) - n + (k - i))
  ) WHERE CAST(n * i DIV (k + 1) AS INT) + 1 + d >= 1
), met AS (
  SELECT DISTINCT probes.key, lkey, most, isco_code, label, label_kind, pieces.n
  FROM probes JOIN pieces ON probes.n = pieces.n AND probes.i = pieces.i AND probes.piece = pieces.piece
), verified AS (
  SELECT *, levenshtein(key, lkey, 4) AS d FROM met
), good AS (
  SELECT key, min(struct(d, -n, label_kind = 'alt', isco_code, label)) AS best
  FROM verified WHERE d BETWEEN 0 AND most OR (d = 2 AND n <= 5 AND array_sort(split(key, '')) = array_sort(split(lkey, ''))) GROUP BY key
), found AS (
  SELECT title, min(best) AS best FROM keys JOIN good USING (key) GROUP BY title
)
SELECT title, explode(salts) AS salt, best.isco_code AS isco_code, best.label AS label, round(1 + best.d / best.col2, 4) AS isco_match_score
FROM found JOIN typed USING (title)"""

_TOLD = f"""
SELECT posting_id, m.isco_code, label, isco_match_score
FROM @postings@ p JOIN @matches@ m ON p.title = m.title AND pmod(xxhash64(p.posting_id), {SALTS}) = m.salt
WHERE p.isco_code IS NULL
UNION ALL
SELECT posting_id, 'none', CAST(NULL AS STRING), CAST(0.0 AS DOUBLE)
FROM @postings@ p LEFT ANTI JOIN @matches@ m ON p.title = m.title AND pmod(xxhash64(p.posting_id), {SALTS}) = m.salt
WHERE p.isco_code IS NULL"""


def _with_tables(text: str) -> str:
    """The SQL text for ``spark.sql`` with its tables as parameters; other braces are the text's own."""
    doubled = text.replace("{", "{{").replace("}", "}}")
    for name in ("labels", "postings", "matches"):
        doubled = doubled.replace(f"@{name}@", "{" + name + "}")
    return doubled


def match_titles(spark: SparkSession, postings: DataFrame, labels: DataFrame) -> DataFrame:
    """posting_id, isco_code, label, isco_match_score of every posting without isco_code, distinct.

    isco_code is 'none' where no label names the occupation, with score 0 and a null label; else the score is
    1 less the share of the label's letters that had to be edited. The nearest label holds, then the longest,
    then a preferred one, then the smallest code. Null and empty titles and an empty label list give 'none'."""
    narrow = postings.select("posting_id", "title", "isco_code")
    matches = spark.sql(_with_tables(_MATCHES), postings=narrow, labels=labels.select("isco_code", "label", "label_kind"))
    return spark.sql(_with_tables(_TOLD), postings=narrow, matches=matches).distinct()


#: The same by brute force, every phrase against every label, in DuckDB.
BRUTE = r"""
WITH labels AS (
  SELECT *, length(key) AS n FROM (SELECT *, array_to_string(regexp_extract_all(translate(lower(label), 'MARKED', 'PLAIN'), '\p{L}+'), '') AS key FROM isco_labels)
), allowed AS (SELECT *, CASE WHEN n <= 5 THEN 1 WHEN n <= 11 THEN 2 WHEN n <= 15 THEN 3 ELSE 4 END AS most FROM labels),
typed AS (SELECT DISTINCT title FROM postings WHERE isco_code IS NULL AND title IS NOT NULL),
chunks AS (SELECT title, unnest(string_split_regex(translate(lower(regexp_replace(title, '(\p{Ll})(\p{Lu})', '\1 \2', 'g')), 'MARKED', 'PLAIN'), '[\s\x{A0}]+[-–—]+|[-–—]+[\s\x{A0}]+|[–—:|/;()\[\]{}#*0-9]+')) AS chunk FROM typed),
phrases AS (
  SELECT title, list_filter(list_transform(string_split(chunk, ','), lambda p: array_to_string(list_filter(list_transform(regexp_extract_all(p, '\p{L}+'), lambda w: coalesce(MAP {FULL}[w], w)), lambda w: w NOT IN (DROPPED)), '')), lambda p: p <> '') AS p FROM chunks
), keys AS (
  SELECT DISTINCT title, unnest(list_concat(p[1:1], list_transform(range(1, len(p)), lambda i: p[i + 1] || p[i]), list_transform(range(1, len(p)), lambda i: p[i] || p[i + 1]),
    list_transform(range(1, len(p) - 1), lambda i: p[i + 2] || p[i] || p[i + 1]), list_transform(range(1, len(p) - 1), lambda i: p[i] || p[i + 1] || p[i + 2]))) AS key FROM phrases
), distances AS (
  SELECT k.key, l.*, levenshtein(k.key, l.key) AS d FROM (SELECT DISTINCT key FROM keys) k, allowed l WHERE abs(length(k.key) - l.n) <= 4
), good AS (
  SELECT key, min(struct_pack(d := d, n := -n, alt := label_kind = 'alt', isco_code := isco_code, label := label)) AS best FROM distances
  WHERE d <= most OR (d = 2 AND n <= 5 AND list_sort(string_split(key, '')) = list_sort(string_split(key_1, ''))) GROUP BY key
), found AS (SELECT title, min(best) AS best FROM keys JOIN good USING (key) GROUP BY title)
SELECT DISTINCT posting_id, coalesce(best.isco_code, 'none') AS isco_code FROM postings LEFT JOIN found USING (title) WHERE postings.isco_code IS NULL"""
BRUTE = (
    BRUTE.replace("MARKED", MARKED).replace("PLAIN", PLAIN).replace("{FULL}", "{" + ", ".join(f"'{a}': '{b}'" for a, b in ABBREVIATIONS.items()) + "}")
    .replace("DROPPED", _quoted((*SENIORITY, *IDLE))).replace("k.key, l.*,", "k.key, l.isco_code, l.label, l.label_kind, l.n, l.most, l.key AS key_1,")
)
BRUTE_MATCHES = BRUTE.replace("coalesce(best.isco_code, 'none') AS isco_code FROM", "coalesce(best.isco_code, 'none') AS isco_code, best.label AS label, coalesce(round(1 + best.d / best.n, 4), 0.0) AS isco_match_score FROM")
