"""Query op12_urls and its SQL, the levels of the tree one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkloom.llm import urls

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


def _case(column: int) -> str:
    whens = []
    for kind, rule in sorted(RULES, key=lambda r: -len(r[1])):
        of, _, start = rule.partition("/")
        whens.append(f"WHEN (host = '{of}' OR ends_with(host, '.{of}')) AND starts_with(path, '/{start}') THEN '{(kind, rule)[column]}'")
    return f"CASE {' '.join(whens)} END"


def _level(k: int) -> str:
    """CTEs of a level: from way{k} to way{k + 1}."""
    return f"""
counts{k} AS (
  SELECT host, way, segments[{k + 1}] AS segment, sum(n) AS n, sum(known) AS known, sum(bad) AS bad,
    sum((least(len(segments), {urls.DEPTH}) - {k + 1}) * n) AS below
  FROM way{k} WHERE len(segments) > {k} GROUP BY ALL),
kept{k} AS (
  SELECT *, known > 0 AS labelled, bad / nullif(known, 0) AS share, floor(below / n + 0.5) AS shape
  FROM (SELECT *, sum(n) OVER (PARTITION BY host, way) AS total FROM counts{k})
  WHERE n >= {urls.LEAST_PAGES} AND n >= {urls.LEAST_SHARE}::DOUBLE * total),
lagged{k} AS (
  SELECT *, lag(known) OVER w AS known_0, lag(bad) OVER w AS bad_0, lag(share) OVER w AS share_0 FROM kept{k}
  WINDOW w AS (PARTITION BY host, way, labelled, shape ORDER BY share, segment)),
tested{k} AS (
  SELECT *, coalesce(labelled AND share - share_0 > {urls.Z}::DOUBLE * sqrt(p * (1 - p) * (1 / known + 1 / known_0)), false) AS differs
  FROM (SELECT *, (bad + bad_0) / (known + known_0) AS p FROM lagged{k})),
grouped{k} AS (
  SELECT *, sum(differs::INT) OVER (PARTITION BY host, way, labelled, shape ORDER BY share, segment) AS part FROM tested{k}),
named{k} AS (
  SELECT host, way, segment, min(segment) OVER (PARTITION BY host, way, labelled, shape, part) AS first FROM grouped{k}),
steps{k} AS (
  SELECT host, way, segment, CASE WHEN first = '*' THEN '***' WHEN starts_with(first, '*') THEN '*' || first ELSE first END AS step FROM named{k}),
way{k + 1} AS (
  SELECT p.host, p.path, p.ruled, p.n, p.known, p.bad, p.segments,
    CASE WHEN len(p.segments) > {k} THEN p.way || '/' || coalesce(s.step, '*') ELSE p.way END AS way
  FROM way{k} p LEFT JOIN steps{k} s ON s.host = p.host AND s.way = p.way AND s.segment = p.segments[{k + 1}])"""


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP12_SQL = rf"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_CAPITALS}', '{_CAPITALS.lower()}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
ruled AS (SELECT *, {_case(1)} AS rule, {_case(0)} AS ruled FROM parsed),
way0 AS (
  SELECT host, path, ruled, count(*) AS n, count(ruled) AS known, count(*) FILTER (WHERE ruled = 'block') AS bad,
    list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS way
  FROM ruled GROUP BY host, path, ruled),{",".join(_level(k) for k in range(urls.DEPTH))},
ways AS (SELECT *, CASE WHEN len(segments) > {urls.DEPTH} THEN way || '/**' ELSE way END AS template FROM way{urls.DEPTH}),
rejected AS (
  SELECT host, template FROM ways GROUP BY host, template HAVING (sum(bad) + 1) / (sum(known) + 2) >= {urls.PURITY}::DOUBLE),
gone AS (SELECT host, path FROM ways SEMI JOIN rejected USING (host, template) WHERE ruled IS NULL)
SELECT page_id, r.host, r.path, rule, coalesce(ruled, CASE WHEN g.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN gone g ON g.host = r.host AND g.path = r.path
"""

QUERIES = {"op12_urls": (op12_urls, OP12_SQL)}
