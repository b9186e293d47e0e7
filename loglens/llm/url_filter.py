"""URL filter: allow/block rules, else the reputation of the host.

Reputation is empirical Bayes. Labelled page outcomes (good or not) are
counted per host, registered domain and suffix. Each level's rates are taken
as draws of a beta distribution around the posterior mean of the level above;
its strength is fitted by moments from the spread of the level's own rates
(Kleinman's estimator), so sparse hosts shrink to their domain, sparse domains
to their suffix, and suffixes to the whole. A page passes when the lower
posterior bound of its host's good rate reaches ``min_good``.

Native: DataFrame functions only. Hosts with a third of all pages are handled
by pre-aggregation (counts) and by a salted join (verdicts).

Defined results: a null URL or one without ``://`` has an empty host and path;
its host '' is a node like any other. Repeated pages count and return as
often as they occur; null outcomes are unlabelled. Pages without any label
below their suffix get the suffix's bound, an entirely unlabelled table the
bound of a uniform prior. Other columns of the input, whatever their names,
are ignored. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm.joins import salted_join
from loglens.llm.store import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Two-label public suffixes told apart from registered domains.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")

# The rules of the registered query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))

Z = 1.645
MIN_GOOD = 0.5
DEFAULT_RHO, LEAST_RHO, MOST_RHO = 0.1, 0.001, 0.5


def url_host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(raw, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls. A rule
    ``host/path`` fits its host and all subdomains if the path starts with its
    own; of rules of one length the one with the longer host wins."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1].index("/") * -1, r[1]))
    rule = verdict = None
    for action, text in ordered:
        cut = text.index("/")
        fits = ((host == text[:cut]) | host.endswith("." + text[:cut])) & path.startswith(text[cut:])
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def suffix_of(host: Column) -> Column:
    last = F.substring_index(host, ".", -1)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(last)


def registered_domain(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(nodes: DataFrame, level: str) -> DataFrame:
    """One row (``one``, ``kappa``): the prior strength of a level, from its nodes (n, good, up)."""
    own = F.when(F.col("n") > 0, F.col("up") * (1 - F.col("up")))
    excess = F.sum(F.when(F.col("n") > 0, F.col("n")) * F.pow(F.col("good") / F.greatest("n", F.lit(1)) - F.col("up"), 2) - own)
    scale = F.sum(own * (F.col("n") - 1))
    rho = F.when(scale > 0, F.least(F.greatest(excess / scale, F.lit(LEAST_RHO)), F.lit(MOST_RHO))).otherwise(DEFAULT_RHO)
    return nodes.agg(rho.alias("rho")).select(F.lit(1).alias("one"), (1 / F.col("rho") - 1).alias(f"kappa_{level}"))


def _with_strength(nodes: DataFrame, level: str) -> DataFrame:
    # The strength is a single row, so its broadcast has a fixed size.
    return nodes.withColumn("one", F.lit(1)).join(F.broadcast(_strength(nodes, level)), "one").drop("one")


def _mean(level: str) -> Column:
    k = F.col(f"kappa_{level}")
    return (k * F.col("up") + F.col("good")) / (k + F.col("n"))


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``outcomes`` (host, good: 1, 0 or null) -> one row per host: n, good,
    mean and lower bound of the posterior good rate."""
    # One row per host from here on; every level reads the written counts.
    hosts = (stored(outcomes.groupBy("host").agg(F.count("good").cast("double").alias("n"),
                                          F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good")), "host-counts")
             .withColumn("domain", registered_domain(F.col("host")))
             .withColumn("suffix", suffix_of(F.col("host"))))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    root = suffixes.agg(((F.coalesce(F.sum("good"), F.lit(0.0)) + 1)
                         / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2)).alias("up")).withColumn("one", F.lit(1))
    suffixes = suffixes.withColumn("one", F.lit(1)).join(F.broadcast(root), "one").drop("one")
    suffix_mean = _with_strength(suffixes, "suffix").select("suffix", _mean("suffix").alias("up"))
    domains = salted_join(domains, suffix_mean, "suffix", ["domain"], "inner")
    domain_mean = _with_strength(domains, "domain").select("domain", _mean("domain").alias("up"))
    hosts = _with_strength(salted_join(hosts, domain_mean, "domain", ["host"], "inner"), "host")
    k = F.col("kappa_host")
    a, b = k * F.col("up") + F.col("good"), k * (1 - F.col("up")) + F.col("n") - F.col("good")
    mean = a / (a + b)
    return hosts.select("host", "n", "good", mean.alias("mean"),
                        (mean - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("lower"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
                z: float = Z, min_good: float = MIN_GOOD) -> DataFrame:
    """``pages`` (page_id, url) and labelled ``outcomes`` (host, good) ->
    page_id, host, path, rule, verdict, mean, lower."""
    judged = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    every = outcomes.select("host", F.col("good").cast("int").alias("good")).unionByName(
        judged.select("host", F.lit(None).cast("int").alias("good")))
    known = host_reputation(every, z).select("host", "mean", "lower")
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("lower") >= min_good, "allow").otherwise("block")
    return (salted_join(judged, known, "host", ["page_id", "path"])
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(action, method).alias("verdict"), "mean", "lower"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good) per label of a page's document, whose id follows the
    language in the URL's path; good: quality 1 and not toxic."""
    doc = F.regexp_extract(url_path(F.col("url")), r"^/[a-z]+/([0-9]{1,18})", 1)
    of = pages.select(url_host(F.col("url")).alias("host"), F.nullif(doc, F.lit("")).cast("long").alias("doc_id"))
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
    return (of.where(F.col("doc_id").isNotNull())
            .join(labels.select("doc_id", good.alias("good")), "doc_id").select("host", "good"))


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or reputation verdict of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_urls(pages, page_outcomes(pages, labels)).select("page_id", "host", "path", "rule", "verdict")


def _level_sql(name: str, nodes: str) -> str:
    return f"""{name}_k AS (SELECT 1 / CASE WHEN sc > 0 THEN least(greatest(ex / sc, {LEAST_RHO}), {MOST_RHO}) ELSE {DEFAULT_RHO} END - 1 AS kappa
  FROM (SELECT sum(n * pow(good / greatest(n, 1) - up, 2) - up * (1 - up)) FILTER (n > 0) AS ex,
               sum(up * (1 - up) * (n - 1)) FILTER (n > 0) AS sc FROM {nodes}))"""


def _two(host: str, k: int) -> str:
    return f"array_to_string(list_slice(string_split({host}, '.'), -{k}, -1), '.')"


def _rule_sql(pick: int) -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    whens = []
    for action, text in ordered:
        host, path = text[:text.index("/")], text[text.index("/"):]
        whens.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
                     f"THEN '{(action, text)[pick]}'")
    return "CASE " + " ".join(whens) + " ELSE NULL END"


_LISTED = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)

ORACLE = f"""
WITH p AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (SELECT host, CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 WHEN quality IS NULL THEN NULL ELSE 0 END AS good
  FROM (SELECT host, TRY_CAST(regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})', 1) AS BIGINT) AS doc_id FROM p)
  JOIN labels USING (doc_id)
  UNION ALL SELECT host, NULL FROM p),
h0 AS (SELECT host, count(good)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS good,
    CASE WHEN {_two('host', 2)} IN ({_LISTED}) THEN {_two('host', 3)} ELSE {_two('host', 2)} END AS domain,
    CASE WHEN {_two('host', 2)} IN ({_LISTED}) THEN {_two('host', 2)} ELSE {_two('host', 1)} END AS suffix
  FROM o GROUP BY host),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h0 GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM d0 GROUP BY ALL),
s1 AS (SELECT *, (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM s0) AS up FROM s0),
{_level_sql('s', 's1')},
d1 AS (SELECT d0.*, (kappa * up + s1.good) / (kappa + s1.n) AS up FROM d0 JOIN s1 USING (suffix), s_k),
{_level_sql('d', 'd1')},
h1 AS (SELECT h0.*, (kappa * up + d1.good) / (kappa + d1.n) AS up FROM h0 JOIN d1 USING (domain), d_k),
{_level_sql('h', 'h1')},
ab AS (SELECT host, kappa * up + good AS a, kappa * (1 - up) + n - good AS b FROM h1, h_k),
r AS (SELECT host, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower_bound FROM ab)
SELECT page_id, host, path, {_rule_sql(1)} AS "rule",
  coalesce({_rule_sql(0)}, CASE WHEN lower_bound >= {MIN_GOOD} THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN r USING (host)
"""

QUERIES = {"op3_url_reputation": op3_url_reputation}
ORACLES = {"op3_url_reputation": ORACLE}
