"""URL rules by a sorted sweep over reversed-host keys (native).

A rule is a host, a path and a verdict; it fits its host and every subdomain
when the URL's path starts with the rule's.  Written backwards
(``net.example``) and cut to as many labels as the rule's host has, a URL's
host followed by its path is a key, and the rule is the interval of all keys
that start with its own.  Intervals of one host nest or are disjoint.

For each label count that occurs among the rules, URL keys and rule keys are
sorted together and swept once.  Each rule row carries the stack of the rules
still open at its key, outermost first; a URL takes the stack of the last rule
before it (no rule that fits can be missing there: whatever sorts between a
prefix and a key has the same prefix) and its longest prefix on that stack is
the innermost open rule.  Over the label counts the longest rule (host and
path together) wins, between equals the one with the longer host.

The sweep runs within one reversed host and one of ``salts`` parts of its URLs,
to which the host's rules are copied, so a host with a third of all URLs is
swept in ``salts`` places.  It is a running ``last`` over the sorted rows: no
group is gathered.  Nothing is broadcast; the driver sees only the label
counts that occur among the rules.

Defined cases: a null URL, or one without ``://``, has empty host and path and
meets no rule; rules with a null or empty host fit nothing, a null path is an
empty one (every URL of the host); of rules with the same host and path a
block wins; rows that repeat are judged each; other columns pass through, but
for those named ``host``, ``path``, ``rule`` or ``verdict`` (case aside),
whose place the results take; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlist.llm.common import materialize, table

#: Rules of the registered query: host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Verdict where no rule fits.
DEFAULT = "allow"
#: Parts that the URLs of one host are swept in.
SALTS = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOUND = "struct<length:int,host_length:int,rule:string,verdict:string>"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Per rule ``depth`` (labels of its host), ``host_key`` (reversed host), ``path`` and
    ``open``: itself and the rules its key lies in, shortest path first."""
    clean = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host != ''")
    one = (clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
           .select(F.size(_labels(F.col("host"))).alias("depth"), F.array_join(_labels(F.col("host")), ".").alias("host_key"), "path",
                   F.struct((F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
                            F.concat("host", "path").alias("rule"), "verdict").alias("found")))
    sizes = one.groupBy("host_key").agg(F.collect_set(F.length("path")).alias("sizes"))
    starts = one.join(sizes, "host_key").select(
        "depth", "host_key", "path", F.explode(F.filter("sizes", lambda n: n <= F.length("path"))).alias("n"))
    outer = one.select("host_key", F.col("path").alias("prefix"), F.struct(F.length("path").alias("n"), F.col("path").alias("prefix"), "found").alias("o"))
    return (starts.withColumn("prefix", F.expr("substring(path, 1, n)")).join(outer, ["host_key", "prefix"])
            .groupBy("depth", "host_key", "path").agg(F.array_sort(F.collect_list("o")).alias("open")))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, salts: int = SALTS) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (host and path of the rule that
    decides, else null) and ``verdict`` (its verdict, else ``default``)."""
    names = {"host", "path", "rule", "verdict"}
    kept = [F.col(f"`{c}`") for c in urls.columns if c.lower() not in names]
    # The part may depend on any column that can be hashed, so copies of a URL spread as well.
    hashed = [F.col(f"`{c}`") for c, kind in urls.dtypes if "map<" not in kind and "variant" not in kind]
    stacks = materialize(rule_stacks(rules))
    rows = urls.select(F.struct(*kept).alias("row"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"),
                       F.pmod(F.xxhash64(*hashed), F.lit(salts)).alias("salt"), F.lit(None).cast(_FOUND).alias("best"))
    for (depth,) in stacks.select("depth").distinct().orderBy("depth").collect():
        rows = _swept(rows, stacks.where(F.col("depth") == depth), depth, salts)
    return rows.select("row.*", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _swept(rows: DataFrame, stacks: DataFrame, depth: int, salts: int) -> DataFrame:
    """``rows`` with ``best`` raised to the longest fitting rule whose host has ``depth`` labels."""
    labels = _labels(F.col("host"))
    cut = F.when(F.size(labels) >= depth, F.array_join(F.slice(labels, 1, depth), "."))
    keyed = rows.select("row", "host", "path", "salt", "best", cut.alias("host_key"), F.lit(1).alias("turn"))
    opened = stacks.select("host_key", "path", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"),
                           F.lit(0).alias("turn"), "open")
    order = Window.partitionBy("host_key", "salt").orderBy("path", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = keyed.unionByName(opened, allowMissingColumns=True).withColumn("open", F.last("open", ignorenulls=True).over(order))
    fits = F.filter("open", lambda o: F.startswith(F.col("path"), o["prefix"]))
    best = F.greatest("best", F.try_element_at(fits, F.lit(-1))["found"])
    return swept.where("turn = 1").select("row", "host", "path", "salt", best.alias("best"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
                                                      for h, p, v in RULES])))
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


QUERIES = {"op13_url_rules": op13_url_rules}
ORACLES = {"op13_url_rules": r"""
WITH u AS (
  SELECT row_number() OVER () AS k, page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT any_value(u.page_id) AS page_id, any_value(u.host) AS host, any_value(u.path) AS path,
       arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(arg_max(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
GROUP BY u.k
"""}
