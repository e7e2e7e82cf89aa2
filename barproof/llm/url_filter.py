"""URL rules applied by a sort-merge range join."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barproof.session import materialize

#: The rules of the registered query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: What holds for a url that no rule fits.
OTHERWISE = "allow"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands between host and path in a key; neither of the two can hold it.
BETWEEN = "#"


def rules_frame(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def parsed_url(url: str = "url") -> tuple[Column, Column]:
    """Host and path of a url column; both are empty without a ``://``."""
    at = F.locate("://", F.col(url))
    after = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    parts = "^([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(after, parts, 1), UPPER, LOWER)
    return host, F.regexp_extract(after, parts, 2)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.concat_ws(".", labels), F.lit(BETWEEN), path)


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _rule_events(rules: DataFrame) -> DataFrame:
    """Two events for each rule: where its interval starts and where it ends.

    An interval holds all keys that start with the rule's key. Intervals nest or are apart, so
    the stack after an event is known from the rules whose keys are prefixes of the rule's own.
    """
    keyed = (
        rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .withColumn("host", F.translate("host", UPPER, LOWER))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            _key(_reversed_labels(F.col("host")), F.col("path")).alias("rule_key"),
            F.struct(
                F.length(F.concat("host", "path")).alias("length"),
                F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"),
                "verdict",
            ).alias("entry"),
        )
    )
    # Only prefixes that are as long as some rule can be one.
    lengths = keyed.agg(F.sort_array(F.collect_set(F.length("rule_key")))).scalar()
    prefixes = (
        keyed.withColumn("lengths", lengths)
        .select(F.col("rule_key").alias("inner_key"), F.explode("lengths").alias("upto"))
        .where(F.col("upto") <= F.length("inner_key"))
        .withColumn("rule_key", F.expr("substring(inner_key, 1, upto)"))
    )
    # A stack is no deeper than the rule's key is long.
    stacks = (
        prefixes.join(keyed, "rule_key")
        .groupBy("inner_key")
        .agg(F.array_sort(F.collect_list(F.struct("upto", "entry"))).alias("stack"))
        .select("inner_key", F.col("stack.entry").alias("stack"))
    )
    key = F.col("inner_key").cast("binary")
    start = stacks.select(key.alias("key"), F.lit(0).alias("kind"), "stack")
    popped = F.slice("stack", 1, F.size("stack") - 1)
    # No key in UTF-8 has a byte FF: the end comes after all keys with the prefix.
    end = stacks.select(F.concat(key, F.unhex(F.lit("FF"))).alias("key"), F.lit(0).alias("kind"), popped.alias("stack"))
    return start.union(end)


def url_filter(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """Judge the urls of ``pages`` (page_id, url) by ``rules`` (host, path, verdict).

    A rule fits its host and all subdomains where the url's path starts with the rule's path; of
    those that fit, the longest wins (then the one with the longer host). Returns page_id, host,
    path, rule (its host and path, or null), verdict (the rule's, or ``otherwise``).

    How: a canonical key is the host with its labels reversed, then the path. A url has one such
    key for its host and one for each parent domain of no more labels than some rule has, which
    turns each rule into one interval of keys. Rule boundaries and keys are sorted together: Spark samples splitters and sorts each
    range, the sweep keeps the stack of the rules that are active, and each range starts with the
    stack that the ranges before it left. Only distinct urls are swept, and ties of one key are
    spread over ranges, so neither a common url nor a common path gathers in one task.

    Edge cases: a null url, or one without ``://``, has an empty host and path and no rule. Rules
    that repeat a host and path count once; if their verdicts differ, the last in code point order
    holds (block before allow). A null in a rule counts as empty, and an empty path fits all paths.
    Repeated pages are judged row by row; other columns are ignored. Empty tables are fine.
    """
    host, path = parsed_url()
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = parsed.select("host", "path").distinct()
    labels = _reversed_labels(F.col("host"))
    # A domain of more labels than any rule has fits none.
    most = F.coalesce(rules.agg(F.max(F.size(F.split(F.coalesce("host", F.lit("")), r"\.")))).scalar(), F.lit(1))
    levels = urls.withColumn("labels", labels).select(
        "host", "path", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), most))).alias("level"), "labels"
    )
    keys = levels.select(
        _key(F.slice("labels", 1, F.col("level")), F.col("path")).cast("binary").alias("key"),
        F.lit(1).alias("kind"),
        "host",
        "path",
    )
    events = keys.unionByName(_rule_events(rules), allowMissingColumns=True)
    placed = materialize(
        events.repartitionByRange("key", "kind", F.xxhash64("host", "path")).withColumn(
            "range", F.spark_partition_id()
        )
    )
    # One row for each range: what the sweep leaves to the ranges after it.
    left = placed.where("kind = 0").groupBy("range").agg(F.max_by("stack", F.struct("key", "kind")).alias("stack"))
    so_far = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.select("range")
        .distinct()
        .join(left, "range", "left")
        .select("range", F.last("stack", ignorenulls=True).over(so_far).alias("carried"))
    )
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    active = placed.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    top = F.element_at(F.coalesce("stack", "carried"), -1)
    verdicts = materialize(
        active.join(carried, "range")
        .where(F.size(F.coalesce("stack", "carried")) > 0)
        .groupBy("host", "path")
        .agg(F.max(top).alias("top"))
        .select("host", "path", F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))
    )
    return parsed.join(verdicts, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )


SQL = r"""
with rules(rule_host, rule_path, verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), hosts as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from cut
), parsed as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from hosts
), urls as (select distinct host, path from parsed),
fits as (
  select host, path, rule_host || rule_path as rule, verdict,
         row_number() over (partition by host, path order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from urls join rules on (host = rule_host or suffix(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, p.host, p.path, rule, coalesce(verdict, 'allow') as verdict
from parsed p left join fits f on p.host = f.host and p.path = f.path and place = 1
"""
