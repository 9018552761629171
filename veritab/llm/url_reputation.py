"""URL filter by empirical-Bayes host reputation (operator 7), DataFrame functions only.

Labelled page outcomes (good or bad) are counted per host, registered domain
and suffix.  Each level's rate is shrunk towards the level above through a
beta prior: its mean is the posterior mean of the parent, its strength is
fitted by the method of moments to the spread of all children's rates.  A page
is blocked if even an optimistic bound of its host's posterior rate of good
pages (mean plus ``Z`` standard deviations) lies below ``FLOOR``.

Explicit host-and-path rules come first: the longest that fits decides.

Counting is one aggregation per level with partial sums; a host with a third
of all pages is one row per task.  Hosts that were labelled are joined to the
pages by name (broadcast only if counted to be small, else a shuffled join
whose large keys Spark splits).

Defined results: a null url, or one without ``://``, has an empty host and
path, no rule, and the verdict of the corpus-wide prior; repeated rows are
judged alike; without labels the prior is even (1, 1); an outcome of null does not
count; a url of any length is read whole; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import written

#: a host is blocked if this bound of its rate of good pages is below the floor
Z, FLOOR = 1.64, 0.5
#: weakest and strongest prior, in pages: 200 bad pages and no good one outweigh any parent
WEAKEST, STRONGEST = 1.0, 100.0
#: labelled hosts that may be broadcast (about 100 bytes each)
BROADCAST_HOSTS = 100_000


class PathRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: the contract's rules (fixed values)
RULES = (
    PathRule("allow", "com", "/"),
    PathRule("block", "example.com", "/en/"),
    PathRule("allow", "www.example.com", "/en/"),
    PathRule("block", "net", "/es/"),
    PathRule("block", "net", "/fr/"),
)
#: labels that countries register names under (fixed values): co.uk, com.br, go.jp, gob.mx ...
SECOND_LABELS = "ac ad asn co com edu firm gen go gob gouv gov govt gr id ind info ltd me mil ne net nhs nic nom or org plc sch web".split()
_TWO_LABELS = rf"\A(?:{'|'.join(SECOND_LABELS)})\.[a-z]{{2}}\z"
_ADDRESS = r"\A(?:\d{1,3}(?:\.\d{1,3}){3}|\[.*\])\z"


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end."""
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return _ascii_lower(found)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def site_of(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r":\d*\z", "")


def suffix_of(host: Column) -> Column:
    """The last label, two under a country's own registry (co.uk); an address is its own suffix."""
    site = site_of(host)
    two = F.substring_index(site, ".", -2)
    return F.when(site.rlike(_ADDRESS), site).when(two.rlike(_TWO_LABELS), two).otherwise(F.substring_index(site, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: one label more than the suffix; an address is its own domain."""
    site = site_of(host)
    two = F.substring_index(site, ".", -2)
    return (F.when(site.rlike(_ADDRESS), site).when(two.rlike(_TWO_LABELS), F.substring_index(site, ".", -3))
            .otherwise(two))


def matched_rule(host: Column, path: Column, rules: tuple[PathRule, ...] = RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the longest is tested first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _with_prior(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Children with their parent's mean."""
    return children.join(parents.select(parent, F.col("mean").alias("prior")), parent)


def _shrunk(with_parent: DataFrame, key: str) -> DataFrame:
    """Posterior (a, b) of every child from its counts and its parent's mean (``prior``).

    The strength m of the prior follows from the children's weighted variance
    around their parents' means (method of moments), one number per level.
    """
    n = F.col("good") + F.col("bad")
    rate = F.col("good") / n
    fit = with_parent.agg(
        F.sum(n).alias("pages"), F.count(F.lit(1)).alias("groups"), F.sum(n * n).alias("squares"),
        F.sum(n * F.pow(rate - F.col("prior"), 2)).alias("spread"),
        F.avg(F.col("prior") * (1 - F.col("prior"))).alias("noise"))
    pages, groups = F.col("pages"), F.col("groups")
    # spread = groups * noise within groups + the variance between them
    between = F.greatest(F.lit(0.0), (F.col("spread") - (groups - 1) * F.col("noise"))
                         / F.nullif(pages - F.col("squares") / pages, F.lit(0.0)))
    fitted = F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), F.col("noise") / between - 1))
    # no variance between the children: as strong as a prior may be
    strength = fit.select(F.when(between > 0, fitted).otherwise(F.lit(STRONGEST))).first()[0]  # one number per level
    return (with_parent
            .select(key, "good", "bad", (F.col("good") + F.col("prior") * strength).alias("a"),
                    (F.col("bad") + (1 - F.col("prior")) * strength).alias("b"))
            .withColumn("mean", F.col("a") / (F.col("a") + F.col("b"))))


def optimistic(a: Column, b: Column, z: float = Z) -> Column:
    """Posterior mean plus z standard deviations of a beta distribution."""
    mean, n = a / (a + b), a + b
    return mean + z * F.sqrt(mean * (1 - mean) / (n + 1))


def reputations(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, tuple[float, float]]:
    """Posteriors per host, domain, suffix, and the overall (a, b), from the columns ``host``, ``good``."""
    counts = written(
        outcomes.where(F.col("good").isNotNull()).groupBy("host")
        .agg(F.sum(F.col("good").cast("bigint")).alias("good"), F.sum(1 - F.col("good").cast("bigint")).alias("bad"))
        .select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "good", "bad"),
        "host_counts")
    whole = counts.agg((F.coalesce(F.sum("good"), F.lit(0)) + 1).cast("double"),
                       (F.coalesce(F.sum("bad"), F.lit(0)) + 1).cast("double")).first()  # two numbers
    by_suffix = counts.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    suffixes = written(_shrunk(by_suffix.withColumn("prior", F.lit(whole[0] / (whole[0] + whole[1]))), "suffix"), "suffixes")
    by_domain = counts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    domains = written(_shrunk(_with_prior(by_domain, suffixes, "suffix"), "domain"), "domains")
    hosts = written(_shrunk(_with_prior(counts, domains, "domain"), "host"), "hosts")
    return hosts, domains, suffixes, (whole[0], whole[1])


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_HOSTS else df


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[PathRule, ...] = RULES,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``bound`` (the
    optimistic rate of good pages) of every page.

    ``outcomes`` has ``url`` and ``good`` (1, 0) of the labelled pages.
    """
    hosts, domains, suffixes, overall = reputations(outcomes.select(host_of(F.col("url")).alias("host"), "good"))
    page = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    named = page.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    for level, table in (("host", hosts), ("domain", domains), ("suffix", suffixes)):
        named = named.join(_bounded(table.select(level, F.struct("a", "b").alias(f"_{level}"))), level, "left")
    top = F.struct(F.lit(overall[0]).alias("a"), F.lit(overall[1]).alias("b"))
    # an unlabelled host is judged by its domain, an unlabelled domain by its suffix, and so on upwards
    nearest = F.coalesce("_host", "_domain", "_suffix", top)
    bound = F.round(F.least(F.lit(1.0), optimistic(nearest["a"], nearest["b"])), 6)
    name, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return named.select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(bound < FLOOR, "block").otherwise("allow")).alias("verdict"), bound.alias("bound"))
