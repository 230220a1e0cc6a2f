"""URL filter: rules first, else the reputation of the host by empirical Bayes.

Labelled pages are counted by host, registered domain and suffix. The suffix is the
last name, or the last two of a country's commercial and similar zones (``co.uk``); the
domain has one name more. An address is a domain by itself, and all addresses share a
suffix. User names and ports belong to no level.
The rate of bad pages of a suffix is shrunk towards that of all pages, a domain's
towards its suffix's and a host's towards its domain's, each by a beta prior whose
strength is estimated by the method of moments from how much the children of that level
differ. A page is blocked if even the lower posterior bound of its host (without
labels: of its domain, else of its suffix) exceeds the limit: ``EXCESS`` times the rate
of all labelled pages, but no more than halfway from there to 1. What counts as bad
differs between tables, so the limit follows the table.

Defined results: a null url, or one without ``://``, has an empty host and path and
no rule; an empty host is a host like any other. Without labels nothing is blocked
but by rule; where hosts differ by no more than chance, they all keep about the rate of
all pages and nothing is. Repeated pages are judged each; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.session import stored

#: Host, path and verdict of the fixed rules. The longest that fits wins.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
EXCESS = 1.5
DEVIATIONS = 1.645
STRENGTHS = (1.0, 1000.0)
#: Names below a country's that are open to registration.
ZONES = "ac|co|com|edu|gov|net|or|org"


def split_url(urls: DataFrame) -> DataFrame:
    """Add host and path of the url column."""
    after = F.expr("CASE WHEN url LIKE '%://%' THEN substr(url, locate('://', url) + 3) ELSE '' END")
    host = F.regexp_extract(F.coalesce(after, F.lit("")), r"^([^/?#]*)", 1)
    rest = F.expr("substr(_after, char_length(_host) + 1)")
    small = F.translate(F.col("_host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (
        urls.withColumn("_after", F.coalesce(after, F.lit("")))
        .withColumn("_host", host)
        .withColumns({"host": small, "path": F.regexp_extract(rest, r"^([^?#]*)", 1)})
        .drop("_after", "_host")
    )


def rule_and_verdict(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and what it says; nulls if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for name, path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = (
            (F.col("host") == name) | F.endswith("host", F.lit("." + name))
        ) & F.startswith("path", F.lit(path))
        rule = F.when(fits, F.lit(name + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _levels(rows: DataFrame) -> DataFrame:
    """Add name (the host without user, port and last dot), domain and suffix."""
    bare = F.regexp_replace(F.substring_index("host", "@", -1), r"\.?(:[0-9]*)?$", "")
    address = F.col("name").rlike(r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\]?)$")
    zone = F.col("name").rlike(rf"(^|\.)({ZONES})\.[a-z]{{2}}$")
    return rows.withColumn("name", bare).withColumns(
        {
            "domain": F.when(address, F.col("name"))
            .when(zone, F.substring_index("name", ".", -3))
            .otherwise(F.substring_index("name", ".", -2)),
            "suffix": F.when(address, "address")
            .when(zone, F.substring_index("name", ".", -2))
            .otherwise(F.substring_index("name", ".", -1)),
        }
    )


def _with_prior(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Posterior rate of each child, shrunk towards its parent's rate.

    The strength of the prior is one number for the level: the variance of the
    children's rates around their parents' beyond what their sizes explain.
    """
    prior = parents.select(parent, F.col("rate").alias("_prior"))
    joined = children.join(prior, parent)
    spread = F.pow(F.col("bad") / F.col("n") - F.col("_prior"), 2) * F.col("n")
    binomial = F.col("_prior") * (1 - F.col("_prior"))
    moments = joined.where("n > 1").agg(
        F.sum(spread - binomial).alias("_beyond"), F.sum(F.expr("n - 1") * binomial).alias("_within")
    )
    # Between-child variance is rho * p * (1 - p); a beta prior has rho = 1 / (strength + 1).
    rho = F.col("_beyond") / F.nullif("_within", F.lit(0.0))
    strength = F.coalesce(
        F.when(rho > 0, F.least(F.greatest(1 / rho - 1, F.lit(STRENGTHS[0])), F.lit(STRENGTHS[1]))),
        F.lit(STRENGTHS[1]),
    )
    with_strength = joined.crossJoin(F.broadcast(moments.select(strength.alias("_strength"))))
    return with_strength.withColumns(
        {
            "rate": (F.col("bad") + F.col("_strength") * F.col("_prior"))
            / (F.col("n") + F.col("_strength")),
            "weight": F.col("n") + F.col("_strength"),
        }
    ).drop("_prior", "_strength")


def reputations(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Posterior rate and weight by name, domain, suffix and overall.

    ``outcomes`` has host and bad (boolean). Counts are combined before the
    shuffle, so a hot host costs a row per task. Each level is stored, as the one below
    it needs its rates twice.
    """
    seen = outcomes.where("bad IS NOT NULL")
    tallies = (F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    by_host = _levels(seen.groupBy("host").agg(*tallies))

    def total(of: DataFrame, *keys: str) -> DataFrame:
        return of.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    names = stored(total(by_host, "name", "domain", "suffix"), "url-names")
    overall = (
        total(names)
        .where("n > 0")
        .select(F.lit("all").alias("all"), ((F.col("bad") + 1) / (F.col("n") + 2)).alias("rate"))
    )
    overall = stored(overall, "url-overall")
    suffixes = stored(_with_prior(total(names, "suffix").withColumn("all", F.lit("all")), overall, "all"), "url-suffixes")
    domains = stored(_with_prior(total(names, "domain", "suffix"), suffixes, "suffix"), "url-domains")
    return stored(_with_prior(names, domains, "domain"), "url-hosts"), domains, suffixes, overall


def lower_bound(rate: Column, weight: Column) -> Column:
    """Lower bound of a beta posterior by its mean and standard deviation."""
    return rate - DEVIATIONS * F.sqrt(rate * (1 - rate) / (weight + 1))


def judged_names(names: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The names with the method's verdict, from the lowest level that has labels.

    ``names`` has name, domain and suffix, each name once.
    """
    hosts, domains, suffixes, overall = reputations(outcomes)
    limit = F.least(EXCESS * F.col("rate"), (1 + F.col("rate")) / 2)
    known = names
    for level, key in ((hosts, "name"), (domains, "domain"), (suffixes, "suffix")):
        bound = lower_bound(F.col("rate"), F.col("weight")).alias(f"_{key}")
        known = known.join(level.select(key, bound), key, "left")
    known = known.join(F.broadcast(overall.select(limit.alias("_limit"))), how="left")
    worst = F.coalesce("_name", "_domain", "_suffix") > F.col("_limit")
    return known.select("name", F.when(worst, "block").otherwise("allow").alias("_method"))


def judge_urls(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    A host without labelled pages is judged by its domain, else its suffix.
    """
    rule, verdict = rule_and_verdict()
    split = _levels(split_url(pages.select("page_id", "url")))
    names = judged_names(split.select("name", "domain", "suffix").distinct(), outcomes)
    return split.join(names, "name", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "_method").alias("verdict")
    )


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Host and outcome of each page whose document has a label.

    The document's number is the first part of the path that begins with a
    digit. A page is bad if its document is of low quality or toxic.
    """
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:[^0-9]|$)", 1)
    split = split_url(pages.select("url")).select("host", number.alias("_number"))
    numbered = split.select("host", F.expr("try_cast(nullif(_number, '') AS bigint)").alias("_doc"))
    bad = labels.select(
        F.col("doc_id").alias("_doc"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return numbered.where("_doc IS NOT NULL").join(bad, "_doc").select("host", "bad")
