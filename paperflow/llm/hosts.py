"""URL filter by host reputation, with empirical-Bayes shrinkage; built-in functions only.

Labelled outcomes of pages are counted by host. A host's share of good pages is
shrunk to its registered domain's, that to its suffix's, and that to the share
of all, each by a beta-binomial prior whose strength is estimated from how much
the members of a level differ from their parents (method of moments). A url is
blocked if even the upper bound of its host's share is too low. Rules go first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fixed values of the query's contract: (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Labels below a two-letter country that belong to the suffix.
SECOND = ("ac", "co", "com", "edu", "gov", "net", "org")
#: A url is blocked if the posterior mean plus Z deviations of its host is below LEAST.
Z, LEAST = 1.645, 0.5
#: Correlation of outcomes within a parent, where too little is labelled to estimate it; and its range.
CORRELATION, RANGE = 0.1, (0.01, 0.9)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two below a country; empty for numbers."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    pair = F.regexp_extract(bare, rf"(?:^|\.)((?:{'|'.join(SECOND)})\.[a-z]{{2}})$", 1)
    return F.when(bare.rlike(r"^[0-9.]*$"), "").when(pair != "", pair).otherwise(F.regexp_extract(bare, r"[^.]*$", 0))


def listed_suffixes(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """`hosts` (with a column host) with suffix: the longest of a table's suffixes that the host ends in, else as `suffix_of` has it.

    suffixes: (suffix), such as those of a public list, without a leading dot.
    """
    bare = F.regexp_replace("host", ":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    known = suffixes.select(F.lower("suffix").alias("tail")).where("tail <> ''").distinct()
    met = hosts.select("host", F.explode(tails).alias("tail")).distinct().join(known, "tail")
    longest = met.groupBy("host").agg(F.max_by("tail", F.length("tail")).alias("listed"))
    return hosts.join(longest, "host", "left").withColumn("suffix", F.coalesce("listed", suffix_of(F.col("host")))).drop("listed")


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label before it."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    inner = F.substring(bare, F.lit(1), F.length(bare) - F.length(suffix) - 1)
    return F.when(suffix == "", bare).when(F.length(bare) <= F.length(suffix) + 1, bare).otherwise(F.concat(F.regexp_extract(inner, r"[^.]*$", 0), F.lit("."), suffix))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path written together) and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def shrunk(children: DataFrame, parent: str) -> DataFrame:
    """`children` (n labelled, k good, and the parent's mean) with mean and strength after shrinkage."""
    m = F.col(parent)
    some = children.where("n > 0").agg(F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - m, F.lit(2.0)) / (m * (1 - m))).alias("s"), F.sum("n").alias("n"), F.count("*").alias("g")).first()
    spare = (some["n"] or 0) - some["g"]
    rho = min(max((some["s"] - some["g"]) / spare, RANGE[0]), RANGE[1]) if spare > 0 else CORRELATION
    kappa = (1 - rho) / rho
    return children.withColumn("mean", (F.col("k") + kappa * m) / (F.col("n") + kappa)).withColumn("strength", F.col("n") + F.lit(kappa))


def reputations(pages: DataFrame, outcomes: DataFrame, key: str = "page_id", suffixes: DataFrame | None = None) -> DataFrame:
    """(host, domain, suffix, n, k, mean, strength, bound) of every host of `pages` (key, host).

    outcomes: (key, good 0/1), summed by host before anything is joined to it.
    Hosts without labelled pages take their domain's mean with its prior's strength.
    """
    labelled = pages.join(outcomes, key, "left").groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    with_suffix = labelled.withColumn("suffix", suffix_of(F.col("host"))) if suffixes is None else listed_suffixes(labelled, suffixes)
    hosts = stored(with_suffix.withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + 1) / ((total["n"] or 0) + 2)
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    suffixes = shrunk(hosts.groupBy("suffix").agg(*sums).withColumn("overall", F.lit(overall)), "overall").select("suffix", F.col("mean").alias("suffix_mean"))
    domains = shrunk(hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix"), "suffix_mean").select("domain", "suffix", F.col("mean").alias("domain_mean"))
    found = shrunk(hosts.join(domains, ["domain", "suffix"]), "domain_mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("strength") + 1))
    return found.select("host", "domain", "suffix", "n", "k", "mean", "strength", (F.col("mean") + Z * deviation).alias("bound"))


def judged(pages: DataFrame, outcomes: DataFrame, rules=RULES, least: float = LEAST, suffixes: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url).

    Null urls and urls without :// have an empty host and path, fit no rule and
    share one reputation. Null page_ids have no outcome. Repeated rows stay;
    outcomes of one page_id are averaged to one (good if at least half are).
    suffixes: a table of registry suffixes; without one a suffix is the last
    label, or two of them below a country for some common ones.
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    once = outcomes.where("page_id is not null and good is not null").groupBy("page_id").agg((F.avg("good") >= 0.5).cast("long").alias("good"))
    known = stored(reputations(split, once, suffixes=suffixes).select("host", (F.col("bound") < least).alias("poor")), "reputations")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return split.join(known, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("poor"), "block").otherwise("allow")).alias("verdict"))


def outcomes_of(labels: DataFrame) -> DataFrame:
    """(page_id, good): pages and documents share ids; a page is good if its quality is 1 and it isn't toxic."""
    return labels.where("quality is not null").select(F.col("doc_id").alias("page_id"), ((F.col("quality") > 0) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("long").alias("good"))


def oracle() -> str:
    """The same as DuckDB SQL over views pages and labels."""

    def level(name: str, source: str, parent: str) -> str:
        return f"""
rho_{name} AS (SELECT CASE WHEN coalesce(sum(n), 0) - count(*) > 0 THEN least(greatest((sum(n * pow(k / n - {parent}, 2) / ({parent} * (1 - {parent}))) - count(*)) / (sum(n) - count(*)), {RANGE[0]}), {RANGE[1]}) ELSE {CORRELATION} END AS rho FROM {source} WHERE n > 0),
{name} AS (SELECT s.*, (k + (1 - rho) / rho * {parent}) / (n + (1 - rho) / rho) AS mean, n + (1 - rho) / rho AS strength FROM {source} s, rho_{name})"""

    fits = "\n".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{{n}}}'" for n, (h, p, _) in enumerate(sorted(RULES, key=lambda r: -len(r[0] + r[1]))))
    order = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule, verdict = fits, fits
    for n, (h, p, v) in enumerate(order):
        rule, verdict = rule.replace(f"{{{n}}}", h + p), verdict.replace(f"{{{n}}}", v)
    pair = rf"(?:^|\.)((?:{'|'.join(SECOND)})\.[a-z]{{2}})$"
    return rf"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
split AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
outcome AS (SELECT doc_id AS page_id, CASE WHEN avg(CASE WHEN quality > 0 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) >= 0.5 THEN 1 ELSE 0 END AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1),
counted AS (SELECT host, count(good)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS k, regexp_replace(host, ':[0-9]*$', '') AS bare FROM split LEFT JOIN outcome USING (page_id) GROUP BY host),
suffixed AS (SELECT *, CASE WHEN regexp_matches(bare, '^[0-9.]*$') THEN '' WHEN regexp_extract(bare, '{pair}', 1) <> '' THEN regexp_extract(bare, '{pair}', 1) ELSE regexp_extract(bare, '[^.]*$') END AS suffix FROM counted),
hosts AS (SELECT *, CASE WHEN suffix = '' OR length(bare) <= length(suffix) + 1 THEN bare ELSE regexp_extract(substr(bare, 1, length(bare) - length(suffix) - 1), '[^.]*$') || '.' || suffix END AS domain FROM suffixed),
overall AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS overall FROM hosts),
suffix_counts AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(overall) AS overall FROM hosts, overall GROUP BY suffix),{level("suffixes", "suffix_counts", "overall")},
domain_counts AS (SELECT domain, h.suffix, sum(h.n) AS n, sum(h.k) AS k, any_value(s.mean) AS suffix_mean FROM hosts h JOIN suffixes s ON h.suffix = s.suffix GROUP BY domain, h.suffix),{level("domains", "domain_counts", "suffix_mean")},
host_counts AS (SELECT h.*, d.mean AS domain_mean FROM hosts h JOIN domains d ON h.domain = d.domain AND h.suffix = d.suffix),{level("final", "host_counts", "domain_mean")}
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN mean + {Z} * sqrt(mean * (1 - mean) / (strength + 1)) < {LEAST} THEN 'block' ELSE 'allow' END AS verdict
FROM split JOIN final USING (host)"""
