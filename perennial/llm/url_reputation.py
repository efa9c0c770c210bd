"""URL filter by rules and by empirical-Bayes host reputation, DataFrame functions only.

Labelled pages give every host so many good ones out of so many. A host's share of good
pages is drawn towards that of its registered domain, the domain's towards that of its
suffix, the suffix's towards that of all. How strongly, the data say: the strength of each
level's beta prior follows from how much its groups differ beyond chance. A host's verdict
is by the lower bound of its beta posterior.

Which names are suffixes is a table that the user gives, of any number of rows and labels;
without one, a short list of two-label suffixes is used. Hosts are counted once and written,
so the pages are read for the counts and for the verdicts only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.llm.shared import ascii_lower, settle

# The rules of the query, (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# Suffixes of two labels below which domains are registered.
LONG_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ac.jp", "or.jp",
    "co.nz", "co.za", "com.br", "com.cn", "com.mx", "co.in", "co.kr", "com.tr",
)


@dataclass(frozen=True)
class Reputation:
    min_good: float = 0.6  # the lower bound must reach it
    z: float = 1.645  # standard deviations of the posterior below its mean
    strongest: float = 1000.0
    weakest: float = 1.0


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """The host without user and port; hosts keep both, priors do not tell them apart."""
    return F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), ":[0-9]*$", "")


def is_address(name: Column) -> Column:
    """Numbers of IPv4 or a name in brackets: no part of it is a domain."""
    return name.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | name.startswith("[")


ADDRESS = "[address]"  # the suffix of all addresses


def suffix_of(host: Column) -> Column:
    name = name_of(host)
    last_two = F.substring_index(name, ".", -2)
    known = F.when(last_two.isin(*LONG_SUFFIXES), last_two).otherwise(F.substring_index(name, ".", -1))
    return F.when(is_address(name), ADDRESS).otherwise(known)


def domain_of(host: Column) -> Column:
    """The suffix and one label more."""
    name = name_of(host)
    last_two = F.substring_index(name, ".", -2)
    known = F.when(last_two.isin(*LONG_SUFFIXES), F.substring_index(name, ".", -3)).otherwise(last_two)
    return F.when(is_address(name), name).otherwise(known)


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Add domain and suffix to rows of different hosts.

    ``suffixes`` holds one column, suffix; the longest one that ends a host counts, and a
    host that ends in none has its last label. NULL and empty suffixes are not used, repeated
    ones count once, a leading dot is dropped; patterns are not understood. A host has as
    many rows in the join as the longest suffix has labels.
    """
    if suffixes is None:
        return hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    known = suffixes.select(F.ltrim(ascii_lower(F.col("suffix")), F.lit(".")).alias("__suffix")).distinct()
    known = known.where("__suffix <> ''")
    most = known.agg(F.coalesce(F.max(F.size(F.split("__suffix", r"\."))), F.lit(1))).scalar()
    labels, size = F.split(name_of(F.col("host")), r"\."), F.size("__labels")
    named = hosts.select("host", labels.alias("__labels")).withColumn("__most", F.least(size, most))
    ends = F.transform(
        F.sequence(F.lit(1), "__most"),
        lambda n: F.array_join(F.slice("__labels", size - n + 1, n), "."),
    )
    ends = named.select("host", F.explode(ends).alias("__suffix")).join(known, "__suffix")
    longest = ends.groupBy("host").agg(F.max(F.size(F.split("__suffix", r"\."))).alias("__long"))
    out = hosts.withColumn("__labels", labels).join(longest, "host", "left")
    long = F.coalesce("__long", F.lit(1))

    def last(n: Column) -> Column:
        n = F.least(size, n)
        return F.array_join(F.slice("__labels", size - n + 1, n), ".")

    address = is_address(name_of(F.col("host")))
    return out.withColumns(
        {
            "domain": F.when(address, name_of(F.col("host"))).otherwise(last(long + 1)),
            "suffix": F.when(address, ADDRESS).otherwise(last(long)),
        }
    ).drop("__labels", "__long")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; NULL if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, rule_verdict).otherwise(verdict)
    return name, verdict


def _strength(groups: DataFrame, params: Reputation) -> Column:
    """The beta prior's strength from (n, good): the one under which groups would differ as
    much as they do, by the analysis of variance of shares. One value for all rows."""
    n, good = F.col("n").cast("double"), F.col("good").cast("double")
    sums = groups.agg(
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum(n).alias("total"),
        F.sum(good).alias("all_good"),
        F.sum(n * n).alias("squares"),
        F.sum(good * good / n).alias("between"),
    )
    k, total, squares = F.col("k"), F.col("total"), F.col("squares")
    share = F.try_divide("all_good", "total")
    among = F.try_divide(F.col("between") - total * share * share, k - 1)
    within = F.try_divide(F.col("all_good") - F.col("between"), total - k)
    typical = F.try_divide(total - F.try_divide(squares, total), k - 1)
    rho = F.try_divide(among - within, among + (typical - 1) * within)
    # One group, one label each or no differences at all tell nothing: the strongest prior.
    strength = F.when(
        (k > 1) & (total > k) & (among + (typical - 1) * within > 0) & (rho > 0), F.try_divide(F.lit(1.0), rho) - 1
    ).otherwise(params.strongest)
    bounded = F.least(F.lit(params.strongest), F.greatest(F.lit(params.weakest), strength))
    return sums.select(F.coalesce(bounded, F.lit(params.strongest)).alias("strength")).scalar()


def reputations(
    hosts: DataFrame, params: Reputation = Reputation(), suffixes: DataFrame | None = None
) -> DataFrame:
    """(host, n, good, mean, bound) from (host, n, good), one row per host; n may be 0."""
    # Priors and their strengths read it several times.
    placed = settle(with_domains(hosts.select("host", "n", "good"), suffixes), "hosts")
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = placed.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    whole = suffixes.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("mean")).select(
        F.coalesce("mean", F.lit(0.5)).alias("mean")
    ).scalar()

    def drawn(groups: DataFrame, prior: Column, columns: list) -> DataFrame:
        strength = _strength(groups.where("n > 0"), params)
        alpha = strength * prior + F.col("good")
        beta = strength * (1 - prior) + F.col("n") - F.col("good")
        return groups.select(*columns, alpha.alias("alpha"), beta.alias("beta"))

    mean = F.col("alpha") / (F.col("alpha") + F.col("beta"))
    suffixes = drawn(suffixes, whole, ["suffix"]).select("suffix", mean.alias("suffix_mean"))
    domains = drawn(domains.join(suffixes, "suffix"), F.col("suffix_mean"), ["domain"])
    domains = domains.select("domain", mean.alias("domain_mean"))
    found = drawn(placed.join(domains, "domain"), F.col("domain_mean"), ["host", "n", "good"])
    total = F.col("alpha") + F.col("beta")
    deviation = F.sqrt(F.col("alpha") * F.col("beta") / (total * total * (total + 1)))
    return found.select("host", "n", "good", mean.alias("mean"), (mean - params.z * deviation).alias("bound"))


def judged_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    params: Reputation = Reputation(),
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, host_labelled) for every row of ``pages``.

    Needs page_id and url; ``outcomes`` holds page_id and good (0 or 1; rows with a NULL are
    not used, several outcomes of a page all count). Further columns are not read. A NULL
    url, or one without ``://``, has an empty host and path, which is a host like any other.
    Repeated rows are judged alike, a labelled page that is repeated counts as often. Hosts
    without labels take the prior of their domain; an address is a domain of its own.
    ``suffixes`` is a table as in ``with_domains``. An empty table gives an empty table.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    marks = (
        outcomes.where("page_id is not null and good is not null")
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("labels"), F.sum("good").alias("goods"))
    )
    hosts = (
        rows.join(marks, "page_id", "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("labels"), F.lit(0)).alias("n"), F.coalesce(F.sum("goods"), F.lit(0)).alias("good"))
    )
    known = reputations(hosts, params, suffixes)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= params.min_good, "allow").otherwise("block")
    return rows.join(known, "host").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, own).alias("verdict"),
        F.col("n").alias("host_labelled"),
    )


def keep_allowed(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    params: Reputation = Reputation(),
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``pages`` whose url is allowed, all columns as given."""
    verdicts = judged_urls(pages.select("page_id", "url"), outcomes, rules, params, suffixes)
    allowed = verdicts.where("verdict = 'allow'").select("page_id", "host", "path").distinct()
    allowed = allowed.select(F.col("page_id").alias("__page"), F.col("host").alias("__host"), F.col("path").alias("__path"))
    rows = pages.select(
        F.struct("*").alias("row"), "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    same = F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path"))
    return rows.join(allowed, same, "left_semi").select("row.*")
