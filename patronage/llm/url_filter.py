"""URL filter: fixed rules first, then an empirical-Bayes reputation of the host.

Outcomes of labelled pages are shrunk level by level: the rate of a suffix towards the rate of
all pages, a registered domain towards its suffix, a host towards its domain. A parent's rate
leaves out the child's own pages. The strength of each prior is the beta-binomial moment
estimate over all groups of the level. A host is blocked when the lower posterior bound of its
rate of bad pages exceeds a limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in force: verdict, host and path.
RULES: tuple[tuple[str, str], ...] = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Public suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
    "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za", "com.sg", "com.tw",
)
MAX_BAD = 0.25
Z = 1.645


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix; user and port are left out, an address is its own."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    labels = F.split(bare, r"\.")
    size = F.size(labels)
    two = F.concat_ws(".", F.get(labels, size - 2), F.get(labels, size - 1))
    width = F.when((size >= 2) & two.isin(*TWO_LABEL_SUFFIXES), F.lit(2)).otherwise(F.lit(1))
    address = bare.rlike(r"^[\d.]+$")
    suffix = F.when(address, bare).otherwise(F.array_join(F.slice(labels, -width, width), "."))
    take = F.least(width + 1, size)
    domain = F.when(address, bare).otherwise(F.array_join(F.slice(labels, -take, take), "."))
    return domain, suffix


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct of verdict and rule, of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _strength() -> Column:
    """Beta-binomial prior strength by moments: the excess of the squared deviations of counts
    over binomial ones tells the correlation within groups, kept within 0.001 and 0.999."""
    n, s, m = F.col("n"), F.col("s"), F.col("prior")
    binomial = n * m * (1 - m)
    excess = F.sum((s - n * m) * (s - n * m) - binomial)
    room = F.sum(binomial * (n - 1))
    rho = F.when(room > 0, F.least(F.lit(0.5), F.greatest(F.lit(0.001), excess / room))).otherwise(F.lit(0.001))
    return 1 / rho - 1


def host_reputation(outcomes: DataFrame, hosts: DataFrame, z: float = Z) -> DataFrame:
    """``host``, ``labelled``, ``bad_rate`` and ``bad_low`` for every host of ``hosts``.

    ``outcomes`` has (host, bad), bad 0 or 1, one row per labelled page; nulls are skipped.
    All pages together start from one bad and one good page. The bound lies ``z`` standard
    deviations of the posterior below its mean.
    """
    counts = (
        outcomes.where("bad is not null")
        .groupBy("host")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("s"))
    )
    host = F.col("host")
    domain, suffix = domain_and_suffix(host)
    base = (
        hosts.select("host")
        .distinct()
        .join(counts, "host", "left")
        .select("host", domain.alias("domain"), suffix.alias("suffix"), *(F.coalesce(c, F.lit(0.0)).alias(c) for c in "ns"))
    )
    sums = [F.sum("n").alias("n"), F.sum("s").alias("s")]
    domains = base.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    whole = suffixes.agg(F.struct(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in "ns"))).scalar()
    suffixes = suffixes.withColumn("prior", (whole["s"] - F.col("s") + 1) / (whole["n"] - F.col("n") + 2))

    def fitted(groups: DataFrame) -> DataFrame:
        """The level's strength beside each group's prior."""
        return groups.withColumn("strength", groups.agg(_strength()).scalar())

    def as_parents(groups: DataFrame, key: str) -> DataFrame:
        return fitted(groups).select(
            key,
            F.col("n").alias("up_n"),
            F.col("s").alias("up_s"),
            (F.col("strength") * F.col("prior")).alias("up_a"),
            F.col("strength").alias("up_k"),
        )

    def below(groups: DataFrame, parents: DataFrame, key: str) -> DataFrame:
        """Prior rate of each group: its parent's posterior without the group's own pages."""
        return groups.join(as_parents(parents, key), key).withColumn(
            "prior",
            (F.col("up_s") - F.col("s") + F.col("up_a")) / (F.col("up_n") - F.col("n") + F.col("up_k")),
        )

    domains = below(domains, suffixes, "suffix")
    base = fitted(below(base.drop("suffix"), domains, "domain"))
    alpha = F.col("s") + F.col("strength") * F.col("prior")
    beta = F.col("n") - F.col("s") + F.col("strength") * (1 - F.col("prior"))
    posterior = base.select("host", F.col("n").cast("long").alias("labelled"), alpha.alias("a"), beta.alias("b"))
    a, b = F.col("a"), F.col("b")
    spread = F.sqrt(a * b / (a + b + 1)) / (a + b)
    return posterior.select(
        "host",
        "labelled",
        (a / (a + b)).alias("bad_rate"),
        F.greatest(F.lit(0.0), a / (a + b) - F.lit(z) * spread).alias("bad_low"),
    )


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    max_bad: float = MAX_BAD,
    z: float = Z,
) -> DataFrame:
    """page_id, host, path, rule, verdict, labelled, bad_rate and bad_low per row of ``pages``.

    ``outcomes`` has (page_id, bad). A page with several outcomes counts each, a repeated page
    once per row. A null url, or one without ``://``, has an empty host and path and is judged as
    the host "". Without outcomes every host has the prior rate of one half and a bound below it.
    """
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = outcomes.select("page_id", "bad").where("bad is not null")
    judged = host_reputation(seen.join(known, "page_id").select("host", "bad"), seen, z)
    found = seen.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    return found.join(judged, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(
            F.col("found.verdict"), F.when(F.col("bad_low") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
        "labelled",
        "bad_rate",
        "bad_low",
    )
