"""Host reputation by empirical Bayes, and rules on hosts and paths, as column expressions and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let, lower_ascii
from .shared import materialised
from .words import fresh

#: Fixed values: (verdict, rule) as host/path-prefix.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
#: Labels that, before a country's two letters, are part of the suffix under which domains are registered. A rule, not a list of all suffixes.
SECOND = ("ac", "asn", "co", "com", "ed", "edu", "go", "gob", "gouv", "gov", "gub", "gv", "id", "info", "kr", "lg", "ltd", "me", "mil", "mod", "ne", "net", "nhs", "nic", "nom", "or", "org", "plc", "police", "re", "res", "sch", "school", "web")


def parsed(url: Column) -> Column:
    """struct<host, path>: empty for null or a url without "://"."""
    rest = F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    return let(
        F.coalesce(rest, F.lit("")),
        lambda r: let(
            F.regexp_extract(r, "^[^/?#]*", 0),
            lambda h: F.struct(lower_ascii(h).alias("host"), F.regexp_extract(F.substring(r, F.length(h) + 1, F.length(r)), "^[^?#]*", 0).alias("path")),
        ),
    )


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one. Rules are a short list in the plan."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def levels(host: Column, second: tuple[str, ...]) -> tuple[Column, Column]:
    """Registered domain and suffix: the last label (before a country's two letters, also one of `second`) and one label more; addresses in digits are their own domain."""
    last, two = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    number, long = last.rlike("^[0-9]+$"), last.rlike("^[a-z][a-z]$") & F.substring_index(two, ".", 1).isin(*second)
    suffix = F.when(number, F.lit("")).when(long, two).otherwise(last)
    domain = F.when(number, host).when(long, F.substring_index(host, ".", -3)).otherwise(two)
    return domain, suffix


def shrunk(level: DataFrame, prior: float) -> DataFrame:
    """level(n, bad, parent): mean and variance of the beta posterior whose prior is the parent's mean with the given strength."""
    a, b = prior * F.col("parent") + F.col("bad"), prior * (1 - F.col("parent")) + F.col("n") - F.col("bad")
    return level.withColumns({"mean": a / (a + b), "var": a * b / ((a + b) * (a + b) * (a + b + 1))})


def strength(level: DataFrame, least: float, most: float) -> float:
    """Prior strength 1/rho - 1 by moments: E[n (p - parent)^2] = parent (1 - parent) (1 + (n - 1) rho). One row comes to the driver."""
    v, n = F.col("parent") * (1 - F.col("parent")), F.col("n")
    row = level.where("n > 0").agg(F.sum(n * (F.col("bad") / n - F.col("parent")) * (F.col("bad") / n - F.col("parent")) - v).alias("over"), F.sum((n - 1) * v).alias("room")).first()
    rho = row.over / row.room if row.over is not None and row.room else 0.0
    return min(most, max(least, 1 / rho - 1 if rho > 0 else most))


def reputations(outcomes: DataFrame, *, second: tuple[str, ...] = SECOND, least: float = 1.0, most: float = 10_000.0) -> DataFrame:
    """outcomes(host, n, bad): a row for each host with its posterior `mean` and `var` of the share of bad pages.

    Rates of suffixes shrink towards the rate of all pages, those of domains towards their suffix, those of hosts towards their domain;
    hosts with n = 0 get what their domain has. Rows of one host are added up first, and the hosts, and later the domains, are kept in the shared folder, so that nothing
    before them is gone through again for the few numbers that the driver asks for. No rows: no reputations."""
    hosts = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domain, suffix = levels(F.col("host"), second)
    hosts = materialised(hosts.withColumns({"domain": domain, "suffix": suffix}))
    every = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    root = ((every.bad or 0) + 1) / ((every.n or 0) + 2)
    most = max(least, min(most, (every.n or 0) + 2))  # no prior weighs more than all outcomes together
    of_suffix = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("parent", F.lit(root))
    of_suffix = shrunk(of_suffix, strength(of_suffix, least, most))
    of_domain = materialised(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(of_suffix.select("suffix", F.col("mean").alias("parent")), "suffix"))
    of_domain = shrunk(of_domain, strength(of_domain, least, most))
    of_host = materialised(hosts.join(of_domain.select("domain", "suffix", F.col("mean").alias("parent")), ["domain", "suffix"]))
    return shrunk(of_host, strength(of_host, least, most)).select("host", "domain", "suffix", "n", "bad", "mean", "var")


def judge(pages: DataFrame, outcomes: DataFrame, *, url: str = "url", rules: list[tuple[str, str]] = RULES, max_bad: float = 0.25, z: float = 1.645, keep: list[str] | None = None, **how) -> DataFrame:
    """`keep` (default: all columns) and host, path, rule, bad_rate, bound, verdict for each page.

    outcomes(url, bad): labelled pages; rows with null bad are left out of the counts. A page without a rule is blocked when the lower bound
    mean - z * sd of its host's share of bad pages exceeds max_bad. Null urls and urls without "://" have the host "", a host like any
    other. Urls may have any length. Empty tables give empty results, or without outcomes a share of 0.5 with a wide bound, which blocks nothing. Repeated rows are
    judged each. Columns with the new names give way, others may have any name. The join on the host is left to adaptive execution, which splits a frequent host."""
    new = ["host", "path", "rule", "bad_rate", "bound", "verdict"]
    kept = [c for c in (pages.columns if keep is None else keep) if c not in new]
    (made,) = fresh(pages, "parsed")
    own = pages.select(*(pages[c] for c in kept), parsed(pages[url]).alias(made)).select(*kept, F.col(f"{made}.host").alias("host"), F.col(f"{made}.path").alias("path"))
    seen = outcomes.where("bad is not null").select(parsed(F.col("url"))["host"].alias("host"), F.lit(1).cast("long").alias("n"), F.col("bad").cast("long").alias("bad"))
    counted = seen.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    all_hosts = own.groupBy("host").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    known = reputations(counted.unionByName(all_hosts), **how).select("host", F.col("mean").alias("bad_rate"), (F.col("mean") - z * F.sqrt("var")).alias("bound"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    found = own.join(known, "host", "left")
    return found.select(*kept, "host", "path", rule.alias("rule"), "bad_rate", "bound", F.coalesce(verdict, F.when(F.col("bound") > max_bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def outcomes_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of pages whose url names a labelled document, its number being the first all-digit start of a path segment; bad: of low quality or toxic."""
    number = F.regexp_extract(parsed(F.col("url"))["path"], "/([0-9]{1,18})", 1)
    judged = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    return pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id")).join(judged, "doc_id").select("url", "bad")
