"""Host reputation by empirical Bayes, and url rules.

Labelled page outcomes are counted per host. The share of good pages of a host is shrunk
towards its registered domain, the domain's towards its suffix, the suffix's towards all
pages. How strongly is estimated on each level from the spread of the children around
their parents (method of moments for a beta-binomial). A host is blocked when the upper
bound of its posterior share of good pages lies below ``floor``.

DataFrame functions only. Outcomes are summed per host before anything is joined, so a host
with a third of all pages costs one row. Null urls have an empty host and are judged like
any other host; pages without an outcome count for nothing; repeated pages count as often as
they occur; without any outcome every host keeps the neutral prior and is allowed. Other
input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T
from starling.session import broadcast_if_small

URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# fixed values: public suffixes of two labels that are treated as one suffix
TWO_LABEL_SUFFIXES = (
    "co.uk org.uk ac.uk gov.uk com.au net.au org.au co.nz co.jp ne.jp or.jp co.kr com.br com.cn com.tw com.mx co.in co.za com.tr"
).split()
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, and a path prefix; ``text`` is both together, like ``net/fr/``."""

    action: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


@dataclass(frozen=True)
class Config:
    floor: float = 0.5  # least acceptable share of good pages
    z: float = 1.645  # one-sided 95 % bound
    least_spread: float = 1e-4  # bounds of the correlation within a parent
    most_spread: float = 0.9


def host_of(url: str = "url") -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PATTERN, 1), F.lit("")), ascii_uppercase, ascii_lowercase)


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def matched_rule(rules: tuple[Rule, ...], host: str = "host", path: str = "path") -> Column:
    """Text of the longest rule that fits, else null. Rules are a short stated list: beyond a limit, an error."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: join them as a table instead")
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)) & F.col(path).startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def _levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    two = F.concat_ws(".", F.slice(labels, -2, 2))
    suffix_labels = F.when((size >= 3) & two.isin(TWO_LABEL_SUFFIXES), 2).otherwise(1)
    short = size <= suffix_labels
    domain = F.when(short, host).otherwise(F.concat_ws(".", F.slice(labels, -(suffix_labels + 1), suffix_labels + 1)))
    suffix = F.when(short, host).otherwise(F.concat_ws(".", F.slice(labels, -suffix_labels, suffix_labels)))
    return domain, suffix


def _strength(children: DataFrame, config: Config) -> float:
    """Prior weight in pages, from rows (good, seen, parent share ``m``)."""
    share, odds = F.col("good") / F.col("seen"), F.col("m") * (1 - F.col("m"))
    # sums as exact decimals: the same in any order of rows
    exact = lambda c: F.coalesce(F.sum(F.round(c, 9).cast("decimal(28,9)")), F.lit(0)).cast("double")
    row = children.filter("seen >= 2").agg(
        exact(F.col("seen") * (share - F.col("m")) ** 2 - odds).alias("spread"),
        exact(odds * (F.col("seen") - 1)).alias("whole"),
    ).first()
    rho = row["spread"] / row["whole"] if row["whole"] > 0 else 0.1
    return 1 / min(max(rho, config.least_spread), config.most_spread) - 1


def reputations(outcomes: DataFrame, config: Config = Config()) -> DataFrame:
    """One row per host of ``outcomes(host, good)``: posterior parameters, upper bound, verdict.

    ``good`` is 0, 1 or null for pages without an outcome.
    """
    domain, suffix = _levels(F.col("host"))
    hosts = T.staged(
        outcomes.groupBy("host").agg(
            F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"), F.count("good").alias("seen")
        ).withColumns({"domain": domain, "suffix": suffix}),
        "hosts",
    )
    total = hosts.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("seen"), F.lit(0))).first()
    level, parent = hosts.withColumn("m", F.lit((total[0] + 1) / (total[1] + 2))), None
    for name in ("suffix", "domain", "host"):
        counts = hosts.groupBy(name, *(["suffix"] if name == "domain" else [])).agg(F.sum("good").alias("good"), F.sum("seen").alias("seen")) if name != "host" else hosts
        children = counts.join(parent, key) if parent is not None else counts.withColumn("m", F.lit((total[0] + 1) / (total[1] + 2)))
        weight = F.lit(_strength(children, config))
        alpha, beta = F.col("m") * weight + F.col("good"), (1 - F.col("m")) * weight + F.col("seen") - F.col("good")
        level = children.withColumns({"alpha": alpha, "beta": beta})
        key, parent = name, level.select(name, (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("m"))
    # normal bound on the log-odds: stays within 0 and 1 for any alpha and beta
    upper = F.log(F.col("alpha") / F.col("beta")) + config.z * F.sqrt(1 / F.col("alpha") + 1 / F.col("beta"))
    judged = level.withColumn("upper", 1 / (1 + F.exp(-upper)))
    return judged.select(
        "host", "seen", "good", "upper", F.when(F.col("upper") < config.floor, "block").otherwise("allow").alias("reputation")
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...], config: Config = Config()) -> DataFrame:
    """Verdict on every row of ``pages(page_id, url)``: the longest rule's, else the host's reputation.

    ``outcomes(url, good)`` are the labelled pages. A host that has none of them is allowed
    unless its domain's pages say otherwise: all hosts of ``pages`` take part with no outcome.
    """
    urls = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    known = outcomes.select(host_of().alias("host"), F.col("good").cast("int").alias("good"))
    every = urls.select("host", F.lit(None).cast("int").alias("good"))
    found = T.staged(reputations(known.unionByName(every), config), "reputations")
    action = F.lit(None).cast("string")
    for rule in rules:
        action = F.when(F.col("rule") == rule.text, F.lit(rule.action)).otherwise(action)
    joined = urls.join(broadcast_if_small(found.select("host", "seen", "reputation"), found), "host")
    return joined.withColumn("rule", matched_rule(rules)).select(
        "page_id", "host", "path", "rule", F.coalesce(action, "reputation").alias("verdict"), F.col("seen").alias("host_outcomes")
    )


def kept(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """The pages whose id was allowed."""
    return pages.join(judged.filter("verdict = 'allow'").select("page_id").distinct(), "page_id", "left_semi")
