"""Registered domains by a table of public-suffix rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions.text import host as host_of


def domains_by_rules(rows: DataFrame, url: str, rules: DataFrame, rule: str = "rule") -> DataFrame:
    """``rows`` with ``host`` and ``domain``, one label more than the host's public suffix.

    A rule is a suffix ("co.uk"), a suffix below any label ("*.ck") or an exception to such a
    one ("!www.ck", whose suffix is "ck"). Exceptions prevail, then the rule of most labels; a
    host that no rule meets has its last label as suffix. A host that is a suffix itself has no
    domain, nor has a null host.

    Endings of the distinct hosts meet the rules in an equi-join, so neither side needs to be
    small. Only as many labels of a host are tried as the deepest rule has.
    """
    text = F.lower(F.trim(F.col(rule)))
    known = rules.where(F.length(text) > 0).select(
        F.regexp_replace(text, r"^(?:!|\*\.)", "").alias("ending"),
        text.startswith("!").alias("exception"),
        F.when(text.startswith("!"), -1).when(text.startswith("*."), 1).otherwise(0).alias("more"),
    ).distinct()
    deepest = known.agg(F.max(F.size(F.split("ending", r"\.")))).first()[0] or 1
    named = rows.withColumn("host", host_of(F.col(url)))
    hosts = named.where("host IS NOT NULL").select("host").distinct().withColumn("labels", F.size(F.split("host", r"\.")))
    endings = hosts.select(
        "host", "labels", F.explode(F.sequence(F.lit(1), F.least("labels", F.lit(deepest)))).alias("depth")
    ).withColumn("ending", F.expr("substring_index(host, '.', -depth)"))
    suffix = F.col("depth") + F.coalesce("more", F.lit(0))
    met = endings.join(known, "ending", "left").select(
        "host", "labels", F.when(F.col("exception").isNotNull() & (suffix <= F.col("labels")), F.struct("exception", suffix.alias("suffix"))).alias("met")
    )
    best = met.groupBy("host", "labels").agg(F.coalesce(F.max("met")["suffix"], F.lit(1)).alias("suffix"))
    domain = F.when(F.col("labels") > F.col("suffix"), F.expr("substring_index(host, '.', -(suffix + 1))"))
    return named.join(best.select("host", domain.alias("domain")), "host", "left").select(*rows.columns, "host", "domain")
