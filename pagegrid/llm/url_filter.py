"""URL filters: rules by host and path, and trust propagated over the hosts' links for all else."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagegrid.runtime import scratch_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An absolute link of a page: what follows // up to the end of the host.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
#: Rounds of propagation in one job, and links of a host that are joined in one place.
ROUNDS, SLOT = 5, 256


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
]


def host(url: Column) -> Column:
    """From behind the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """From behind the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")


def fitting(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, ruled) of each distinct place (host, path): the longest rule that fits, else null.

    A place meets the rules by equality: of each ending of its host that has as many labels
    as some rule's, and of each beginning of its path that is as long as some rule's. So
    neither many rules nor a hot host makes a place meet rules that don't fit.
    """
    ends = F.array_sort(F.collect_set(F.size(F.split("host", "[.]"))))
    begins = F.array_sort(F.collect_set(F.length("path")))
    shape = rules.where("host is not null and path is not null").agg(ends.alias("ends"), begins.alias("begins")).first()  # no longer than hosts and paths are
    known = rules.select(F.col("host").alias("end"), F.col("path").alias("begin"), F.concat("host", "path").alias("name"), "verdict").distinct()
    wanted = places.distinct()
    within = f"filter(array({', '.join(map(str, shape['ends'])) or '0'}), n -> n > 0 and n <= size(split(host, '[.]')))"
    keyed = wanted.withColumn("end", F.explode(F.expr(f"transform({within}, n -> substring_index(host, '.', -n))")))
    within = f"filter(array({', '.join(map(str, shape['begins'])) or '-1'}), n -> n >= 0 and n <= length(path))"
    keyed = keyed.withColumn("begin", F.explode(F.expr(f"transform({within}, n -> substring(path, 1, n))")))
    fits = keyed.join(known, ["end", "begin"])
    best = F.max_by(F.struct("name", "verdict"), F.struct(F.length("name"), "name", "verdict"))
    found = fits.groupBy("host", "path").agg(best.alias("best"))
    return found.select("host", "path", F.col("best.name").alias("rule"), F.col("best.verdict").alias("ruled"))


def host_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(src, dst, n): pages of a host that link to another host."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1), lambda x: F.translate(x, UPPER, LOWER)))
    links = pages.select(host(F.col(url_col)).alias("src"), F.explode(found).alias("dst"))
    return links.where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(nodes: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-4) -> DataFrame:
    """Personalised PageRank of trust along the links, and of distrust against them.

    nodes: (host, allowed, blocked), how many pages of the host rules allow and block; the
    seeds are these in proportion. links: (src, dst, n). Returns (host, trust, distrust).
    Mass of hosts without a link on goes back to the seeds: that scales all ranks alike, so
    it is left out of the rounds and made good at the end by dividing by the sum.

    `held` of a host sums what has come to it, `moving` is what it passes on next. A round
    makes all that moves at least (1 - damping) less, so the number of rounds follows from
    the tolerance, the share of a kind's rank that may not have arrived; the graph's size
    has no part in it. ROUNDS rounds are one job; each shuffles the flows, summed before.
    Links of a hub are dealt to slots of at most SLOT links, each joined by itself.
    """
    spark = nodes.sparkSession
    both = F.array(
        F.struct(F.lit("t").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n"),
        F.struct(F.lit("d").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"),
    )
    ways = scratch_table(links.select(F.inline(both)), "directed")
    out = scratch_table(ways.groupBy("kind", "host").agg(F.sum("n").alias("out_n"), F.ceil(F.count("*") / SLOT).cast("int").alias("slots")), "out")
    share = (F.lit(damping) * F.col("n") / F.col("out_n")).alias("share")
    slot = F.pmod(F.xxhash64("to"), F.col("slots")).cast("int").alias("slot")
    ways = scratch_table(ways.join(out.hint("merge"), ["kind", "host"]).select("kind", "host", slot, "to", share), "ways")

    total = nodes.agg(F.sum("allowed").alias("t"), F.sum("blocked").alias("d")).first()
    seeds = F.array(*(F.struct(F.lit(k).alias("kind"), "host", (F.col(c) / (total[k] or 1)).alias("held")) for k, c in (("t", "allowed"), ("d", "blocked"))))
    state = nodes.select(F.inline(seeds)).join(out.select("kind", "host", "slots").hint("merge"), ["kind", "host"], "left")
    state = scratch_table(state.select("kind", "host", "held", F.col("held").alias("moving"), "slots"), "rank")
    # All that is still to come is at most moving * damping / (1 - damping), of a sum of held of at least 1.
    least = tolerance * (1 - damping) / damping
    on = F.col("slot") >= 0
    for _ in range(1 + math.ceil(math.log(least) / math.log(damping) / ROUNDS)):
        for _ in range(ROUNDS):
            last = F.when(F.col("moving") > 0, F.coalesce("slots", F.lit(0))).otherwise(0) - 1
            dealt = state.withColumn("slot", F.explode(F.sequence(F.lit(-1), last)))  # -1: what the host holds
            met = dealt.join(ways.hint("merge"), ["kind", "host", "slot"], "left")
            flow = F.when(on, F.col("moving") * F.col("share"))
            met = met.select(
                "kind", F.when(on, F.col("to")).otherwise(F.col("host")).alias("host"), F.coalesce(flow, "held").alias("held"),
                F.coalesce(flow, F.lit(0.0)).alias("moving"), F.when(~on, F.col("slots")).alias("slots"),
            )
            state = met.where("host is not null").groupBy("kind", "host").agg(F.sum("held").alias("held"), F.sum("moving").alias("moving"), F.max("slots").alias("slots"))
        seen = Observation()
        state = scratch_table(state.observe(seen, F.sum(F.when(F.col("slots").isNotNull(), F.col("moving"))).alias("moving")), "rank")
        if (seen.get["moving"] or 0.0) <= least:
            break
    else:
        raise RuntimeError("ranks did not settle")
    sums = {r["kind"]: r["all"] for r in state.groupBy("kind").agg(F.sum("held").alias("all")).collect()}
    part = {k: F.sum(F.when(F.col("kind") == k, F.col("held"))) / F.lit(sums.get(k) or 1.0) for k in "td"}
    return state.groupBy("host").agg(*(F.coalesce(part[k], F.lit(0.0)).alias(n) for k, n in (("t", "trust"), ("d", "distrust"))))


def judge(pages: DataFrame, rules: list[Rule] | DataFrame = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = 0.5, **options) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust, distrust.

    rules: a list, or a table (verdict, host, path) of any size; rules with a null are none.
    A rule fits its host and all subdomains if the path starts with the rule's; the longest
    wins, of equally long ones the last by name, of the same name that which blocks. Where
    none fits, the host is judged: it is blocked if distrust is over `threshold` of its
    trust and distrust together, and allowed otherwise, so also where neither reaches it;
    ranks are exact but for a share of `tolerance` (see propagate). Only absolute links to
    other hosts count. Hosts without a page of their own pass trust on as well. A null url,
    or one without ://, has an empty host and path, is in no graph and allowed unless a rule
    fits. A null page has no links. Repeated rows are answered one by one and count as
    pages. Columns of other names are not read, whatever they are called. An empty table
    gives no rows.
    """
    rules = rules if isinstance(rules, DataFrame) else rules_table(pages.sparkSession, rules)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    seen = scratch_table(rows.select("id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")), "places")
    ruled = scratch_table(fitting(seen.select("host", "path"), rules), "ruled")
    links = scratch_table(host_links(rows, "url", "html"), "links")
    seen = scratch_table(seen.join(ruled.hint("merge"), ["host", "path"], "left"), "judged")
    named = seen.where("host <> ''").groupBy("host").agg(F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked"))
    other = links.select(F.col("dst").alias("host"), F.lit(0).cast("long").alias("allowed"), F.lit(0).cast("long").alias("blocked"))
    nodes = scratch_table(named.unionByName(other).groupBy("host").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")), "hosts")
    scores = scratch_table(propagate(nodes, links, **options), "scores")
    judged = seen.join(scores.hint("merge"), "host", "left")
    by_host = F.when(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")), "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), "trust", "distrust")
