"""URL filter: rules first, and a character language-model ratio for what no rule covers.

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, are
one table of character triples: a triple backs off to the pair and the single character.
The table's rows are triples of a fixed alphabet, so its size is bounded whatever the
input. A URL's score is the difference of its log-likelihoods by character; the threshold
is calibrated between the scores of accepted and rejected URLs. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import ascii_lower, stored

START, END, OTHER = "\x02", "\x03", "\x01"
ALPHABET = 97  # printable ASCII, one for all else, the end; triples: fewer than 98 ** 3
PRIOR = 2.0  # weight of the shorter context, in observations
SLICE = 1 << 20  # characters that a task takes to triples


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lowered) and path; both empty for null or without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def triples(address: Column) -> Column:
    """One triple for each character and the end, the earlier characters first."""
    padded = F.concat(F.lit(START * 2), F.regexp_replace(address, "[^!-~]", OTHER), F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substr(padded, i, F.lit(3)))


def spread(addresses: DataFrame) -> DataFrame:
    """The addresses over as many partitions as their length asks for: a character becomes a row."""
    length = addresses.agg(F.sum(F.length("address") + 1)).first()[0] or 0
    return addresses.repartition(1 + length // SLICE)


def model(examples: DataFrame) -> DataFrame:
    """(triple, ratio): log-likelihood difference of every triple of examples (address, verdict).

    Rows without verdict count nothing, but their triples are in the table.
    """
    each = examples.select(F.explode(triples(F.col("address"))).alias("triple"),
                           F.coalesce(F.col("verdict") == "allow", F.lit(False)).cast("bigint").alias("allow"),
                           F.coalesce(F.col("verdict") == "block", F.lit(False)).cast("bigint").alias("block"))
    sides = ("allow", "block")
    full = each.groupBy("triple").agg(*(F.sum(s).alias(s) for s in sides))
    full = stored(full.select("triple", F.substr("triple", F.lit(2), F.lit(2)).alias("pair"),
                       F.substr("triple", F.lit(3), F.lit(1)).alias("one"),
                       F.substr("triple", F.lit(1), F.lit(2)).alias("ctx2"),
                       F.substr("triple", F.lit(2), F.lit(1)).alias("ctx1"), *sides))

    def totals(key: str) -> DataFrame:
        return full.groupBy(key).agg(*(F.sum(s).alias(f"{s}_{key}") for s in sides))

    for key in ("pair", "one", "ctx2", "ctx1"):
        full = full.join(totals(key), key)
    every = full.join(F.broadcast(full.agg(*(F.sum(s).alias(f"{s}_n") for s in sides))))  # one row
    ratio = F.lit(0.0)
    for s, sign in (("allow", 1), ("block", -1)):
        p = F.lit(1.0 / ALPHABET)
        for count, total in ((f"{s}_one", f"{s}_n"), (f"{s}_pair", f"{s}_ctx1"), (s, f"{s}_ctx2")):
            p = (F.col(count) + PRIOR * p) / (F.col(total) + PRIOR)
        ratio = ratio + sign * F.log(p)
    return every.select("triple", ratio.alias("ratio"))


def scored(addresses: DataFrame, ratios: DataFrame) -> DataFrame:
    """addresses (distinct `address`, with `verdict`) and their length-normalised score."""
    each = addresses.select("address", "verdict", F.explode(triples(F.col("address"))).alias("triple"))
    return (each.join(F.broadcast(ratios), "triple")  # fewer than 98 ** 3 rows
            .groupBy("address", "verdict").agg(F.avg("ratio").alias("score")))


def threshold(scores: DataFrame) -> float:
    """Between the mean scores of both sides, at as many standard deviations from either; 0 if a side has none."""
    found = {r.verdict: r for r in scores.where("verdict IS NOT NULL").groupBy("verdict")
             .agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread")).collect()}  # two rows
    if len(found) < 2:
        return 0.0
    a, b = found["allow"], found["block"]
    wide = a.spread + b.spread
    return round((a.mean + b.mean) / 2 if not wide else (a.mean * b.spread + b.mean * a.spread) / wide, 9)


def judge(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", page_id: str = "page_id",
          whole: bool = False) -> DataFrame:
    """page_id, host, path, rule, verdict and score of each row of pages.

    rules: (allow or block, host/path). A rule fits its host and all subdomains where the
    path starts with the rule's; the longest wins. Without a fitting rule the score decides
    and `rule` is null; `score` is null where a rule decides. A null or schemeless url has
    an empty host and path. With `whole` the models learn from and score each url as it is,
    null as empty; without it only host and path, so a schemeless url counts as empty.
    Repeated urls are scored once and judged alike. Without rule-judged examples of both
    sides the threshold is 0. An empty table gives no row. Other columns are not read.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    address = F.coalesce(F.col(f"`{url}`"), F.lit("")) if whole else F.concat(host, path)
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), host.alias("host"), path.alias("path"), address.alias("address"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "host", "path", "address", "_rule.*")
    distinct = spread(stored(rows.groupBy("address").agg(F.first("verdict").alias("verdict"))))
    scores = stored(scored(distinct, stored(model(distinct))))
    least = threshold(scores)
    new = scores.where("verdict IS NULL").select("address", F.round("score", 9).alias("score"))
    return rows.join(new, "address", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("score") >= least, "allow").otherwise("block")).alias("verdict"),
        F.when(F.col("verdict").isNull(), F.col("score")).alias("score"))
