"""Rules a publication must satisfy; every rule returns problem rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.operators import guards
from meshtally.operators.guards import problem_rows


def list_slack(n: Column) -> Column:
    """How far a list of rounded fractions may be from 1: it grows with the list."""
    return F.greatest(F.lit(K.SHARE_SLACK), n * K.SHARE_SLACK_PER_ITEM)


def _label(*columns: str) -> Column:
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in columns])


def cited_regions(citations: DataFrame, regions: DataFrame, what: list[str], context: str) -> DataFrame:
    """Cited regions that the municipality does not publish."""
    lost = citations.join(regions.select("cd_municipio_ibge", "id_regiao").distinct(),
                          ["cd_municipio_ibge", "id_regiao"], "left_anti").distinct()
    return problem_rows(lost, "unknown region", context,
                        F.concat(_label(*what), F.lit(": "), F.col("id_regiao").cast("string")))


def fraction_lists(docs: DataFrame, keys: list[str], context: str) -> DataFrame:
    """Fractions of a list add up to 1 and never rise.

    `docs` has keys, parte and regioes (array of id_regiao, fracao).
    """
    lists = docs.where(F.size("regioes") > 0)
    part = lists.select(*keys, F.size("regioes").alias("n"),
                        F.aggregate("regioes", F.lit(0.0), lambda a, x: a + x["fracao"]).alias("s"),
                        F.transform("regioes", lambda x: x["fracao"]).alias("f"))
    sums = part.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    off = sums.where(F.abs(F.col("s") - 1) > list_slack(F.col("n")))
    rising = part.where(~F.sort_array("f", asc=False).eqNullSafe(F.col("f")))
    return problem_rows(off, "fractions", context, F.concat(
        _label(*keys), F.lit(": add up to "), F.round("s", 3).cast("string"))).unionByName(
        problem_rows(rising, "order", context, F.concat(_label(*keys), F.lit(": not descending"))))


def street_problems(docs: DataFrame, local: DataFrame, regions: DataFrame) -> DataFrame:
    """All rules of street documents and their localities."""
    key = ["cd_municipio_ibge", "nome"]
    cited = (docs.select(*key, F.col("regiao_provavel").alias("id_regiao"))
             .unionByName(docs.select(*key, F.explode("trechos").alias("t")).select(*key, "t.id_regiao"))
             .unionByName(docs.select(*key, F.explode("regioes").alias("t")).select(*key, "t.id_regiao"))
             .unionByName(local.select(*key, F.explode("regioes").alias("t")).select(*key, "t.id_regiao")))
    bare = docs.groupBy(*key).agg(F.max("n_regioes").alias("n"),
                                  F.sum(F.coalesce(F.size("regioes"), F.lit(0))).alias("k")).where(
        "n > 1 and k <= 0")
    return (cited_regions(cited, regions, ["nome"], "street")
            .unionByName(problem_rows(bare, "ambiguous street", "street",
                                      F.concat("nome", F.lit(": no list of regions"))))
            .unionByName(fraction_lists(docs, key, "street"))
            .unionByName(fraction_lists(local, [*key, "bairro"], "street locality")))


def locality_problems(docs: DataFrame, regions: DataFrame) -> DataFrame:
    key = ["cd_municipio_ibge", "nome"]
    cited = docs.select(*key, F.explode("regioes").alias("t")).select(*key, "t.id_regiao")
    return cited_regions(cited, regions, ["nome"], "locality").unionByName(
        fraction_lists(docs, key, "locality"))


def candidate_problems(candidates: DataFrame, keys: list[str], context: str,
                       closes: Column | None = None) -> DataFrame:
    """Rules of candidate rows (keys, nome, votos, pct): ranges; where `closes` holds,
    shares of a contest add up to 100."""
    bad = candidates.where(~F.col("pct").between(0, 100) | (F.col("votos") < 0))
    sums = candidates.where(closes) if closes is not None else candidates
    off = sums.groupBy(*keys).agg(F.sum("pct").alias("s")).where(F.abs(F.col("s") - 100) > K.PCT_SLACK)
    return problem_rows(bad, "range", context, F.concat(_label(*keys), F.lit(": "), "nome")).unionByName(
        problem_rows(off, "percent", context, F.concat(_label(*keys), F.lit(": shares add up to "),
                                                       F.round("s", 2).cast("string"))))


def abstention_problems(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Abstention never below zero, never without voters, never above them."""
    known = rows.where("abstencao is not null")
    why = (F.when(F.col("abstencao") < 0, "negative").when(F.col("qt_eleitores").isNull(), "no voters")
           .when(F.col("abstencao") > F.col("qt_eleitores"), "above voters"))
    bad = known.withColumn("_w", why).where("_w is not null")
    return problem_rows(bad, "abstention", "region", F.concat(_label(*keys), F.lit(": "), "_w"))


def key_format(df: DataFrame, column: str, context: str) -> DataFrame:
    bad = df.where(~F.coalesce(F.col(column).rlike(K.PUBLIC_KEY_FORMAT), F.lit(False)))
    return problem_rows(bad, "key format", context, F.coalesce(F.col(column), F.lit("null")))


def region_problems(regions: DataFrame, candidates: DataFrame, abstentions: DataFrame, keys: list[str],
                    closes: Column | None = None) -> DataFrame:
    """All rules of published region results at once: public keys, candidate rows, abstention.

    regions: cd_municipio_ibge, id_publico; candidates and abstentions carry `keys`.
    """
    return (key_format(regions, "id_publico", "region")
            .unionByName(guards.unique_key(regions, ["cd_municipio_ibge", "id_publico"], "public key"))
            .unionByName(candidate_problems(candidates, keys, "region", closes))
            .unionByName(abstention_problems(abstentions, keys)))


def aggregate_problems(candidates: DataFrame, totals: DataFrame, keys: list[str], context: str) -> DataFrame:
    """A territory result: no repeated name, not too many names, closes at 100, and no
    more valid votes than votes."""
    twice = candidates.groupBy(*keys, "nome").agg(F.count("*").alias("n")).where("n > 1")
    many = candidates.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > K.MAX_CANDIDATES)
    valid = candidates.groupBy(*keys).agg(F.sum("votos").alias("v")).join(totals, keys).where("v > total")
    return (candidate_problems(candidates, keys, context)
            .unionByName(problem_rows(twice, "repeated candidate", context,
                                      F.concat(_label(*keys), F.lit(": "), "nome")))
            .unionByName(problem_rows(many, "too many candidates", context, _label(*keys)))
            .unionByName(problem_rows(valid, "valid votes", context,
                                      F.concat(_label(*keys), F.lit(": more valid votes than votes")))))


def country_covers_states(country: DataFrame, states: DataFrame, keys: list[str]) -> DataFrame:
    """States add up to no more than the country, and to at most one percent less."""
    both = country.select(*keys, F.col("total").alias("br")).join(
        states.groupBy(*keys).agg(F.sum("total").alias("ufs")), keys, "left").fillna(0, ["ufs"])
    why = F.when(F.col("ufs") > F.col("br"), "states exceed the country").when(
        F.col("br") - F.col("ufs") > F.col("br") * 0.01, "too many votes outside the states")
    bad = both.withColumn("_w", why).where("_w is not null")
    return problem_rows(bad, "country", "aggregates", F.concat(_label(*keys), F.lit(": "), "_w"))


def share_problems(share: DataFrame, aliases: DataFrame, regions: DataFrame) -> DataFrame:
    """Link keys: format, uniqueness, right region, no alias that is a key, no dangling alias.

    `regions` has cd_municipio_ibge, id_regiao and id_publico.
    """
    on = ["cd_municipio_ibge", "chave"]
    keys = regions.select("cd_municipio_ibge", F.col("id_publico").alias("chave")).distinct()
    here = regions.select("cd_municipio_ibge", F.col("id_regiao").alias("regiao"),
                          F.col("id_publico").alias("_key"))
    pointed = share.join(here, ["cd_municipio_ibge", "regiao"], "left")
    wrong = pointed.where(F.col("_key").isNull() | (F.col("_key") != F.col("chave")))
    crowded = share.where(F.size("candidatos") > 2)
    odd = share.where(F.exists("candidatos", lambda c: ~c["pct"].between(0, 100)))
    named = aliases.withColumnRenamed("apelido", "chave")
    double = named.join(share.select(*on), on, "left_semi")
    target = aliases.select("cd_municipio_ibge", F.col("id_publico").alias("chave"), "apelido")
    dangling = target.join(keys, on, "left_anti")
    return (key_format(share, "chave", "share").unionByName(key_format(aliases, "apelido", "alias"))
            .unionByName(guards.unique_key(regions, ["cd_municipio_ibge", "id_publico"], "public key"))
            .unionByName(problem_rows(wrong, "share region", "share", _label("cd_municipio_ibge", "chave")))
            .unionByName(problem_rows(crowded, "share candidates", "share", _label("cd_municipio_ibge", "chave")))
            .unionByName(problem_rows(odd, "range", "share", _label("cd_municipio_ibge", "chave")))
            .unionByName(problem_rows(double, "alias is a key", "alias", _label("cd_municipio_ibge", "chave")))
            .unionByName(problem_rows(dangling, "dangling alias", "alias", _label("cd_municipio_ibge", "apelido"))))


def index_counts(states: DataFrame, municipalities: DataFrame) -> DataFrame:
    """The state index agrees with the lists of municipalities."""
    real = municipalities.groupBy(F.col("sg_uf").alias("sigla")).agg(F.count("*").alias("n"))
    bad = states.join(real, "sigla", "full").where(~F.col("n").eqNullSafe(F.col("n_municipios")))
    return problem_rows(bad, "index counts", "states", F.concat(
        "sigla", F.lit(": index "), F.coalesce(F.col("n_municipios").cast("string"), F.lit("none")),
        F.lit(", list "), F.coalesce(F.col("n").cast("string"), F.lit("none"))))


def documents_present(municipalities: DataFrame, **published: DataFrame) -> DataFrame:
    """Municipalities of the index without documents of some kind."""
    out = None
    for name, df in published.items():
        gap = municipalities.join(df.select("cd_municipio_ibge").distinct(), "cd_municipio_ibge", "left_anti")
        rows = problem_rows(gap, "missing documents", name, F.col("cd_municipio_ibge"))
        out = rows if out is None else out.unionByName(rows)
    return out
