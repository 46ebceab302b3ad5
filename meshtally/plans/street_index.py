"""Street index: addresses per region compressed into runs, shares and lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally.operators import guards
from meshtally.operators.runs import heaviest_per_key, run_starts
from meshtally.operators.shares import dominant_member, member_shares, weighted
from meshtally.schemas import ADDRESS_COLUMNS, STREET
from meshtally.session import settle

NUMBER_BLOCK = 1000   # house numbers per task-sized piece of a street


@dataclass
class StreetIndex:
    """The five tables of the index."""

    runs: DataFrame             # street, numero_inicial, id_regiao
    streets: DataFrame          # street, id_regiao_dominante, n_regioes, fracao
    street_regions: DataFrame   # ambiguous streets: id_regiao, fracao, peso
    street_localities: DataFrame   # ambiguous streets in several localities
    localities: DataFrame       # municipality x locality

    def key_guards(self) -> list[DataFrame]:
        lists = [(self.street_regions, [*STREET, "id_regiao"], "street regions"),
                 (self.street_localities, [*STREET, "bairro", "id_regiao"], "street localities"),
                 (self.localities, ["cd_municipio_ibge", "bairro", "id_regiao"], "localities")]
        return [guards.unique_key(self.runs, [*STREET, "numero_inicial"], "runs"),
                guards.unique_key(self.streets, STREET, "streets"),
                *[guards.unique_key(df, keys, name) for df, keys, name in lists]]

    def guards(self) -> list[DataFrame]:
        shares = [(self.streets, "streets"), (self.street_regions, "street regions"),
                  (self.street_localities, "street localities"), (self.localities, "localities")]
        return [*self.key_guards(), *[guards.no_missing(df, ["fracao"], name) for df, name in shares]]


def usable_rows(counts: DataFrame) -> DataFrame:
    """Rows with a street and a region, weighted; no number becomes 0, no locality ''.

    The counts are stored first: the weights read them twice, and they may come from all addresses.
    """
    guards.require_columns(counts, ADDRESS_COLUMNS, "street index")
    rows = (counts.where(F.col("logradouro").isNotNull() & (F.col("logradouro") != "")
                         & F.col("id_regiao").isNotNull())
            .withColumn("numero", F.coalesce(F.col("numero").cast("bigint"), F.lit(0)).cast("bigint"))
            .withColumn("bairro", F.coalesce("bairro", F.lit(""))))
    return weighted(settle(rows), STREET, "n_domicilios", "n_enderecos")


def build_runs(rows: DataFrame) -> DataFrame:
    """Runs of one region along the house numbers of a street."""
    per_number = rows.groupBy(*STREET, "numero", "id_regiao").agg(F.sum("peso").alias("peso"))
    best = heaviest_per_key(per_number, [*STREET, "numero"], "peso", "id_regiao")
    starts = run_starts(best, STREET, ["numero"], "id_regiao",
                        F.floor(F.col("numero") / NUMBER_BLOCK))
    return starts.select(*STREET, F.col("numero").alias("numero_inicial"), "id_regiao")


def build_index(counts: DataFrame) -> StreetIndex:
    # Each of these feeds several tables of the index.
    rows = settle(usable_rows(counts))
    by_street = settle(member_shares(rows, STREET, "id_regiao"))
    ambiguous = by_street.where("n_regioes > 1")
    named = rows.where("bairro <> ''")
    # A locality only helps on an ambiguous street that runs through more than one.
    split = (named.groupBy(*STREET).agg((F.min("bairro") != F.max("bairro")).alias("_several"))
             .where("_several").drop("_several")
             .join(ambiguous.select(*STREET).distinct(), STREET, "left_semi"))
    by_locality = member_shares(named.join(split, STREET, "left_semi"), [*STREET, "bairro"],
                                "id_regiao")
    by_town = member_shares(named, ["cd_municipio_ibge", "bairro"], "id_regiao")
    share = ["id_regiao", "fracao", "peso"]
    return StreetIndex(
        runs=build_runs(rows), streets=dominant_member(by_street, STREET, "id_regiao"),
        street_regions=ambiguous.select(*STREET, *share),
        street_localities=by_locality.select(*STREET, "bairro", *share),
        localities=by_town.select("cd_municipio_ibge", "bairro", *share))


def ambiguous_coverage(counts: DataFrame) -> DataFrame:
    """Addresses, those without number, and those whose street and number span regions."""
    keys = [*STREET, "numero"]
    per_key = counts.groupBy(*keys).agg(
        F.sum("n_enderecos").alias("n"),
        (F.min("id_regiao") != F.max("id_regiao")).alias("ambigua"))
    # A missing number is no key: it is part of the total only.
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("enderecos"),
        F.coalesce(F.sum(F.when(F.col("numero") == 0, F.col("n"))), F.lit(0)).alias("sem_numero"),
        F.coalesce(F.sum(F.when(F.col("ambigua") & F.col("numero").isNotNull(), F.col("n"))),
                   F.lit(0)).alias("em_chave_ambigua"))
