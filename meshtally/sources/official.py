"""Nested official documents flattened to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.operators import guards


def sections(config: DataFrame, announced_only: bool = False) -> DataFrame:
    """Section config to one row per principal section.

    Aggregated sections (`nsp`) have no ballot box of their own. With
    `announced_only`, only sections whose files exist (`da`).
    """
    rows = (config.select(F.explode("abr").alias("a"))
            .select(F.col("a.cd").alias("uf"), F.explode("a.mu").alias("m"))
            .select("uf", F.col("m.cd").alias("municipio"), F.col("m.nm").alias("municipio_nome"),
                    F.explode("m.zon").alias("z"))
            .select("uf", "municipio", "municipio_nome", F.col("z.cd").alias("zona"),
                    F.explode("z.sec").alias("s")))
    out = rows.where(F.coalesce(F.col("s.nsp"), F.lit("")) == "")
    if announced_only:
        out = out.where(F.coalesce(F.col("s.da"), F.lit("")) != "")
    return out.select("uf", "municipio", "municipio_nome", "zona", F.col("s.ns").alias("secao"),
                      F.col("s.da").alias("data_aux"), F.col("s.ha").alias("hora_aux"))


def elections(catalogue: DataFrame) -> DataFrame:
    return (catalogue.select(F.explode("pl").alias("p"))
            .select(F.col("p.c").alias("ciclo"), F.col("p.cd").alias("pleito"),
                    F.col("p.dt").alias("data"), F.explode("p.e").alias("e"))
            .select(F.col("e.cd").alias("codigo"), F.col("e.nm").alias("nome"),
                    F.col("e.t").alias("turno"), "ciclo", "pleito", "data"))


def _ordinary(found: DataFrame, year: int, round_: str) -> DataFrame:
    return found.where((F.col("ciclo") == f"ele{year}") & (F.col("turno") == round_)
                       & F.lower("nome").contains("ordin"))


def federal_election(found: DataFrame, year: int, round_: str = "1") -> DataFrame:
    """The one ordinary federal election of the year; none or several is an error."""
    one = _ordinary(found, year, round_).where(F.lower("nome").contains("federal"))
    guards.enforce(guards.exactly_one(one, f"federal election {year}/{round_}"))
    return one


def election_per_office(found: DataFrame, year: int, round_: str = "1") -> DataFrame:
    """Office code -> code of the election that counts it; unknown offices are left out."""
    kind = F.lower("nome")
    named = _ordinary(found, year, round_).select(
        "codigo", F.explode(F.array_compact(F.array(*[
            F.when(kind.contains(k), k) for k in ("federal", "estadual", "municipal")]))).alias("especie"))
    codes = named.groupBy("especie").agg(F.min("codigo").alias("codigo"))
    offices = found.sparkSession.createDataFrame(list(K.OFFICE_KIND.items()), "cargo int, especie string")
    return offices.join(codes, "especie").select("cargo", "codigo")


def result_votables(results: DataFrame, keys: list[str]) -> DataFrame:
    """Official result to candidate rows and party-list rows (list votes above zero)."""
    parties = (results.select(*keys, F.explode("carg").alias("c"))
               .select(*keys, F.explode("c.agr").alias("a"))
               .select(*keys, F.explode("a.par").alias("p")))
    lists = parties.where(F.coalesce(F.col("p.tvtl").cast("bigint"), F.lit(0)) > 0).select(
        *keys, F.lit("legenda").alias("tipo_voto"), F.col("p.n").alias("nr_votavel"),
        F.concat(F.coalesce("p.sg", F.lit("")), F.lit(" (legenda)")).alias("nome"),
        F.col("p.sg").alias("partido"), F.col("p.tvtl").cast("bigint").alias("votos"))
    people = parties.select(*keys, F.col("p.sg").alias("partido"), F.explode("p.cand").alias("k")).select(
        *keys, F.lit("nominal").alias("tipo_voto"), F.col("k.n").alias("nr_votavel"),
        F.coalesce("k.nmu", F.lit("")).alias("nome"), "partido",
        F.coalesce(F.col("k.vap").cast("bigint"), F.lit(0)).alias("votos"))
    return people.unionByName(lists)


def _count(c: str) -> Column:
    return F.coalesce(F.col(f"v.{c}").cast("bigint"), F.lit(0).cast("bigint"))


def result_totals(results: DataFrame, keys: list[str]) -> DataFrame:
    """Official totals put back to what the ballot boxes recorded.

    Valid votes are the larger of the summary and the sum of its parts, plus votes
    the official count moved to null. `avisos` block, `notas` only describe.
    """
    parts = _count("vnom") + _count("vl") + _count("van") + _count("vansj")
    valid = F.greatest(_count("vvc"), parts)
    nulls = F.coalesce(F.col("v.tvn").cast("bigint"), F.col("v.vn").cast("bigint"), F.lit(0))
    moved = _count("vnt")
    turnout = F.coalesce(F.col("e.c").cast("bigint"), F.lit(0))
    total = valid + _count("vb") + nulls
    declared = F.coalesce(F.col("v.tv").cast("bigint"), total)
    return results.select(
        *keys, turnout.alias("comparecimento"), (valid + moved).alias("validos"),
        _count("vb").alias("brancos"), (nulls - moved).alias("nulos"),
        F.struct(*[_count(c).alias(c) for c in ("vl", "van", "vansj", "vnt")]).alias("ajustes"),
        F.array_compact(F.array(
            F.when(declared != total, F.concat(F.lit("tv "), declared, F.lit(" differs from vvc+vb+tvn "),
                                               total)),
            F.when(turnout != declared, F.concat(F.lit("turnout "), turnout,
                                                 F.lit(" differs from all votes "), declared))))
        .alias("avisos"),
        F.array_compact(F.array(
            F.when(parts != _count("vvc"), F.concat(F.lit("summary "), _count("vvc"),
                                                    F.lit(" differs from its parts "), parts))))
        .alias("notas"))


def counting_progress(results: DataFrame, keys: list[str]) -> DataFrame:
    """Sections in total, counted, and the official percentage (decimal comma)."""
    return results.select(
        *keys, F.coalesce(F.col("s.ts").cast("bigint"), F.lit(0)).alias("secoes"),
        F.coalesce(F.col("s.st").cast("bigint"), F.lit(0)).alias("totalizadas"),
        F.coalesce(F.replace("s.pst", F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0)).alias("pct"))


def official_maximum(results: DataFrame, keys: list[str]) -> DataFrame:
    """Most votes a name can have anywhere inside the territory of the document."""
    people = result_votables(results, keys).where("tipo_voto = 'nominal'")
    return people.groupBy(*keys, "nome").agg(F.max("votos").alias("limite"))
