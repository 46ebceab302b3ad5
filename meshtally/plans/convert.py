"""Ballot reports to the vote table of the batch chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import text
from meshtally.functions.votes import electoral_unit
from meshtally.operators import guards
from meshtally.operators.shares import top_n
from meshtally.schemas import VOTE_COLUMNS


def report_problems(rows: DataFrame) -> DataFrame:
    """(arquivo, motivo): what a well-formed report must not have.

    Votes of an office equal the turnout; a senator's may also be twice that.
    """
    good = rows.where("erro is null")
    offices = good.groupBy("arquivo", "eleicao", "grupo", "ordem", "cargo", "comparecimento").agg(
        F.sum("quantidade").alias("soma"),
        F.max(F.when(F.col("tipo").startswith("desconhecido"), F.col("tipo"))).alias("estranho"),
        F.count_if((F.col("tipo") == "nominal") & F.col("numero").isNull()).alias("sem_numero"))
    turnout = F.col("comparecimento")
    balanced = (F.col("soma") == turnout) | ((F.col("cargo") == K.SENATOR) & (F.col("soma") == turnout * 2))
    label = F.concat(F.lit("office "), F.col("cargo").cast("string"), F.lit(": "))
    found = F.array_compact(F.array(
        F.when(~balanced, F.concat(label, F.lit("votes add up to "), F.col("soma").cast("string"),
                                   F.lit(", turnout is "), turnout.cast("string"))),
        F.when(F.col("estranho").isNotNull(), F.concat(label, F.lit("vote type "), F.col("estranho"))),
        F.when(F.col("sem_numero") > 0, F.concat(label, F.lit("nominal vote without number")))))
    return offices.select("arquivo", F.explode(found).alias("motivo"))


def rejections(rows: DataFrame) -> DataFrame:
    """(arquivo, classe, motivo), one row per rejected report: unreadable, wrong phase
    or unbalanced."""
    broken = rows.where("erro is not null").select(
        "arquivo", F.lit("estrutura").alias("classe"), F.col("erro").alias("motivo"))
    phase = rows.where("erro is null and fase <> 'oficial'").groupBy("arquivo").agg(
        F.lit("fase").alias("classe"), F.concat(F.lit("phase "), F.min("fase")).alias("motivo"))
    uneven = (report_problems(rows.where("erro is null and fase = 'oficial'")).groupBy("arquivo")
              .agg(F.lit("conta").alias("classe"), F.min("motivo").alias("motivo")))
    return broken.unionByName(phase).unionByName(uneven)


def rejection_rate(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rejected share of all reports, and of the first ones by name; problem rows."""
    reports = rows.select("arquivo").distinct()
    bad = reports.join(rejected.select("arquivo", F.lit(1).alias("_bad")), "arquivo", "left")
    # The opening sample shows a wrong format early; the order is that of the file names.
    first = bad.orderBy("arquivo").limit(K.FIRST_REPORTS).agg(
        F.count("*").alias("n"), F.count("_bad").alias("bad"))
    whole = bad.agg(F.count("*").alias("n"), F.count("_bad").alias("bad"))
    checks = (first.where(F.col("n") >= K.FIRST_REPORTS)
              .withColumn("limite", F.lit(K.FIRST_REJECT_LIMIT))
              .unionByName(whole.withColumn("limite", F.lit(K.REJECT_LIMIT))))
    over = checks.where((F.col("n") > 0) & (F.col("bad") / F.col("n") > F.col("limite")))
    return guards.problem_rows(over, "rejection rate", "ballot reports", F.concat(
        F.col("bad").cast("string"), F.lit(" of "), F.col("n").cast("string"),
        F.lit(" rejected, limit "), F.col("limite").cast("string")))


def rejection_report(rejected: DataFrame, examples: int = 5) -> DataFrame:
    """Counts per reason class with a few examples each."""
    shown = top_n(rejected.withColumn("_k", F.lit(1)), ["classe"], "_k", "arquivo", examples)
    lists = shown.groupBy("classe").agg(F.array_sort(F.collect_list(
        F.concat("arquivo", F.lit(": "), "motivo"))).alias("exemplos"))
    return rejected.groupBy("classe").agg(F.count("*").alias("boletins")).join(lists, "classe")


def counted_rows(rows: DataFrame, rejected: DataFrame, offices: Sequence[int]) -> DataFrame:
    """Vote lines that count: official phase, accepted report, wanted offices, whichever
    election of the report holds them."""
    return (rows.where((F.col("erro").isNull()) & (F.col("fase") == "oficial")
                       & F.col("cargo").isin(list(offices)))
            .join(rejected.select("arquivo").distinct(), "arquivo", "left_anti"))


def ballot_counts(rows: DataFrame, where: Sequence[str] = ()) -> DataFrame:
    """Votes by place and votable. Place as the ballot box declares it."""
    return rows.groupBy(*where, "municipio", "zona", "local", "cargo", "tipo", "partido", "numero").agg(
        F.sum("quantidade").alias("qt_votos"))


def preferred_candidacies(register: DataFrame) -> DataFrame:
    """One candidacy per (office, unit, number): with a result, then eligible, then latest."""
    named = register.withColumn("cargo", F.upper(F.trim("DS_CARGO")))
    result = ~F.coalesce(F.col("DS_SIT_TOT_TURNO"), F.lit("")).isin(K.VOID_SITUATIONS)
    able = F.coalesce(F.upper("DS_SITUACAO_CANDIDATURA") == "APTO", F.lit(False))
    kept = [c for c in named.columns if c not in ("cargo", "SG_UE", "NR_CANDIDATO")]
    best = F.max_by(F.struct(*kept), F.struct(result, able, F.col("SQ_CANDIDATO")))
    return (named.groupBy("cargo", "SG_UE", "NR_CANDIDATO").agg(best.alias("_b"))
            .select("cargo", "SG_UE", "NR_CANDIDATO", "_b.*"))


def vote_rows(counts: DataFrame, state: str, year: int, round_: str,
              register: DataFrame) -> DataFrame:
    """Ballot counts in the schema of the vote table, names and parties attached."""
    office = F.create_map(*[F.lit(x) for p in K.OFFICES.items() for x in p])
    base = counts.select(
        F.concat(F.lit(f"{state.upper()}_"), "municipio", F.lit("_"), F.col("zona").cast("string"),
                 F.lit("_"), F.col("local").cast("string")).alias("id_local_votacao"),
        F.lit(state.upper()).alias("sg_uf"), F.lit(year).alias("ano_eleicao"),
        F.lit(round_).alias("turno"), F.try_element_at(office, F.col("cargo")).alias("cargo"),
        F.col("tipo").alias("tipo_voto"),
        electoral_unit(F.col("cargo"), F.lit(state), F.col("municipio")).alias("SG_UE"),
        F.col("partido").cast("string").alias("nr_partido"),
        F.col("numero").cast("string").alias("NR_CANDIDATO"), "qt_votos")
    people = preferred_candidacies(register).select(
        "cargo", "SG_UE", "NR_CANDIDATO", "SQ_CANDIDATO", "NM_URNA_CANDIDATO", "SG_PARTIDO")
    parties = register.groupBy(F.col("NR_PARTIDO").alias("nr_partido")).agg(
        F.min("SG_PARTIDO").alias("sigla"))
    df = base.join(people, ["cargo", "SG_UE", "NR_CANDIDATO"], "left").join(parties, "nr_partido", "left")
    kind = F.col("tipo_voto")
    is_list, blank = kind == "legenda", kind == "branco"
    null = kind.isin("nulo", "cargo_sem_candidato")
    return df.select(
        "id_local_votacao", "sg_uf", "ano_eleicao", "turno", "cargo",
        F.when(is_list, K.PARTY_LIST_SEQ).when(blank | null, K.EMPTY_SEQ)
        .otherwise(F.col("SQ_CANDIDATO")).alias("sq_candidato"),
        F.when(blank, K.BLANK_CODE).when(null, K.NULL_CODE).otherwise(F.col("NR_CANDIDATO")).alias("nr_votavel"),
        F.when(blank, K.BLANK_NAME).when(null, K.NULL_NAME).when(is_list, F.col("sigla"))
        .otherwise(F.col("NM_URNA_CANDIDATO")).alias("nm_votavel"),
        F.when(is_list, F.col("sigla")).when(~(blank | null), F.col("SG_PARTIDO")).alias("sg_partido"),
        "tipo_voto", "qt_votos").select(*VOTE_COLUMNS)


def candidate_map(register: DataFrame, offices: Sequence[int]) -> DataFrame:
    """(unidade, cargo, numero) -> name and party; president under 'presidente'."""
    best = preferred_candidacies(register).where(
        F.col("cargo").isin([K.OFFICES[o] for o in offices]))
    return best.select(
        F.when(F.col("cargo") == "PRESIDENTE", "presidente").otherwise(F.col("SG_UE")).alias("unidade"),
        text.office_slug(F.col("cargo")).alias("cargo"), F.col("NR_CANDIDATO").alias("numero"),
        text.title_case(F.col("NM_URNA_CANDIDATO")).alias("nome"), F.col("SG_PARTIDO").alias("partido"))
