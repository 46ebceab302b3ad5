"""Official reconciliation: our counts against the published result, per territory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.operators import guards, votes as VOTES

TOTALS = ["comparecimento", "validos", "brancos", "nulos"]


def compare_totals(ours: DataFrame, official: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per territory and total: difference and mark.

    ' ' equal; '~' explained by ballot boxes we do not have; 'x' wrong, also where the whole
    territory is missing on our side.
    """
    a = ours.select(*keys, *[F.col(t).alias(f"_a_{t}") for t in TOTALS])
    b = official.select(*keys, *[F.col(t).alias(f"_b_{t}") for t in TOTALS], F.lit(True).alias("_has"))
    a = a.withColumn("_mine", F.lit(True))
    # What a side lacks counts 0, so that a territory missing on ours is short of all its votes.
    both = a.join(b, list(keys), "full").fillna(0, [f"_{x}_{t}" for x in "ab" for t in TOTALS])
    short = F.col("_b_comparecimento") - F.col("_a_comparecimento")
    short = F.when(F.col("_has"), short)
    rows = both.select(*keys, "_has", "_mine", short.alias("falta"), F.explode(F.array(*[
        F.struct(F.lit(t).alias("total"), F.when(F.col("_has"), F.col(f"_b_{t}")).alias("oficial"),
                 F.col(f"_a_{t}").alias("nosso")) for t in TOTALS])).alias("t"))
    diff = F.col("nosso") - F.col("oficial")
    absent = F.col("_mine").isNull()
    return (rows.select(*keys, F.coalesce("_has", F.lit(False)).alias("tem_oficial"), "falta", "t.*", diff.alias("diferenca"),
                        F.when(F.col("_has").isNull(), "?").when(absent, "x").when(diff == 0, " ")
                        .when((F.col("falta") > 0) & diff.between(-F.col("falta"), F.lit(0)), "~")
                        .otherwise("x").alias("marca")))


def compare_votables(ours: DataFrame, official: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full comparison by ballot number; missing on a side counts 0."""
    on = [*keys, "tipo_voto", "nr_votavel"]
    both = ours.select(*on, F.col("votos").alias("nosso")).join(
        official.select(*on, "nome", F.col("votos").alias("oficial")), on, "full")
    extra = F.col("oficial").isNull()
    both = both.withColumn("no_oficial", ~extra).fillna(0, ["nosso", "oficial"])
    limit = F.greatest(F.lit(float(K.VOTE_SLACK)), F.col("oficial") * K.VOTE_SLACK_SHARE)
    diff = F.col("nosso") - F.col("oficial")
    return both.withColumn("diferenca", diff).withColumn(
        "marca", F.when(F.abs(diff) <= limit, " ").otherwise("x"))


def reconcile(votes: DataFrame, totals: DataFrame, votables: DataFrame,
              keys: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(problems, totals comparison, votable comparison) of one office at one level."""
    label = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    t = compare_totals(VOTES.totals_by_type(votes, keys), totals, keys)
    v = compare_votables(VOTES.votes_by_number(votes, keys), votables, keys)
    turnout = t.where("total = 'comparecimento'")
    gap = F.col("falta") / F.greatest(F.col("oficial"), F.lit(1))
    problems = guards.problem_rows(
        turnout.where("not tem_oficial"), "official result", "reconcile",
        F.concat(label, F.lit(": nothing to compare with")))
    for rows, detail in [
        (t.where("marca = 'x'"), F.concat(label, F.lit(": "), "total", F.lit(" differs by "),
                                          F.col("diferenca").cast("string"))),
        (turnout.where((F.col("falta") > 0) & (gap > K.MISSING_LIMIT)),
         F.concat(label, F.lit(": short of "), F.col("falta").cast("string"), F.lit(" votes"))),
        (turnout.where("falta < 0"), F.concat(label, F.lit(": more votes than the official count"))),
        (v.where("marca = 'x'"), F.concat(label, F.lit(", number "), "nr_votavel", F.lit(" differs by "),
                                          F.col("diferenca").cast("string"))),
        (totals.select(*keys, F.explode("avisos").alias("a")), F.concat(label, F.lit(": "), F.col("a"))),
    ]:
        problems = problems.unionByName(guards.problem_rows(rows, "reconcile", "official", detail))
    return problems, t, v


# --- country, state and municipality at once -------------------------------------------

CONTEST = ["ano_eleicao", "turno", "cargo"]
TERRITORY = ["sg_uf", "cd_municipio"]
LEVELS = ["nivel", *CONTEST, *TERRITORY]
COUNTRY, STATE, TOWN = range(3)


def by_level(rows: DataFrame, keep: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums of `values` for country, state and municipality in one pass; '' above a territory's level.

    Municipal sums are combined first, so the grouping sets expand few rows.
    """
    fixed = [*CONTEST, *keep]
    fine = rows.groupBy(*fixed, *TERRITORY).agg(*[F.sum(v).alias(v) for v in values])
    sets = [[F.col(c) for c in (*fixed, *TERRITORY[:k])] for k in (COUNTRY, STATE, TOWN)]
    rolled = fine.groupingSets(sets, *fixed, *TERRITORY).agg(
        *[F.sum(v).alias(v) for v in values], *[F.grouping(c).alias(f"_g_{c}") for c in TERRITORY])
    level = F.lit(TOWN) - sum((F.col(f"_g_{c}") for c in TERRITORY), F.lit(0))
    place = [F.when(F.col(f"_g_{c}") == 1, "").otherwise(F.coalesce(c, F.lit("?"))).alias(c) for c in TERRITORY]
    return rolled.select(level.cast("int").alias("nivel"), *fixed, *place, *values)


def _label() -> Column:
    """Country, state or state/municipality with the contest, for messages."""
    place = F.when(F.col("nivel") == COUNTRY, "BR").when(F.col("nivel") == STATE, F.col("sg_uf")).otherwise(F.concat_ws("/", *TERRITORY))
    return F.concat_ws(" ", place, F.concat_ws("/", *(F.col(c).cast("string") for c in CONTEST)))


def _parent(level: int) -> list[Column]:
    """Keys of the row one level up."""
    state = F.col("sg_uf") if level == TOWN else F.lit("")
    return [F.lit(level - 1).alias("nivel"), *[F.col(c) for c in CONTEST], state.alias("sg_uf"), F.lit("").alias("cd_municipio")]


def explained(totals: DataFrame) -> DataFrame:
    """Totals with `falta_abaixo`, the turnout missing one level down, and `explicada`.

    A shortage is explained where the territories below lack exactly as many votes: then it
    is theirs, and is reported there. A town's shortage, or one whose territories are not
    published, has nothing below it.
    """
    turnout = totals.where("total = 'comparecimento' AND tem_oficial")
    below = turnout.where(F.col("nivel") == TOWN).select(*_parent(TOWN), "falta").unionByName(
        turnout.where(F.col("nivel") == STATE).select(*_parent(STATE), "falta"))
    below = below.groupBy(*LEVELS).agg(F.sum("falta").alias("falta_abaixo"))
    return totals.join(below, LEVELS, "left").withColumn(
        "explicada", (F.col("falta") > 0) & F.coalesce(F.col("falta") == F.col("falta_abaixo"), F.lit(False)))


def official_levels_agree(official: DataFrame) -> DataFrame:
    """Problem rows where a published territory is not the sum of those published below it."""
    below = official.where(F.col("nivel") == TOWN).select(*_parent(TOWN), *TOTALS).unionByName(
        official.where(F.col("nivel") == STATE).select(*_parent(STATE), *TOTALS))
    sums = below.groupBy(*LEVELS).agg(*[F.sum(t).alias(f"_s_{t}") for t in TOTALS])
    both = official.join(sums, LEVELS).select(*LEVELS, F.explode(F.array(*[
        F.struct(F.lit(t).alias("total"), F.col(t).alias("v"), F.col(f"_s_{t}").alias("s")) for t in TOTALS])).alias("t"))
    return guards.problem_rows(both.where("t.v <> t.s"), "levels agree", "official", F.concat(
        _label(), F.lit(": "), "t.total", F.lit(" "), F.col("t.v").cast("string"), F.lit(" x "), F.col("t.s").cast("string")))


def reconcile_levels(votes: DataFrame, official_totals: DataFrame, official_votables: DataFrame
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(problems, totals, votables) of all contests at country, state and municipality.

    votes: contest, sg_uf, cd_municipio, tipo_voto, nr_votavel, qt_votos. The official frames
    carry LEVELS, '' above a territory's level; a level that isn't published is not compared
    beyond "nothing to compare with". Contests are never added together.
    """
    kind = F.col("tipo_voto")
    valid = VOTES.V.is_valid_vote(kind)
    parts = {"comparecimento": F.lit(True), "validos": valid, "brancos": kind == "branco", "nulos": kind == "nulo"}
    counted = votes.select(*CONTEST, *TERRITORY, *[F.when(c, F.col("qt_votos")).otherwise(0).alias(t) for t, c in parts.items()])
    totals = explained(compare_totals(by_level(counted, [], TOTALS), official_totals, LEVELS))
    ours = by_level(votes.where(valid).withColumnRenamed("qt_votos", "votos"), ["tipo_voto", "nr_votavel"], ["votos"])
    named = compare_votables(ours, official_votables, LEVELS)

    turnout = totals.where("total = 'comparecimento'")
    gap = F.col("falta") / F.greatest(F.col("oficial"), F.lit(1))
    own = (F.col("falta") > 0) & ~F.col("explicada")
    label = _label()
    problems = official_levels_agree(official_totals)
    for rows, detail in [
        (turnout.where("NOT tem_oficial"), F.concat(label, F.lit(": nothing to compare with"))),
        (totals.where("marca = 'x' AND NOT explicada"),
         F.concat(label, F.lit(": "), "total", F.lit(" differs by "), F.col("diferenca").cast("string"))),
        (turnout.where(own & (gap > K.MISSING_LIMIT)),
         F.concat(label, F.lit(": short of "), F.col("falta").cast("string"), F.lit(" votes"))),
        (turnout.where("falta < 0"), F.concat(label, F.lit(": more votes than the official count"))),
        (named.where("marca = 'x'"), F.concat(label, F.lit(", number "), "nr_votavel", F.lit(" differs by "),
                                              F.col("diferenca").cast("string"))),
        (official_totals.select(*LEVELS, F.explode("avisos").alias("a")), F.concat(label, F.lit(": "), F.col("a"))),
    ]:
        problems = problems.unionByName(guards.problem_rows(rows, "reconcile", "official", detail))
    return problems, totals, named
