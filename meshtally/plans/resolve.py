"""Address requests to regions, as one batch of joins.

Nothing is looked up row by row: requests are reduced to distinct questions, each
step joins the questions to one index table, and answers are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.functions import text
from meshtally.operators.ordered import ordinal
from meshtally.operators.runs import nearest_compatible, run_lookup
from meshtally.plans.street_index import NUMBER_BLOCK, StreetIndex
from meshtally.schemas import STREET
from meshtally.session import settle

ASK = ["cd_municipio", "rua", "_numero", "_bairro"]


def match_streets(asked: DataFrame, streets: DataFrame) -> DataFrame:
    """(cd_municipio, rua) -> logradouro: the exact name, else the name without accents."""
    names = asked.select("cd_municipio", "rua").distinct()
    exact = streets.select(F.col("cd_municipio_ibge").alias("cd_municipio"),
                           F.col("logradouro").alias("rua"), F.col("logradouro").alias("_exact"))
    loose = (streets.groupBy(F.col("cd_municipio_ibge").alias("cd_municipio"),
                             text.unaccented(F.col("logradouro")).alias("_n"))
             .agg(F.max("logradouro").alias("_loose")))
    return (names.join(exact, ["cd_municipio", "rua"], "left")
            .withColumn("_n", text.unaccented(F.col("rua")))
            .join(loose, ["cd_municipio", "_n"], "left")
            .select("cd_municipio", "rua", F.coalesce("_exact", "_loose").alias("logradouro")))


def resolve(requests: DataFrame, index: StreetIndex) -> DataFrame:
    """Requests (cd_municipio, rua, numero, bairro, ...) with the region that answers them.

    Adds logradouro, id_regiao, confianca (exata, interpolada, provavel; null when the
    street is unknown), n_opcoes, bairro_ignorado, conflito_numero_bairro and
    bairro_usado. The list of options is `options`.
    """
    asked = (requests
             .withColumn("_numero", F.when(F.col("numero") > 0, F.col("numero").cast("bigint"))
                         .otherwise(F.lit(0).cast("bigint")))
             .withColumn("_bairro", F.coalesce("bairro", F.lit(""))))
    questions = asked.select(*ASK).distinct()
    answers = _answer(questions, index)
    return asked.join(answers, ASK, "left").drop("_numero", "_bairro")


def _answer(questions: DataFrame, index: StreetIndex) -> DataFrame:
    found = questions.join(match_streets(questions, index.streets), ["cd_municipio", "rua"])
    found = (found.where(F.col("logradouro").isNotNull())
             .withColumnRenamed("cd_municipio", "cd_municipio_ibge"))
    q = found.join(index.streets, STREET)

    # Locality of the street: the heaviest one whose name matches without accents.
    known = (index.street_localities.groupBy(*STREET, "bairro").agg(F.sum("peso").alias("_p"))
             .groupBy(*STREET, text.unaccented(F.col("bairro")).alias("_bn"))
             .agg(F.min_by("bairro", F.struct(-F.col("_p"), F.col("bairro"))).alias("_local")))
    several = F.col("n_regioes") > 1
    q = (q.withColumn("_bn", F.when(several & (F.col("_bairro") != ""),
                                    text.unaccented(F.col("_bairro"))))
         .join(known, [*STREET, "_bn"], "left")
         .withColumn("bairro_ignorado", F.col("_bn").isNotNull() & F.col("_local").isNull())
         .withColumn("_local", F.coalesce("_local", F.lit(""))))

    members = candidates(index)
    heads = members.groupBy(*STREET, "_local").agg(
        F.count("*").alias("_n"),
        F.min_by("id_regiao", F.struct(-F.col("peso"), F.col("id_regiao"))).alias("_first"))
    q = q.join(heads, [*STREET, "_local"], "left")
    n_options = F.when(several, F.col("_n")).otherwise(F.lit(1))
    first = F.when(several, F.col("_first")).otherwise(F.col("id_regiao_dominante"))
    # The questions feed several branches below: they are computed once and stored.
    q = settle(q.withColumn("n_opcoes", n_options.cast("bigint")).withColumn("_first", first))

    by_number = F.col("_numero") > 0
    open_ = q.where(several & (F.col("n_opcoes") > 1) & by_number)
    numbered = _by_number(open_, index, members)
    q = q.join(numbered, [*STREET, "_numero", "_local"], "left")
    settled = F.col("n_opcoes") == 1
    hit = F.col("_run").isNotNull()
    return q.select(
        F.col("cd_municipio_ibge").alias("cd_municipio"), "rua", "_numero", "_bairro", "logradouro",
        F.when(settled, F.col("_first")).when(hit, F.col("_run")).otherwise(F.col("_first"))
        .alias("id_regiao"),
        F.when(settled, "exata").when(hit & F.col("_sharp"), "exata").when(hit, "interpolada")
        .otherwise("provavel").alias("confianca"),
        "n_opcoes", "n_regioes", "bairro_ignorado",
        (~settled & by_number & ~hit & (F.col("_local") != "")).alias("conflito_numero_bairro"),
        F.when(F.col("_local") != "", F.col("_local")).alias("bairro_usado"))


def candidates(index: StreetIndex) -> DataFrame:
    """Regions that may answer: of the whole street (no locality) or of one locality."""
    cols = [*STREET, "_local", "id_regiao", "fracao", "peso"]
    return (index.street_regions.withColumn("_local", F.lit("")).select(*cols).unionByName(
        index.street_localities.withColumnRenamed("bairro", "_local").select(*cols)))


def _by_number(open_: DataFrame, index: StreetIndex, members: DataFrame) -> DataFrame:
    """Region of the run holding the number, or of the closest run that is a candidate."""
    probes = open_.select(*STREET, "_numero", "_local").distinct()
    runs = ordinal(index.runs, STREET, ["numero_inicial"],
                   F.floor(F.col("numero_inicial") / NUMBER_BLOCK), out="_pos")
    at = run_lookup(probes.select(*STREET, "_numero").distinct(), runs, STREET, "_numero",
                    "numero_inicial", ["id_regiao", "_pos"])
    here = probes.join(at, [*STREET, "_numero"])
    allowed = members.select(*STREET, "_local", "id_regiao")
    here = settle(here.join(allowed.withColumn("_ok", F.lit(True)),
                            [*STREET, "_local", "id_regiao"], "left"))
    direct = here.where("_ok").select(
        *STREET, "_numero", "_local", F.col("id_regiao").alias("_run"),
        (F.col("numero_inicial") == F.col("_numero")).alias("_sharp"))
    stray = here.where("_ok is null").select(*STREET, "_local", "_numero", F.col("_pos").alias("_from0"))
    wanted = stray.select(*STREET, "_local").distinct()
    compatible = (runs.join(allowed.join(wanted, [*STREET, "_local"], "left_semi"),
                            [*STREET, "id_regiao"]).select(*STREET, "_local", "_pos", "id_regiao"))
    walked = nearest_compatible(stray.select(*STREET, "_local", "_from0").distinct(), compatible,
                                [*STREET, "_local"], "_from0", "id_regiao")
    walked = stray.join(walked, [*STREET, "_local", "_from0"]).select(
        *STREET, "_numero", "_local", F.col("id_regiao").alias("_run"), F.lit(False).alias("_sharp"))
    return direct.unionByName(walked)


def options(resolved: DataFrame, index: StreetIndex, regions: DataFrame | None = None) -> DataFrame:
    """The options of each resolved request, one row per region, heaviest first by `ordem`.

    With `regions`, adds the name and address of the place.
    """
    streets = settle(resolved.where(F.col("logradouro").isNotNull()).select(
        F.col("cd_municipio").alias("cd_municipio_ibge"), "logradouro",
        F.coalesce("bairro_usado", F.lit("")).alias("_local")).distinct())
    single = index.streets.where("n_regioes = 1").select(
        *STREET, F.lit("").alias("_local"), F.col("id_regiao_dominante").alias("id_regiao"),
        "fracao", F.lit(1.0).alias("peso"))
    rows = candidates(index).withColumn("peso", F.col("peso").cast("double")).unionByName(single)
    rows = rows.join(streets, [*STREET, "_local"], "left_semi")
    # -log of the share falls as the share grows, so its floor is a block in list order.
    block = F.floor(-F.log(F.greatest(F.col("fracao"), F.lit(1e-12))) * 4)
    rows = ordinal(rows.withColumn("_o", -F.col("fracao")), [*STREET, "_local"],
                   ["_o", "id_regiao"], block, out="ordem", start=1).drop("_o")
    if regions is not None:
        rows = rows.join(regions.select("id_regiao", F.col("nm_local_votacao").alias("local"),
                                        F.col("ds_endereco").alias("endereco")), "id_regiao", "left")
    return rows.withColumn("bairro", F.when(F.col("_local") != "", F.col("_local"))).drop("_local")


def resolve_by_locality(requests: DataFrame, localities: DataFrame) -> DataFrame:
    """Requests that know only municipality and locality."""
    key = ["cd_municipio_ibge", "bairro"]
    heads = localities.groupBy(*key).agg(
        F.count("*").alias("n_opcoes"), F.sum("peso").alias("_p"),
        F.min_by("id_regiao", F.struct(-F.col("peso"), F.col("id_regiao"))).alias("id_regiao"))
    named = (heads.groupBy(F.col("cd_municipio_ibge").alias("cd_municipio"),
                           text.unaccented(F.col("bairro")).alias("_n"))
             .agg(F.max_by(F.struct("bairro", "n_opcoes", "id_regiao"), "bairro").alias("_h")))
    return (requests.withColumn("_n", text.unaccented(F.col("bairro")))
            .join(named, ["cd_municipio", "_n"], "left")
            .select(*requests.columns, F.col("_h.bairro").alias("bairro_usado"),
                    F.col("_h.id_regiao").alias("id_regiao"), F.col("_h.n_opcoes").alias("n_opcoes"),
                    F.when(F.col("_h.n_opcoes") == 1, "exata")
                    .when(F.col("_h.n_opcoes") > 1, "provavel").alias("confianca")))


def search_names(df: DataFrame, columns: list[str], term: str, order: str, limit: int = 20) -> DataFrame:
    """Autocomplete: rows whose text contains the term without accents, first by name.

    Rows of one name stand by their other columns, from left to right, so the same rows
    are shown whatever order they are read in.
    """
    joined = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    ties = [F.col(f"`{f.name}`") for f in df.schema
            if f.name != order and "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    return df.where(text.contains_text(joined, term)).orderBy(
        F.collate(F.col(order), "UNICODE_CI_AI"), F.col(order), *ties).limit(limit)


def _pairs_of_letters(c: Column) -> Column:
    """Distinct two-letter pieces of a text; a text contains a term only with all of the term's."""
    n = F.length(c)
    return F.when(n >= 2, F.array_distinct(F.transform(
        F.sequence(F.lit(1), n - 1), lambda i: F.substr(c, i, F.lit(2)))))


def containing(terms: DataFrame, names: DataFrame, keys: list[str], term: str, name: str) -> DataFrame:
    """Pairs (keys, term, name) where the name contains the term.

    Terms meet only names that share their rarest two-letter piece, never all names
    of the key; the containment itself is then tested.
    """
    pieces = names.select(*keys, name, F.explode(_pairs_of_letters(F.col(name))).alias("_g"))
    rarity = pieces.groupBy(*keys, "_g").agg(F.count("*").alias("_c"))
    asked = terms.select(*keys, term, F.explode(_pairs_of_letters(F.col(term))).alias("_g"))
    rarest = (asked.join(rarity, [*keys, "_g"], "left").groupBy(*keys, term)
              .agg(F.min_by("_g", F.struct(F.coalesce("_c", F.lit(0)), F.col("_g"))).alias("_g")))
    return (rarest.join(pieces, [*keys, "_g"]).where(F.col(name).contains(F.col(term)))
            .select(*keys, term, name))


def match_names(asked: DataFrame, names: DataFrame, keys: list[str], wanted: str,
                name: str) -> DataFrame:
    """Best name per question by tier: 1 exact, 2 without accents, 3 contained; first wins.

    Terms under two characters are not searched inside names.
    """
    exact = asked.join(names.select(*keys, F.col(name).alias(wanted), F.col(name).alias("_m1")),
                       [*keys, wanted], "left")
    loose = names.groupBy(*keys, text.unaccented(F.col(name)).alias("_n")).agg(F.min(name).alias("_m2"))
    two = exact.withColumn("_n", text.unaccented(F.col(wanted))).join(loose, [*keys, "_n"], "left")
    rest = two.where("_m1 is null and _m2 is null").select(*keys, "_n").distinct()
    plain = names.groupBy(*keys, text.unaccented(F.col(name)).alias("_cn")).agg(F.min(name).alias("_c"))
    inside = (containing(rest, plain, keys, "_n", "_cn").join(plain, [*keys, "_cn"])
              .groupBy(*keys, "_n").agg(F.min("_c").alias("_m3")))
    all_ = two.join(inside, [*keys, "_n"], "left")
    return all_.select(*asked.columns, F.coalesce("_m1", "_m2", "_m3").alias("encontrado"),
                       F.when(F.col("_m1").isNotNull(), 1).when(F.col("_m2").isNotNull(), 2)
                       .when(F.col("_m3").isNotNull(), 3).alias("nivel"))
