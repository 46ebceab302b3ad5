"""A sample of addresses with their true regions."""

from meshtally.plans import street_index as SI
from meshtally.plans import reports

RAW = ("COD_UNICO_ENDERECO string, COD_MUNICIPIO string, NOM_TIPO_SEGLOGR string, NOM_TITULO_SEGLOGR string, NOM_SEGLOGR string, "
       "NUM_ENDERECO string, LATITUDE string, LONGITUDE string, COD_ESPECIE string, DSC_LOCALIDADE string")
REGION = "id_regiao bigint, sg_uf string, cd_municipio_ibge string, latitude_final double, longitude_final double"


def test_sampled_truth(spark):
    regions = spark.createDataFrame([(1, "XA", "11", -9.0, -60.0), (2, "XA", "11", -9.5, -60.0), (3, "XB", "12", -9.1, -60.0)], REGION)

    def address(code, town, lat, kind="1"):
        return (str(code), town, "RUA", None, "Q", str(code), lat, "-60.0", kind, "C")

    rows = [address(i, "11", str(-9.0 - i % 2 * 0.5 - 0.01)) for i in range(40)]
    rows += [address(50, "12", "-9.49"), address(51, "12", "-9.49", "5"), address(60, "11", ""), address(61, "99", "-9.0"), rows[0]]
    raw = spark.createDataFrame(rows, RAW)
    whole = reports.sampled_truth(raw, regions, 1000).collect()
    assert len(whole) == 42
    # The nearest region of the own municipality, though another's lies nearer.
    assert all(r.verdade == (3 if r.sg_uf == "XB" else 1 + r.numero % 2) for r in whole)
    assert sorted(r.domicilio for r in whole if r.sg_uf == "XB") == [False, True]
    few = [sorted(map(tuple, reports.sampled_truth(df, regions, 7).collect())) for df in (raw, raw.repartition(9))]
    assert few[0] == few[1] and len(few[0]) == 9
    assert reports.sampled_truth(raw.limit(0), regions, 7).count() == 0


def test_counts_are_computed_once(spark):
    """The weights of the index read the counts twice; what the counts come from is read once."""
    seen = spark.sparkContext.accumulator(0)

    def watched(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    schema = "cd_municipio_ibge string, logradouro string, bairro string, numero bigint, id_regiao bigint, n_enderecos bigint, n_domicilios bigint"
    counts = spark.createDataFrame([("1", "A", None, n, n // 10, 2, n % 2) for n in range(100)], schema)
    runs = SI.build_runs(SI.usable_rows(counts.mapInPandas(watched, schema)))
    assert runs.count() == 10
    assert seen.value == 100
