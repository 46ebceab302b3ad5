"""Archives as a data source: names by template, pruning, choice of members."""

import zipfile

import pytest

from meshtally.sources.archive_source import read_archives

SCHEMA = "ano int, uf string, nome string, votos string"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("zips")
    for year in (2030, 2034):
        for state, lines in {"XA": ['"Ação;1";5', ";6"], "XB": ['"duas\nlinhas";7']}.items():
            with zipfile.ZipFile(root / f"v_{year}_{state}.zip", "w") as z:
                text = "\r\n".join(["nome;votos", *lines, ""])
                z.writestr(f"v_{state}.csv", text.encode("latin-1"))
                z.writestr("v_BRASIL.csv", (text + text.split("\r\n", 1)[1]).encode("latin-1"))
                z.writestr("leia-me.txt", "nada")
    return root


def template(folder):
    return f"{folder}/v_{{ano}}_{{uf}}.zip"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_all_archives_once(spark, folder):
    got = rows(read_archives(spark, template(folder), SCHEMA, ano=[2030, 2034], uf=["XA", "XB"]).fillna("-"))
    assert got == sorted((y, *r) for y in (2030, 2034) for r in
                         [("XA", "Ação;1", "5"), ("XA", "-", "6"), ("XB", "duas\nlinhas", "7")])
    national = read_archives(spark, template(folder), SCHEMA, national=True, ano=[2030], uf=["XB"])
    assert [r.votos for r in national.collect()] == ["7", "7"]


def test_filters_leave_archives_unopened(spark, folder):
    # The archives of 2038 don't exist, so opening one would fail.
    df = read_archives(spark, template(folder), SCHEMA, ano=[2030, 2038], uf=["XA", "XB"])
    assert rows(df.where("ano = 2030 AND votos > '5'").select("uf", "votos")) == [("XA", "6"), ("XB", "7")]
    assert rows(df.where("ano IN (2030, 2034) AND uf = 'XB'").select("votos")) == [("7",)]
    assert df.where("ano = 2034").count() == 0
    assert df.where("ano = 2030").rdd.getNumPartitions() == 2


def test_what_is_refused(spark, folder):
    with pytest.raises(Exception, match="v_2038_XA"):
        read_archives(spark, template(folder), SCHEMA, ano=[2030, 2038], uf=["XA"]).collect()
    with pytest.raises(Exception, match="no values for"):
        read_archives(spark, template(folder), SCHEMA, ano=[2030]).collect()
    with pytest.raises(Exception, match="lugar"):
        read_archives(spark, template(folder), "lugar string", ano=[2030], uf=["XA"]).collect()
    with pytest.raises(Exception, match="can't be"):
        read_archives(spark, template(folder), "votos int", ano=[2030], uf=["XA"]).collect()
