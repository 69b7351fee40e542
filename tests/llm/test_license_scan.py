import duckdb
from helpers import no_documents, odd_documents

from stargauge.llm.license_scan import PASSAGES, anchors, least_shared, oracle_sql, scan_licenses, template_bigrams, templates

PROSE = "The quick prose of the document goes on, and on to the end of the line."
MIT_LINES = PASSAGES["MIT"].replace("including", "\nincluding").replace("The above", "\n\nThe above")


def documents(spark):
    rows = [
        (20, PROSE),
        (21, f"{PROSE}\nReleased under the MIT License.\n{PROSE}"),
        (22, "this work is licensed under the gnu general public license version 3"),
        (23, f"{PROSE}\n{MIT_LINES}\n{PROSE}"),
        (24, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."),
        (25, "Released under the\nBSD 3-Clause\nLicense"),
        (26, "licensed under the sun"),
        (27, "This project is Released under the MIT License. Thanks to everyone involved."),
        (28, f"{PROSE * 40} Licensed under the Apache License, Version 2.0. {PROSE * 40}"),
        (29, PASSAGES["GPL-3.0"].replace(" ", "\n\n")),
        (30, f"{PROSE} {PASSAGES['MIT']} {PROSE} {PASSAGES['ISC']}".replace("copyright", "copy right")),
        (31, "Released under the MIT License. " * 30),
        (32, "released under the terms of the mit license of the house"),
        (33, "This work is licensed under the sun."),
        (34, "this work is licensed under the"),
    ]
    return odd_documents(spark).select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))


def test_known_cases(spark):
    got = {r["doc_id"]: r for r in scan_licenses(documents(spark)).collect() if r["doc_id"] is not None}
    assert {i: got[i]["licenses"] for i in range(20, 35)} == {
        20: "", 21: "MIT", 22: "GPL-3.0", 23: "MIT", 24: "Apache-2.0,CC-BY-NC-4.0", 25: "BSD-3-Clause", 26: "", 27: "MIT",
        28: "Apache-2.0", 29: "GPL-3.0", 30: "ISC,MIT", 31: "MIT", 32: "", 33: "", 34: "",
    }
    assert got[21]["best_dice"] == got[27]["best_dice"] == 1.0 and got[21]["n_license_words"] == got[27]["n_license_words"] == 5
    assert got[23]["best_dice"] == 1.0 and got[29]["best_dice"] == 1.0 and got[31]["n_license_words"] == 150
    assert got[1]["licenses"] == "" and got[1]["best_license"] is None and got[1]["best_dice"] is None


def test_sql_agrees_on_odd_rows(spark):
    docs = documents(spark)
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    columns = ["doc_id", "n_license_words", "licenses", "best_license", "best_dice"]
    want = connection.sql(f"SELECT {', '.join(columns)} FROM ({oracle_sql()})").fetchall()
    key = lambda r: tuple(str(x) for x in r)
    got = [tuple(r) for r in scan_licenses(docs).select(*columns).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_no_template_can_be_reached_without_an_anchor():
    known, words = templates(), set(anchors(templates(), 0.8))
    for _, bigrams in known:
        without = [b for b in bigrams if not words & set(b.split())]
        assert len(without) < least_shared(len(bigrams), 0.8)
    assert template_bigrams("A b, a B c") == ["a b", "b a", "b c"]


def test_empty_table_and_extra_columns(spark):
    assert scan_licenses(no_documents(spark)).count() == 0
    assert scan_licenses(odd_documents(spark)).count() == odd_documents(spark).count()
