import random

import duckdb
from helpers import no_documents, odd_documents, words
from pyspark.sql import functions as F

from stargauge.llm.quality_rules import OP8_SQL, judge_lines

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def facts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {p for at in places.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered))


def texts():
    draw = random.Random(5)
    vocabulary = ["a", "b", "the", "End.", "###", "x|y", "|", "WOW!!", "é", "cookie", "policy"]
    return ["".join(draw.choice(vocabulary) + draw.choice(" \n  \t") for _ in range(draw.randint(0, 120))) for _ in range(60)]


def judged(docs):
    return judge_lines(docs).select("doc_id", *[F.col(f"line_rules.{x}").alias(x) for x in FIELDS])


def test_base_statistics_match_a_plain_count(spark):
    rows = list(enumerate(texts()))
    found = {r["doc_id"]: tuple(r)[1:6] for r in judged(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: facts(t) for i, t in rows}


def test_sql_agrees_on_odd_rows(spark):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    docs = odd_documents(spark).select("doc_id", "text").union(extra)
    documents = docs.toPandas().astype({"doc_id": "Int64"})
    connection = duckdb.connect()
    connection.register("documents", documents)
    want = connection.sql(f"SELECT doc_id, {', '.join(FIELDS)} FROM ({OP8_SQL})").fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in judged(docs).collect()), key=key) == sorted(want, key=key)


def test_failing_lines_go_and_clean_documents_stay(spark):
    good = "\n".join(f"Line{i} tells{i} something{i} new{i}, and ends{i} here{i}." for i in range(12))
    menu = "Home | News | Sport | Contact | About"
    rows = [(1, good), (2, good + "\n" + menu), (3, "\n".join([menu] * 30)), (4, good + "\n\n" + good.upper())]
    found = {r["doc_id"]: r["line_rules"] for r in judge_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["kept"] and found[1]["clean_text"] == good
    assert found[2]["kept"] and found[2]["clean_text"] == good
    assert not found[3]["kept"]
    assert not found[4]["kept"] and found[4]["clean_text"] == good + "\n"


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    out = judge_lines(docs, into="score")
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    rows = {(r["doc_id"], r["text"]): r["score"] for r in out.collect()}
    assert rows[1, None]["n_words"] == 0 and rows[1, None]["base_failed"] and not rows[1, None]["kept"]
    assert rows[2, ""]["n_dup_lines"] == 0
    assert judge_lines(no_documents(spark)).count() == 0


def test_boilerplate_in_four_languages_goes(spark):
    good = "\n".join(f"Line{i} tells{i} something{i} new{i}, and ends{i} here{i}." for i in range(12))
    stock = ["Click here.", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Términos y condiciones."]
    rows = [(i, f"{good}\n{line}") for i, line in enumerate(stock)]
    found = judge_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["line_rules"]["kept"] and r["line_rules"]["clean_text"] == good for r in found) and len(found) == 4
