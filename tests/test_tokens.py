"""Golden sentences of the word tokenizer, tokens by hand; and that no Python worker runs."""

import pytest

from quillwork.functions import text

GOLDEN = {
    "Good muffins cost $3.88 (roughly 3,36 euros)\nin New York.  Please buy me two of them.\nThanks.": "Good muffins cost $ 3.88 ( roughly 3,36 euros ) in New York . Please buy me two of them . Thanks .",
    "They'll save and invest more.": "They 'll save and invest more .",
    "hi, my name can't hello,": "hi , my name ca n't hello ,",
    '"We beat some pretty good teams to get here," Slocum said.': "`` We beat some pretty good teams to get here , '' Slocum said .",
    "I cannot cannot work under these conditions!": "I can not can not work under these conditions !",
    "The company spent 40.75% of its income last year.": "The company spent 40.75 % of its income last year .",
    "He arrived at 3:00 pm.": "He arrived at 3:00 pm .",
    "I bought these items: books, pencils, and pens.": "I bought these items : books , pencils , and pens .",
    "Though there were 150, 100 of them were old.": "Though there were 150 , 100 of them were old .",
    "There were 300,000, but that wasn't enough.": "There were 300,000 , but that was n't enough .",
    "el dr. pérez llegó a la av. grau. luego se fue...": "el dr. pérez llegó a la av. grau . luego se fue ...",
    "se reunió con j. p. díaz el 3. de mayo.": "se reunió con j. p. díaz el 3. de mayo .",
    "¿qué pasó? «nada», dijo. (fin.)": "¿qué pasó ? « nada » , dijo . ( fin . )",
    "'Tis gonna be John's [last] dog; I've more'n two--really.": "'T is gon na be John 's [ last ] dog ; I 've more 'n two -- really .",
    "a@b #c & d* {e} <f>": "a @ b # c & d * { e } < f >",
    "etc.": "etc .",
    "no-dialogo, no_dialogo": "no-dialogo , no_dialogo",
    "": "",
    " \n\t ": "",
}


def test_golden_sentences(spark):
    df = spark.createDataFrame(list(GOLDEN.items()), "s string, t string")
    made = df.select("s", "t", text.tokens(df["s"]).alias("got"))
    assert "Python" not in made._jdf.queryExecution().toString() and "Arrow" not in made._jdf.queryExecution().executedPlan().toString()
    for row in made.collect():
        assert " ".join(row["got"]) == row["t"]


@pytest.mark.parametrize("stop", [[], ["la", ",", "."]])
def test_stop_words_and_nulls(spark, stop):
    df = spark.createDataFrame([(1, "La mesa, la SILLA."), (2, None)], "i int, s string")
    got = {r["i"]: r["t"] for r in df.select("i", text.clean_text(df["s"], stop).alias("t")).collect()}
    assert got == {1: "mesa silla" if stop else "la mesa , la silla .", 2: None}
