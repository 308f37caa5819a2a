import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork import schemas
from quillwork.functions import dates, labels, text
from quillwork.operators import metrics, relational, reports, reshape, review, sentiment, spells
from quillwork.sources import readers
from quillwork.streaming import counts


def values(spark, column, given, kind="string"):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], f"i int, c {kind}")
    return [r.v for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


def test_spells(spark):
    day = lambda s: dt.datetime.fromisoformat(s)
    rows = [(1, 0, "nuevo", "2020-01-01"), (1, 1, "reactivado", "2020-02-01"), (1, 2, "latente", "2020-03-01"), (1, 3, "reactivado", "2020-05-01"), (2, 0, "resuelto", "2020-01-01"), (4, 0, "nuevo", "2021-01-01"), (4, 1, "latente", "2021-01-01"), (5, 0, "nuevo", "2023-01-01"), (3, 0, "nuevo", None), (None, 0, "nuevo", "2020-01-01")]
    df = spark.createDataFrame([(i, o, s, d and day(d)) for i, o, s, d in rows], "id int, ord int, status string, date timestamp_ntz")
    got = [(r.id, r.status, str(r.start_date)[:10], str(r.end_date)[:10]) for r in spells.spells(df, "id", "date", "status", "ord").orderBy("id", "start_date", "end_date").collect()]
    assert got == [
        (1, "active", "2020-01-01", "2020-03-01"), (1, "non_active", "2020-03-01", "2020-05-01"), (1, "active", "2020-05-01", "2022-07-01"), (2, "non_active", "2020-01-01", "2022-07-01"),
        (4, "active", "2021-01-01", "2021-01-01"), (4, "non_active", "2021-01-01", "2022-07-01"), (5, "active", "2023-01-01", "2022-07-01"),
    ]


def test_labels(spark):
    given = ["HAY_DIALOGO", "hay diálogo", "  Hay   Diálogo ", "NO HAY DIÁLOGO", "no_dialogo", "NO DIALOGO", "Creo que HAY_DIALOGO aquí", "Respuesta: NO_HAY_DIALOGO.", "NO_DIALOGO.", "Respuesta: NO_DIALOGO", "NOHAYDIALOGO", "", "sí", None]
    hay, no = schemas.LABELS
    assert values(spark, labels.normalize_label, given) == [hay, hay, hay, no, no, no, hay, no, None, None, None, None, None, None]
    plain = values(spark, labels.parse_plain, ["hay diálogo", "x"])
    assert [tuple(p) for p in plain] == [(hay, False, None), (None, True, "invalid_plain_label")]


def test_json_labels(spark):
    hay, no = schemas.LABELS
    given = ['x ```{"label":"HAY_DIALOGO","confidence":0.9}```', '{"label":"no hay diálogo"}', "sin json", "} {", '{"label":"x"', "{bad}", "{'label':'X'}", '{"label":"A"} {"label":"B"}', '{"label":"HAY_DIALOGO",}', "{}", '{"label":null}', '{"label":"tal vez"}', '{"label":NaN}', '{"label":{"a":"HAY_DIALOGO"}}', None]
    none, quotes = "no_json_object", "json_decode_error:Expecting property name enclosed in double quotes"
    want = [(hay, None), (no, None), (None, none), (None, none), (None, none), (None, quotes), (None, quotes), (None, "json_decode_error:Extra data"), (None, "json_decode_error:Illegal trailing comma before end of object"), *[(None, "invalid_json_label")] * 4, (hay, None), (None, none)]
    got = values(spark, labels.parse_json, given)
    assert [(g.label, g.error) for g in got] == want and all(g.is_invalid == (g.label is None) for g in got)


def predictions(spark):
    hay, no = schemas.LABELS
    rows = [(hay, hay)] * 26 + [(hay, no)] * 15 + [(no, hay)] * 7 + [(no, no)] * 2
    return spark.createDataFrame([("m", t, p) for t, p in rows], "g string, true_label string, normalized_label string")


def test_summary_golden(spark):
    r = metrics.summarize(predictions(spark), ["g"]).first()
    want = {"n_rows": 50, "accuracy": 0.56, "balanced_accuracy": 0.4281842818428184, "precision_macro": 0.45276292335115864, "recall_macro": 0.4281842818428184, "f1_macro": 0.4282744282744283, "precision_hay_dialogo": 0.7878787878787878, "recall_hay_dialogo": 0.6341463414634146, "f1_hay_dialogo": 0.7027027027027027, "support_hay_dialogo": 41, "precision_no_dialogo": 0.11764705882352941, "recall_no_dialogo": 0.2222222222222222, "f1_no_dialogo": 0.15384615384615385, "support_no_dialogo": 9}
    assert all(r[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())


def test_summary_of_one_class_and_nulls(spark):
    hay = schemas.LABELS[0]
    df = spark.createDataFrame([("a", hay, hay), ("a", hay, None)], "g string, true_label string, normalized_label string")
    r = metrics.summarize(df, ["g"]).first()
    assert (r.accuracy, r.balanced_accuracy, r.recall_macro, r.f1_no_dialogo, r.support_no_dialogo) == (0.5, 0.5, 0.25, 0.0, 0)
    cells = {(c.true_label, c.pred_label): c["count"] for c in metrics.confusion(df, "g").collect()}
    assert len(cells) == 9 and sum(cells.values()) == 2 and cells[hay, schemas.INVALID] == 1


def test_average_precision_and_softmax(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.1), (0, 0.05)], "y int, s double")
    assert metrics.average_precision(df, "y", "s").first()[0] == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)
    row = spark.range(1).select(metrics.softmax(F.array(F.lit(1.0), F.lit(1.0))).alias("s"), metrics.argmax(F.array(F.lit(1.0), F.lit(2.0), F.lit(2.0))).alias("a")).first()
    assert row.s == [0.5, 0.5] and row.a == 1


def test_dates(spark):
    given = ["Agosto de 2019", "setiembre 2020. Hubo reunión", "DICIEMBRE de 2018, texto", "En mayo de 2017", "Mayo", "Agosto de 2019. uno\ndos", None]
    assert [d and str(d) for d in values(spark, dates.first_of_month, given)] == ["2019-08-01", "2020-09-01", "2018-12-01", None, None, "2019-08-01", None]
    assert values(spark, dates.rest_text, given) == [None, "Hubo reunión", "texto", None, None, None, None]
    more = ["Mayo, 2019. Hubo reunión", "Mayo de 2019: texto", "Mayo de, 2019.,x", "Mayo de 2019; y", "Mayo 2019 - z", "Mayo  de\u00a02019 w", "Mayo2019 v"]
    assert values(spark, dates.rest_text, more) == ["Hubo reunión", ": texto", "x", "; y", "- z", "w", None]
    series = [r.month_text for r in dates.month_series(spark).orderBy("n").collect()]
    assert len(series) == 204 and series[0] == "Enero 2007" and series[-1] == "Diciembre 2023"


def test_conflict_types(spark):
    given = ["Por asunto de gobierno local ...", "ASUNTOS DE GOBIERNO LOCAL", "Asuntos de gobiernos regional", "Por asuntos de gobierno nacional", "DEMARCACIÓN TERRITORIAL", "Socioambiental minería", "Comunal", None]
    assert values(spark, text.conflict_type, given) == ["asuntos de gobierno local", "asuntos de gobierno local", "asuntos de gobierno regional", "por asuntos de gobierno nacional", "demarcación territorial", "socioambiental", "comunal", None]
    given = ["Cultivo ilegal de hoja de coca en X", "Cultivos de coca", "Por demarcación territorial", "Por asunto de gobierno regional", "Por asuntos de gobiernos regional", "Asunto de gobiern regional", "Asunto de gobierno nacional"]
    assert values(spark, text.conflict_type, given) == ["cultivo ilegal de hoja de coca", "cultivos de coca", "por demarcación territorial", "asuntos de gobierno regional", "por asuntos de gobiernos regional", "asuntos de gobierno regional", "asuntos de gobierno nacional"]


def test_record_types(spark):
    given = ["x Socio ambien tal y", "Comu nal", "Otro", "Labo\nral", "Asunto de gobierno local", "Asuntos de go bierno local\nLaboral.", None]
    assert values(spark, text.record_type, given) == ["Socioambiental", "Comunal", "Otro", "Labo\nral", "Asunto de gobierno local", "Asunto de gobierno local\nLaboral", None]


def test_text_functions(spark):
    assert values(spark, text.strip, ["  a b\t\n", "", None]) == ["a b", "", None]
    assert values(spark, lambda c: text.rsplit(c, 2), ["a b c d", "x y", "one"]) == [["a b", "c", "d"], ["x", "y"], ["one"]]
    assert values(spark, text.leading_int, ["123a", "12ab", "1abc", "abc"]) == [123, 12, 1, None]
    assert values(spark, lambda c: text.after(c, "=>"), ["a=>b=>c", "ab"]) == ["b=>c", None]
    assert values(spark, lambda c: text.section(c, "INI", "FIN"), ["x I NI a\nb FI N FIN", "no"]) == [" a\nb ", None]
    assert values(spark, lambda c: text.format_text("<{c}>", c=c), ["a", None]) == ["<a>", None]
    assert values(spark, lambda c: text.clean_tokens(c, ["la"]), ["La (casa), la casa-grande."]) == [["casa", "casa-grande"]]


def test_melts(spark):
    df = spark.createDataFrame([(1, "2020-01-01", None, "a", "b")], "id int, d1 string, d2 string, i1 string, i2 string")
    assert [tuple(r) for r in reshape.paired_melt(df, ["id"], ["d1", "d2"], ["i1", "i2"]).collect()] == [(1, "2020-01-01", "a")]
    assert values(spark, reshape.status_name, ["d_TCNuevo2", "d_TCLatente12", "d_TCRetirado"]) == ["nuevo2", "latente12"[:7], "retirado"]
    assert [len(t) for t in values(spark, reshape.triples, [list("abcdefg"), list("ab"), []], "array<string>")] == [2, 0, 0]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX|out of bounds"):
        values(spark, reshape.triples, [list("abcdefgh")], "array<string>")


def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cells = [["id", "what", "d_TCNuevo", "d_TCLatente1", "d_Expresión1", "InfoExpresión1"], ["1", "mine", "43831", "43862", "43831", "march"], ["2", "river", None, None, None, None]]
    body = "".join("<row>" + "".join(f'<c r="{chr(65 + j)}{i + 1}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(row) if v is not None) + "</row>" for i, row in enumerate(cells))
    path = tmp_path / "book.xlsx"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    kinds = [T.IntegerType(), T.StringType(), T.DateType(), T.DateType(), T.DateType(), T.StringType()]
    df = readers.read_workbooks(spark, str(path), T.StructType([T.StructField(n, k) for n, k in zip(cells[0], kinds, strict=True)]))
    assert [tuple(r) for r in reports.workbook_description(df).orderBy("id").collect()] == [(1, "mine"), (2, "river")]
    assert [(r.id, str(r.date), r.exp_details) for r in reports.workbook_expressions(df).collect()] == [(1, "2020-01-01", "march")]
    assert [(r.id, r.status, str(r.start_date)[:10], str(r.end_date)[:10]) for r in reports.workbook_spells(df).orderBy("start_date").collect()] == [(1, "active", "2020-01-01", "2020-02-01"), (1, "non_active", "2020-02-01", "2022-07-01")]


def test_readers(spark, tmp_path):
    (tmp_path / "media.csv").write_bytes("﻿El Diario;http://a;\n;;\nOtro;http://b;\n".encode())
    assert [tuple(r) for r in readers.read_media_list(spark, str(tmp_path / "media.csv")).collect()] == [("El Diario", "http://a"), ("Otro", "http://b")]
    (tmp_path / "words.txt").write_bytes("; note\n\ngood\n na\xefve \n".encode("latin-1"))
    assert {r.word for r in readers.read_word_list(spark, str(tmp_path / "words.txt")).collect()} == {"good", "naïve"}
    (tmp_path / "p.json").write_text(json.dumps([{"row_id": 1, "true_label": "x"}, {"row_id": 2, "is_correct": True}]))
    assert readers.read_json_array(spark, str(tmp_path / "p.json"), schemas.PREDICTION).count() == 2
    df = spark.createDataFrame([(1, 'say "hi",\nthere')], "a int, b string")
    readers.write_csv(df, str(tmp_path / "out"))
    assert readers.read_csv(spark, str(tmp_path / "out"), df.schema).first().b == 'say "hi",\nthere'
    readers.write_json(df, str(tmp_path / "json"))
    assert spark.read.schema(df.schema).json(str(tmp_path / "json")).count() == 1
    assert readers.list_files(spark, str(tmp_path), "*.txt").count() == 1


def test_html(spark):
    html = '<div><h1>T &amp; t</h1><p class="x">a <b>b</b></p><a href="/0">Reporte de conflictos Nº 1</a><div class="card-body"><a href="/1"><h5>Reporte de conflictos Nº 12</h5></a></div><a href="/2">other</a></div>'
    pages = spark.createDataFrame([(1, html), (2, "<h1>only</h1>"), (3, None)], "id int, html string")
    assert [tuple(r) for r in readers.report_links(pages, "id", "html", "conflictos").collect()] == [(1, 12, "Reporte de conflictos Nº 12", "/1")]
    assert [tuple(r) for r in readers.article_fields(pages, "html", ["id"], {"title": ("h1", None, None), "body": ("p", "class", "x")}).collect()] == [(1, "T & t", "a b")]


def test_article_fields_with_cut_references(spark):
    """A reference cut before its semicolon stays as it is, as in the SQL; pages without the field are kept on demand."""
    html = ["<title>a &amp; b&amp</title>", "<title>c &lt d&#x27;&#39 &amp;lt; e\u00a0\u00a0f</title>", "<p>none</p>", None]
    pages = spark.createDataFrame(list(enumerate(html)), "id int, html string")
    got = readers.article_fields(pages, "html", ["id"], {"title": ("title", None, None)}, drop=False).collect()
    assert dict(map(tuple, got)) == {0: "a & b&amp", 1: "c &lt d'&#39 &lt; e\u00a0\u00a0f", 2: None, 3: None}
    assert readers.article_fields(pages, "html", ["id"], {"title": ("title", None, None)}).count() == 2


def test_page_texts(spark):
    files = spark.createDataFrame([("f", ["one", "two KEY here ", "KEY again"]), ("g", ["none"])], "path string, pages array<string>")
    pages = readers.page_texts(files, F.col("pages"))
    assert {r.path: r.text for r in readers.text_after(pages, "KEY").collect()} == {"f": "here", "g": None}
    assert {r.path: r.text for r in readers.whole_text(pages).collect()}["f"] == "one\ntwo KEY here \nKEY again"


def test_report_records(spark):
    body = "intro PIURA Tipo: Socioambiental x Caso: mina Ubicación: u Actores primarios: p Diálogo: HAY Detalle del mes: d1 Ti po: Comunal Caso: c2 Ubicación: u2 Actores primarios: p2 Actores secundarios: s2 Diálogo: NO HAY Detalle del mes: d2 PUNO Tipo: Otro Caso: c3 Ubicación: u3 Actores primarios: p3 Diálogo: NO Detalle del mes: d3"
    df = spark.createDataFrame([(1, 36, body)], "id int, n int, body string")
    got = reports.report_records(df, "id", "body", F.col("n"), ["PIURA", "LIMA", "PUNO"]).orderBy("Dpto", "Caso").collect()
    assert [(r.Dpto, r.Tipo, r.Caso, r["Actores secundarios"], r["Detalle del mes"], r.Mes, r.NInforme) for r in got] == [("PIURA", "Comunal", "c2", "s2", "d2", "Febrero 2007", 36), ("PIURA", "Socioambiental", "mina", "", "d1", "Febrero 2007", 36), ("PUNO", "Otro", "c3", "", "d3", "Febrero 2007", 36)]
    table = spark.createDataFrame([("r", "x START\nmine water 12 30%\nroad 4 9%")], "k string, body string")
    assert [tuple(r) for r in reports.activity_counts(table, "k", "body", "START").collect()] == [("r", "mine water", "12", "30%"), ("r", "road", "4", "9%")]


def test_occurrences(spark):
    base = {f.name: None for f in schemas.OCCURRENCE.fields} | {"conflict_type": "Socioambiental x", "date_init": " Mayo de 2021. algo ", "conflict_text": "La mina", "dialogo": "HAY DIÁLOGO", "conflict_uid": "u1", "state": "activo"}
    rows = [base | {"event_text": f"e{i % 6}", "report_number": 200} for i in range(7)] + [base | {"conflict_uid": "u2", "event_text": "z", "report_number": 1}] * 2
    # not counted: other dialogue values; not kept: events that say nothing; kept: null event with text behind the date, null conflict text
    rows += [base | {"conflict_uid": "u3", "event_text": f"e{i}", "report_number": 2, "dialogo": "SI" if i < 3 else "NO HAY DIÁLOGO"} for i in range(8)]
    rows += [base | {"conflict_uid": "u4", "event_text": e, "report_number": i, "dialogo": "NO HAY DIÁLOGO", "conflict_text": None} for i, e in enumerate(["se registraron nuevos hechos durante el mes.", "se registraron nuevos hechos durante el mes..", None, "", "a", "b"])]
    rows.append(base | {"conflict_uid": "u1", "event_text": None, "date_init": "Mayo", "report_number": 9})
    df = spark.createDataFrame([tuple(r[f.name] for f in schemas.OCCURRENCE.fields) for r in rows], schemas.OCCURRENCE)
    got = reports.clean_occurrences(df, stop=["la"])
    assert got.columns == reports.MODEL_COLUMNS
    by = {}
    for r in got.collect():
        by.setdefault(r.conflict_uid, []).append(r)
    assert by.keys() == {"u1", "u4"} and len(by["u1"]) == 6
    assert {(r.dialogo, str(r.clean_date), r.clean_conflict_text, r.conflict_type, r.date_init) for r in by["u1"]} == {(1, "2021-05-01", "mina", "socioambiental", "Mayo de 2021. algo")}
    assert sorted((r.dialogo, r.clean_event_text, r.clean_conflict_text) for r in by["u4"]) == [(0, "", None), (0, "a", None), (0, "algo", None), (0, "b", None)]


def test_sentiment(spark):
    df = spark.createDataFrame([(1, "good bad table good"), (2, "")], "id int, t string")
    tokens = text.clean_tokens(F.col("t"), [])
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1), ("good", -1)], "word string, polarity int")
    for got in (sentiment.proportions(df, "id", tokens, ["good"], ["bad", "good"]), sentiment.proportions_by_join(df, "id", tokens, lexicon)):
        assert {r.id: (r.positive, r.negative, r.neutral) for r in got.collect()} == {1: (0.5, 0.25, 0.25), 2: (None, None, None)}
    # examples that the rules' authors publish, with their lexicon's values
    valence = {"smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "sux": -1.5, "horrible": -2.5, "great": 3.1, "uncompelling": -0.9, "kind": 2.4}
    known = {
        "VADER is smart, handsome, and funny.": 0.8316, "VADER is smart, handsome, and funny!": 0.8439, "VADER is very smart, handsome, and funny.": 0.8545, "VADER is VERY SMART, handsome, and FUNNY.": 0.9227,
        "VADER is VERY SMART, handsome, and FUNNY!!!": 0.9342, "VADER is not smart, handsome, nor funny.": -0.7424, "The book was good.": 0.4404, "The book was kind of good.": 0.3832, "Today SUX!": -0.5461,
        "At least it isn't a horrible book.": 0.431, "The plot was good, but the characters are uncompelling and the dialog is not great.": -0.7042, "": 0.0,
    }
    rated = sentiment.polarity(spark.createDataFrame([(t,) for t in known], "t string"), "t", valence).collect()
    assert {r.t: round(r.compound, 4) for r in rated} == known and all(abs(r.pos + r.neg + r.neu - 1) < 1e-9 for r in rated if r.t)
    scored = sentiment.polarity(spark.createDataFrame([("it is good",), ("not good",), (None,)], "t string"), "t", {"good": 2.0}).collect()
    assert scored[0].compound > 0 > scored[1].compound and scored[2].compound == 0


def test_splits(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"), (F.col("id") % 37).alias("g"))
    s = relational.stratified_split(df, "y", "id")
    counts_ = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert counts_ == {(0, "train"): 630, (0, "validation"): 135, (0, "test"): 135, (1, "train"): 70, (1, "validation"): 15, (1, "test"): 15}
    assert relational.leaked_keys(relational.group_split(df, "g"), "g").count() == 0


def test_lookup_strict(spark):
    df = spark.createDataFrame([("a",), ("z",)], "k string")
    assert [r[0] for r in df.select(relational.lookup(F.col("k"), {"a": "1"})).collect()] == ["1", "z"]
    with pytest.raises(Exception, match="no value for z"):
        df.select(relational.lookup(F.col("k"), {"a": "1"}, strict=True)).collect()


def test_prompts(spark):
    df = spark.createDataFrame([("reunión de mesa", "HAY_DIALOGO"), ("paro", "NO_DIALOGO")], "t string, y string")
    with pytest.raises(ValueError):
        review.prompt("few_shot", F.col("t"))
    with pytest.raises(ValueError):
        review.prompt("nope", F.col("t"))
    got = review.review(df, "t", "y", list(review.STYLES), [("x", "HAY_DIALOGO")])
    assert got.count() == 10 and got.where("is_correct").count() == 10
    both = relational.union_diagonal(got, review.multi_agent(df, "t", "y"))
    assert both.where("agent_a_argument is null").count() == 10


def test_stream(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1 + i), 1, "view", 1.0, None) for i in range(6)] + [(9, dt.datetime(2024, 1, 1), 1, "other", 1.0, None)]
    spark.createDataFrame(rows, counts.EVENTS).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = counts.windowed_counts(counts.read_events(spark, str(tmp_path / "in"), "*.parquet"), ["view"])
    q = stream.writeStream.format("memory").queryName("seen").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) from seen").first()[0] == 6


def test_classifier_on_held_out_rows(spark):
    words = {"a": ["mesa", "acuerdo", "reunión"], "b": ["paro", "bloqueo", "protesta"]}
    rows = [(i, f"caso {i % 13} {words[y][i % 3]} {words[y][i % 2]} zona {i % 7}", y) for i in range(200) for y in ("a" if i % 3 else "b",)]
    df = spark.createDataFrame(rows, "id int, t string, y string")
    model = review.train_classifier(df.where("id < 140"), "t", "y")
    got = model.transform(df.where("id >= 140")).collect()
    assert sum(r.prediction == (r.y == "b") for r in got) == len(got) == 60
