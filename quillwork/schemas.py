"""Declared schemas of the fixed tables (sources are read with these, never by inference)."""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


OCCURRENCE = _schema(
    ("conflict_type", _S), ("date_init", _S), ("conflict_text", _S), ("location", _S), ("actors_1", _S), ("actors_2", _S), ("actors_3", _S),
    ("event_text", _S), ("dialogo", _S), ("_page_start", _I), ("_page_end", _I), ("_confidence", _D), ("_section", _S), ("_subsection", _S),
    ("_source_pdf", _S), ("_seccion", _S), ("_grupo_conflicto", _S), ("_case_id_local", _S), ("conflict_uid", _S), ("state", _S), ("report_number", _I),
)
PREDICTION = _schema(
    ("row_id", _L), ("true_label", _S), ("conflict_uid", _S), ("prompt_style", _S), ("model_name", _S), ("raw_response_text", _S),
    ("normalized_label", _S), ("response_id", _S), ("is_correct", T.BooleanType()),
)
MEDIA = _schema(("name", _S), ("url", _S), ("_empty", _S))
SPELLS = ("id", "status", "start_date", "end_date")
EXPRESSIONS = ("id", "date", "exp_details")
RECORD = ("Dpto", "Tipo", "Ingreso como caso nuevo", "Caso", "Ubicacion", "Actores primarios", "Actores secundarios", "Actores terciarios", "Dialogo", "Detalle del mes", "Mes", "NInforme")
#: The two labels, in their fixed order, and the mark of an invalid answer.
LABELS = ("HAY_DIALOGO", "NO_DIALOGO")
INVALID = "__INVALID__"
