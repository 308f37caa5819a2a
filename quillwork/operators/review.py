"""Prompts and model reviews (STR21, LLM1-LLM3, JON4, SET2, MLT1, MLT2). Providers are any `(system, user) -> str`; an offline one is given."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import parse_json, parse_plain
from ..functions.text import format_text
from ..schemas import LABELS
from .responses import stored_answers

Provider = Callable[[str, str], str]
#: How a case is shown, of its conflict and its event (a fixed format).
CASE = "[CONFLICTO]\n{conflict}\n\n[EVENTO]\n{event}"
SYSTEM = "You label events of social conflicts."
ASK = "Is there dialogue between the parties in this event? Answer HAY_DIALOGO or NO_DIALOGO.\nReport: {text}"
RUBRIC = "Count as dialogue: meetings, working tables, mediation, signed minutes. Do not count: announcements, demands, protests.\n"
AS_JSON = 'Answer with one JSON object: {"label": "...", "confidence": 0.0}.\n'
JUDGE = 'Answer with one JSON object: {"label": "...", "winning_side": "A or B", "rationale": "..."}.\n'
#: style -> (response format, needs examples, rubric, JSON)
STYLES = {"zero_shot_simple": ("plain", False, False, False), "zero_shot_rubric": ("plain", False, True, False), "few_shot": ("plain", True, False, False), "structured_json": ("json", False, False, True), "structured_few_shot_rubric": ("json", True, True, True)}


def case(conflict: Column, event: Column) -> Column:
    """STR21: the text of a case from its conflict and event texts; null if either is."""
    return format_text(CASE, conflict=conflict, event=event)


def examples_block(examples: list[tuple[str, str]]) -> str:
    return "".join(f"Example {i + 1}: {text}\nAnswer: {label}\n" for i, (text, label) in enumerate(examples))


def prompt(style: str, text: Column, examples: list[tuple[str, str]] | None = None) -> Column:
    """STR21: struct of prompt_style, response_format, system_prompt, user_prompt; null text gives a null user_prompt."""
    if style not in STYLES:
        raise ValueError(f"unknown prompt style: {style}")
    kind, shots, rubric, as_json = STYLES[style]
    if shots and not examples:
        raise ValueError(f"{style} needs examples")
    head = RUBRIC * rubric + AS_JSON * as_json + (examples_block(examples or []) if shots else "")
    before, behind = ASK.split("{text}")
    user = F.concat(F.lit(head + before), text, F.lit(behind))
    return F.struct(F.lit(style).alias("prompt_style"), F.lit(kind).alias("response_format"), F.lit(SYSTEM).alias("system_prompt"), user.alias("user_prompt"))


def prompts(df: DataFrame, text: str, styles: list[str], examples: list[tuple[str, str]] | None = None) -> DataFrame:
    """JON4: each row with each style."""
    return df.withColumn("_p", F.explode(F.array(*[prompt(s, F.col(text), examples) for s in styles]))).select(*df.columns, "_p.*")


def offline(system: str, user: str) -> str:
    """A deterministic stand-in: reads dialogue words in the report."""
    report = user.rsplit("Report:", 1)[-1].lower()
    label = LABELS[0] if any(w in report for w in ("dialog", "diálogo", "meeting", "reunión", "mesa", "table")) else LABELS[1]
    return f'{{"label": "{label}", "confidence": 0.5}}' if "JSON" in user else label


def ask(df: DataFrame, provider: Provider = offline, out: str = "raw_response_text", system: str = "system_prompt", user: str = "user_prompt") -> DataFrame:
    """LLM1: df with the provider's answers, in Arrow batches."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: [provider(s, u) if u is not None else None for s, u in zip(pdf[system], pdf[user], strict=True)]})

    from pyspark.sql import types as T

    return df.mapInPandas(call, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def parsed(df: DataFrame) -> DataFrame:
    """LLM1: normalized_label, is_invalid and error by the response format."""
    plain, as_json = parse_plain(F.col("raw_response_text")), parse_json(F.col("raw_response_text"))
    d = df.withColumns({"_plain": plain, "_json": as_json})
    pick = lambda f: F.when(F.col("response_format") == "json", F.col(f"_json.{f}")).otherwise(F.col(f"_plain.{f}"))
    return d.withColumns({"normalized_label": pick("label"), "is_invalid": pick("is_invalid"), "error": pick("error")}).drop("_plain", "_json")


def review(df: DataFrame, text: str, truth: str, styles: list[str], examples: list[tuple[str, str]] | None = None, provider: Provider = offline, store: str | None = None, model_name: str = "offline") -> DataFrame:
    """LLM2: every row under every style, answered, parsed and compared. With a store (a folder's URI), equal prompts are asked once and repeated tasks
    never ask again; rows then bear model_name and response_id."""
    made = prompts(df, text, styles, examples)
    got = parsed(stored_answers(made, provider, store, model_name) if store else ask(made, provider))
    return got.withColumn("is_correct", F.col("normalized_label").eqNullSafe(F.col(truth)))


def multi_agent(df: DataFrame, text: str, truth: str, provider: Provider = offline) -> DataFrame:
    """LLM3: two sides argue over the case in `text`, a judge decides in JSON; three dependent calls for each row."""
    side = lambda label: F.concat(F.lit(f"Argue in at most four sentences that the answer is {label}, from this report alone.\nReport: "), F.col(text))
    d = df.withColumns({"_s": F.lit(SYSTEM), "_a": side(LABELS[0]), "_b": side(LABELS[1])})
    d = ask(ask(d, provider, "agent_a_argument", "_s", "_a"), provider, "agent_b_argument", "_s", "_b")
    said = [part for label, agent in zip(LABELS, "ab", strict=True) for part in (F.lit(f"For {label}: "), F.col(f"agent_{agent}_argument"), F.lit("\n"))]
    judge = F.concat(F.lit("Two sides have argued. Decide.\n"), *said, F.lit(JUDGE + ASK.split("{text}")[0]), F.col(text))
    d = ask(d.withColumn("_j", judge), provider, "raw_response_text", "_s", "_j").withColumns({"prompt_style": F.lit("multi_agent"), "response_format": F.lit("json")})
    return parsed(d).drop("_s", "_a", "_b", "_j").withColumn("is_correct", F.col("normalized_label").eqNullSafe(F.col(truth)))


def train_classifier(df: DataFrame, text: str, label: str, features: int = 1 << 14):
    """MLT1, MLT2: TF-IDF and logistic regression with balanced class weights (in place of a fine-tuned transformer); returns a fitted pipeline whose
    transform adds `prediction`. Labels become ids from 0 in sorted order."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, StringIndexer, Tokenizer

    from .metrics import class_weights

    weighted = df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)
    steps = [StringIndexer(inputCol=label, outputCol="label_id", stringOrderType="alphabetAsc"), Tokenizer(inputCol=text, outputCol="_words"), HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features), IDF(inputCol="_tf", outputCol="_x"), LogisticRegression(featuresCol="_x", labelCol="label_id", weightCol="weight", regParam=0.01, maxIter=30)]
    return Pipeline(stages=steps).fit(weighted)
