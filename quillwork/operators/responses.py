"""LLM1 with a store of responses: equal prompts are asked once, and never again, whatever tasks are repeated.

A prompt's key is the digest of model name, system and user prompt. A response is written to the store, one file under its key, as soon as it is there;
a task that runs again (or a later run over the same store) finds it and does not ask. Two attempts of a task at the same moment (speculative execution)
may both ask; the first one's answer stays."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import free_name, materialise

#: (system, user) -> text, or (text, response id).
Provider = Callable[[str, str], str | tuple[str, str]]


def prompt_key(model_name: str, system: str, user: str):
    """Null where the user prompt is."""
    part = lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), c)
    return F.sha2(F.concat(part(F.lit(model_name)), part(F.coalesce(system, F.lit(""))), part(F.col(user))), 256)


def stored_answers(df: DataFrame, provider: Provider, store: str, model_name: str, system: str = "system_prompt", user: str = "user_prompt", tasks: int | None = None) -> DataFrame:
    """df with model_name, raw_response_text and response_id (the provider's own, or one made of the key), which are null where the user prompt is null.

    store: a URI of a folder that driver and executors share. tasks: how many ask at the same time (the number of shuffle partitions if not given)."""
    spark = df.sparkSession
    key = free_name(df.columns, "_key")
    keyed = df.withColumn(key, prompt_key(model_name, system, user))
    distinct = keyed.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.first(F.coalesce(system, F.lit(""))).alias("system"), F.first(user).alias("user"))
    many = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(store)
        for pdf in batches:
            for k, s, u in zip(pdf["key"], pdf["system"], pdf["user"], strict=True):
                folder, path = f"{base}/{k[:2]}", f"{base}/{k[:2]}/{k}.json"
                if files.get_file_info(path).type == fs.FileType.NotFound:
                    said = provider(s, u)
                    text, name = said if isinstance(said, tuple) else (said, f"resp_{k[:24]}")
                    files.create_dir(folder, recursive=True)
                    own = f"{folder}/.{uuid.uuid4().hex}"
                    with files.open_output_stream(own) as f:
                        f.write(json.dumps({"model_name": model_name, "raw_response_text": text, "response_id": name}).encode())
                    if files.get_file_info(path).type == fs.FileType.NotFound:
                        files.move(own, path)
                    else:
                        files.delete_file(own)
                with files.open_input_file(path) as f:
                    kept = json.loads(f.read())
                yield pd.DataFrame({"key": [k], "raw_response_text": [kept["raw_response_text"]], "response_id": [kept["response_id"]]}, dtype=object)

    # written, so that a plan that is run again reads them
    answers = materialise(distinct.repartition(many, F.col("key")).mapInPandas(ask, "key string, raw_response_text string, response_id string"), "responses")
    answers = answers.select(F.col("key").alias(key), "raw_response_text", "response_id")
    joined = keyed.join(answers, key, "left")
    return joined.select(*df.columns, F.when(F.col(key).isNotNull(), F.lit(model_name)).alias("model_name"), "raw_response_text", "response_id")
