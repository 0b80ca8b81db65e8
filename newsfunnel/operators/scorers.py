"""Plug point for scorers (R2, R3, T3): any callable that answers prompts.

A scorer is ``scorer(system: str, prompts: list[str]) -> list[str | None]``: one answer a prompt,
in order; it may raise.  It runs in the workers on batches of ``batch_rows`` prompts, next
to the rows (no shuffle, no join back), and must be picklable: clients are best made on
first use inside it.

Failures are the rules' own: a batch that raises, or answers another number of prompts,
has NULL answers, which a verdict reads as yes and a district as none.  After ``give_up``
failed batches in a row a task stops asking and leaves its other rows NULL.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfunnel.functions.workers import ship_by_value
from newsfunnel.operators.tagging import district_prompt, resolve_answer, with_state_districts
from newsfunnel.operators.verdicts import parse_verdict, relevance_prompt

Scorer = Callable[[str, list[str]], list[str | None]]

# The system prompts of the two questions.
RELEVANCE_SYSTEM = ("You are a news classifier. Determine if an article is about HEAT or HEATWAVE impact in a SPECIFIC REGION of INDIA. "
                    "Answer ONLY 'Yes' or 'No'.")
DISTRICT_SYSTEM = "You extract geographic information from Indian news articles. You can read all Indian languages and scripts."


def with_answers(df: DataFrame, prompt: Column, scorer: Scorer, system: str, out: str = "response", batch_rows: int = 32, give_up: int = 5) -> DataFrame:
    """``df`` with the scorer's answer to each row's prompt; rows with a NULL prompt are not asked."""
    asked = df.drop(out).withColumn(out, prompt)
    at = len(asked.columns) - 1
    schema = T.StructType([*asked.schema.fields[:-1], T.StructField(out, T.StringType())])

    def run(batches):
        failed = 0
        for b in batches:
            prompts = b.column(at).to_pylist()
            answers: list[str | None] = [None] * len(prompts)
            open_ = [i for i, p in enumerate(prompts) if p is not None]
            for k in range(0, len(open_), batch_rows):
                rows = open_[k:k + batch_rows]
                if failed >= give_up:
                    break
                try:
                    got = list(scorer(system, [prompts[i] for i in rows]))
                    if len(got) != len(rows):
                        raise ValueError("a scorer answers each prompt")
                    failed = 0
                except Exception:  # noqa: BLE001 - the rule: a failed call has no answer
                    failed += 1
                    continue
                for i, a in zip(rows, got):
                    answers[i] = a
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(answers, pa.string())], names=b.schema.names)

    return asked.mapInArrow(run, schema)


def filter_refs(refs: DataFrame, scorer: Scorer, **how) -> DataFrame:
    """R3 with a scorer: refs whose title it does not refuse (no text is read)."""
    asked = with_answers(refs.withColumn("_no_text", F.lit(None).cast("string")), relevance_prompt(text="_no_text"), scorer, RELEVANCE_SYSTEM, "_answer", **how)
    return asked.where(parse_verdict("_answer")).drop("_answer", "_no_text")


def tag_with_scorer(df: DataFrame, gazetteer: DataFrame, scorer: Scorer, key: str = "ord", district: str = "district", state: str = "state", **how) -> DataFrame:
    """T3 with a scorer: untagged rows of known states are asked for their district."""
    j = with_state_districts(df, gazetteer, state, "_sd")
    eligible = F.col(district).isNull() & F.col("_sd").isNotNull() & (F.size(F.col("_sd")) > 0)
    asked = with_answers(j, F.when(eligible, district_prompt(state=state, districts="_sd")), scorer, DISTRICT_SYSTEM, "_answer", **how)
    return asked.withColumn(district, F.when(eligible, resolve_answer(F.col("_answer"), F.col("_sd"))).otherwise(F.col(district))).drop("_sd", "_answer")


ship_by_value(__name__)
