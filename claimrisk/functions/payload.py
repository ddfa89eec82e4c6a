"""Requests and responses of scoring and answering services as JSON columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimrisk.functions.columns import vector_columns
from claimrisk.schemas import FEATURES


def records_payload(features: Sequence[str] = FEATURES) -> Column:
    """One request per row: a list with one record of the model inputs in contract order."""
    record = F.struct(*vector_columns(list(features)))
    return F.to_json(F.struct(F.array(record).alias("dataframe_records")))


def read_payload(payload: Column, features: Sequence[str] = FEATURES) -> Column:
    """The first record of a request as a struct."""
    record = ", ".join(f"{f}: DOUBLE" for f in features)
    return F.from_json(payload, f"STRUCT<dataframe_records: ARRAY<STRUCT<{record}>>>")[
        "dataframe_records"][0]


def first_prediction(response: Column) -> Column:
    """The score in a response of the form {"predictions": [score]}."""
    return F.try_variant_get(F.try_parse_json(response), "$.predictions[0]", "double")


def response_text(response: Column) -> Column:
    """The text of an answer, whichever of three shapes it has; else the whole response.

    Output items with typed text parts (joined by line feeds), choices with a message, or a list
    of messages whose last one answers.
    """
    shape = F.from_json(response, """STRUCT<
        output: ARRAY<STRUCT<content: ARRAY<STRUCT<type: STRING, text: STRING>>>>,
        choices: ARRAY<STRUCT<message: STRUCT<content: STRING>>>,
        messages: ARRAY<STRUCT<content: STRING>>>""")
    listed = F.flatten(F.transform(
        shape["output"], lambda item: F.coalesce(item["content"], F.array())))
    spoken = F.filter(
        listed, lambda c: c["type"].isin("output_text", "text") & (F.length(c["text"]) > 0))
    text = F.array_join(F.transform(spoken, lambda c: c["text"]), "\n")
    last = F.try_element_at(shape["messages"], F.lit(-1))
    return F.coalesce(
        F.when(F.size(spoken) > 0, text),
        F.try_element_at(shape["choices"], F.lit(1))["message"]["content"],
        F.when(last.isNotNull(), F.coalesce(last["content"], F.lit(""))),
        response)
