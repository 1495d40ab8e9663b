"""Payments that arrive as nested JSON messages, and quarantine of those that can't be read.

A message is parsed once, as a VARIANT, so a schema may grow: fields are named
by their paths, and what no field names stays in the parsed message. Each
message is either accepted or rejected with its reasons, never both or
neither.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where the columns of a raw payment stand in a message, and their types.
FIELDS: dict[str, tuple[str, str]] = {
    "timestamp": ("$.payment.time", "string"),
    "sender_bic": ("$.header.sender", "string"),
    "receiver_bic": ("$.header.receiver", "string"),
    "amount": ("$.payment.amount", "double"),
    "currency": ("$.payment.currency", "string"),
    "msg_type": ("$.header.type", "string"),
}
#: Fields without which a message is rejected.
REQUIRED = ("timestamp", "amount")


def read_messages(
    raw: DataFrame, text: str = "message", fields: Mapping[str, tuple[str, str]] = FIELDS, required: Collection[str] = REQUIRED
) -> DataFrame:
    """``raw`` with a column per field, ``parsed`` (the whole message as VARIANT) and ``reasons``.

    ``reasons`` lists, in the order of ``fields``, why a message can't be used;
    it is empty for a good one: ``no_message`` (null or blank), ``not_json``,
    ``not_an_object``, ``missing:<field>`` (required, absent or null) or
    ``type:<field>`` (there, but not of its type). Other columns of ``raw`` stay; those named like an added one are
    replaced. Lazy, one pass, in the JVM.
    """
    raw = raw.drop(*[c for c in (*fields, "parsed", "reasons") if c != text])
    message = F.col(text)
    # what is exploded is made once per row: no later filter or field repeats the parse or the look-ups
    parsed = raw.select("*", F.explode(F.array(F.try_parse_json(message))).alias("parsed"))
    there = F.struct(*[F.try_variant_get("parsed", path, "variant").alias(name) for name, (path, _) in fields.items()])
    found = parsed.select("*", F.explode(F.array(there)).alias("_there"))

    def value(name: str, kind: str) -> Column:
        given = F.col("_there").getField(name)
        shape = F.schema_of_variant(given)
        return F.when(~(shape.startswith("OBJECT") | shape.startswith("ARRAY")), F.try_variant_get(given, "$", kind)).alias(name)

    found = found.select("*", F.explode(F.array(F.struct(*[value(name, kind) for name, (_, kind) in fields.items()]))).alias("_values"))
    of_fields = []
    for name in fields:
        given = F.col("_there").getField(name)
        missing = F.when(given.isNull() | F.is_variant_null(given), F.lit(f"missing:{name}") if name in required else F.lit(None).cast("string"))
        of_fields.append(missing.otherwise(F.when(F.col("_values").getField(name).isNull(), F.lit(f"type:{name}"))))
    is_object = F.schema_of_variant("parsed").startswith("OBJECT")
    reasons = (
        F.when(message.isNull() | (F.trim(message) == ""), F.array(F.lit("no_message")))
        .when(F.col("parsed").isNull(), F.array(F.lit("not_json")))
        .when(~is_object, F.array(F.lit("not_an_object")))
        .otherwise(F.array_compact(F.array(*of_fields)))
    )
    judged = found.select("*", F.explode(F.array(reasons)).alias("reasons"))
    return judged.select(*[c for c in raw.columns if c not in fields], "parsed", *[F.col("_values").getField(name).alias(name) for name in fields], "reasons")


def accepted(messages: DataFrame) -> DataFrame:
    """The good ones of :func:`read_messages`, without ``reasons``."""
    return messages.filter(F.size("reasons") == 0).drop("reasons")


def rejected(messages: DataFrame, text: str = "message", fields: Mapping[str, tuple[str, str]] = FIELDS) -> DataFrame:
    """The others: ``raw``'s own columns with the message as it came, and ``reasons`` joined by commas."""
    own = [c for c in messages.columns if c == text or c not in (*fields, "parsed", "reasons")]
    return messages.filter(F.size("reasons") > 0).select(*own, F.array_join("reasons", ",").alias("reasons"))
