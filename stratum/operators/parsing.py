"""Events ⇄ rows: JSON encoding for the topic (SNK1, SNK2), tolerant parsing
into Bronze (PRJ1–PRJ4), the JSON-Schema gate (QG1) and dead-letter envelopes
(QG2).

All of it is per-row column expressions, so it runs inside the scan stage with
no shuffle and scales linearly with the topic.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import iso_text
from stratum.manifest import Manifest, spark_type

CORRUPT_COL = "_corrupt_record"


# ------------------------------------------------------------------ encode
def message_key(c: Column) -> Column:
    """Topic key of a row: the key field as text, ``""`` for NULL.

    Zero stays ``"0"`` (a falsy value is still a value)."""
    return F.coalesce(c.cast("string"), F.lit(""))


def encode_events(df: DataFrame, manifest: Manifest | None = None,
                  key_field: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows → ``(key STRING, value STRING)`` messages.

    The value is the row as one JSON object with the column names as keys;
    timestamps become ISO-8601 text with a ``T`` separator (fraction only when
    present) and NULL fields are written as ``null``, not dropped. Columns named
    in ``keep`` stay beside the message and are not part of it.
    """
    key_field = key_field if key_field is not None else (manifest.key_field if manifest else None)
    fields = []
    for f in df.schema.fields:
        if f.name in keep:
            continue
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            fields.append(iso_text(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            fields.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            fields.append(F.col(f.name))
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    key = message_key(F.col(key_field)) if key_field else F.lit(None).cast("string")
    return df.select(key.alias("key"), value.alias("value"), *keep)


# ------------------------------------------------------------------- parse
@dataclass
class Parsed:
    """Result of parsing a topic: Bronze rows and rejected messages."""

    rows: DataFrame
    rejects: DataFrame


def _ingestion_ts(ingestion_ts) -> Column:
    if ingestion_ts is None:
        return F.current_timestamp().cast(T.TimestampNTZType())
    if isinstance(ingestion_ts, Column):
        return ingestion_ts.cast(T.TimestampNTZType())
    return F.lit(ingestion_ts).cast(T.TimestampNTZType())


def with_fraction(pattern: str) -> str:
    """The pattern with an optional fraction of up to six digits after its seconds, if it has none:
    the encoder writes a fraction whenever there is one."""
    return pattern if "S" in pattern else re.sub(r"ss(?!.*ss)", "ss[.SSSSSS]", pattern)


def parse_timestamp(c: Column, pattern: str) -> Column:
    """Text → wall-clock timestamp by pattern, with or without a fraction of a second; text
    that does not match is NULL."""
    pattern = with_fraction(pattern)
    return F.try_to_timestamp(c, F.lit(pattern)).cast(T.TimestampNTZType())


def bronze_columns(manifest: Manifest, parsed: Column) -> list[Column]:
    """Topic struct → Bronze columns: timestamps parsed by the manifest pattern,
    other columns cast to their Bronze type (NULL when they do not fit)."""
    out = []
    for col in manifest.columns:
        src = parsed[col.name]
        target = spark_type(col.bronze_type)
        if col.parse_timestamp:
            expr = parse_timestamp(src, manifest.spark_ts_pattern)
        elif spark_type(col.kafka_type) == target:
            expr = src
        else:
            expr = src.try_cast(target)
        out.append(expr.alias(col.name))
    return out


def _parsed(topic: DataFrame, manifest: Manifest, value_col: str, observation: Observation | None) -> DataFrame:
    """The topic with ``_value``, the parsed document ``_p`` and ``_bad_doc``."""
    schema = manifest.topic_schema().add(CORRUPT_COL, T.StringType())
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    p = F.col("_p")
    staged = topic.select(F.col(value_col).alias("_value"),
                          F.from_json(F.col(value_col), schema, opts).alias("_p"))
    # Only flagged rows pay for the second parse that tells "bad field" from
    # "not a document".
    not_object = F.when(
        p[CORRUPT_COL].isNotNull() | F.col("_value").isNull(),
        F.coalesce(~F.startswith(F.schema_of_variant(F.try_parse_json(F.col("_value"))),
                                 F.lit("OBJECT")), F.lit(True)),
    ).otherwise(F.lit(False))
    staged = staged.withColumn("_bad_doc", not_object)
    # Run metrics of the parse (RC8: messages read, messages rejected). The
    # observation point also keeps later filters on parsed fields (quality
    # filters, de-dup keys) above it: pushed below, each predicate would
    # re-parse the document, and they can never reach the source scan anyway.
    return staged.observe(observation or f"bronze_parse_{uuid.uuid4().hex[:8]}",
                          F.count(F.lit(1)).alias("messages"),
                          F.count_if(F.col("_bad_doc")).alias("rejected"))


REJECT_MESSAGE = "malformed JSON document"


def parse_events(topic: DataFrame, manifest: Manifest, ingestion_ts=None,
                 value_col: str = "value", observation: Observation | None = None) -> Parsed:
    """Bronze parse of a topic of JSON documents.

    * a field that does not fit its declared type becomes NULL, the row stays;
    * a message that is not a JSON object at all goes to ``rejects``;
    * ``ingestion_ts`` is one value per batch (``current_timestamp()`` unless a
      fixed run time is given);
    * pass an ``Observation`` to read the run metrics (``messages``,
      ``rejected``) after the first action.
    """
    staged = _parsed(topic, manifest, value_col, observation)
    rows = staged.filter(~F.col("_bad_doc")).select(
        *bronze_columns(manifest, F.col("_p")), _ingestion_ts(ingestion_ts).alias("ingestion_ts"))
    rejects = staged.filter(F.col("_bad_doc")).select(
        F.lit(REJECT_MESSAGE).alias("error"),
        F.col("_value").alias("payload"),
        _ingestion_ts(ingestion_ts).alias("rejected_at"))
    return Parsed(rows, rejects)


def parse_routed(topic: DataFrame, manifest: Manifest, ingestion_ts=None, value_col: str = "value",
                 observation: Observation | None = None) -> DataFrame:
    """The same parse as one frame, for writers that need both outputs from one read: ``row`` (a
    Bronze row) and ``error``, ``payload``, ``rejected_at``, split by ``rejected``."""
    staged = _parsed(topic, manifest, value_col, observation)
    bad, at = F.col("_bad_doc"), _ingestion_ts(ingestion_ts)
    row = F.struct(*bronze_columns(manifest, F.col("_p")), at.alias("ingestion_ts"))
    return staged.select(F.when(~bad, row).alias("row"), F.when(bad, F.lit(REJECT_MESSAGE)).alias("error"),
                         F.when(bad, F.col("_value")).alias("payload"), F.when(bad, at).alias("rejected_at"), bad.alias("rejected"))


# ------------------------------------------------------------- schema gate
_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def json_type_of(schema_text: Column) -> Column:
    """JSON-Schema type name from a variant schema string
    (``schema_of_variant``): ``null``, ``boolean``, ``string``, ``object``,
    ``array``, ``integer`` (whole numbers) or ``number``."""
    # cuts at the first bracket, not a regex: every branch below evaluates it again
    base = F.substring_index(F.substring_index(schema_text, "(", 1), "<", 1)
    return (F.when(schema_text.isNull(), F.lit(None))
            .when(base == "VOID", F.lit("null"))
            .when(base == "BOOLEAN", F.lit("boolean"))
            .when(base == "STRING", F.lit("string"))
            .when(base == "OBJECT", F.lit("object"))
            .when(base == "ARRAY", F.lit("array"))
            .when(base.isin(*_INTEGRAL) | ((base == "DECIMAL") & F.endswith(schema_text, F.lit(",0)"))),
                  F.lit("integer"))
            .otherwise(F.lit("number")))


def _type_ok(actual: Column, allowed: list[str]) -> Column:
    names = set(allowed)
    if "number" in names:
        names.add("integer")
    return actual.isin(*sorted(names))


def _member(name: str) -> str:
    """Variant path of a property, whatever its name holds: dots and quotes are part of the name."""
    quote = '"' if '"' not in name else "'"
    return f"$[{quote}{name}{quote}]"


def schema_gate(topic: DataFrame, json_schema: dict, value_col: str = "value") -> DataFrame:
    """Adds ``error`` (NULL when valid) by checking each message against a
    JSON Schema's ``type`` (per property) and ``required`` rules.

    The first failing rule wins: property types in schema order, then missing
    required properties in list order. Date-time formats are not checked.
    Messages: ``<field>: <actual> is not of type <allowed>`` and
    ``'<field>' is a required property``; a message that is not an object
    gives ``not a JSON object``.

    Each message is parsed once; each property's JSON type is derived once in
    a projection, and the rules read those columns.
    """
    props = [(n, spec) for n, spec in (json_schema.get("properties") or {}).items()]
    names = sorted({n for n, _ in props} | set(json_schema.get("required") or []))
    idx = {n: i for i, n in enumerate(names)}
    parsed = topic.withColumn("_v", F.try_parse_json(F.col(value_col)))
    schemas = parsed.select(
        *[F.col(c) for c in topic.columns],
        F.schema_of_variant(F.col("_v")).alias("_root"),
        *[F.schema_of_variant(F.try_variant_get(F.col("_v"), _member(n), "variant")).alias(f"_s{idx[n]}")
          for n in names])
    typed = schemas.select(*[F.col(c) for c in topic.columns], "_root",
                           *[json_type_of(F.col(f"_s{i}")).alias(f"_t{i}") for i in range(len(names))])
    checks: list[tuple[Column, Column]] = [
        (F.coalesce(~F.startswith(F.col("_root"), F.lit("OBJECT")), F.lit(True)),
         F.lit("not a JSON object")),
    ]
    for name, spec in props:
        allowed = spec.get("type")
        if allowed is None:
            continue
        allowed = [allowed] if isinstance(allowed, str) else list(allowed)
        actual = F.col(f"_t{idx[name]}")
        msg = F.concat(F.lit(f"{name}: "), actual,
                       F.lit(" is not of type " + ", ".join(f"'{t}'" for t in allowed)))
        checks.append((actual.isNotNull() & ~_type_ok(actual, allowed), msg))
    for name in json_schema.get("required") or []:
        checks.append((F.col(f"_t{idx[name]}").isNull(), F.lit(f"'{name}' is a required property")))
    error = None
    for cond, msg in checks:
        error = F.when(cond, msg) if error is None else error.when(cond, msg)
    gated = typed.select(*[F.col(c) for c in topic.columns], error.alias("error"))
    # Run metrics of the gate (RC8). The observation point also keeps routing
    # filters on ``error`` above the gate instead of re-deriving it per branch.
    return gated.observe(f"schema_gate_{uuid.uuid4().hex[:8]}",
                         F.count(F.lit(1)).alias("events"), F.count("error").alias("invalid"))


def split_by_schema(topic: DataFrame, json_schema: dict, value_col: str = "value"):
    """(valid messages, rejected messages with ``error``). Two frames over one gate: a job that needs both
    writes ``schema_gate`` once with the error as a route (see ``sinks.publish``)."""
    gated = schema_gate(topic, json_schema, value_col)
    return (gated.filter(F.col("error").isNull()).drop("error"),
            gated.filter(F.col("error").isNotNull()))


def dlq_envelope(rejects: DataFrame, payload_col: str = "value", error_col: str = "error",
                 at=None) -> DataFrame:
    """Rejected messages → dead-letter envelopes
    ``{"error": .., "row": <payload>, "timestamp": ..}`` as one JSON string.
    The payload is embedded as JSON when it parses, else as a string."""
    payload = F.col(payload_col)
    row = F.coalesce(F.try_parse_json(payload), payload.cast("variant"))
    envelope = F.struct(F.col(error_col).alias("error"), row.alias("row"),
                        iso_text(_ingestion_ts(at)).alias("timestamp"))
    value = F.to_json(envelope, {"ignoreNullFields": "false"})
    return rejects.select(F.col(error_col).alias("error"), value.alias("value"))
