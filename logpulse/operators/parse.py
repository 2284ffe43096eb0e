"""Broker rows to parsed events, split into good and bad."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.schema import EVENT_FIELDS, EVENT_PAYLOAD, only

# How a row that is not an event is labelled.
BAD_ROW_TYPE = "json_parse_failed"
BAD_ROW_MESSAGE = "value is not valid JSON"

MODES = ("strict", "permissive")


def decode(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Binary key and value to text; the broker's timestamp becomes the receive time.

    The text is generator output (see ``json_column``): a filter on it, or on what is made of
    it, would else be copied down to the source together with all that the value is computed
    from, and run over rows that were dropped in between.
    """
    return raw.selectExpr(
        "explode(array(CAST(value AS STRING))) AS raw_json",
        "CAST(key AS STRING) AS kafka_key",
        "topic",
        "partition",
        "offset",
        "timestamp AS kafka_received_at",
        *keep,
    )


def json_column(text: str, ddl: str) -> Column:
    """Parse ``text`` as generator output.

    Read as a plain column, the parsed struct would be copied into every filter pushed below
    the projection, and the text parsed once per copy. Output of a generator is computed once
    per row and stays where it is.
    """
    return F.explode(F.array(F.from_json(text, ddl)))


#: A row is an event if it has this; both modes leave the payload of other rows NULL.
IS_EVENT = "json IS NOT NULL"


def strict_json(df: DataFrame, text: str, ddl: str) -> DataFrame:
    """Adds ``json``, the payload of a text that is one well-formed JSON object, else NULL.

    The text is parsed once, into a variant: verdict and fields both come from that value, so the
    fields a query asks for cannot decide whether a row counts. Names within an object must be
    distinct and nothing may follow the object: as the content of an array it has to be the only
    element. What a variant cannot hold is no event either: nesting beyond 1,000 levels, and
    texts larger than a variant may be.

    A whole number is read only where the text has one: neither ``"12"`` nor ``1.5`` is 12. Text
    fields take any scalar in its canonical spelling, and objects as compact JSON.

    Every step is generator output, as in ``json_column``: computed once per row, and not copied
    into filters pushed below it.
    """
    kinds = dict(part.split() for part in ddl.split(","))
    loose = ", ".join(f"{n}: {k if k == 'STRING' else 'VARIANT'}" for n, k in kinds.items())
    fields = ", ".join(f"'{n}', {_field(n, k)}" for n, k in kinds.items())
    steps = {
        "_doc": f"try_parse_json(concat('[', {text}, ']'))",
        "_read": f"""if(try_variant_get(_doc, '$[1]', 'variant') IS NULL,
            try_variant_get(_doc, '$[0]', 'struct<{loose}>'), NULL)""",
        "json": f"if(_read IS NULL, NULL, named_struct({fields}))",
    }
    for name, rule in steps.items():
        df = df.select("*", F.expr(f"explode(array({rule}))").alias(name))
    return df.drop("_doc", "_read")


def _field(name: str, kind: str) -> str:
    value = f"_read.{name}"
    if kind == "STRING":
        return value
    whole = f"schema_of_variant({value}) = 'BIGINT'"
    return f"if({whole}, try_variant_get({value}, '$', '{kind}'), NULL)"


def parse_events(
    raw: DataFrame,
    *,
    mode: str = "strict",
    received_at: Column | None = None,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Broker rows with a ``json`` struct, NULL where the row is no event, and the receive time.

    ``permissive`` only rejects rows without text: its parser stops early and takes single
    quotes. ``strict`` (``strict_json``) rejects everything that is not one well-formed object.
    ``fields`` restricts parsing to the payload fields a query needs, and may be empty where
    only the verdict is; ``keep`` carries extra input columns through.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    wanted = EVENT_FIELDS if fields is None else [*fields] or EVENT_FIELDS[:1]
    ddl, rows = only(EVENT_PAYLOAD, wanted), decode(raw, keep)
    if mode == "strict":
        parsed = strict_json(rows, "raw_json", ddl)
    else:
        parsed = rows.select("*", json_column("raw_json", ddl).alias("json"))
    now = F.current_timestamp() if received_at is None else received_at
    return parsed.withColumn("spark_received_at", now)


def good_events(parsed: DataFrame) -> DataFrame:
    """Only the events; no frame of bad rows is built."""
    return parsed.where(IS_EVENT)


def split_events(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: every row is in exactly one; bad rows say why."""
    bad = parsed.where(f"NOT ({IS_EVENT})").withColumns(
        {"error_type": F.lit(BAD_ROW_TYPE), "error_message": F.lit(BAD_ROW_MESSAGE)}
    )
    return good_events(parsed), bad
