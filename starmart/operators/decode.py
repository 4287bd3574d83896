"""Topic rows to typed event rows, with unreadable messages kept aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import has_number_text, lenient

CORRUPT = "_corrupt_record"
MISFIT = "_misfit"
REASON = "_reason"


def _end_mark(text: Column) -> Column:
    """A text that the JSON put behind ``text`` holds to show that it was reached.

    Only ``]`` right behind an object could close the brackets put around the text and hide what follows, an end made up in the
    text included. Where there is one the mark is as long as the text, so that it can't be found inside.
    """
    return F.when(text.rlike(r"\}\s*\]"), F.repeat(F.lit("x"), F.length(text))).otherwise("")


def decode_messages(
    raw: DataFrame, schema: T.StructType, value: str = "value", keep: list[str] | None = None, misfits: bool = False
) -> DataFrame:
    """Expand the JSON in ``value`` to the typed columns of ``schema``.

    Fields are read as text first and then parsed leniently, so ``1``, ``1.0`` and ``"1"`` all
    decode to the integer 1. Text that is not one JSON object is kept in ``_corrupt_record``
    (NULL for a good row); a second object or other text behind the first makes it unreadable.
    ``keep`` names columns of ``raw`` to carry along. With ``misfits``, ``_misfit`` names the
    fields whose text was there but is no value of their type (NaN and null apart), NULL if none.
    """
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    text = F.col(value).cast("string")
    end = "__end"
    while end in schema.names:
        end = f"_{end}"
    # in brackets and with an end mark, whatever stands behind the first object breaks the array, makes it longer or hides the mark
    item = T.StructType([*as_text, T.StructField(end, T.StringType())])
    bracketed = F.concat(F.lit("["), text, F.lit(f',{{"{end}":"'), _end_mark(text), F.lit('"}]'))
    # a text that does not begin and end like an object is none; the parser would find that out by exceptions, message by message
    bare = F.btrim(text, F.lit(" \t\r\n"))
    items = F.from_json(F.when(bare.startswith("{") & bare.endswith("}"), bracketed), T.ArrayType(item))
    raw = raw.select(*(keep or []), text.alias("__text"), items.alias("__items"))
    text = F.col("__text")
    # inline() makes the parsed fields columns of their own, so that a later filter on one of
    # them works on the parsed text and does not parse the message a second time
    one = (F.size("__items") == 2) & F.get("__items", F.lit(0)).isNotNull() & (F.get("__items", F.lit(1))[end] == _end_mark(text))
    whole = F.struct(F.coalesce(one, F.lit(False)).alias("__one"), *[F.get("__items", F.lit(0))[n].alias(f"__{n}") for n in as_text.names])
    parsed = raw.select(*(keep or []), "__text", F.inline(F.array(whole)))
    unreadable = F.when(~F.col("__one"), F.coalesce(F.col("__text"), F.lit("")))
    values = {f.name: F.when(F.col("__one"), lenient(F.col(f"__{f.name}"), f.dataType)) for f in schema}
    if misfits:
        # values are parsed once, for themselves and for what is said of them
        own = "__value_"
        while any(c.lower().startswith(own) for c in [*parsed.columns, *(keep or [])]):
            own = f"_{own}"
        parsed = parsed.select("*", *[v.alias(f"{own}{n}") for n, v in values.items()])
        values = {n: F.col(f"{own}{n}") for n in values}
    columns = [value.alias(name) for name, value in values.items()]
    if misfits:
        lost = [F.when(v.isNull() & F.col("__one") & has_number_text(F.col(f"__{n}")), F.lit(n)) for n, v in values.items()]
        columns.append(F.nullif(F.concat_ws(",", *lost), F.lit("")).alias(MISFIT))
    return parsed.select(*(keep or []), *columns, unreadable.alias(CORRUPT))


def with_reason(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add ``_reason``: the first failed rule of a row, NULL for a good row. A rule states what must hold.

    An unreadable message comes before a field that does not fit, and both before the rules.
    """
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable")) if CORRUPT in df.columns else None
    if MISFIT in df.columns:
        told = F.concat(F.lit("misfit:"), F.col(MISFIT))
        reason = F.when(F.col(MISFIT).isNotNull(), told) if reason is None else reason.when(F.col(MISFIT).isNotNull(), told)
    for name, holds in (rules or {}).items():
        broken = ~F.coalesce(holds, F.lit(False))
        reason = F.when(broken, F.lit(name)) if reason is None else reason.when(broken, F.lit(name))
    return df.withColumn(REASON, F.lit(None).cast("string") if reason is None else reason)


def split_quarantine(df: DataFrame, rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their ``_reason``). Both read ``df``: pass a staged frame if it is costly."""
    marked = with_reason(df, rules)
    good = marked.filter(F.col(REASON).isNull()).drop(REASON, CORRUPT, MISFIT)
    return good, marked.filter(F.col(REASON).isNotNull())
