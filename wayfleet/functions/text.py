"""Text tidying."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

_BLANKS = " \t\n\r\f\x0b"


def title_case(c: Column, every_break: bool = False) -> Column:
    """Capitalise words.

    By default only spaces separate words ("mercedes-benz" -> "Mercedes-benz").
    With ``every_break`` any non-letter does ("Mercedes-Benz"), the way Python's
    ``str.title`` behaves.
    """
    if not every_break:
        return F.initcap(c)
    pieces = F.split(c, r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def tidy(df: DataFrame, *, title: Iterable[str] = (), lower: Iterable[str] = (), trim: bool = False,
         every_break: bool = False) -> DataFrame:
    """Title-case, lower-case and trim in one projection; absent columns are ignored.

    Matching of names ignores case, as the feeds disagree on it. NULL stays NULL.
    """
    titled = {t.lower() for t in title}
    lowered = {t.lower() for t in lower}
    changes: dict[str, Column] = {}
    for field in df.schema.fields:
        if not isinstance(field.dataType, T.StringType):
            continue
        value = F.col(f"`{field.name}`")
        if trim:
            value = F.btrim(value, F.lit(_BLANKS))
        if field.name.lower() in titled:
            value = title_case(value, every_break)
        if field.name.lower() in lowered:
            value = F.lower(value)
        if trim or field.name.lower() in titled | lowered:
            changes[field.name] = value
    return df.withColumns(changes) if changes else df
