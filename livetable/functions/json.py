"""JSON functions: path extraction, typed parsing, quarantine of bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from livetable import schemas


def _top_level(path: str) -> str | None:
    """``$.name`` -> ``name``; None for deeper paths."""
    if path.startswith("$.") and all(ch not in path[2:] for ch in ".[*"):
        return path[2:]
    return None


def json_fields(df: DataFrame, fields: dict[str, str], col: str = "value",
                types: dict[str, str] | None = None,
                keep: list[str] | None = None) -> DataFrame:
    """Extract JSON fields as text (``get_json_object`` semantics), then cast.

    ``fields`` maps output name -> JSON path.  When every path is a top-level
    ``$.name`` the fields come from one ``json_tuple`` (one parse per row, and
    a generator that stops the optimizer from copying the parse into pushed
    filters); deeper paths use ``get_json_object``.  ``types`` casts with
    ``try_cast``: malformed text becomes null instead of failing the job.
    """
    types = types or {}
    names = list(fields)
    keys = [_top_level(p) for p in fields.values()]
    if all(keys) and len(keys) > 1:
        raw = df.select(*(keep or []), F.json_tuple(F.col(col), *keys).alias(*names))
        src = {n: F.col(n) for n in names}
    else:
        raw = df
        src = {n: F.get_json_object(F.col(col), p) for n, p in fields.items()}
    out = [(src[n].try_cast(types[n]) if n in types else src[n]).alias(n) for n in names]
    return raw.select(*(keep or []), *out)


def parse_json(df: DataFrame, schema: StructType = schemas.ANSWER,
               col: str = "value", keep: list[str] | None = None,
               timestamp_format: str = schemas.ANSWER_TS_FORMAT,
               raw: bool = False) -> DataFrame:
    """One ``from_json`` per row into a declared struct, flattened.

    With ``raw=True`` the source text is kept as ``_raw`` for quarantine.
    """
    opts = {"timestampNTZFormat": timestamp_format,
            "timestampFormat": timestamp_format, "mode": "PERMISSIVE"}
    parsed = F.from_json(F.col(col), schema, opts)
    extra = [F.col(col).alias("_raw")] if raw else []
    # inline(array(struct)) flattens the struct through a generator: the JSON
    # is parsed once per row, and filters on the fields (quarantine) cannot be
    # pushed below it with a copy of the parse.
    return df.select(*(keep or []), *extra, F.inline(F.array(parsed)))


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows with all ``required`` columns set, and the rest."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok)


def to_json_line(*cols: Column | str, name: str = "value") -> Column:
    """A JSON object text from named columns."""
    return F.to_json(F.struct(*cols)).alias(name)
