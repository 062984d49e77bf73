"""Typed fields: specs of raw text columns and the expressions that type them.

Values that do not fit become null, never an error; fields that a frame lacks are skipped.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.operators.transforms import set_columns, to_boolean, to_integer, to_number

ALIASES = {"character": "string", "int": "integer", "number": "numeric"}
KINDS = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "numeric": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "time": T.StringType(),
    "boolean": T.BooleanType(),
}
# fixed values: format letters and the date patterns that stand for them
DIRECTIVES = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%f": "SSSSSS", "%b": "MMM"}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"
    format: str | None = None
    dec: int = 0
    sign: str = ""
    thousands: str = ""
    decimal: str = "."
    width: int | None = None
    tag: str | None = None
    description: str = ""

    def __post_init__(self) -> None:
        object.__setattr__(self, "kind", ALIASES.get(self.kind, self.kind))
        if self.kind not in KINDS:
            raise ValueError(f"unknown type: {self.kind}")

    def typed(self, of: Column | None = None) -> Column:
        """The column of this name, or another one, as its type."""
        raw = (F.col(f"`{self.name}`") if of is None else F.trim(of)).cast("string")
        text = F.trim(raw)
        if self.kind == "integer":
            return to_integer(text)
        if self.kind == "boolean":
            return to_boolean(text)
        if self.kind == "numeric":
            if self.thousands:
                text = F.replace(text, F.lit(self.thousands), F.lit(""))
            if self.decimal != ".":
                text = F.replace(text, F.lit(self.decimal), F.lit("."))
            number = to_number(text)
            if self.dec:
                number = number / F.lit(10.0**self.dec)
            return -number if self.sign == "-" else number
        if self.kind in ("date", "datetime", "time"):
            default = {"date": "%Y-%m-%d", "datetime": "%Y-%m-%d %H:%M:%S", "time": "%H:%M:%S"}[self.kind]
            pattern = re.sub(r"%[A-Za-z]", lambda m: DIRECTIVES[m[0]], self.format or default)
            moment = F.try_to_timestamp(text, F.lit(pattern))
            if self.kind == "date":
                return moment.cast("date")
            return moment.cast("timestamp_ntz") if self.kind == "datetime" else F.date_format(moment, "HH:mm:ss")
        return raw


def schema_of(fields: Sequence[Field]) -> T.StructType:
    """All nullable; width and tag kept as metadata."""
    return T.StructType(
        [T.StructField(f.name, KINDS[f.kind], True, {k: v for k, v in (("width", f.width), ("tag", f.tag)) if v is not None}) for f in fields]
    )


def apply_fields(df: DataFrame, fields: Sequence[Field], set_names: bool = False) -> DataFrame:
    """Types the columns in one select; ``set_names`` renames them by position first."""
    if set_names:
        df = set_columns(df, [f.name for f in fields])
    typed = {f.name: f.typed() for f in fields if f.name in df.columns}
    return df.select(*[typed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def apply_fields_multi(dfs: dict[str, DataFrame], fields: dict[str, Sequence[Field]]) -> dict[str, DataFrame]:
    if not isinstance(dfs, dict):
        raise TypeError("a dictionary of frames is needed")
    return {name: apply_fields(df, fields[name]) if name in fields else df for name, df in dfs.items()}


def select_fields(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`") for f in fields])


def seconds_of_day(time: Column) -> Column:
    """From HH:mm:ss text."""
    part = F.split(time, ":")
    return part[0].try_cast("int") * 3600 + part[1].try_cast("int") * 60 + part[2].try_cast("int")


def field_of(name: str, kind: str, **more) -> Field:
    """From a type text: a name, or a name with settings, such as numeric(dec=2, sign='-')."""
    match = re.fullmatch(r"\s*(\w+)\s*(?:\((.*)\))?\s*", kind)
    if not match:
        raise ValueError(f"not a type: {kind}")
    settings = {}
    for part in re.findall(r"(\w+)\s*=\s*('[^']*'|\"[^\"]*\"|[-+.\w]+)", match[2] or ""):
        settings[part[0]] = ast.literal_eval(part[1])
    return Field(name, match[1], **settings, **more)


def fields_of(rows: Sequence[dict]) -> list[Field]:
    """A record layout kept as a table: name, type and, where they matter, width, tag and description."""
    known = ("width", "tag", "description")
    return [field_of(r["name"], r.get("type") or "string", **{k: r[k] for k in known if r.get(k) is not None}) for r in rows]
