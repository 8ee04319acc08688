"""Dirty JSON: lenient parsing, repair, and checks of model-made classifications."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def light_repair(raw: Column) -> Column:
    """Control characters dropped, invalid escapes doubled, trailing commas removed."""
    x = F.regexp_replace(raw, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    x = F.regexp_replace(x, r'\\(?!["\\/bfnrtu])', r"\\\\\\\\")
    return F.regexp_replace(x, r",\s*([\]}])", "$1")


_NEXT = re.compile(r"\}\s*,?\s*(?=\{)")


def _object_end(raw: str, at: int) -> int:
    """The place behind the object that begins at ``at``, by its brackets outside of strings; -1 if they don't close
    before something that ends no member of a list."""
    depth, quoted, i = 0, False, at
    while i < len(raw):
        c = raw[i]
        if quoted:
            if c == "\\":
                i += 1
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            if not depth:
                rest = raw[i + 1 :].lstrip()[:1]
                return i + 1 if rest in ("", ",", "]", "{") else -1
        i += 1
    return -1


def _whole_objects(raw: str | None) -> str | None:
    """The objects of a broken array that are complete, as an array.

    An object that can't be read is passed over up to its own end, found by depth and strings; where it
    has none, the scan takes up again behind the next place where one object ends and another begins."""
    if raw is None:
        return None
    decoder, at, found = json.JSONDecoder(strict=False), raw.find("{"), []
    while at >= 0:
        try:
            value, end = decoder.raw_decode(raw, at)
            found.append(value)
        except ValueError:
            end = _object_end(raw, at)
            if end < 0:
                met = _NEXT.search(raw, at + 1)
                end = met.end() if met else len(raw)
        at = raw.find("{", end)
    return json.dumps(found) if found else None


@F.pandas_udf(StringType())
def whole_objects(raw: pd.Series) -> pd.Series:
    return raw.map(_whole_objects)


def repair(raw: Column) -> Column:
    """A parsable text: the raw one, the lightly repaired one, or its complete objects; else null."""
    light = light_repair(raw)
    return F.when(F.try_parse_json(raw).isNotNull(), raw).when(F.try_parse_json(light).isNotNull(), light).otherwise(whole_objects(light))


def as_list(value: Column) -> Column:
    """A variant that holds a string or a list of strings, as an array."""
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.array(value.cast("string"))).when(kind.startswith("ARRAY"), value.cast("array<string>"))


def first_valid(values: Column, allowed: list[str], fallback: str) -> Column:
    """The first allowed value, blanks and a trailing period aside; else the fallback."""
    clean = F.transform(values, lambda v: F.regexp_replace(F.trim(v), r"\.$", ""))
    canonical = F.create_map(*[x for a in allowed for x in (F.lit(a.lower()), F.lit(a))])
    hits = F.filter(F.transform(clean, lambda v: F.element_at(canonical, F.lower(v))), lambda v: v.isNotNull())
    return F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit(fallback))


def is_empty_list(values: Column) -> Column:
    return F.coalesce(F.size(F.filter(values, lambda v: v != "")), F.lit(0)) <= 0


def transient(message: Column, patterns: list[str]) -> Column:
    return F.lower(message).rlike("|".join(re.escape(p.lower()) for p in patterns))
