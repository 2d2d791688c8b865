"""Column functions that several operators share."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad3(number: Column) -> Column:
    """At least three digits; longer numbers stay whole."""
    return F.format_string("%03d", number)


def remapped(label: Column, mapping: dict[int, int]) -> Column:
    """mapping.get(label, label), once."""
    if not mapping:
        return label
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return F.coalesce(F.try_element_at(table, label), label)


def uniform(seed: Column | str, *slots: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts: 32 bits, the same in any engine that has MD5."""
    text = F.concat_ws("|", F.lit(seed) if isinstance(seed, str) else seed, *slots)
    return hash32(text) / 4294967296.0


def hash32(text: Column) -> Column:
    """The first eight hexadecimal digits of the MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _let(make: dict[str, Column], use) -> Column:
    """use(row) of a struct that is made once; expressions inside a lambda are evaluated at every item."""
    return F.get(F.transform(F.array(F.struct(*(c.alias(k) for k, c in make.items()))), use), F.lit(0))


def softmax(v: Column) -> Column:
    """Of an array of doubles, shifted by its maximum."""
    powers = _let({"v": v, "m": F.array_max(v)}, lambda t: F.transform(t["v"], lambda x: F.exp(x - t["m"])))
    summed = _let({"e": powers}, lambda t: F.struct(t["e"].alias("e"), F.aggregate(t["e"], F.lit(0.0), lambda a, b: a + b).alias("s")))
    return _let({"t": summed}, lambda t: F.transform(t["t"]["e"], lambda x: x / t["t"]["s"]))


def argmax(v: Column) -> Column:
    """The place from 0 of the largest item, the first of equal ones."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def file_name(path: Column) -> Column:
    """What follows the last slash, with slashes at the end left out."""
    return F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def document(value: Column) -> Column:
    """A struct as a JSON text, two spaces a level, null fields and empty maps and lists included.

    Spark's own writer spaces and breaks lines in another way, so the text is
    laid out again; for documents, which are few, not for rows.
    """
    laid_out = F.udf(lambda x: None if x is None else json.dumps(json.loads(x), indent=2), "string", useArrow=True)
    return laid_out(F.to_json(value, {"ignoreNullFields": "false"}))
