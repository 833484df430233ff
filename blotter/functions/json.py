"""Reading fields and lists out of JSON text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keeps from_json as lenient and as strict as get_json_object on the same text.
_PARSE_OPTIONS = {
    "allowUnquotedControlChars": "true",
    "allowNonNumericNumbers": "false",
}


def _nested(paths: Iterable[list[str]]) -> T.StructType:
    children: dict[str, list[list[str]]] = {}
    for head, *rest in paths:
        children.setdefault(head, [])
        if rest:
            children[head].append(rest)
    return T.StructType(
        [
            T.StructField(name, _nested(rest) if rest else T.StringType())
            for name, rest in children.items()
        ]
    )


def field_struct(text: Column, paths: Iterable[str]) -> Column:
    """Parse JSON text once into a struct holding only the dotted ``paths``."""
    return F.from_json(text, _nested([p.split(".") for p in paths]), _PARSE_OPTIONS)


def quoted_list(text: Column) -> Column:
    """A JSON array as a list of strings; any other text as a one-element list."""
    parsed = F.from_json(text, "array<string>", _PARSE_OPTIONS)
    return F.when(text.isNotNull(), F.coalesce(parsed, F.array(text)))
