"""Typed columns from JSON text, parsed once per row."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import typed_sql


class JsonField(NamedTuple):
    name: str
    type_name: str
    path: tuple[str, ...]


def json_fields(text: str) -> list[JsonField]:
    """Read a field list: one ``name type [path]`` per line, the path defaulting to the name."""
    fields = []
    for line in text.strip().splitlines():
        words = line.split()
        if not words:
            continue
        path = words[2] if len(words) > 2 else words[0]
        fields.append(JsonField(words[0], words[1], tuple(path.split("."))))
    return fields


def _text_schema(paths: Iterable[tuple[str, ...]]) -> T.StructType:
    """A schema whose leaves are all text: bad values then cost one field, never the whole row."""
    children: dict[str, list[tuple[str, ...]]] = {}
    for path in paths:
        children.setdefault(path[0], []).append(path[1:])
    schema = T.StructType()
    for name, rests in children.items():
        deeper = [rest for rest in rests if rest]
        schema.add(name, _text_schema(deeper) if deeper and () not in rests else T.StringType())
    return schema


def extract_json(
    df: DataFrame,
    fields: list[JsonField],
    source: str = "json_str",
    carry: Iterable[str] = (),
) -> DataFrame:
    """Select ``fields`` out of the JSON text in ``source`` plus the ``carry`` columns.

    The text is parsed by one ``from_json`` with a schema holding just the wanted paths. It goes
    through ``inline`` so that a later filter on an extracted column stays above the parse;
    a plain projection would let the optimizer push the filter below and parse every row twice.
    A sub-object wanted both as text and by its inner paths is kept as text by that parse, and
    only that text is parsed again for the inner paths.
    """
    paths = {field.path for field in fields}
    both = {p[0] for p in paths if len(p) == 1} & {p[0] for p in paths if len(p) > 1}
    doc = F.from_json(F.col(source), _text_schema(sorted(paths)))
    parsed = df.select(*carry, F.inline(F.array(F.struct(doc.alias("doc")))))
    for name in sorted(both):
        inner = _text_schema(sorted(p[1:] for p in paths if len(p) > 1 and p[0] == name))
        parsed = parsed.withColumn(f"doc_{name}", F.from_json(F.col(f"doc.{name}"), inner))

    def value(field: JsonField) -> str:
        steps = list(field.path)
        if len(steps) > 1 and steps[0] in both:
            steps[0] = f"doc_{steps[0]}"
        else:
            steps.insert(0, "doc")
        text = ".".join(f"`{step}`" for step in steps)
        return f"{typed_sql(text, field.type_name)} AS `{field.name}`"

    return parsed.selectExpr(*carry, *(value(field) for field in fields))
