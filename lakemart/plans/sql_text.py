"""Query text over interchangeable tables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from importlib.resources import files
from importlib.resources.abc import Traversable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lakemart.plans.defaults import DEFAULTS

#: A literal or quoted name, which stays as it is, or a table's name in braces.
_PARTS = re.compile(
    r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|\{\{\s*(\w+)\s*\}\}|\{(\w+)\}""", re.DOTALL
)


class QueryText(str):
    """Query text with values for its parameters."""

    params: Mapping[str, object] = {}


def run_sql(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame],
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run SQL in which ``{table}`` or ``{{table}}`` names a source.

    Sources are bound as DataFrames and ``:name`` parameters as typed literals,
    so no value is ever pasted into the text. Only tables in use are opened.
    Braces inside a literal, or around anything but a name, are left as they are.
    ``params`` win over those that the text brings along.
    """
    used: dict[str, DataFrame] = {}

    def place(found: re.Match) -> str:
        name = found[1] or found[2]
        if name is None:
            return _plain(found[0])
        used.setdefault(name, tables[name])
        return "{" + name + "}"

    parts, at = [], 0
    for found in _PARTS.finditer(text):
        parts += [_plain(text[at : found.start()]), place(found)]
        at = found.end()
    parts.append(_plain(text[at:]))
    values = {**getattr(text, "params", {}), **(params or {})}
    # without tables nothing is substituted, so braces need no doubling
    query = "".join(parts) if used else str(text)
    return spark.sql(query, args=values, **used)


def _plain(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def load_queries(folder: str | Path | Traversable) -> dict[str, str]:
    """The ``*.sql`` files of a folder as name -> text, sorted by name."""
    if isinstance(folder, str):
        folder = Path(folder)
    texts = {
        file.name.removesuffix(".sql"): file.read_text(encoding="utf-8").strip()
        for file in folder.iterdir()
        if file.name.endswith(".sql")
    }
    return dict(sorted(texts.items()))


def packaged_queries() -> dict[str, str]:
    """The query set that comes with this package, in SQL form, ready to run."""
    queries: dict[str, str] = {}
    for name, text in load_queries(files("lakemart.plans") / "sql").items():
        queries[name] = query = QueryText(text)
        query.params = {key: value for key, value in DEFAULTS.items() if f":{key}" in text}
    return queries
