"""DuckDB statements the registered queries are compared with."""

from __future__ import annotations

import re

from .base import TABLES
from .statements import STATEMENTS


def _needed(sql: str) -> list[str]:
    wanted: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name, body in TABLES.items():
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                pending.append(body)
    return [n for n in TABLES if n in wanted]


def statement(name: str) -> str:
    """The statement of one query with the common tables it refers to in front."""
    body = STATEMENTS[name].strip()
    ctes = [f"{n} AS ({TABLES[n].strip()})" for n in _needed(body)]
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        body = ", " + body[5:]
    else:
        body = "\n" + body
    return "WITH " + ",\n".join(ctes) + body


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in STATEMENTS}
