"""A registry of named SQL texts and the assembly of a query from the ones it needs."""

from __future__ import annotations

from spellcast.sources.fixtures import BASE_TABLES, VIEWS

_TEXTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    """Register ``sql`` under ``name``; ``needs`` are the registered texts it reads."""
    _TEXTS[name] = (sql, needs)


for _name, _sql in VIEWS.items():
    cte(_name, _sql.format(**{t: t for t in BASE_TABLES[_name]}))


def query(final: str, *needs: str) -> str:
    """``final`` preceded by every text it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dep in _TEXTS[name][1]:
                visit(dep)
            ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return final
    with_ = ",\n".join(f"{n} AS MATERIALIZED ({_TEXTS[n][0]})" for n in ordered)
    return f"WITH {with_}\n{final}"


def select(name: str, columns: str = "*") -> str:
    """All rows of a registered text."""
    return query(f"SELECT {columns} FROM {name}", name)
