"""Registration of queries next to their SQL twins."""

from __future__ import annotations


class Plans:
    """Queries of one module; `query(name, sql)` registers a function."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def register(f):
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return register

    def integers(self, columns: dict[str, list[str]]) -> None:
        """The SQL twins give these columns in 64 bits; cast them to what the plans give."""
        for name, names in columns.items():
            casts = ", ".join(f"{c}::INT AS {c}" for c in names)
            self.sql[name] = f"SELECT * REPLACE ({casts}) FROM ({self.sql[name]}) AS twin"
