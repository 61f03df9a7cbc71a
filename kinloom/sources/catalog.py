"""Sources found by name in a table catalogue.

Tables belong to a dataset theme by a keyword of their name; of the yearly themes
each table's year is cut from its name.  A table is checked against its declared
columns when it is loaded, and ``drift`` reports, for all yearly tables, which
columns are as declared, missing, of another type or not expected, and how many
rows have a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.reshape import union_all
from . import schemas as S
from .io import discover_tables, tables_by_year, theme_tables

# Themes that come as one table a year, and keywords of the tables that come alone.
YEARLY_THEMES: dict[str, Callable[[int], StructType]] = {
    "hospital": lambda year: S.episodes_table(),
    "census": S.census_table,
    "absence": S.absence_table,
}
SINGLE_TABLES = {
    "civil_births": "civil_births", "civil_deaths": "civil_deaths", "birth_notifications": "birth_notifications",
    "bridging": "bridging", "mother_baby_links": "mb_links", "ks1": "ks1", "ks2": "ks2", "ks4_a": "ks4_a",
    "ks4_b": "ks4_b", "ks5_a": "ks5_a", "ks5_b": "ks5_b",
}


@dataclass(frozen=True)
class Catalog:
    """Table names, and a reader of a table by its name."""

    names: tuple[str, ...]
    read: Callable[[str], DataFrame]

    @classmethod
    def of_session(cls, spark: SparkSession, database: str | None = None) -> Catalog:
        """The tables and views that the session's catalogue lists."""
        listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
        prefix = f"{database}." if database else ""
        return cls(tuple(t.name for t in listed), lambda name: spark.table(prefix + name))

    def yearly(self, theme: str) -> dict[int, str]:
        """A theme's table names by year."""
        return tables_by_year(theme_tables(self.names)[theme])

    def single(self, source: str) -> str:
        found = discover_tables(self.names, SINGLE_TABLES[source])
        if len(found) != 1:
            raise ValueError(f"{source}: one table expected, found {found}")
        return found[0]

    def load(self, name: str, declared: StructType) -> DataFrame:
        """The declared columns of a table; others are left out, missing ones are an error."""
        df = self.read(name)
        if wrong := S.missing(df.schema, declared):
            raise ValueError(f"{name} is not as declared: {', '.join(wrong)}")
        return df.select(*declared.names)


def catalog_sources(catalog: Catalog):
    """The cohort build's sources, found by name."""
    from ..plans.cohort_pipeline import Sources

    def loaders(theme: str) -> dict[int, Callable[[], DataFrame]]:
        declared = YEARLY_THEMES[theme]
        return {y: (lambda n=n, y=y: catalog.load(n, declared(y))) for y, n in sorted(catalog.yearly(theme).items())}

    single = {s: (lambda n=catalog.single(s), s=s: catalog.load(n, S.SOURCES[s])) for s in SINGLE_TABLES}
    hospital = loaders("hospital")
    return Sources(episodes=lambda: {y: f() for y, f in hospital.items()}, census=loaders("census"),
                   absence=loaders("absence"), **single)


def drift(catalog: Catalog, themes: Iterable[str] = tuple(YEARLY_THEMES)) -> DataFrame:
    """``theme, year, table_name, column_name, status, n_rows, n_filled`` of all yearly tables.

    ``status``: ok, type (held in another type than declared), missing, unexpected.
    Each table is read once, by one aggregate."""
    parts = []
    for theme in themes:
        for year, name in sorted(catalog.yearly(theme).items()):
            df, declared = catalog.read(name), YEARLY_THEMES[theme](year)
            have = {f.name: f.dataType for f in df.schema.fields}
            expected = {f.name: f.dataType for f in declared.fields}
            status = {c: "ok" if have.get(c) == t else "type" if c in have else "missing" for c, t in expected.items()}
            status |= {c: "unexpected" for c in have if c not in expected}
            at = {c: f"_{i}" for i, c in enumerate(have)}
            one = df.selectExpr("count(1) AS n_rows", *[f"count(`{c}`) AS {n}" for c, n in at.items()])
            cells = ", ".join(f"struct('{c}' AS column_name, '{s}' AS status, {at.get(c, 'cast(NULL AS bigint)')} AS n_filled)"
                              for c, s in status.items())
            parts.append(one.selectExpr(f"'{theme}' AS theme", f"{year} AS year", f"'{name}' AS table_name", "n_rows",
                                        f"inline(array({cells}))"))
    return union_all(parts).select("theme", "year", "table_name", "column_name", "status", "n_rows", "n_filled")
