"""A small metric layer: declared tables, measures and relationships.

Declarations hold Spark SQL expressions. A query names measures and dimensions,
and gets an aggregated DataFrame with every mandatory filter applied.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import DEFAULT_ITEM_CATEGORY
from tidemark.operators.quality import unique_check

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Field:
    """A dimension, measure, time dimension or named filter."""

    name: str
    expr: str
    description: str = ""


@dataclass(frozen=True)
class Product:
    """Sum of a base measure times a measure of a related table (count x price)."""

    name: str
    measure: str
    factor: str


@dataclass(frozen=True)
class LogicalTable:
    name: str
    dimensions: tuple[Field, ...] = ()
    measures: tuple[Field, ...] = ()
    time_dimensions: tuple[Field, ...] = ()
    filters: tuple[Field, ...] = ()

    def dimension(self, name: str) -> Field | None:
        return next((d for d in self.dimensions + self.time_dimensions if d.name == name), None)

    def measure(self, name: str) -> Field | None:
        return next((m for m in self.measures if m.name == name), None)


@dataclass(frozen=True)
class Relationship:
    """Many-to-one left join on a composite key, as (left, right) column pairs."""

    name: str
    left_table: str
    right_table: str
    columns: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class SemanticModel:
    name: str
    tables: tuple[LogicalTable, ...]
    relationships: tuple[Relationship, ...] = field(default_factory=tuple)

    def table(self, name: str) -> LogicalTable:
        for table in self.tables:
            if table.name == name:
                return table
        raise ValueError(f"model {self.name}: unknown table {name!r}")

    def links_from(self, left: str) -> tuple[Relationship, ...]:
        return tuple(r for r in self.relationships if r.left_table == left)

    def paths(self, start: str) -> dict[str, list[tuple[Relationship, ...]]]:
        """Every table that many-to-one links lead to from ``start``, with all ways there; no way meets a table twice."""
        found: dict[str, list[tuple[Relationship, ...]]] = {}
        ways: list[tuple[Relationship, ...]] = [()]
        while ways:
            way = ways.pop()
            met = {start, *(r.right_table for r in way)}
            for link in self.links_from(way[-1].right_table if way else start):
                if link.right_table not in met:
                    found.setdefault(link.right_table, []).append((*way, link))
                    ways.append((*way, link))
        return found

    def path(self, start: str, end: str, via: Collection[str] = ()) -> tuple[Relationship, ...]:
        """The one way from ``start`` to ``end``; of several, the one that uses most of the links named in ``via``."""
        ways = self.paths(start).get(end, [])
        if not ways:
            if start in self.paths(end):
                raise ValueError(f"model {self.name}: {end} has many rows for one of {start}; its values would be counted repeatedly")
            raise ValueError(f"model {self.name}: no relationship leads from {start} to {end}")
        used = [sum(r.name in via for r in way) for way in ways]
        best = [way for way, n in zip(ways, used, strict=True) if n == max(used)]
        if len(best) > 1:
            names = " or ".join(sorted("/".join(r.name for r in way) for way in best))
            raise ValueError(f"model {self.name}: several ways lead from {start} to {end} ({names}); name one in via")
        return best[0]


def model_from_spec(spec: Mapping) -> SemanticModel:
    """Build a model from the parsed YAML form (tables, relationships)."""

    def fields(table: Mapping, section: str) -> tuple[Field, ...]:
        return tuple(Field(f["name"], f["expr"], f.get("description", "")) for f in table.get(section, ()))

    def filters(table: Mapping) -> tuple[Field, ...]:
        marked = [f for f in table.get("facts", ()) if "filter" in f.get("labels", ())]
        return tuple(Field(f["name"], f["expr"], f.get("description", "")) for f in marked)

    tables = tuple(
        LogicalTable(
            t["name"], fields(t, "dimensions"), fields(t, "measures"), fields(t, "time_dimensions"), filters(t)
        )
        for t in spec["tables"]
    )
    links = []
    for r in spec.get("relationships", ()):
        if r.get("relationship_type", "many_to_one") != "many_to_one" or r.get("join_type", "left") != "left":
            raise ValueError(f"relationship {r['name']}: only many_to_one left joins are supported")
        pairs = tuple((c["left_column"], c["right_column"]) for c in r["relationship_columns"])
        links.append(Relationship(r["name"], r["left_table"], r["right_table"], pairs))
    return SemanticModel(spec["name"], tables, tuple(links))


def check_relationship(model: SemanticModel, name: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Many-to-one holds when the right side's key is unique."""
    link = next((r for r in model.relationships if r.name == name), None)
    if link is None:
        raise ValueError(f"model {model.name}: unknown relationship {name!r}")
    return unique_check(frames[link.right_table], [r for _, r in link.columns], link.right_table)


def _at_grain(column: Column, grain: str) -> Column:
    if not grain:
        return column
    return column.cast("date") if grain == "day" else F.trunc(column, grain)


def _one_per_key(related: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The right side of a many-to-one join; a key that occurs twice fails the query that reads it."""
    values = [c for c in related.columns if c not in keys]
    once = related.na.drop(subset=list(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in values]
    )
    twice = F.raise_error(F.lit(f"{name}: a key of the many-to-one relationship occurs more than once"))
    return once.where(F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(F.lit(True))).drop("_n")


@dataclass
class _Node:
    """A table of the query: the columns that are wanted of it, and the tables that it leads to, by link."""

    table: LogicalTable
    columns: dict[str, Column] = field(default_factory=dict)
    next: dict[Relationship, _Node] = field(default_factory=dict)

    def at(self, model: SemanticModel, path: Sequence[Relationship]) -> _Node:
        node = self
        for link in path:
            node = node.next.setdefault(link, _Node(model.table(link.right_table)))
        return node

    def keys(self) -> dict[str, Column]:
        """The columns that lead on, under names of their own."""
        return {f"_{link.name}_{i}": F.col(pair[0]) for link in self.next for i, pair in enumerate(link.columns)}

    def joined(self, rows: DataFrame, frames: Mapping[str, DataFrame]) -> DataFrame:
        """Rows that hold ``keys`` with the wanted columns of all tables behind; each table is joined unique by its key."""
        for link, node in self.next.items():
            right = frames[node.table.name]
            for f in node.table.filters:
                right = right.where(F.expr(f.expr))
            own = {f"_{link.name}_{i}": F.col(pair[1]) for i, pair in enumerate(link.columns)}
            right = right.select(*[c.alias(n) for n, c in {**own, **node.columns, **node.keys()}.items()])
            right = node.joined(_one_per_key(right, list(own), link.name), frames).drop(*node.keys())
            rows = rows.join(right, list(own), "left")
        return rows


def _found(model: SemanticModel, base: str, name: str, kind: str, via: Collection[str]) -> tuple[tuple[Relationship, ...], Field, str]:
    """(way to its table, field, name of the result) of ``name`` or ``table.name``; the base table comes first."""
    owner, _, plain = name.rpartition(".")
    get = lambda table: getattr(model.table(table), kind)(plain)
    if not owner and get(base):
        return (), get(base), plain
    owners = [owner] if owner else [t for t in model.paths(base) if get(t)]
    if not owners:  # a field of a table that cannot be reached has a better message of its own
        owners = [t.name for t in model.tables if get(t.name)][:1]
    if not owners or not get(owners[0]):
        raise ValueError(f"model {model.name}: unknown {kind} {name!r} from {base}")
    if len(owners) > 1:
        raise ValueError(f"model {model.name}: {kind} {name!r} is in {', '.join(sorted(owners))}; name the table")
    return model.path(base, owners[0], via) if owners[0] != base else (), get(owners[0]), name.replace(".", "_")


def metric_query(
    model: SemanticModel,
    frames: Mapping[str, DataFrame],
    base: str,
    measures: Sequence[str | Product],
    dimensions: Sequence[str] = (),
    where: Sequence[str] = (),
    via: Collection[str] = (),
) -> DataFrame:
    """Measures by dimensions over ``base`` and the tables that its relationships lead to, over any number of links.

    A dimension may carry a grain, ``"CREATED_DATE:month"``, and its table, ``"nation.name"`` (in the result:
    ``nation_name``). ``where`` holds SQL conditions on columns of the base table. If several ways lead to a table,
    ``via`` names a relationship of the wanted one. What lies against the direction of a relationship is an error,
    as its values would be counted repeatedly.

    The base rows are summed by dimensions and join keys before the joins. These
    then see one row per group instead of one per item, so a hot or NULL key
    costs a single row, and rows without a match keep a NULL factor.
    """
    top = _Node(model.table(base))
    dims: list[str] = []
    for text in dimensions:
        name, _, grain = text.partition(":")
        if grain and grain not in GRAINS:
            raise ValueError(f"unknown grain {grain!r}; known: {GRAINS}")
        path, found, out = _found(model, base, name, "dimension", via)
        out = f"{out}_{grain}" if grain else out
        top.at(model, path).columns[out] = _at_grain(F.expr(found.expr), grain)
        dims.append(out)

    products = [m for m in measures if isinstance(m, Product)]
    plain = [m for m in measures if not isinstance(m, Product)]
    needed = dict.fromkeys(plain + [p.measure for p in products])
    for name in needed:
        if top.table.measure(name) is None:
            raise ValueError(f"model {model.name}: unknown measure {name!r} on {base}")
    for p in products:
        path, found, _ = _found(model, base, p.factor, "measure", via)
        if not path:
            raise ValueError(f"model {model.name}: unknown related measure {p.factor!r} from {base}")
        top.at(model, path).columns[f"_f_{p.name}"] = F.expr(found.expr)

    rows = frames[base]
    for condition in [f.expr for f in top.table.filters] + list(where):
        rows = rows.where(F.expr(condition))
    grouped = rows.groupBy(*[c.alias(n) for n, c in {**top.columns, **top.keys()}.items()]).agg(
        *[F.sum(F.expr(top.table.measure(n).expr)).alias(f"_m_{n}") for n in needed],
    )
    return top.joined(grouped, frames).groupBy(*dims).agg(
        *[F.sum(f"_m_{n}").alias(n) for n in plain],
        *[F.sum(F.col(f"_m_{p.measure}") * F.col(f"_f_{p.name}")).alias(p.name) for p in products],
    )


def categorize_items(items: DataFrame, seed: DataFrame, default: str = DEFAULT_ITEM_CATEGORY) -> DataFrame:
    """Item names to their category through the seed; unlisted names get the default.

    The seed is unique by ``item_name``. A few names cover all items: adaptive execution
    broadcasts a seed it measures as small and splits the hot names of a larger one.
    """
    named = seed.select("item_name", F.col("category").alias("_category"))
    return items.join(named, "item_name", "left").select(
        *items.columns, F.coalesce("_category", F.lit(default)).alias("subtract_category")
    )
