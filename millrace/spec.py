"""Declarations: what a target table is made of."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

Hook = Callable[[DataFrame], Column]
Reader = Callable[[str], DataFrame | None]


@dataclass(frozen=True)
class Rule:
    """A SQL condition on target columns; rows where it is false are quarantined under the rule's name.

    With `column` the rule holds only where the target has that column.
    """

    name: str
    test: str
    column: str | None = None


@dataclass(frozen=True)
class Latest:
    """Keep one source row per key: the one that is newest by the listed columns, first column first."""

    key: tuple[str, ...]
    newest_by: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """A unique key of a target. A part may be a SQL expression; rows failing `where` are not held to it."""

    parts: tuple[str, ...]
    where: str | None = None


@dataclass(frozen=True)
class Reference:
    """A legacy reference to a target loaded earlier.

    The value of `column` is looked up in column `key` of `target` and replaced by `value` (only checked when
    `value` is empty). `names` compares trimmed upper-case text. Without a match the column is null, or the row
    is an orphan if `required`. `into` writes the result elsewhere, `also` to a second place. `build` replaces
    the plain lookup by one of its own: a frame (_key, _value), given a reader of targets.
    """

    column: str
    target: str
    key: str = ""
    value: str = ""
    names: bool = False
    required: bool = False
    into: str = ""
    also: str = ""
    build: Callable[[Reader, list[str]], DataFrame | None] | None = None


@dataclass(frozen=True)
class Surrogate:
    """A generated id, kept over re-runs by the natural key."""

    column: str
    natural: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    """One source table feeding one target table.

    Columns need not be listed. Every source column becomes a target column under its lower-case name
    (`split_words` also splits at capitals), cleaned by the kind of its type. `rename` moves a column, `mirror`
    adds copies under further names, `kind` overrides the cleaning by target column, `derive` adds computed
    columns, `drop` leaves source columns out. `expect` names source columns that hooks use. `required` columns
    must be set where the target has them. `years` (date column, first, last year) keeps the target in yearly parts.
    """

    source: str
    target: str
    order: int = 10
    database: str = "main"
    sort: tuple[str, ...] = ()
    split_words: bool = False
    rename: dict[str, str] = field(default_factory=dict)
    mirror: dict[str, tuple[str, ...]] = field(default_factory=dict)
    kind: dict[str, str] = field(default_factory=dict)
    derive: dict[str, Hook] = field(default_factory=dict)
    expect: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    static: dict[str, str] = field(default_factory=dict)
    where: Hook | None = None
    skip: Hook | None = None
    validate: str | None = None
    latest: Latest | None = None
    references: tuple[Reference, ...] = ()
    without: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    required: tuple[str, ...] = ()
    unique: tuple[Unique, ...] = ()
    surrogate: Surrogate | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None
    staged: bool = False
    years: tuple[str, int, int] | None = None

    @property
    def stored_as(self) -> str:
        """Where rows are kept: staged targets are folded into their target by a derivation."""
        return f"{self.target}__staged" if self.staged else self.target

    def source_columns(self) -> tuple[str, ...]:
        """Source columns the spec names itself; a farm that lacks one gets nulls and a note in the log."""
        named = [*self.rename, *self.mirror, *self.expect, *self.sort]
        if self.latest:
            named += [*self.latest.key, *self.latest.newest_by]
        return tuple(dict.fromkeys(named))


def target_name(source_column: str, split_words: bool = False) -> str:
    """Default target name of a source column: lower case, signs and blanks to underscores."""
    text = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", source_column) if split_words else source_column
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")


def select_specs(specs: Iterable[TableSpec], tables: Iterable[str] | None) -> list[TableSpec]:
    """The specs of the named source tables (letter case aside), in load order; all when nothing is named."""
    wanted = None if tables is None else {t.lower() for t in tables}
    chosen = [s for s in specs if wanted is None or s.source.lower() in wanted]
    return sorted(chosen, key=lambda s: s.order)
