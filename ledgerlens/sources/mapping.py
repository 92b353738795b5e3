"""Star schemas mapped onto the billing tables by declaration.

A ``StarMapping`` says for every billing table from which source tables its rows come and by which SQL expression each
column is computed.  ``tables`` checks the whole declaration against the columns of the sources and ``schemas.BRONZE``
before any row is read, raises one ``MappingError`` that names every fault, and returns lazy plans: the scans stay
column-pruned, filters reach them, and Catalyst picks the joins.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas


class MappingError(ValueError):
    """A mapping that does not fit its sources or the billing schemas; ``faults`` holds one line for each fault."""

    def __init__(self, faults: list[str]):
        super().__init__("; ".join(faults))
        self.faults = faults


@dataclass(frozen=True)
class Lookup:
    """Columns of another source table, found where the condition ``on`` holds; ``how`` is ``inner`` or ``left``.

    A key that the looked-up table holds several times gives several rows, a null key finds none, as in any join.
    """

    table: str
    on: str
    how: str = "inner"


@dataclass(frozen=True)
class Rows:
    """Rows of one billing table: those of ``source`` with ``lookups``, of which ``where`` holds, by an expression for every column.

    Columns of equal names are told apart by their table: ``orders.status``.
    """

    source: str
    columns: Mapping[str, str]
    lookups: tuple[Lookup, ...] = ()
    where: str | None = None


@dataclass(frozen=True)
class StarMapping:
    """Billing table -> its rows (the union of all of them).  ``types`` holds columns kept as another type than the schemas'."""

    targets: Mapping[str, tuple[Rows, ...]]
    types: Mapping[str, str] = field(default_factory=dict)

    def sources(self) -> list[str]:
        """Names of the source tables that the mapping reads."""
        parts = [p for rows in self.targets.values() for p in rows]
        return sorted({p.source for p in parts} | {x.table for p in parts for x in p.lookups})

    def schema(self, target: str) -> list[tuple[str, T.DataType]]:
        """Columns of a billing table with the types that the mapping gives them."""
        kept = {c: T.DataType.fromDDL(t) for c, t in self.types.items()}
        return [(f.name, kept.get(f.name, f.dataType)) for f in schemas.BRONZE[target].fields]

    def tables(self, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """The mapped billing tables over the source tables."""
        faults = [f"no billing table {t}" for t in self.targets if t not in schemas.BRONZE]
        faults += [f"no rows for {t}" for t in schemas.BRONZE if not self.targets.get(t)]
        known = {f.name for s in schemas.BRONZE.values() for f in s.fields}
        faults += [f"types: no billing table has a column {c}" for c in self.types if c not in known]
        out = {}
        for target in (t for t in schemas.BRONZE if t in self.targets):
            parts = [self._rows(target, i, rows, sources, faults) for i, rows in enumerate(self.targets[target])]
            if parts and all(p is not None for p in parts):
                out[target] = reduce(lambda a, b: a.unionByName(b), parts)
        if faults:
            raise MappingError(faults)
        return out

    def _rows(self, target: str, at: int, rows: Rows, sources: Mapping[str, DataFrame], faults: list[str]) -> DataFrame | None:
        """One part of a target, or None with its faults noted."""
        place, before = f"{target}[{at}]", len(faults)
        wanted = self.schema(target)
        names = [c for c, _ in wanted]
        faults += [f"{place}: no expression for {c}" for c in names if c not in rows.columns]
        faults += [f"{place}: {target} has no column {c}" for c in rows.columns if c not in names]
        absent = [t for t in (rows.source, *(x.table for x in rows.lookups)) if t not in sources]
        faults += [f"{place}: no source table {t}" for t in absent]
        faults += [f"{place}: a lookup is inner or left, not {x.how}" for x in rows.lookups if x.how not in ("inner", "left")]
        if len(faults) > before:
            return None
        try:
            step = "lookup"
            df = sources[rows.source].alias(rows.source)
            for x in rows.lookups:
                step = f"lookup of {x.table}"
                df = df.join(sources[x.table].alias(x.table), F.expr(x.on), x.how)
            step = "where"
            df = df if rows.where is None else df.filter(F.expr(rows.where))
        except (AnalysisException, ParseException) as e:
            faults.append(f"{place}: {step}: {_line(e)}")
            return None
        try:
            found = df.select([F.expr(rows.columns[c]).alias(c) for c in names])
        except (AnalysisException, ParseException):  # column by column, to name all that fail
            for c in names:
                try:
                    df.select(F.expr(rows.columns[c]).alias(c))
                except (AnalysisException, ParseException) as e:
                    faults.append(f"{place}.{c}: {_line(e)}")
            if len(faults) == before:
                faults.append(f"{place}: its expressions cannot stand in one row")
            return None
        for (c, wish), f in zip(wanted, found.schema.fields, strict=True):
            if not _fits(f.dataType, wish):
                faults.append(f"{place}.{c}: {f.dataType.simpleString()} is not kept whole as {wish.simpleString()}; say in the expression how to turn it")
        if len(faults) > before:
            return None
        return found.select([F.col(c).cast(wish).alias(c) for c, wish in wanted])


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of the one type is a value of the other, so that no cast rounds, cuts or nulls anything."""
    if isinstance(have, T.NullType) or have == want:
        return True
    if isinstance(want, T.StringType):
        return isinstance(have, (T.StringType, *_WHOLE))
    if type(have) in _WHOLE and type(want) in _WHOLE:
        return _WHOLE[type(have)] <= _WHOLE[type(want)]
    if isinstance(want, T.DecimalType):
        if type(have) in _WHOLE:
            return _WHOLE[type(have)] <= want.precision - want.scale
        return isinstance(have, T.DecimalType) and have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    return False


def _line(e: Exception) -> str:
    return str(e).strip().splitlines()[0]
