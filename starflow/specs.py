"""Small declarative descriptions of the tables the operators build."""

from __future__ import annotations

from dataclasses import dataclass, field

ADDITIVE = "additive"
SEMI_ADDITIVE = "semi_additive"
ATOMIC_AGGREGATES = ("sum", "count", "max", "min", "avg")


@dataclass(frozen=True)
class DimSpec:
    """A dimension: business ``key`` plus ``attributes``.

    ``tracked`` attributes open a new version when they change (full history);
    with none, the dimension is overwritten at each load. ``fixed`` attributes
    keep their first value within a version; the others are refreshed in place.
    """

    name: str
    source: str
    key: str
    attributes: tuple[str, ...]
    tracked: tuple[str, ...] = ()
    fixed: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        unknown = {*self.tracked, *self.fixed} - set(self.attributes)
        if unknown:
            raise ValueError(f"{self.name}: not attributes: {sorted(unknown)}")

    @property
    def sk(self) -> str:
        return f"{self.name}_sk"

    @property
    def table(self) -> str:
        return f"dim_{self.name}"

    @property
    def refreshed(self) -> tuple[str, ...]:
        held = {*self.tracked, *self.fixed}
        return tuple(a for a in self.attributes if a not in held)


@dataclass(frozen=True)
class Measure:
    name: str
    additivity: str = ADDITIVE

    def __post_init__(self) -> None:
        if self.additivity not in (ADDITIVE, SEMI_ADDITIVE):
            raise ValueError(f"{self.name}: unknown additivity {self.additivity}")


@dataclass(frozen=True)
class FactSpec:
    """A fact: its grain key, dimension lookups, carried columns and measures."""

    name: str
    table: str
    source: str
    grain: str
    lookups: tuple[tuple[str, str], ...]  # (dimension name, foreign key column)
    carried: tuple[str, ...] = ()
    measures: tuple[Measure, ...] = ()

    @property
    def sk(self) -> str:
        return f"{self.name}_sk"

    @property
    def measure_names(self) -> tuple[str, ...]:
        return tuple(m.name for m in self.measures)

    def measure(self, column: str) -> Measure | None:
        return next((m for m in self.measures if m.name == column), None)


@dataclass(frozen=True)
class Metric:
    """``agg`` of ``column`` of the fact called ``fact``, published as ``name``."""

    name: str
    fact: str
    column: str
    agg: str
    dtype: str

    def __post_init__(self) -> None:
        if self.agg not in ATOMIC_AGGREGATES:
            raise ValueError(f"{self.name}: {self.agg} is not an atomic aggregate")


@dataclass(frozen=True)
class SummarySpec:
    """Atomic metrics of one or more facts at the grain of some dimensions."""

    name: str
    table: str
    grain: tuple[str, ...]
    metrics: tuple[Metric, ...]
    attributes: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def facts(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(m.fact for m in self.metrics))

    def check(self, facts: dict[str, FactSpec]) -> None:
        """Refuse aggregates that a measure's additivity does not allow."""
        for m in self.metrics:
            measure = facts[m.fact].measure(m.column)
            semi = measure is not None and measure.additivity == SEMI_ADDITIVE
            if m.agg == "sum" and semi:
                raise ValueError(f"{m.name}: {m.column} must not be summed")
            if m.agg == "avg" and not semi:
                raise ValueError(f"{m.name}: only semi-additive measures average")
