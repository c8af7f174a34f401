"""Driver-side orchestration: stages, variants, coefficient sources, scenarios."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import zip_longest

from pyspark.sql import DataFrame

from isoreach.sources.catalog import Catalog, CatalogError

AREA = "${area}"


class PlanError(ValueError):
    pass


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[..., object]
    variants: tuple[str, ...] = ()

    def resolved(self, area: str | None) -> tuple[str, ...]:
        """Variants with the area put in; a placeholder without an area is an error."""
        if area is None and any(AREA in v for v in self.variants):
            raise PlanError(f"stage {self.name} needs an area")
        return self.variants if area is None else tuple(v.replace(AREA, area) for v in self.variants)


@dataclass
class Plan:
    name: str
    stages: list[Stage] = field(default_factory=list)

    def __post_init__(self) -> None:
        names = [s.name for s in self.stages]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise PlanError(f"stage names occur twice: {sorted(twice)}")

    def select(self, start_from: str | None = None, only: str | None = None, skip: tuple[str, ...] = ()) -> list[Stage]:
        if only and start_from:
            raise PlanError("only and start_from exclude each other")
        names = [s.name for s in self.stages]
        for n in (only, start_from, *skip):
            if n is not None and n not in names:
                raise PlanError(f"unknown stage {n!r}")
        chosen = [s for s in self.stages if s.name == only] if only else self.stages[names.index(start_from) if start_from else 0 :]
        return [s for s in chosen if only or s.name not in skip]

    def run(self, area: str | None = None, **selection) -> list[tuple[str, object]]:
        """Run the stages in order, once a variant; an area that no stage uses is an error."""
        stages = self.select(**selection)
        if area is not None and not any(AREA in v for s in self.stages for v in s.variants):
            raise PlanError("no stage uses the area")
        out = []
        for s in stages:
            for v in s.resolved(area) or (None,):
                out.append((s.name, s.run() if v is None else s.run(v)))
        return out


class Variants:
    """Named parameter sets over fixed labels."""

    def __init__(self, labels: tuple[str, ...]) -> None:
        self.labels, self.entries = labels, {}

    def add(self, name: str | None = None, **values) -> None:
        if set(values) != set(self.labels):
            raise PlanError(f"a variant needs exactly {sorted(self.labels)}")
        name = name or "_".join(str(values[x]) for x in self.labels)
        if name in self.entries:
            raise PlanError(f"variant {name!r} occurs twice")
        self.entries[name] = {"name": name, **values}

    def get(self, which: str | int = "all") -> list[dict]:
        every = list(self.entries.values())
        if isinstance(which, int):
            return [every[which]]
        if which in ("all", "first"):
            return every if which == "all" else every[:1]
        if which not in self.entries:
            raise PlanError(f"unknown variant {which!r}")
        return [self.entries[which]]


@dataclass(frozen=True)
class Calibrate:
    """Coefficients are fitted on the scenario's own data."""


@dataclass(frozen=True)
class ImportFrom:
    """Coefficients are copied from another scenario."""

    scenario: str


@dataclass(frozen=True)
class HandWritten:
    """Coefficients were placed by hand."""


def resolve_coefs(catalogs: dict[str, Catalog], declared: dict[str, dict[str, object]], scenario: str, name: str, calibrate: Callable[[], DataFrame]) -> DataFrame:
    """A scenario's coefficients by their declared source; only Calibrate calls back."""
    if name not in declared.get(scenario, {}):
        raise PlanError(f"scenario {scenario} declares no source for {name}")
    source, catalog = declared[scenario][name], catalogs[scenario]
    kinds = {Calibrate: "calibrated", ImportFrom: "transferred", HandWritten: "manual"}
    if isinstance(source, Calibrate):
        catalog.write_coefs(calibrate(), name, "calibrated")
        return catalog.read_coefs(name, "calibrated")
    if isinstance(source, ImportFrom):
        other = declared.get(source.scenario, {}).get(name)
        if other is None:
            raise PlanError(f"scenario {source.scenario} has no {name}")
        catalog.write_coefs(catalogs[source.scenario].read_coefs(name, kinds[type(other)]), name, "transferred")
        return catalog.read_coefs(name, "transferred")
    if isinstance(source, HandWritten):
        return catalog.read_coefs(name, "manual")
    raise PlanError(f"unknown source {source!r}")


@dataclass(frozen=True)
class Grid:
    """One accessibility grid: the cost it is cut by, and its parameters."""

    name: str
    cost: str
    bin_edges: tuple[float, ...] = ()
    half_decays: tuple[float, ...] = ()
    betas: tuple[float, ...] = ()
    ks: tuple[float, ...] = ()

    def __post_init__(self) -> None:
        if self.cost not in ("time_gross", "util", "dist_line"):
            raise PlanError(f"grid {self.name}: unknown cost {self.cost}")
        if any(a >= b for a, b in zip(self.bin_edges, self.bin_edges[1:], strict=False)):
            raise PlanError(f"grid {self.name}: bin edges must rise")
        if self.cost == "util" and (self.bin_edges or self.half_decays):
            raise PlanError(f"grid {self.name}: utilities have neither bins nor half decays")
        if self.cost != "util" and self.betas:
            raise PlanError(f"grid {self.name}: rates are for utilities")
        if any(x <= 0 for x in (*self.half_decays, *self.betas, *self.ks)):
            raise PlanError(f"grid {self.name}: decays, rates and k must be positive")

    def bins(self) -> list[tuple[float, float]]:
        return list(zip(self.bin_edges, self.bin_edges[1:], strict=False))


@dataclass(frozen=True)
class Mode:
    """One mode's network settings: search cutoff, distance bands and least cost, in the units of the cost."""

    name: str
    cutoff: float
    r_cells: float
    r_medium: float
    r_zones: float
    floor: float = 0.0

    def __post_init__(self) -> None:
        if not 0 < self.r_cells <= self.r_medium <= self.r_zones:
            raise PlanError(f"mode {self.name}: the bands must rise")
        if self.cutoff <= 0 or self.floor < 0:
            raise PlanError(f"mode {self.name}: cutoff must be positive and floor not negative")


@dataclass(frozen=True)
class Scenario:
    name: str
    modes: tuple[Mode, ...]
    grids: tuple[Grid, ...]
    coefs: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        for what, names in (("modes", [m.name for m in self.modes]), ("grids", [g.name for g in self.grids])):
            if len(set(names)) < len(names):
                raise PlanError(f"scenario {self.name}: {what} occur twice")
        if not self.modes:
            raise PlanError(f"scenario {self.name} has no mode")


def residual_coefs(keys: set[str], consumed: set[str], not_run: set[str], shifts: set[str]) -> set[str]:
    """Coefficients that nothing has used."""
    return keys - consumed - not_run - shifts


def same_grid(grids: list[Grid], cost: str, betas: tuple[float, ...] = ()) -> Grid:
    """The one grid of the cost (and rates); none or several are an error."""
    found = [g for g in grids if g.cost == cost and (not betas or g.betas == betas)]
    if len(found) != 1:
        raise PlanError(f"{len(found)} grids match {cost}")
    return found[0]


def latex_rows(rows: list[dict], block: str, columns: list[str], digits: int = 1) -> list[str]:
    """Table lines, the block's name on its first row only; null is a dash."""
    out, last = [], object()
    for r in rows:
        cells = ["" if r[block] == last else str(r[block])]
        last = r[block]
        cells += ["--" if r[c] is None else f"{r[c]:.{digits}f}" if isinstance(r[c], float) else str(r[c]) for c in columns]
        out.append(" & ".join(cells) + r" \\")
    return out


def stars(p: float | None) -> str:
    """Stars for significance at 0.001, 0.01 and 0.05."""
    return "" if p is None else "***" if p < 0.001 else "**" if p < 0.01 else "*" if p < 0.05 else ""


def paired(a: list, b: list) -> list[tuple]:
    return list(zip_longest(a, b))


def nearest_year(years: list[int], wanted: int) -> int:
    """The year closest to the wanted one, the earlier of two equally close."""
    if not years:
        raise CatalogError("no years")
    return min(sorted(years), key=lambda y: abs(y - wanted))
