"""Project settings: checked when read, unknown names refused with the nearest known one."""

from __future__ import annotations

import dataclasses
import difflib
import hashlib
import json
import math
from dataclasses import dataclass, field
from typing import Any

from skerry.functions.geo import KM_PER_DEGREE
from skerry.functions.values import PERCENTILE, STATS
from skerry.plans import products, settings


class SettingsError(ValueError):
    """Settings that can't be used; the message lists every fault found."""


def nearest_name(name: str, known: list[str]) -> str:
    hit = difflib.get_close_matches(name, known, 1)
    return f"{name!r}" + (f" (did you mean {hit[0]!r}?)" if hit else f" (known: {', '.join(sorted(known))})")


def build(cls: type, data: dict[str, Any], where: str):
    """A settings object from a mapping; an unknown key is an error."""
    known = [f.name for f in dataclasses.fields(cls)]
    if unknown := [k for k in data if k not in known]:
        raise SettingsError(f"{where}: unknown {', '.join(nearest_name(k, known) for k in unknown)}")
    try:
        return cls(**data)
    except TypeError as e:
        raise SettingsError(f"{where}: {e}") from e


@dataclass(frozen=True)
class Area:
    """A named area round a centre."""

    name: str
    lat: float
    lon: float
    ns_km: float
    ew_km: float

    def bbox(self) -> tuple[float, float, float, float]:
        """West, south, east, north; clamped at the poles, longitudes wrapped into -180..180."""
        dy = self.ns_km / KM_PER_DEGREE
        dx = self.ew_km / (KM_PER_DEGREE * max(math.cos(math.radians(self.lat)), 1e-9))
        wrap = lambda x: (x + 180) % 360 - 180
        return wrap(self.lon - dx), max(self.lat - dy, -90.0), wrap(self.lon + dx), min(self.lat + dy, 90.0)


@dataclass(frozen=True)
class Sensor:
    """A sensor whose scenes are ranked and mosaicked; ``versions`` stand beside each other, each with its own channels."""

    prefix: str
    water_is_land: bool = False
    use_cloud: bool = True
    qc_levels: tuple[int, ...] | None = None
    trust_valid: bool = False
    mosaic: bool = False
    versions: tuple[str, ...] = ()


#: The sensors known by default and how their layers are read.
SENSORS = (
    Sensor("eco", water_is_land=True, use_cloud=False, qc_levels=(0, 1), mosaic=True),
    Sensor("lst", mosaic=True),
    Sensor("modis", trust_valid=True, mosaic=True, versions=("terra", "aqua")),
    Sensor("modisref", trust_valid=True),
)


@dataclass(frozen=True)
class Channel:
    """What to extract: a channel, its radius, statistics and mask."""

    name: str
    radius_m: float = 0.0
    stat: tuple[str, ...] = ("nearest",)
    mask: str | None = None

    def __post_init__(self) -> None:
        stats = (self.stat,) if isinstance(self.stat, str) else tuple(self.stat)
        object.__setattr__(self, "stat", stats)
        if len(set(stats)) != len(stats):
            raise SettingsError(f"{self.name}: a statistic is given twice")
        for s in stats:
            if s != "nearest" and s not in STATS and not PERCENTILE.match(s):
                raise SettingsError(f"{self.name}: unknown statistic {nearest_name(s, [*STATS, 'nearest'])}")
        if self.radius_m > 0 and stats == ("nearest",):
            raise SettingsError(f"{self.name}: the radius is not used by 'nearest'")


#: Options of each step with their defaults.
STEPS: dict[str, dict[str, Any]] = {
    "water_line": {"dem_source": None, "tide_source": None, "sensors": None},
    "fill_water": {"sources": None, "mask_channel": "landcover_water"},
    "filter_clouds": {"method": "offset", "threshold_k": 5.0, "n_sigma": 3.0, "baseline": "mur_sst", "stat_scope": "pixel", "seasonality": "off", "sensors": ["eco"], "mask_sst": True, "use_cloud_raster": False},
    "filter_cloud_cover": {"scene_max_pct": 30.0, "pixel_max_pct": 80.0, "sensors": ["eco"], "source": "auto", "water_mask_channel": "landcover_water", "mask_sst": True},
    "filter_land_clouds": {"threshold_k": 5.0, "sensors": ["eco"], "source": "auto", "land_source": "landcover", "mask_channel": "landcover_water", "mask_sst": True},
    "flag_georef": {"sensors": ["eco"], "tol_m": 200.0, "max_shift_m": 10_000.0, "coarse_stride": 4, "n_refine": 8, "sigma": 1.5, "lo_pct": 80.0, "hi_pct": 97.0, "min_coast_obs": 500, "min_valid_pct": 2.0, "min_edges": 300, "z_min": 4.5, "lift_min": 2.5, "gain_min": 0.1, "ok_shift_m": 300.0, "stability_windows_km": [5.0, 10.0, 20.0, 30.0]},
    "correct_georef": {"sensors": ["eco"], "fields": ["sst", "valid"], "fill": None},
}
#: The filters again on corrected geometry: they have the options of the filter that they repeat, unless given others.
CORRECTED = {f"{name}_corrected": name for name in ("filter_clouds", "filter_cloud_cover", "filter_land_clouds")}
STEPS |= {name: STEPS[base] for name, base in CORRECTED.items()}
#: Steps that must be chosen with a step, and steps that go before it where they are chosen.
STEP_REQUIRES = {"correct_georef": ("flag_georef",), **{name: ("correct_georef",) for name in CORRECTED}}
STEP_NEEDS = {"filter_clouds": ("fill_water",), "filter_land_clouds": ("water_line",), "flag_georef": ("filter_clouds", "filter_cloud_cover", "filter_land_clouds"), "correct_georef": ("flag_georef",), **{name: ("correct_georef",) for name in CORRECTED}}
CHOICES = {"method": ("offset", "sigma"), "stat_scope": ("pixel", "pooled"), "seasonality": ("off", "harmonic"), "land_source": ("landcover", "water_line")}


@dataclass(frozen=True)
class Project:
    """Areas, grid, window, inputs, sensors, steps and extraction of a project."""

    areas: tuple[Area, ...]
    start: str
    end: str
    resolution_m: float = 100.0
    target_crs: str = "auto"
    snap_origin: bool = True
    met_time: str = "reference"
    insitu: bool = True
    block_days: int | None = None
    memory_budget_gb: float | None = None
    jobs: int = 1
    points_columns: dict[str, str] = field(default_factory=dict)
    points_format: str = "parquet"
    idle: tuple[str, ...] = ()
    products: dict[str, dict[str, Any]] = field(default_factory=dict)
    regions: dict[str, dict[str, dict[str, Any]]] = field(default_factory=dict)
    inputs: dict[str, str] = field(default_factory=dict)
    sensors: tuple[Sensor, ...] = SENSORS
    insitu_max_dt_min: float = 60.0
    steps: dict[str, dict[str, Any]] = field(default_factory=dict)
    channels: tuple[Channel, ...] = ()
    overrides: dict[str, dict[str, dict[str, Any]]] = field(default_factory=dict)
    output: str = "out"

    def step(self, name: str, area: str | None = None) -> dict[str, Any]:
        """A step's options: defaults, the project's, then the area's; those of a repeated filter before the repetition's own."""
        own = self.overrides.get(area or "", {})
        base = CORRECTED.get(name)
        first = self.steps.get(base, {}) | own.get(base, {}) if base else {}
        return STEPS[name] | first | self.steps.get(name, {}) | own.get(name, {})

    def product(self, name: str, area: str | None = None) -> dict[str, Any]:
        """A product's options: defaults, the project's, then the area's."""
        return products.PRODUCTS[name].options | self.products.get(name, {}) | self.regions.get(area or "", {}).get(name, {})

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True, default=str).encode()).hexdigest()

    def select(self, names: list[str] | None) -> tuple[Area, ...]:
        """Areas by name, in the project's order; an unknown name is an error."""
        known = [a.name for a in self.areas]
        if names is None:
            return self.areas
        if bad := [n for n in names if n not in known]:
            raise SettingsError(f"no area {', '.join(nearest_name(n, known) for n in bad)}")
        return tuple(a for a in self.areas if a.name in names)


INPUTS = ("scenes", "daily", "static", "bathymetry", "datum", "series", "stations", "readings", "points", "met", "snapshots", "ocean")


def parse(data: dict[str, Any]) -> Project:
    """A checked project from a mapping; all faults are reported at once."""
    faults: list[str] = []

    def attempt(f):
        try:
            return f()
        except SettingsError as e:
            faults.append(str(e))

    idle: list[str] = []
    if settings.is_nested(data):
        data, faults, idle = settings.flatten(data, nearest_name)
    known = [f.name for f in dataclasses.fields(Project) if f.name != "idle"]
    faults += [f"unknown {nearest_name(k, known)}" for k in data if k not in known]
    data = {k: v for k, v in data.items() if k in known}
    areas = tuple(x for a in data.get("areas", []) if (x := attempt(lambda a=a: build(Area, a, "area"))))
    if not areas:
        faults.append("no areas")
    if len({a.name for a in areas}) != len(areas):
        faults.append("two areas have one name")
    if not data.get("start") or not data.get("end") or data["start"] > data["end"]:
        faults.append("start and end must be given, the start first")
    sensors = SENSORS
    if "sensors" in data:
        sensors = tuple(x for s in data["sensors"] if (x := attempt(lambda s=s: build(Sensor, {k: tuple(v) if isinstance(v, list) else v for k, v in s.items()}, "sensor"))))
    channels = tuple(x for c in data.get("channels", []) if (x := attempt(lambda c=c: build(Channel, c, "channel"))))
    faults += [f"inputs: unknown {nearest_name(k, list(INPUTS))}" for k in data.get("inputs", {}) if k not in INPUTS]
    for where, steps in (("steps", data.get("steps", {})), *((f"overrides of {a}", s) for a, s in data.get("overrides", {}).items())):
        for name, opts in steps.items():
            if name not in STEPS:
                faults.append(f"{where}: unknown step {nearest_name(name, list(STEPS))}")
            else:
                faults += [f"{where}.{name}: unknown {nearest_name(k, list(STEPS[name]))}" for k in opts if k not in STEPS[name]]
                faults += [f"{where}.{name}: unknown {k} {nearest_name(str(v), list(CHOICES[k]))}" for k, v in opts.items() if k in CHOICES and v not in CHOICES[k]]
    for name in data.get("steps", {}):
        faults += [f"{name} needs {d}" for d in STEP_REQUIRES.get(name, ()) if d not in data["steps"]]
    faults += products.faults(data.get("products", {}), "products", nearest_name)
    for region, bags in data.get("regions", {}).items():
        faults += products.faults(bags, f"regions.{region}", nearest_name, regional=True)
        if region not in [x.name for x in areas]:
            faults.append(f"regions: no area {nearest_name(region, [x.name for x in areas])}")
    if data.get("met_time", "reference") not in ("reference", "daily_mean"):
        faults.append(f"unknown met_time {nearest_name(str(data['met_time']), ['reference', 'daily_mean'])}")
    prefixes = [s.prefix for s in sensors]
    for where, bags in (("products", data.get("products", {})), *((f"regions.{r}", b) for r, b in data.get("regions", {}).items())):
        for product, key in (("met_overpass", "combinations"), ("tides", "overpass_combinations")):
            faults += [f"{where}.{product}: no sensor {nearest_name(str(p[0]), prefixes)}" for p in bags.get(product, {}).get(key) or () if len(p) == 2 and p[0] not in prefixes]
    for name, opts in data.get("steps", {}).items():
        faults += [f"{name}: no sensor {nearest_name(s, prefixes)}" for s in opts.get("sensors") or [] if s not in prefixes]
    faults += [f"overrides: no area {nearest_name(a, [x.name for x in areas])}" for a in data.get("overrides", {}) if a not in [x.name for x in areas]]
    if faults:
        raise SettingsError("; ".join(faults))
    if data.get("points_format", "parquet") not in ("parquet", "csv"):
        raise SettingsError(f"extract: unknown format {nearest_name(str(data['points_format']), ['parquet', 'csv'])}")
    return Project(**(data | {"idle": (*idle, *products.unused(data.get("products", {}))), "areas": areas, "sensors": sensors, "channels": channels}))


def load(path: str) -> Project:
    """A project from a JSON or YAML file."""
    with open(path) as f:
        text = f.read()
    try:
        return parse(json.loads(text))
    except json.JSONDecodeError:
        import yaml

        return parse(yaml.safe_load(text))


def step_order(names: list[str]) -> list[str]:
    """Selected steps after those selected ones that they need, otherwise in the order of the registry."""
    out: list[str] = []
    left = [n for n in STEPS if n in names]
    while left:
        n = next(n for n in left if not any(d in left for d in STEP_NEEDS.get(n, ())))
        out.append(n)
        left.remove(n)
    return out
