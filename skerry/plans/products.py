"""The products that a project may take, their options, and the checks of them."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Product:
    """A product: the input table that holds it, the options that shape its channels with their defaults, the options of acquisition
    (known, but without effect here, as inputs come as tables), what a region may override, and the sources known for it."""

    table: str
    options: dict[str, Any] = field(default_factory=dict)
    acquisition: frozenset[str] = frozenset()
    regional: frozenset[str] = frozenset()
    sources: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    after: tuple[str, ...] = ()


def _product(table: str, options: dict[str, Any], acquisition: str, regional: str = "", sources: str = "", needs: str = "", after: str = "") -> Product:
    return Product(table, options, frozenset(acquisition.split()) | {"output_format", "overwrite"}, frozenset(regional.split()), tuple(sources.split()), tuple(needs.split()), tuple(after.split()))


#: The names of products, their options, what a region may override, known sources and required layers.
PRODUCTS: dict[str, Product] = {
    "bathymetry": _product("bathymetry", {"sources": None, "datum_offset_m": None}, "cudem_index_cache cudem_urllist layer min_cudem_cover pad_deg resolution stats_subgrid_m", "datum_offset_m sources", "cudem gmrt", "depth depth_p25 depth_p75 elevation"),
    "mur": _product("daily", {}, "access overpass_sensors pad_deg short_name variable", "overpass_sensors", needs="sst valid", after="ecostress landsat modis"),
    "cmems": _product("ocean", {"sources": None, "variables": None, "depths": None}, "datasets pad_deg", "datasets sources", "my_global anfc_global", "valid"),
    "ecostress": _product("scenes", {}, "categorical layers short_name versions", needs="cloud sst valid water"),
    "landsat": _product("scenes", {}, "cloud_cover_max collection masking platforms source stac_url", "collection source stac_url", needs="cloud sst valid water"),
    "modis": _product("scenes", {}, "access daytime_only night_solar_hours platforms quality_min regrid_radius_m short_name time_of_day variable", sources="terra aqua", needs="sst valid"),
    "modis_ref": _product("scenes", {}, "access daytime_only footprint_id match_landsat max_time_diff_minutes quality_min regrid_radius_m short_name time_of_day variable", needs="sst valid", after="landsat"),
    "met": _product("met", {"sources": None, "variables": None, "reference_time": "10:30", "reference_basis": "solar"}, "daily_mean_hours era5_zarr fxx model pad_deg product regrid_radius_m", "model sources", "hrrr era5"),
    "met_overpass": _product("snapshots", {"combinations": (), "variables": None}, "era5_zarr fxx model pad_deg product regrid_radius_m sources", "combinations model sources", "hrrr era5", after="ecostress landsat modis"),
    "tides": _product("series", {"sources": None, "overpass_combinations": ()}, "interval max_distance_km model model_directory stations warn_distance_km", "model model_directory overpass_combinations sources stations", "coops eo_tides", "tide"),
    "landcover": _product("static", {}, "collection source stac_url water_classes year", "collection source stac_url", "esa worldcover", "landcover water"),
    "insitu": _product("readings", {"exclude_stations": (), "stations": (), "max_sensor_depth_m": None, "qc_pass_values": None, "max_position_drift_m": 1000.0}, "columns default_station_id pad_deg path qc_flags sources time_zone units variables", "exclude_stations path sources stations variables", "ioos csv", "qc sst"),
}
#: The prefix of each overpass sensor's channels.
PREFIX = {"ecostress": "eco", "landsat": "lst", "modis": "modis", "modis_ref": "modisref"}


def order(chosen: list[str]) -> list[str]:
    """Products after the chosen ones that they follow, otherwise in the order of the registry."""
    left, out = [p for p in PRODUCTS if p in chosen], []
    while left:
        one = next(p for p in left if not any(d in left for d in PRODUCTS[p].after))
        out.append(one)
        left.remove(one)
    return out


def faults(bags: dict[str, dict[str, Any]], where: str, name_of, *, regional: bool = False) -> list[str]:
    """What is wrong with option bags: unknown products and options, options that a region may not override, unknown or empty
    sources, pairs that aren't (sensor, source)."""
    out = []
    for product, bag in bags.items():
        if product not in PRODUCTS:
            out.append(f"{where}: unknown product {name_of(product, list(PRODUCTS))}")
            continue
        p = PRODUCTS[product]
        known = [*p.options, *p.acquisition]
        for k, v in bag.items():
            at = f"{where}.{product}"
            if k not in known and k not in p.regional:
                out.append(f"{at}: unknown {name_of(k, known)}")
            elif regional and k not in p.regional:
                out.append(f"{at}: {k!r} can't differ by region")
            elif k in ("sources", "platforms") and v is not None:
                tags = [*p.sources, *bag.get("datasets", ())]
                if not v:
                    out.append(f"{at}: {k} is empty")
                out += [f"{at}: unknown source {name_of(s, tags)}" for s in v if s not in tags]
            elif k in ("combinations", "overpass_combinations"):
                for pair in v or ():
                    if not isinstance(pair, (list, tuple)) or len(pair) != 2:
                        out.append(f"{at}: {pair!r} isn't a (sensor, source) pair")
                    elif pair[1] not in p.sources:
                        out.append(f"{at}: unknown source {name_of(pair[1], list(p.sources))}")
    return out


def unused(bags: dict[str, dict[str, Any]]) -> list[str]:
    """Options given that only steer acquisition."""
    return sorted(f"{p}.{k}" for p, bag in bags.items() if p in PRODUCTS for k in bag if k in PRODUCTS[p].acquisition)
