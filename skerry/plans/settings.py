"""Settings in nested blocks (time, grid, products, datacube, preprocess, extract, runtime, regions with their areas) as flat ones."""

from __future__ import annotations

from typing import Any

#: The blocks and their options; those marked False steer acquisition or file layout and have no effect here.
BLOCKS: dict[str, dict[str, bool]] = {
    "time": {"start_date": True, "end_date": True},
    "grid": {"resolution_m": True, "target_crs": True, "snap_origin": True, "resampling_continuous": False, "resampling_categorical": False},
    "datacube": {"met_time": True, "insitu": True, "insitu_max_dt_min": True, "block_days": True, "memory_budget_gb": True, "chunks": False, "compression": False, "output_subdir": False, "overwrite": False},
    "preprocess": {"enabled": True, "steps": True, "block_days": False, "memory_budget_gb": False, "overwrite": False},
    "extract": {"points": True, "columns": True, "channels": True, "format": True, "output_subdir": False, "stem": False, "overwrite": False, "memory_budget_gb": False},
    "runtime": {"jobs": True, "assemble_jobs": True, "gates": False},
}
TOP = ("name", "output_dir", "auth", "products", "regions", "inputs", "sensors", *BLOCKS)
AREA = {"name": "name", "center_lat": "lat", "center_lon": "lon", "buffer_ns_km": "ns_km", "buffer_ew_km": "ew_km"}
REGION = ("name", "areas", "sources", "preprocess")


def is_nested(data: dict[str, Any]) -> bool:
    return isinstance(data.get("regions"), list) or "time" in data


def channels(block: dict[str, Any]) -> list[dict[str, Any]]:
    """Channels to extract, also in their short forms: no value, a statistic, a list of them."""
    return [{"name": k, **({} if v is None else {"stat": v} if isinstance(v, (str, list)) else v)} for k, v in block.items()]


def flatten(data: dict[str, Any], name_of) -> tuple[dict[str, Any], list[str], list[str]]:
    """The flat settings, what is wrong with the blocks, and which options given have no effect here."""
    wrong = [f"unknown {name_of(k, list(TOP))}" for k in data if k not in TOP]
    idle = ["auth"] if data.get("auth") else []
    block: dict[str, dict[str, Any]] = {}
    for b, options in BLOCKS.items():
        own = data.get(b) or {}
        wrong += [f"{b}: unknown {name_of(k, list(options))}" for k in own if k not in options]
        idle += [f"{b}.{k}" for k in own if options.get(k) is False]
        block[b] = {k: v for k, v in own.items() if options.get(k)}
    time, cube, pre, extract, run = (block[b] for b in ("time", "datacube", "preprocess", "extract", "runtime"))
    areas, bags, overrides = [], {}, {}
    for r in data.get("regions") or []:
        wrong += [f"region: unknown {name_of(k, list(REGION))}" for k in r if k not in REGION]
        for a in r.get("areas") or []:
            wrong += [f"area: unknown {name_of(k, list(AREA))}" for k in a if k not in AREA]
            areas.append({AREA[k]: v for k, v in a.items() if k in AREA})
            if r.get("sources"):
                bags[a.get("name")] = r["sources"]
            if steps := (r.get("preprocess") or {}).get("steps"):
                overrides[a.get("name")] = {k: v or {} for k, v in steps.items()}
    flat = {
        "areas": areas, "start": str(time.get("start_date", "")), "end": str(time.get("end_date", "")), "output": data.get("output_dir", "out"),
        "products": {k: v or {} for k, v in (data.get("products") or {}).items()}, "regions": bags, "overrides": overrides, "inputs": dict(data.get("inputs") or {}),
        "steps": {k: v or {} for k, v in (pre.get("steps") or {}).items()} if pre.get("enabled") else {}, "channels": channels(extract.get("channels") or {}),
        "jobs": run.get("assemble_jobs") or run.get("jobs") or 1, **block["grid"], **{k: v for k, v in cube.items() if k != "block_days" or v != "auto"},
    }
    if extract.get("points"):
        flat["inputs"]["points"] = extract["points"]
    flat |= {f"points_{k}": extract[k] for k in ("columns", "format") if extract.get(k)}
    return flat | ({"sensors": data["sensors"]} if "sensors" in data else {}), wrong, idle
