"""``python -m skerry VERB SETTINGS``: validate, grids, order, verify, run, assemble, preprocess, extract, provenance, check."""

from __future__ import annotations

import argparse
import json
import sys

from skerry.plans import config, products

VERBS = {
    "validate": "check the settings",
    "grids": "print each area's grid",
    "order": "print the steps and products in their order",
    "verify": "check that the input tables are there and have their columns",
    "run": "cube, derived channels, extraction",
    "assemble": "the cube only",
    "preprocess": "the derived channels of a cube that is there",
    "extract": "the values at points of tables that are there",
    "provenance": "what the input tables hold for each area",
    "check": "list complete, bad and left-over tables",
}
STAGES = {"run": ("cube", "derived", "points"), "assemble": ("cube",), "preprocess": ("derived",), "extract": ("points",)}
#: Columns that an input table must have.
COLUMNS = {
    "scenes": "area sensor day granule ts row col sst", "daily": "area source day row col value", "static": "area row col water", "bathymetry": "area source row col elevation",
    "datum": "area source datum_offset_m", "series": "area source ts value", "stations": "area station_id", "readings": "station_id time value", "points": "point_id",
    "met": "area source day row col", "snapshots": "area source ts row col var value", "ocean": "area source var level day row col value",
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skerry", description="Gridded observation cubes on Spark")
    verbs = p.add_subparsers(dest="verb", required=True)
    for verb, text in VERBS.items():
        v = verbs.add_parser(verb, help=text)
        v.add_argument("settings")
        v.add_argument("--area", action="append", help="only this area; may be given again")
        if verb in STAGES:
            v.add_argument("--overwrite", action="store_true", help="write finished tables again")
            v.add_argument("--dry-run", action="store_true", help="tell what would be written, write nothing")
            v.add_argument("--jobs", type=int, help="areas at a time")
        if verb == "check":
            v.add_argument("--repair", action="store_true", help="put back tables of broken writes and delete what they left; asks first")
            v.add_argument("--yes", action="store_true", help="don't ask")
    return p


def _verify(spark, project: config.Project) -> list[str]:
    wrong = []
    for name, path in project.inputs.items():
        try:
            have = set(spark.read.parquet(path).columns)
        except Exception as e:  # noqa: BLE001 - whatever keeps a table from being read
            wrong.append(f"{name}: can't be read ({str(e).splitlines()[0][:80]})")
            continue
        if lacks := [c for c in COLUMNS[name].split() if c not in have]:
            wrong.append(f"{name}: no column {', '.join(lacks)}")
    return wrong


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    try:
        project = config.load(a.settings)
        areas = project.select(a.area)
    except (config.SettingsError, OSError) as e:
        print(e, file=sys.stderr)
        return 2
    if a.verb == "validate":
        print(f"{len(areas)} areas, settings {project.fingerprint()[:12]}")
        if project.idle:
            print(f"without effect here (they steer acquisition or files; inputs come as tables): {', '.join(project.idle)}")
        return 0
    if a.verb == "order":
        print("\n".join(config.step_order(list(project.steps))))
        if project.products:
            print("products: " + ", ".join(products.order(list(project.products))))
        return 0
    if a.verb == "grids":
        from skerry.plans.project import epsg_and_grid

        for x in areas:
            epsg, g = epsg_and_grid(project, x)
            print(f"{x.name}: {g.height} x {g.width} cells of {g.res:g} m, EPSG:{epsg}, corner {g.x0:g} {g.y0:g}, {', '.join(f'{v:.4f}' for v in x.bbox())}")
        return 0
    from pyspark.sql import SparkSession

    from skerry.sources import store

    spark = SparkSession.builder.appName("skerry").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.verb == "verify":
        wrong = _verify(spark, project)
        print("\n".join(wrong) or f"{len(project.inputs)} input tables can be read")
        return int(bool(wrong))
    if a.verb in STAGES:
        import dataclasses

        from skerry.plans.project import run

        project = dataclasses.replace(project, jobs=a.jobs) if a.jobs else project
        if a.dry_run:
            done = {f"{x.name}/{s}": store.is_complete(spark, f"{project.output}/{x.name}/{s}") and not a.overwrite for x in areas for s in STAGES[a.verb]}
            print(json.dumps({k: "kept" if v else "to be written" for k, v in done.items()}, indent=1))
            return 0
        print(json.dumps(run(spark, project, areas=a.area, overwrite=a.overwrite, stages=STAGES[a.verb]), indent=1))
        return 0
    if a.verb == "provenance":
        from skerry.plans.project import provenance

        for x in areas:
            for row in provenance(spark, project, x).orderBy("product").collect():
                print(f"{x.name} {row['product']}: {row['rows']} rows, {row['sources'] or '-'}, {row['first_day']} to {row['last_day']}")
        return 0
    found = {x.name: store.scan(spark, f"{project.output}/{x.name}", deep=True) for x in areas}
    print(json.dumps(found, indent=1))
    if a.repair and any(f["scratch"] for f in found.values()):
        if not a.yes and input("Put back and delete what broken writes left? [y/N] ").strip().lower() != "y":
            return 1
        print(json.dumps({x.name: store.repair(spark, f"{project.output}/{x.name}") for x in areas}, indent=1))
        return int(any(f["bad"] for f in found.values()))
    return int(any(f["bad"] or f["scratch"] for f in found.values()))


if __name__ == "__main__":
    sys.exit(main())
