"""The two plans from a command line: tables in, tables out.

    spark-submit -m duskfield votes --detections D --catalog gaia=G --catalog usno=U --output O
    spark-submit -m duskfield supernova --candidates C --movers M --stars S --galaxies G --known K --output O
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import identity as ident
from .plans import viewer
from .plans.pipeline import STRATEGIES, DifferenceCandidates, supernova_chain
from .sources.config import Settings


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="duskfield", description="Candidates from tables of detections.")
    top.add_argument("--config", help="settings, as YAML or INI")
    sub = top.add_subparsers(dest="plan", required=True)
    v = sub.add_parser("votes", help="votes of catalogues over exposures, with light curves")
    v.add_argument("--detections", required=True)
    v.add_argument("--catalog", action="append", default=[], metavar="NAME=PATH", help="stars: sx, sy, star_mag")
    v.add_argument("--strategy", choices=sorted(STRATEGIES), help="subtraction: the detections are of difference images")
    v.add_argument("--template", default="unknown", help="what difference images were made with")
    v.add_argument("--movers", help="epoch_id, mra, mdec")
    v.add_argument("--variables", help="vra, vdec")
    v.add_argument("--frame", nargs=2, type=float, metavar=("WIDTH", "HEIGHT"))
    v.add_argument("--edge", type=float, default=10.0)
    v.add_argument("--min-catalogs", type=float, help="share of the catalogues that have to agree")
    v.add_argument("--min-found", type=int, help="least number of detections")
    v.add_argument("--siglim", type=float)
    s = sub.add_parser("supernova", help="filters, hosts, known transients and scores")
    for name in ("candidates", "movers", "stars", "galaxies", "known"):
        s.add_argument(f"--{name}", required=True)
    s.add_argument("--target", action="append", default=[], nargs=2, type=float, metavar=("RA", "DEC"))
    s.add_argument("--years", type=float, default=0.0, help="since the stars' epoch")
    s.add_argument("--within", type=float, default=4.0, help="degrees from a target")
    s.add_argument("--observation", default="observation")
    for p in (v, s):
        p.add_argument("--output", required=True)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    settings = Settings.read(a.config) if a.config else Settings()
    spark = spark or SparkSession.builder.appName("duskfield").getOrCreate()
    read = lambda path: spark.read.parquet(path) if path else None
    if a.plan == "votes":
        given = {"min_catalogs_fraction": a.min_catalogs, "min_n_detections": a.min_found, "siglim": a.siglim}
        settings = replace(settings, **{k: v for k, v in given.items() if v is not None})
        how = {"movers": read(a.movers), "variables": read(a.variables), "frame": tuple(a.frame) if a.frame else None, "edge": a.edge}
        kind = STRATEGIES[a.strategy or settings.strategy]
        if kind is DifferenceCandidates:
            plan = kind(settings, a.template, **how)
        else:
            plan = kind({name: read(path) for name, _, path in (c.partition("=") for c in a.catalog)}, settings, **how)
        rows, points = plan.run(read(a.detections))
        points = points.join(rows.select("gid", "transient_id"), "gid")
        viewer.save_results(rows, points, a.output, settings.max_candidates)
        viewer.nested_json(rows, points, settings.max_candidates).select("value").write.mode("overwrite").text(f"{a.output}/candidates_json")
    else:
        rows = supernova_chain(read(a.candidates), read(a.movers), read(a.stars), read(a.galaxies), read(a.known), [tuple(t) for t in a.target], a.years, a.within, settings)
        rows = rows.withColumn("transient_id", ident.position_id(F.col("ra"), F.col("dec"), "sn"))
        rows.write.mode("overwrite").parquet(f"{a.output}/candidates")
        viewer.report_rows(rows).select("report").write.mode("overwrite").text(f"{a.output}/report_lines")
        viewer.report(rows, a.observation).write.mode("overwrite").json(f"{a.output}/report")


if __name__ == "__main__":
    main()
