"""Command line: score a city from tables, roll it up to tracts, compare labels, publish features."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import benchmarks, checks, labels, maps, publish
from .plans import city, runs
from .sources import readers


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="helioquery", description=__doc__)
    kinds = out.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *paths: str) -> argparse.ArgumentParser:
        own = kinds.add_parser(name, help=about)
        for p in paths:
            own.add_argument(p)
        return own

    score = command("score", "buildings from roof pixels and insolation", "pixels", "insolation", "out")
    score.add_argument("--method", choices=("multiplane", "ransac"), default="multiplane")
    score.add_argument("--origin", type=float, nargs=2, default=(0.0, 0.0))
    score.add_argument("--res", type=float, default=2.0)
    score.add_argument("--area", default="city")
    score.add_argument("--label", default=runs.run_label())
    command("aggregate", "tracts from buildings, demographics and burden", "buildings", "tracts", "people", "burden", "out")
    command("compare", "hand labels against a detailed score", "labels", "score", "out")
    command("publish", "web features of buildings", "buildings", "out")
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("helioquery").getOrCreate()
    if a.command == "score":
        rows = city.score_study_area(spark.read.parquet(a.pixels), spark.read.parquet(a.insolation), tuple(a.origin), a.res, a.method)
        where = runs.run_folder(a.out, a.area, a.label) + "/buildings.parquet"
        rows.write.mode("overwrite").parquet(where)
        print(benchmarks.markdown(checks.reason_counts(spark.read.parquet(where))))
    elif a.command == "aggregate":
        read = spark.read.parquet
        city.aggregate_city(readers.buildings(spark, a.buildings), read(a.tracts), read(a.people), read(a.burden)).write.mode("overwrite").parquet(a.out)
        print(benchmarks.markdown(benchmarks.tract_headline(read(a.out))))
    elif a.command == "compare":
        own, score = spark.read.csv(a.labels, header=True), readers.score_tables(spark, a.score, ("planes", "obstructions", "buildings"))
        labels.check_labels(own, score["buildings"])
        found = labels.compare_labels(own, score["buildings"], score["planes"], score["obstructions"])
        found.write.mode("overwrite").csv(a.out, header=True)
        print(benchmarks.markdown(labels.summarize_spot_check(found)))
    else:
        rows = publish.roofs_to_web(readers.buildings(spark, a.buildings), "rings")
        maps.write_features(maps.polygon_features(rows, [c for c in rows.columns if c != "rings"]), a.out)


if __name__ == "__main__":
    main()
