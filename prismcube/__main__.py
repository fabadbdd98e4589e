"""`python -m prismcube process|job|extract ...` on the session that spark-submit or the environment gives."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import jobs


def main(arguments: list[str] | None = None) -> list[str]:
    p = argparse.ArgumentParser(prog="prismcube")
    sub = p.add_subparsers(dest="command", required=True)
    q = sub.add_parser("process", help="run a task list on an image")
    q.add_argument("image")
    q.add_argument("background", nargs="?")
    q.add_argument("-task", required=True)
    q.add_argument("-o", default=None)
    q.add_argument("-srcwin", default="")
    q.add_argument("-nodata", default="")
    q.add_argument("-ot", default=None)
    q.add_argument("-ow", action="store_true")
    q.add_argument("-oc", action="store_true")
    q.add_argument("-v", type=int, default=0)
    q = sub.add_parser("job", help="run a JSON job")
    q.add_argument("path")
    q.add_argument("-templates", default="")
    q = sub.add_parser("extract", help="decode and splice raw files")
    q.add_argument("files", nargs="+")
    q.add_argument("-o", default="out.dat")
    q.add_argument("-splice", type=int, default=1)
    q.add_argument("-c", default="packed", choices=("packed", "none"))
    a = p.parse_args(arguments)
    spark = SparkSession.builder.appName("prismcube").getOrCreate()
    if a.command == "process":
        _, paths = jobs.process(spark, a.image, a.task, a.o, a.background, a.srcwin, a.nodata, a.ot, a.ow, a.oc, a.v >= 2)
    elif a.command == "job":
        paths = [x for _, found in jobs.run_job(spark, a.path, a.templates) for x in found]
    else:
        paths = jobs.extract(spark, a.files, a.o, a.splice, a.c == "packed")
    print("\n".join(paths))
    return paths


if __name__ == "__main__":
    main()
