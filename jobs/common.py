"""What the jobs share: settings, logging, the session of a command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def settings(spark: SparkSession, path: str, defaults: dict) -> dict:
    """A JSON file over the defaults; an unknown name is an error. Read by Spark, so it may lie in any store."""
    given = json.loads(spark.read.text(path, wholetext=True).first()[0])
    unknown = given.keys() - defaults.keys()
    if unknown:
        raise ValueError(f"{path}: unknown settings {sorted(unknown)}")
    return defaults | given


def table(spark: SparkSession, path: str, schema: str, form: str = "parquet") -> DataFrame:
    """A table of files that may not be there yet: empty, of the given schema, until something has written it."""
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def main(name: str, paths: dict[str, str], run: Callable[..., dict]) -> None:
    """``--<path>`` options, --config and --master; ``run(session, *paths, config=...)`` does the work."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}")
    for option, text in paths.items():
        parser.add_argument(f"--{option}", required=True, help=text)
    parser.add_argument("--config", help="JSON file of settings")
    parser.add_argument("--master", help="only without spark-submit, such as local[8]")
    given = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config, master = given.pop("config"), given.pop("master")
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(master) if master else builder).getOrCreate()
    try:
        print(json.dumps(run(spark, *given.values(), config=config), sort_keys=True))
    finally:
        spark.stop()
