"""``python -m earshot --data DIR --out DIR`` runs the whole chain."""

from __future__ import annotations

import argparse
from dataclasses import replace

from earshot.plans.chain import Settings, run
from earshot.session import build_session
from earshot.sources.tables import read_dictionary, read_lexicon


def main() -> None:
    parser = argparse.ArgumentParser(prog="earshot")
    parser.add_argument("--data", required=True, help="folder with feedback.csv, customers.csv, products.csv")
    parser.add_argument("--out", required=True, help="folder for all results")
    parser.add_argument("--lexicon", help='JSON file {"phrase": "theme:sentiment"}')
    parser.add_argument("--valences", help='JSON file {"word": valence}')
    parser.add_argument("--master", help="Spark master; default from the environment")
    args = parser.parse_args()
    spark = build_session("earshot", args.master)
    settings = Settings()
    if args.lexicon:
        settings = replace(settings, lexicon=read_lexicon(spark, args.lexicon))
    if args.valences:
        settings = replace(settings, valences=read_dictionary(spark, args.valences))
    tables = run(spark, args.data, args.out, settings)
    tables["alerts"].show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
