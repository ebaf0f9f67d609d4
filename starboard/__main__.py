"""Job from a folder of files to the marts of a dataset: ``python -m starboard --help``.

``spark-submit --py-files <zip of the package> starboard/__main__.py ...`` runs it on a cluster.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from starboard.plans import marts
from starboard.plans.dataset import analyze_dataset, analyze_raw_dataset
from starboard.session import build_session, release_staged


def main(given: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starboard", description="Analyse a folder of ratings.")
    parser.add_argument("folder", help="delimited files of any dialect")
    parser.add_argument("root", help="folder of the marts")
    parser.add_argument("dataset_id", type=int, nargs="?", help="given out if left out")
    parser.add_argument("--name", help="of the dataset in the registry")
    parser.add_argument("--raw", action="store_true",
                        help="headerless '::' files ratings*, movies* and users*")
    parser.add_argument("--min-count", type=int, help="ratings a top movie has at least")
    args = parser.parse_args(given)

    spark = build_session()
    number = args.dataset_id
    if number is None:
        number = marts.register_dataset(spark, args.root, args.name or args.folder)
    options = {} if args.min_count is None else {"min_count": args.min_count}
    analyze = analyze_raw_dataset if args.raw else analyze_dataset
    analyze(spark, args.folder, args.root, number, args.name, **options)
    marts.list_datasets(spark, args.root).where(f"id = {number}").show(truncate=False)
    release_staged(spark)


if __name__ == "__main__":
    main()
