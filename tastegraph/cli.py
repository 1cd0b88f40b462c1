"""Command line entry: ``spark-submit -m tastegraph.cli <program> ...`` or
``python -m tastegraph.cli <program> ...``.

Programs mirror the reference's scripts; outputs are written as parquet (or
shown with ``--show``) instead of printed line by line.
"""

from __future__ import annotations

import argparse

from tastegraph.plans import recommenders as REC
from tastegraph.session import build_session, scratch_tables
from tastegraph.sources import delimited as D
from tastegraph.sources import metadata as MD


def _emit(name, df, args):
    if args.out:
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    else:
        print(f"== {name}")
        df.show(args.show, truncate=False)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="tastegraph")
    ap.add_argument("--master", default=None)
    ap.add_argument("--out", default=None, help="write results as parquet under this folder")
    ap.add_argument("--show", type=int, default=50)
    sub = ap.add_subparsers(dest="program", required=True)

    c = sub.add_parser("corated", help="co-rated cosine recommendations")
    c.add_argument("ratings")
    c.add_argument("titles")
    c.add_argument("user_id", nargs="?", type=int)
    c.add_argument("--sep", default="|")
    c.add_argument("--cap", type=int, default=None, help="sample at most so many raters per product")

    z = sub.add_parser("centred", help="centred cosine report for a user and a product")
    z.add_argument("ratings")
    z.add_argument("user_id", type=int)
    z.add_argument("product_id", help="as in the file; products need not be numbers")
    z.add_argument("--sep", default=",")
    z.add_argument("--user-id-cap", type=int, default=None)

    a = sub.add_parser("als", help="ALS grid search, evaluation and top-50 for a profile")
    a.add_argument("ratings")
    a.add_argument("titles")
    a.add_argument("profile")
    a.add_argument("--profile-user-id", type=int, default=None, help="user of the profile file to serve, if it holds several")
    a.add_argument("--serve-as", type=int, default=None, help="id to serve the profile under, if its own is taken")
    a.add_argument("--titles-sep", default="#")
    a.add_argument("--sep", default="|")
    a.add_argument("--ranks", default="12")
    a.add_argument("--lambdas", default="0.01,0.1")
    a.add_argument("--iterations", default="20")

    e = sub.add_parser("encode", help="dense-encode user and product ids of a raw ratings CSV")
    e.add_argument("ratings")
    e.add_argument("--metadata", default=None)

    m = sub.add_parser("metadata", help="project loose-JSON product metadata")
    m.add_argument("path")

    args = ap.parse_args(argv)
    spark = build_session(args.master)
    with scratch_tables(spark):
        _run(spark, args, ap)
    spark.stop()


def _run(spark, args, ap):
    if args.program == "corated":
        r = D.read_ratings_delimited(spark, args.ratings, sep=args.sep)
        p = D.read_product_titles(spark, args.titles)
        users = [args.user_id] if args.user_id is not None else None  # a listed id is a predicate of the scan
        _emit("recommendations", REC.corated_recommendations(r, p, users, cap=args.cap), args)
        _emit("rating_rejects", D.rating_rejects(spark, args.ratings, sep=args.sep), args)
        _emit("title_rejects", D.title_rejects(spark, args.titles), args)
    elif args.program == "centred":
        r = spark.read.option("header", True).option("sep", args.sep).schema(
            "user_id long, product_id string, rating double, ts long").csv(args.ratings)
        for k, v in REC.centred_cosine_report(r, args.user_id, args.product_id, args.user_id_cap).items():
            _emit(k, v, args)
        _emit("rating_rejects", D.csv_rating_rejects(spark, args.ratings, sep=args.sep, id_type="string"), args)
    elif args.program == "als":
        r = D.read_ratings_delimited(spark, args.ratings, sep=args.sep)
        p = D.read_product_titles(spark, args.titles, sep=args.titles_sep)
        prof = D.load_personal_ratings(spark, args.profile)
        uid = args.profile_user_id
        if uid is None:
            ids = [row[0] for row in prof.select("user_id").distinct().limit(2).collect()]
            if len(ids) > 1:
                ap.error("the profile file holds several users; choose one with --profile-user-id")
            uid = ids[0]
        res = REC.als_recommender(r, p, prof, uid, tuple(int(x) for x in args.ranks.split(",")),
                                  tuple(float(x) for x in args.lambdas.split(",")),
                                  tuple(int(x) for x in args.iterations.split(",")), serve_as=args.serve_as)
        for k, v in res.items():
            _emit(k, v, args)
        _emit("rating_rejects", D.rating_rejects(spark, args.ratings, sep=args.sep), args)
        _emit("title_rejects", D.title_rejects(spark, args.titles, sep=args.titles_sep), args)
    elif args.program == "encode":
        raw = spark.read.option("header", True).schema(
            "user_id string, product_id string, rating double, ts long").csv(args.ratings)
        meta = None
        if args.metadata:
            meta = MD.project_metadata(MD.metadata_records(MD.read_metadata_json(spark, args.metadata)))
        made = REC.encode_ratings(raw, meta)
        for k, v in made.items():
            _emit(k, v, args)
        _emit("rating_rejects", D.csv_rating_rejects(spark, args.ratings, id_type="string"), args)
        if args.out:  # the text that the other programs read
            D.write_ratings_delimited(made["ratings"], f"{args.out.rstrip('/')}/ratings.txt", sep="|")
            if "titles" in made:
                D.write_titles_delimited(made["titles"], f"{args.out.rstrip('/')}/titles.txt")
    elif args.program == "metadata":
        df = MD.read_metadata_json(spark, args.path)
        _emit("metadata", MD.project_metadata(MD.metadata_records(df)), args)
        _emit("rejects", MD.metadata_rejects(df), args)


if __name__ == "__main__":
    main()
