"""``python -m starflow --root <folder> <step>``, or the same through spark-submit."""

import argparse

from starflow import session
from starflow.sources.broker import broker_options, broker_stream
from starflow.star import Star

STEPS = ("land", "clean", "dim_department", "dim_patient", "timeline", "fact", "resolve", "fold", "kpi", "serve")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starflow")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="folder of all tables, reachable by every executor")
    parser.add_argument("--servers", help="broker addresses (land)")
    parser.add_argument("--topic", help="topic to read (land)")
    parser.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE", help="broker option, may be repeated (land)"
    )
    parser.add_argument("--backfilled", action=argparse.BooleanOptionalAction, default=True, help="read the backfill folder too (clean)")
    parser.add_argument("--every", help="run on at this interval, such as '1 minute', instead of once")
    parser.add_argument("--export", help="folder for the exports (serve)")
    parser.add_argument("--keep", type=int, default=2, help="superseded versions that stay on disk (dim_patient, fact, resolve)")
    parser.add_argument("--max-files", type=int, help="files in a batch at most (dimensions, fact)")
    parser.add_argument("--late-guard", action="store_true", help="older events do not supersede newer ones (dim_patient)")
    parser.add_argument("--horizon", help="remember members for so long, such as '1 day' (dim_department)")
    parser.add_argument("--first-version", type=int, help="number of the first batch's version (dimensions, fact)")
    parser.add_argument("--input-bytes", type=int, help="size of the input, to size shuffles by; needs --cores")
    parser.add_argument("--cores", type=int, help="cores of the cluster")
    args = parser.parse_args(argv)

    sizes = session.sizing(args.input_bytes, args.cores) if args.input_bytes and args.cores else {}
    star = Star(session.build(**sizes), args.root)
    run = {"trigger": {"processingTime": args.every}} if args.every else {}
    if args.step == "land":
        if not (args.servers and args.topic):
            parser.error("land needs --servers and --topic")
        options = dict(pair.split("=", 1) for pair in args.option)
        star.land(broker_stream(star.spark, broker_options(args.servers, args.topic, **options)), **run)
    elif args.step == "clean":
        star.clean(backfilled=args.backfilled, **run)
    elif args.step == "kpi":
        star.count_beds()
        star.stored_occupancy().show()
        star.stored_turnover().show()
    elif args.step == "serve":
        if not args.export:
            parser.error("serve needs --export")
        star.serve(args.export)
    elif args.step == "fold":
        print(f"folded: {', '.join(star.fold()) or 'nothing'}")
    elif args.step == "resolve":
        print(f"dates changed: {star.resolve(keep=args.keep)}")
    else:
        options = {"max_files": args.max_files}
        if args.step != "timeline":
            options["first_version"] = args.first_version
        if args.step == "dim_department":
            options["horizon"] = args.horizon
        if args.step in ("dim_patient", "timeline", "fact"):
            options["keep"] = args.keep
        if args.step == "dim_patient":
            options["late_guard"] = args.late_guard or None
        getattr(star, args.step)(**run, **{k: v for k, v in options.items() if v is not None})


if __name__ == "__main__":
    main()
