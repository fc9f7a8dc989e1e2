"""Command line: ``python -m mediacurate {download,regenerate,rebuild,caption} ...``.

Fetchers, decoders and captioners are named as ``module:attribute``; the
attribute is called without arguments to make one.
"""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import SparkSession

from mediacurate.operators.caption import EMPTY, REJECT, CaptionOptions
from mediacurate.plans import jobs


def make(spec: str | None):
    if spec is None:
        return None
    module, _, name = spec.partition(":")
    return getattr(import_module(module), name)()


def show(name: str, counts) -> None:
    """Print a table of counts."""
    for row in counts.collect():
        print(f"{name}: " + ", ".join(f"{key}={value}" for key, value in row.asDict().items()))


def parser() -> argparse.ArgumentParser:
    whole = argparse.ArgumentParser(prog="mediacurate")
    jobs = whole.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=text)
        added.add_argument("--output", required=True, help="root of the dataset")
        return added

    def checks(added: argparse.ArgumentParser) -> None:
        added.add_argument("--level", choices=["structural", "decode"], default="decode")
        added.add_argument("--decoder", help="module:attribute of a decoder factory")

    download = job("download", "fetch a source table into a dataset")
    download.add_argument("--source", required=True, help="parquet source table")
    download.add_argument("--fetcher", default="mediacurate.operators.fetch:UrlFetcher")
    download.add_argument("--threads", type=int, default=64)
    download.add_argument("--timeout", type=float, default=30)
    download.add_argument("--retries", type=int, default=3)
    download.add_argument("--clean", action="store_true", help="remove corrupt files")
    checks(download)

    regenerate = job("regenerate", "write the training manifest again")
    regenerate.add_argument("--validate", action="store_true", help="leave out corrupt files")
    regenerate.add_argument("--clean", action="store_true", help="remove them as well")
    regenerate.add_argument(
        "--delete-mode", choices=["file", "pair", "stem"], default="file", help="what goes with a corrupt file"
    )
    regenerate.add_argument("--per-file", action="store_true", help="list every valid file, not one per key")
    checks(regenerate)

    rebuild = job("rebuild", "validate and write the manifest from the sidecars")
    rebuild.add_argument("--clean", action="store_true", help="remove corrupt files and their sidecars")
    checks(rebuild)

    caption = job("caption", "caption every unprocessed image")
    caption.add_argument("--captioner", required=True)
    caption.add_argument("--checkpoint-dir", required=True, help="where batches and the complete table go")
    caption.add_argument("--push-every", type=int, default=500, help="rows per batch")
    caption.add_argument("--publish-to", help="path for published batches; none are published without it")
    caption.add_argument("--max-images", type=int)
    caption.add_argument("--batch-size", type=int, default=1)
    caption.add_argument("--max-tokens", type=int, default=256)
    caption.add_argument("--prompt")
    caption.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    caption.add_argument("--resume-from", help="folder of an earlier run whose keys count as processed")
    caption.add_argument("--on-error", choices=[REJECT, EMPTY], default=REJECT, help="what a failing image gets")
    caption.add_argument("--task-gpus", type=float, help="GPUs of each captioning task, a share for tasks that share one")
    caption.add_argument("--task-cpus", type=int, help="cores of each captioning task")
    caption.add_argument("--take-over", action="store_true", help="after a crashed run")
    return whole


def profile_of(cpus: int | None, gpus: float | None) -> ResourceProfile | None:
    """What captioning tasks ask for, in a profile of their own; none if they ask for nothing."""
    if not cpus and not gpus:
        return None
    asked = TaskResourceRequests()
    if cpus:
        asked.cpus(cpus)
    if gpus:
        asked.resource("gpu", gpus)
    return ResourceProfileBuilder().require(asked).build


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"mediacurate {args.job}").getOrCreate()
    if args.job == "caption":
        chosen = {"batch_size": args.batch_size, "max_new_tokens": args.max_tokens}
        if args.prompt:
            chosen["prompt"] = args.prompt
        jobs.caption_dataset(
            spark,
            args.output,
            args.checkpoint_dir,
            make(args.captioner),
            rows_per_batch=args.push_every,
            max_images=args.max_images,
            resume_run=args.resume,
            publish_to=args.publish_to,
            options=CaptionOptions(**chosen),
            take_over=args.take_over,
            report=show,
            on_error=args.on_error,
            resume_from=args.resume_from,
            profile=profile_of(args.task_cpus, args.task_gpus),
        )
        return
    check = {"level": args.level, "decoder": make(args.decoder), "report": show}
    if args.job == "download":
        jobs.download(
            spark,
            args.source,
            args.output,
            make(args.fetcher),
            args.threads,
            args.timeout,
            args.retries,
            validate="clean" if args.clean else "report",
            **check,
        )
    elif args.job == "regenerate":
        choice = "none" if not args.validate else "clean" if args.clean else "report"
        jobs.regenerate(spark, args.output, choice, delete_mode=args.delete_mode, per_file=args.per_file, **check)
    else:
        jobs.rebuild(spark, args.output, args.clean, **check)


if __name__ == "__main__":
    main()
