"""Command line: ``spark-submit -m epochloom <job> ...`` or ``python -m epochloom <job> ...``."""

from __future__ import annotations

import argparse

from epochloom.constants import REST_WEIGHT, TRAIN_RATIO
from epochloom.plans import jobs
from epochloom.session import build_session


def _numbers(text: str) -> list[int]:
    return [int(part) for part in text.split(",")]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="epochloom")
    commands = top.add_subparsers(dest="job", required=True)

    def job(name: str, help_text: str, *required: str, **optional) -> None:
        command = commands.add_parser(name, help=help_text)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        for option, (kind, default) in optional.items():
            flag = f"--{option.replace('_', '-')}"
            if kind is bool:
                command.add_argument(flag, action="store_true")
            else:
                command.add_argument(flag, type=kind, default=default)

    job("ingest", "convert EDF recordings that have not landed yet", "recordings", "landed", metrics=(str, None))
    job("features", "band powers and z-scores per epoch", "landed", "out", weight=(float, REST_WEIGHT))
    job("train", "tune and store a random forest", "features", "model", "metrics", runs=(str, None),
        importances=(str, None), trees=(_numbers, [50, 100]), depths=(_numbers, [5, 10]), folds=(int, 3),
        ratio=(float, TRAIN_RATIO))
    job("evaluate", "score the held-out subjects", "features", "model", "predictions", "metrics",
        ratio=(float, TRAIN_RATIO))
    job("export", "tables for a dashboard", "landed", "features", "predictions", "out",
        subject=(str, "S001"), run=(str, "R03"))
    job("replay", "land a recording as live epochs", "landed", "out", subject=(str, "S001"), run=(str, "R04"),
        start=(str, None), rate=(float, 0.5), duration=(float, 300.0), files=(int, None), loop=(bool, False))
    job("stream", "score live epochs", "source", "out", "checkpoint", "landed", "model",
        timeout=(float, 3600.0), files_per_trigger=(int, 1), once=(bool, False), trees=(int, 300), depth=(int, 18),
        training_recordings=(int, jobs.LIVE_TRAINING_RECORDINGS))
    return top


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    name = options.pop("job")
    for short, long in (("features", "features_path"), ("model", "model_path")):
        if short in options:
            options[long] = options.pop(short)
    result = getattr(jobs, name)(build_session(f"epochloom-{name}"), **options)
    if hasattr(result, "show"):
        result.show(truncate=False)
    elif result is not None:
        print(result)


if __name__ == "__main__":
    main()
