"""``python -m lexloom <job> key=value ...``: run one job of ``lexloom.plans.jobs``.

Lists are comma-separated; a label switch is on only for "true" in any case.
"""

from __future__ import annotations

import inspect
import sys

from .operators.rows import label_flag
from .plans import jobs
from .session import build_session


def available() -> dict:
    return {
        name.replace("_", "-"): fn
        for name, fn in vars(jobs).items()
        if inspect.isfunction(fn) and fn.__module__ == jobs.__name__ and not name.startswith("_")
    }


def arguments(fn, pairs: list[str]) -> dict:
    kinds = {n: p.annotation for n, p in inspect.signature(fn).parameters.items()}
    given = dict(p.split("=", 1) for p in pairs)
    cast = {"bool": label_flag, "int": int, "list[str]": lambda v: v.split(",")}
    return {k: cast.get(str(kinds[k]), str)(v) for k, v in given.items()}


def main(argv: list[str]) -> int:
    commands = available()
    if not argv or argv[0] not in commands:
        print("jobs:", *(f"  {n}{inspect.signature(f)}" for n, f in sorted(commands.items())), sep="\n")
        return 2
    fn = commands[argv[0]]
    spark = build_session(f"lexloom {argv[0]}")
    fn(spark, **arguments(fn, argv[1:]))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
