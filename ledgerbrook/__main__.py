"""``spark-submit -m``-style entry: ``python -m ledgerbrook <job> --balance ... --out ...``.

The options of a job are the parameters of its function in ``plans.jobs``.
"""

from __future__ import annotations

import argparse
import inspect

from .plans.jobs import JOBS
from .session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerbrook")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, run in JOBS.items():
        sub = jobs.add_parser(name, help=(run.__doc__ or name).splitlines()[0])
        for parameter in list(inspect.signature(run).parameters.values())[1:]:
            flag = "--" + parameter.name.replace("_", "-")
            default = parameter.default
            if default is inspect.Parameter.empty:
                sub.add_argument(flag, required=True)
            elif isinstance(default, bool):
                sub.add_argument(flag, action=argparse.BooleanOptionalAction, default=default)
            else:
                kind = int if isinstance(default, int) else str
                sub.add_argument(flag, type=kind, default=default)
    return parser


def main(argv: list[str] | None = None) -> None:
    options = vars(_parser().parse_args(argv))
    run = JOBS[options.pop("job")]
    counts = run(build_session("ledgerbrook"), **options)
    for what, n in (counts or {}).items():
        print(f"{what}: {n}")


if __name__ == "__main__":
    main()
