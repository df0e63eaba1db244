"""Commands: build, verify, finalize, stage."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from gridcube.config import GridConfig
from gridcube.functions.fixed import DIGESTS, PHASES, VERIFY_DEFAULTS
from gridcube.plans import build, finalize, stage, verify
from gridcube.session import tune

LOG = logging.getLogger("gridcube")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridcube", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str):
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--log-file", help="append the log here as well")
        return sub

    def configured(name: str, text: str):
        sub = command(name, text)
        sub.add_argument("--config", required=True)
        sub.add_argument("--variable", help="one variable, in either spelling; all of the family if left out")
        return sub

    sub = configured("build", "build or resume stores")
    sub.add_argument("--force", action="store_true", help="rebuild a published store")
    sub = configured("verify", "audit stores against their raw files")
    sub.add_argument("--phases", default=",".join(verify.DEFAULT_PHASES), help=f"some of {','.join(PHASES)}")
    sub.add_argument("--compare-with", help="configuration of the other layout, for the metadata phase")
    for option, default in VERIFY_DEFAULTS.items():
        sub.add_argument(f"--{option.replace('_', '-')}", type=int, default=default)
    sub.add_argument("--digests", choices=DIGESTS, default=DIGESTS[0], help="what the cells of all chunks are compared with")
    sub = configured("finalize", "status, attributes, tag or garbage collection of a store")
    action = sub.add_mutually_exclusive_group(required=True)
    action.add_argument("--status", action="store_true")
    action.add_argument("--attrs", action="store_true")
    action.add_argument("--tag", metavar="NAME")
    action.add_argument("--gc", action="store_true")
    sub.add_argument("--apply", action="store_true", help="write; without it, report only")
    sub = command("stage", "copy a window of raw files")
    sub.add_argument("--source-config", required=True)
    sub.add_argument("--fixture-config", required=True)
    sub.add_argument("--variables", required=True, help="comma separated")
    sub.add_argument("--years", help="comma separated; all if left out")
    sub.add_argument("--lat", type=int, nargs=2, required=True)
    sub.add_argument("--lon", type=int, nargs=2, required=True)
    sub.add_argument("--restage", action="store_true")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.command == "stage":
        years = [int(y) for y in args.years.split(",")] if args.years else None
        n = stage.stage_window(
            spark, GridConfig.load(args.source_config), GridConfig.load(args.fixture_config),
            args.variables.split(","), tuple(args.lat), tuple(args.lon), years, args.restage,
        )
        LOG.info("staged %d files", n)
        return 0
    config = GridConfig.load(args.config)
    if args.command == "build":
        for name, n in build.build_family(spark, config, args.variable, args.force).items():
            LOG.info("%s: %d commits", name, n)
        return 0
    if args.command == "verify":
        other = GridConfig.load(args.compare_with) if args.compare_with else None
        options = {k: getattr(args, k) for k in (*VERIFY_DEFAULTS, "digests")}
        phases = [p.strip() for p in args.phases.split(",") if p.strip()]
        audits = verify.verify_family(spark, config, args.variable, phases, other, **options)
        for audit in audits:
            for phase, label, ok, detail in audit.checks:
                LOG.info("%s  %s: %s  %s", "PASS" if ok else "FAIL", phase, label, detail)
            for phase, note in audit.notes:
                LOG.info("note  %s: %s", phase, note)
        failed = [label for a in audits for label in a.failures]
        LOG.info("%d checks, %d failures", sum(len(a.checks) for a in audits), len(failed))
        return 1 if failed else 0
    store, config = finalize.open_for(spark, config, args.variable)
    if args.status:
        for key, value in finalize.status(store, config).items():
            LOG.info("%-20s %s", key, value)
        return 0
    if args.attrs:
        LOG.info("%s", finalize.write_attrs(store, config, args.apply))
        return 0
    if args.tag:
        return finalize.create_tag(store, args.tag, args.apply)
    return finalize.collect(store, args.apply)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stdout)]
    if args.log_file:
        handlers.append(logging.FileHandler(args.log_file, mode="a"))
    logging.basicConfig(
        level=logging.INFO, handlers=handlers, format="%(asctime)s [%(levelname)s] %(name)s: %(message)s"
    )
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = tune(SparkSession.builder.appName("gridcube").getOrCreate())
    return run(spark, args)
