"""The whole build: tasks to episodes to examples to filters to a sink."""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from parley.functions import formats, picks
from parley.operators import filters, grouping, windowing
from parley.plans import tasks

ORDER = ["part", "file", "row", "sub", "ex"]


@dataclass
class Config:
    """What a build is told; unknown names are refused before anything runs."""

    tasks: list[str]
    output: str = ""
    fmt: str = "markers"
    filters: list[str] = field(default_factory=list)
    max_length: int = windowing.BUDGET
    show: bool = False
    seed: int = picks.SEED
    start: int = 0
    max_count: int = 0
    mode: str = "reference"
    policy: str = "reference"
    root: str | None = None

    def check(self) -> None:
        if not self.show and not self.output.strip():
            raise ValueError("an output folder is needed, or show")
        formats.lookup(self.fmt)
        for names, known in ((self.tasks, tasks.TASKS), (self.filters, filters.FILTERS)):
            for n in names:
                if n not in known:
                    raise ValueError(f"unknown name {n!r}; there are {', '.join(sorted(known))}")


def examples(spark: SparkSession, config: Config) -> DataFrame:
    """All examples of a build with their order columns; tasks come in the order they are named, repeats too."""
    made = []
    for name in config.tasks:
        episodes = tasks.run(spark, name, config.root, config.seed, config.mode)
        made.append(windowing.examples(episodes, config.max_length, config.fmt, config.policy, config.seed))
    out = filters.apply_all(grouping.chain(*made), config.filters, ORDER)
    if config.start or config.max_count:
        out = grouping.window_of(out, ORDER, config.start, config.max_count, config.mode)
    return out


def write(found: DataFrame, path: str, single_file: bool = False) -> None:
    """JSON Lines of prompt, generation and identifier, in order: files sort by name, rows within files."""
    rows = found.orderBy(*[c for c in ORDER if c in found.columns]).select("prompt", "generation", "identifier")
    (rows.coalesce(1) if single_file else rows).write.mode("errorifexists").json(path)


def show(found: DataFrame, out=None) -> None:
    """Print examples one by one; episodes and examples have headers."""
    out = out or sys.stdout
    episode = None
    for r in found.orderBy(*[c for c in ORDER if c in found.columns]).toLocalIterator():
        name = r["identifier"].rpartition("-")[0]
        if name != episode:
            print("\x1b[30;42m     episode     \x1b[0m", name, file=out)
            episode = name
        print("\x1b[30;43m     example     \x1b[0m", file=out)
        print(f"\x1b[90m{r['prompt']}\x1b[0m\x1b[32m{r['generation']}\x1b[0m", file=out)


def run(spark: SparkSession, config: Config) -> None:
    config.check()
    found = examples(spark, config)
    if config.show:
        show(found)
    else:
        write(found, config.output)


def parse(argv: list[str]) -> Config:
    p = argparse.ArgumentParser(prog="parley", description="Build conversational training examples.")
    names = lambda s: [x for x in s.split(",") if x]
    options = {
        "-t --tasks": dict(required=True, type=names, help="names of tasks, parted by commas"),
        "-o --output-file": dict(help="folder for JSON Lines", default=""),
        "-f --filters": dict(default=[], type=names, help="names of filters, parted by commas"),
        "-l --max-length": dict(help="tokens of an example", default=windowing.BUDGET, type=int),
        "-m --format": dict(default="markers", help=", ".join(formats.FORMATS)),
        "-p --print": dict(help="print examples and write nothing", action="store_true"),
        "-v --verbose": dict(help="log more", action="store_true"),
        "--seed": dict(default=picks.SEED, type=int),
        "--starting-index": dict(help="first example, from 1", default=0, type=int),
        "--max-count": dict(help="number of examples; 0: all", default=0, type=int),
        "--mode": dict(choices=tasks.MODES, default="reference"),
        "--policy": dict(choices=windowing.POLICIES, default="reference"),
        "--data": dict(help="folder of the sources"),
    }
    for flags, what in options.items():
        p.add_argument(*flags.split(), **what)
    a = p.parse_args(argv)
    return Config(a.tasks, a.output_file, a.format, a.filters, a.max_length, a.print, a.seed, a.starting_index, a.max_count, a.mode, a.policy, a.data)


def main(argv: list[str] | None = None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    config = parse(argv)
    config.check()
    spark = SparkSession.builder.appName("parley").getOrCreate()
    spark.sparkContext.setLogLevel("INFO" if {"-v", "--verbose"} & set(argv) else "WARN")
    run(spark, config)
