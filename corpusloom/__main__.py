"""Command line: build a list from a text corpus, or print counts."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import counts as C
from .operators import quality as Q
from .plans.build import Inputs, build
from .sources import config, readers, sinks


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="corpusloom")
    p.add_argument("command", choices=["build", "counts"])
    p.add_argument("--config", required=True)
    p.add_argument("--dictionary")
    p.add_argument("--lemmas")
    p.add_argument("--stage", type=int, default=2)
    p.add_argument("--sample", type=int)
    p.add_argument("--top", type=int, default=50)
    p.add_argument("--set", action="append", default=[], metavar="PATH=VALUE")
    a = p.parse_args(argv)
    cfg = config.load(a.config, a.stage).with_overrides({k: config.coerce(v) for k, _, v in (s.partition("=") for s in a.set)})
    if a.sample:
        cfg = cfg.with_overrides({"corpus.sample_lines": a.sample})
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    lines = readers.read_lines(spark, cfg["corpus"]["path"], cfg["corpus"]["sample_lines"], cfg["corpus"]["partitions"])
    if a.command == "counts":
        C.ranked(C.unigrams(lines), a.top).orderBy("rank").show(a.top, False)
        return
    made = build(Inputs(lines, readers.read_dictionary(spark, a.dictionary), readers.read_table(spark, a.lemmas, "overrides", header=False)), cfg)
    out = cfg.root
    sinks.write_bands(made.entries, [tuple(b) for b in cfg["output"]["bands"]], out)
    sinks.write_lines(sinks.dropped_lines(made.dropped, cfg["output"]["dropped_from"]), f"{out}/dropped")
    sinks.write_table(made.suspects, f"{out}/suspects", "entry_rank", "kind", "entry")
    Q.enforce(made.suspects)


if __name__ == "__main__":
    main()
