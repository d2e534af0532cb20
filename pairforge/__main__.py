"""Command line: ``python -m pairforge build|check|subsample|rewrite ...`` (or spark-submit).

* ``build``: pair sources -> chat records -> exact seeded split -> JSON lines
  under ``--out/split=train|val``; prints records per split.
* ``check``: validates the written split files; prints per split the record
  count, problems (first 5 with their index, and how many more) and word
  statistics of user and assistant messages.
* ``subsample``: exact seeded subsample of the written split files into a new
  directory (300 train / 50 validation lines by default).
* ``rewrite``: before/after rewrites of a Parquet text table, written as
  Parquet; rewriters are factories given as ``module:function``.

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings are those of the launcher.
"""

from __future__ import annotations

import argparse
import importlib
import re
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _source(spark: SparkSession, spec: str):
    """``name=path[,path...]`` with optional trailing ``:cap=N``, ``:truncate=N``
    and ``:enabled=no``. Paths may be URIs; only these options end a spec."""
    from pairforge.operators.pairs import parquet_source

    head, kv = split_spec(spec)
    name, _, paths = head.partition("=")
    return parquet_source(
        spark, name, paths.split(","), cap=kv.get("cap"), truncate_input=kv.get("truncate"), enabled=kv.get("enabled", True)
    )


def split_spec(spec: str) -> tuple[str, dict]:
    """The part before the trailing options, and the options."""
    opts: dict = {}
    while m := re.search(r":(?:(cap|truncate)=(\d+)|(enabled)=(yes|no))$", spec):
        opts[m[1] or m[3]] = int(m[2]) if m[1] else m[4] == "yes"
        spec = spec[: m.start()]
    return spec, opts


def _json_source(spark: SparkSession, spec: str):
    from pairforge.operators.pairs import json_array_source

    head, kv = split_spec(spec)
    name, _, path = head.partition("=")
    src = json_array_source(spark, name, path, cap=kv.get("cap"))
    if src is None:
        print(f"skipped, not found: {path}")
    return src


def _factory(ref: str):
    mod, _, fn = ref.partition(":")
    return getattr(importlib.import_module(mod), fn)


def cmd_build(spark: SparkSession, args) -> None:
    from pairforge.plans.build import run_build

    sources = [_source(spark, s) for s in args.source]
    sources += [s for s in (_json_source(spark, x) for x in args.json_source) if s is not None]
    group_cols = {None: None, "input": ("abstract",), "pair": ("abstract", "plain_summary")}[args.together]
    for r in run_build(spark, sources, args.out, args.val_ratio, args.seed, group_cols=group_cols, versioned=args.versioned).collect():
        print(f"{r['split']}: {r['records']} records ({r['status']})")


def cmd_check(spark: SparkSession, args) -> None:
    from pairforge.operators.validate import problem_head, validate_records
    from pairforge.plans.check import check_split_files, first_record
    from pairforge.sources.jsonl import LINE_ORDER, load_jsonl

    summary = sorted(check_split_files(spark, args.dir).collect(), key=lambda r: r["file"])
    for s in summary:
        print(f"\nsplit {s['file']}: {s['records']} records, {s['invalid']} with problems ({s['status']})")
        if s["invalid"]:
            # every line is JSON here (check_split_files raised otherwise); the
            # split's folder alone is read
            part = load_jsonl(spark, f"{args.dir}/split={s['file']}", mode="collect").filter("valid")
            rows = sorted(problem_head(validate_records(part), LINE_ORDER, 5).collect(), key=lambda r: r["idx"])
            for r in rows:
                print(f"  at {r['idx']}: {r['problems']}")
            if rows and rows[0]["more"]:
                print(f"  and {rows[0]['more']} others")
        print(f"  words of user turns: {s['user_words']}")
        print(f"  words of assistant turns: {s['assistant_words']}")
    if any(s["file"] == "train" and s["records"] for s in summary):
        print(f"\nfirst training record:\n{first_record(spark, args.dir).first()['value']}")


def cmd_subsample(spark: SparkSession, args) -> None:
    from pairforge.plans.subsample import subsample_files

    from pairforge.plans.subsample import SUBSAMPLE_SIZES

    sizes = dict(SUBSAMPLE_SIZES)
    sizes.update((k, int(v)) for k, v in (x.split("=") for x in args.size or []))
    for r in sorted(subsample_files(spark, args.dir, args.out, sizes, args.seed).collect()):
        print(f"{r['split']}: {r['records']} records")


def cmd_rewrite(spark: SparkSession, args) -> None:
    from pairforge.operators.rewrite import compare_rewrites

    df = spark.read.parquet(*args.input).select(args.key_col, args.text_col)
    out = compare_rewrites(df, _factory(args.base), _factory(args.tuned), (args.key_col,), args.text_col)
    out.write.mode("overwrite").parquet(args.out)
    print(f"wrote {args.out}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="pairforge")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="pairs -> chat records -> split JSON lines")
    b.add_argument("--source", action="append", required=True, help="name=path[,path]:cap=N:truncate=N (repeat, in order)")
    b.add_argument("--json-source", action="append", default=[], help="name=path of a JSON array of pairs, :cap=N (repeat; after the others)")
    b.add_argument("--out", required=True)
    b.add_argument("--val-ratio", type=float, default=0.1)
    b.add_argument("--seed", type=int, default=42)
    b.add_argument("--together", choices=["input", "pair"], help="keep equal inputs, or equal pairs, on one side of the split")
    b.add_argument("--versioned", action="store_true", help="publish a new version of the output in place of overwriting it")
    c = sub.add_parser("check", help="validate written split files")
    c.add_argument("dir")
    ss = sub.add_parser("subsample", help="exact seeded subsample of written split files into a new directory")
    ss.add_argument("dir")
    ss.add_argument("--out", required=True)
    ss.add_argument("--size", action="append", default=None, help="split=N (repeatable; default train=300, val=50)")
    ss.add_argument("--seed", type=int, default=42)
    r = sub.add_parser("rewrite", help="before/after rewrites of a text table")
    r.add_argument("--input", nargs="+", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--key-col", default="doc_id")
    r.add_argument("--text-col", default="text")
    r.add_argument("--base", default="pairforge.operators.rewrite:squeeze_factory")
    r.add_argument("--tuned", default="pairforge.operators.rewrite:sentence_lines_factory")
    args = p.parse_args(argv)

    from pairforge.session import apply_required_conf, ship_by_value

    spark = spark or SparkSession.builder.getOrCreate()
    apply_required_conf(spark)
    ship_by_value()
    {"build": cmd_build, "check": cmd_check, "subsample": cmd_subsample, "rewrite": cmd_rewrite}[args.cmd](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
