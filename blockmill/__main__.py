"""Command line: ``python -m blockmill build|audit|rows|batches|steps``, or spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation, SparkSession

from blockmill import config
from blockmill.config import PackSettings, TokenProfile
from blockmill.functions import ByteTokenizer, FileTokenizer
from blockmill.operators.ranks import step_plan
from blockmill.plans.build import build, resume, shards_of
from blockmill.plans.reader import read_batches, read_training_rows
from blockmill.sources import audit_manifest, scan_manifest, scan_sources, spec_list


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="blockmill")
    commands = top.add_subparsers(dest="command", required=True)

    b = commands.add_parser("build", help="mix, pack and write shards")
    b.add_argument("--out_dir", required=True)
    b.add_argument("--sources_json", required=True)
    b.add_argument("--total_tokens", type=int, required=True)
    b.add_argument("--seq_len", type=int, default=config.DEFAULT_SEQ_LEN)
    b.add_argument("--blocks_per_shard", type=int, default=config.DEFAULT_BLOCKS_PER_SHARD)
    b.add_argument("--seed", type=int, default=config.DEFAULT_SEED)
    b.add_argument("--resume", action="store_true")
    b.add_argument("--base", default="", help="folder that the dataset paths start from")
    b.add_argument("--tokenizer", help="a tokenizer.json; bytes without one")
    b.add_argument("--eos_token", help="end-of-text token of the tokenizer file")
    b.add_argument("--doc_id", action="append", default=[], metavar="SOURCE=EXPRESSION")
    b.add_argument("--format", action="append", default=[], metavar="SOURCE=FORMAT")

    for name, text in (("rows", "training rows"), ("batches", "micro-batches")):
        r = commands.add_parser(name, help=f"write {text} with their rank")
        r.add_argument("--packed_dir", required=True)
        r.add_argument("--output_dir", required=True)
        r.add_argument("--seq_len", type=int, default=config.DEFAULT_SEQ_LEN)
        r.add_argument("--world", type=int, default=1)
        r.add_argument("--shuffle_seed", type=int)
        r.add_argument("--vocab_size", type=int, default=TokenProfile.vocab_size)
        r.add_argument("--pad_id", type=int, default=TokenProfile.pad_id,
                       help="masked id; one that no token has, as -1, supervises all")
        r.add_argument("--micro_batch_size", type=int, default=1)
        r.add_argument("--manifest", help="read only the shards that it lists")

    a = commands.add_parser("audit", help="recount and rehash the shards of a build")
    a.add_argument("--out_dir", required=True)
    a.add_argument("--seq_len", type=int, default=config.DEFAULT_SEQ_LEN)
    a.add_argument("--report_dir", help="folder of the full report; out_dir/audit without one")

    s = commands.add_parser("steps", help="steps of one pass over a build")
    s.add_argument("--out_dir", required=True)
    s.add_argument("--seq_len", type=int, default=config.DEFAULT_SEQ_LEN)
    s.add_argument("--micro_batch_size", type=int, default=1)
    s.add_argument("--world", type=int, default=1)
    s.add_argument("--grad_accum_steps", type=int, default=1)
    return top


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("blockmill").getOrCreate()
    if args.command == "build":
        specs = spec_list(args.sources_json)
        doc_ids, formats = (dict(p.split("=", 1) for p in ps) for ps in (args.doc_id, args.format))
        docs = scan_sources(spark, specs, args.base, doc_ids, formats)
        if args.tokenizer:
            tokenizer = FileTokenizer.load(spark, args.tokenizer, args.eos_token)
        else:
            tokenizer = ByteTokenizer()
        settings = PackSettings(args.seq_len, args.total_tokens, args.blocks_per_shard, args.seed)
        plan = (resume if args.resume else build)(docs, specs, settings, tokenizer, args.out_dir)
        print(f"blocks={plan.n_blocks} tokens={plan.n_blocks * args.seq_len} out_dir={args.out_dir}")
    elif args.command in ("rows", "batches"):
        profile = TokenProfile(args.vocab_size, pad_id=args.pad_id)
        common = (spark, args.packed_dir, args.seq_len, profile)
        if args.command == "rows":
            seen = Observation("lengths")
            out = read_training_rows(*common, args.world, args.shuffle_seed, args.manifest, seen)
        else:
            out = read_batches(*common, args.micro_batch_size, args.world, args.shuffle_seed, args.manifest)
        out.write.partitionBy("rank").parquet(args.output_dir)
        if args.command == "rows":
            found = seen.get
            print(f"rows_read={found['rows_read']} rows_skipped={found['rows_skipped']}")
            if found["rows_read"] and found["rows_read"] == found["rows_skipped"]:
                raise SystemExit(f"no row has {args.seq_len} ids")
    elif args.command == "audit":
        report = audit_manifest(
            spark, shards_of(args.out_dir), f"{args.out_dir}/manifest", args.seq_len
        )
        report_dir = args.report_dir or f"{args.out_dir}/audit"
        report.write.mode("overwrite").json(report_dir)
        counts = spark.read.schema(report.schema).json(report_dir).groupBy("verdict").count()
        for verdict, n in sorted(map(tuple, counts.collect())):
            print(f"{verdict}={n}")
        print(f"report={report_dir}")
    else:
        lines = scan_manifest(spark, f"{args.out_dir}/manifest")
        step_plan(lines, args.seq_len, args.micro_batch_size, args.world, args.grad_accum_steps).show()


if __name__ == "__main__":
    main()
