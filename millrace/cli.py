"""Command line: ``python -m millrace.cli COMMAND --config FILE [--phase N]``.

freeze-inputs        write the configuration with the revisions of its local mirrors (--output FILE)
validate             check the plan, the labels and their raw rows (also: validate-datasets, with --max-documents N)
plan                 write the phase manifests (also: prepare-manifests)
prepare-token-cache  write the token cache of a phase and its audit (--split, --token-budget, --rebuild)
dry-run              print what would be done

The configuration (see config.load) names ``tables`` (upstream, plan, labels:
Parquet), ``secondary`` (a list of name, path, weight, score_gte, target_gb),
``tokenizer`` (path, eos_token_id, pad_token_id; see tokenize.FileTokenizer),
``rules`` (see pipeline.Rules), ``phases`` and ``paths``. With ``storage_root``
all folders must lie below it and revisions must be pinned.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from millrace import config as settings


class CodePoints:
    """The tokenizer of tests: one id for each code point."""

    eos_token_id = pad_token_id = 2
    vocab_size = 0x110000

    def encode(self, text: str, add_special_tokens: bool = False) -> list[int]:
        return [ord(c) for c in text]


def main(argv: Sequence[str] | None = None, spark=None, tokenizer=None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["freeze-inputs", "validate", "validate-datasets", "plan", "prepare-manifests", "prepare-token-cache", "dry-run"])
    parser.add_argument("--config", required=True)
    parser.add_argument("--phase", type=int, default=1)
    parser.add_argument("--rebuild", action="store_true")
    parser.add_argument("--output")
    parser.add_argument("--split")
    parser.add_argument("--token-budget", type=int)
    parser.add_argument("--max-documents", type=int, default=0)
    args = parser.parse_args(argv)
    config = settings.load(args.config)
    if args.command == "freeze-inputs":
        folders = {"labels": config["tables"]["labels"], **{s["name"]: s["path"] for s in config.get("secondary", [])}}
        settings.dump(settings.frozen(config, {n: settings.mirror_revision(f) for n, f in folders.items()}), args.output or args.config)
        return 0
    phase = settings.phase(config, args.phase)
    if config.get("storage_root"):
        settings.require_runnable(config, config["storage_root"])

    from millrace.operators.tokenize import FileTokenizer
    from millrace.plans import pipeline
    from millrace.sources import readers
    from millrace.sources.phases import put_json
    from millrace.sources.sinks import phase_manifest

    given = {"split": args.split, "max_tokens": args.token_budget}
    rules = pipeline.Rules(**{**config.get("rules", {}), **phase.get("rules", {}), **{k: v for k, v in given.items() if v is not None}})
    catalog = {s["name"]: s for s in config.get("secondary", [])}
    wanted = phase.get("sources", [{"dataset": n} for n in catalog])
    manifest = phase_manifest({**phase, "sources": wanted}, config.get("partitions", {}), catalog)
    if args.command == "dry-run":
        print(json.dumps({"phase": manifest, "rules": vars(rules), "tables": config["tables"]}, ensure_ascii=False, default=list))
        return 0
    if args.command in ("plan", "prepare-manifests"):
        put_json(f"{config['paths']['manifest_dir']}/phase_{args.phase}_manifest.json", manifest)
        return 0
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("millrace").getOrCreate()
    upstream, plan, labels = (spark.read.parquet(config["tables"][t]) for t in ("upstream", "plan", "labels"))
    secondary = [
        pipeline.Secondary(s["name"], readers.read_ordered_jsonl(spark, s["path"]), w.get("weight", s.get("weight", 1.0)), w.get("score_gte", s.get("score_gte")), w.get("target_gb", s.get("target_gb")))
        for w in wanted
        for s in [catalog[w["dataset"]]]
    ]
    if args.command in ("validate", "validate-datasets"):
        decided = pipeline.decided_rows(upstream, plan, labels, rules)
        if args.command == "validate":
            print(json.dumps({"verified_rows": decided.count()}))
            return 0
        accepted = decided.filter("decision = 'accepted'")
        n = (accepted.limit(args.max_documents) if args.max_documents else accepted).count()
        if not n:
            raise ValueError("no accepted text")
        for s in secondary:
            if not pipeline.secondary_texts(s, rules).limit(1).count():
                raise ValueError(f"{s.name} gives no text")
        print(json.dumps({"accepted_rows": n, "secondary": [s.name for s in secondary], "whole": not args.max_documents}))
        return 0
    if tokenizer is None and "tokenizer" in config:
        tokenizer = FileTokenizer(**config["tokenizer"])
    done = pipeline.prepare_token_cache(spark, upstream, plan, labels, secondary, tokenizer or CodePoints(), config["paths"]["cache_dir"], rules, args.phase, args.rebuild)
    print(json.dumps({k: done[k] for k in ("complete", "total_chunks", "total_tokens", "source_token_counts")}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
