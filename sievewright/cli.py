"""The command line: each command reads the manifest, runs its plan, shows the report, and writes the manifest back."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sievewright.operators import manifest, pixels, tree
from sievewright.plans import commands, config, render
from sievewright.schema import CLASSES, Thresholds
from sievewright.scratch import written


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sievewright", description=__doc__)
    p.add_argument("--manifest", default="dataset/manifest.jsonl")
    p.add_argument("--images", default="dataset/images")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *options: tuple) -> None:
        s = sub.add_parser(name)
        for flags, kw in options:
            s.add_argument(*flags, **kw)

    number, flag = {"type": int}, {"action": "store_true"}
    add("audit", (("--path",), {}), (("--min-short-side",), number), (("--min-sharpness",), {"type": float}), (("--write-manifest",), flag))
    add("ingest", (("--source",), {"required": True}), (("--source-name",), {"default": "local"}))
    add("recover", (("--dry-run",), flag), (("--limit",), number | {"default": 600}), (("--category",), {"action": "append"}), (("--candidates",), {"help": "Parquet of candidates with their hashes"}), (("--thumbs",), {"default": "dataset/thumbs", "help": "folder for thumbnails of candidates that are listed now"}))
    add("fetch", (("--source",), {"action": "append"}), (("--klass",), {"choices": CLASSES}), (("--limit",), number | {"default": 100}), (("--dry-run",), flag), (("--allow-unknown-license",), flag), (("--secrets",), {"default": "config/secrets.yaml", "help": "YAML or JSON: for each source its options, such as api_key"}))
    add("refilter", (("--min-short-side",), number | {"required": True}), (("--klass",), {"choices": CLASSES}))
    add("relicense")
    add("synthesize", (("--count",), number | {"default": 100}), (("--steps",), number | {"default": 30}), (("--ip-adapter-scale",), {"type": float, "default": 0.35}), (("--seed",), number | {"default": 7797676568}), (("--reference-dir",), {"required": True}))
    add("classify", (("--overwrite",), flag))
    add("caption", (("--overwrite",), flag))
    add("sheet", (("--out",), {"default": "dataset/sheet.html"}), (("--title",), {"default": "Revisión del dataset"}), (("--only-rejected",), flag), (("--klass",), {"choices": CLASSES}))
    add("export", (("--out",), {"default": "dataset/train"}), (("--keep",), flag))
    add("reject", (("filenames",), {"nargs": "+"}), (("--reason",), {}))
    add("restore", (("filenames",), {"nargs": "+"}))
    add("report", (("--attributions",), {"nargs": "?", "const": "dataset/ATTRIBUTIONS.md"}))
    return p


def _queries(settings: dict, klass: str | None) -> dict[str, list[str]]:
    from sievewright.operators.classes import GROUP_CLASS

    out: dict[str, list[str]] = {}
    for group, name in GROUP_CLASS.items():
        if klass in (None, name):
            out[name] = [f"Category:{c}" for c in (settings.get("wikimedia_categories") or {}).get(group) or []] + list((settings.get("search_terms") or {}).get(group) or [])
    return {k: v for k, v in out.items() if v}


def run(spark: SparkSession, argv: list[str]) -> commands.Outcome:
    """Run one command; the manifest is written back if it changed and the command is no dry run."""
    a = parser().parse_args(argv)
    records, settings = written(manifest.load(spark, a.manifest), "manifest"), config.load(a.config)
    names = lambda: spark.createDataFrame([(n,) for n in a.filenames], "filename string")
    save = not getattr(a, "dry_run", False)
    if a.command == "audit":
        out, save = commands.audit(spark, records, a.path or a.images, Thresholds().override(a.min_short_side, a.min_sharpness)), a.write_manifest
    elif a.command == "ingest":
        out = commands.ingest_folder(spark, records, a.source, a.images, a.source_name)
    elif a.command == "recover":
        if a.candidates:
            candidates = spark.read.parquet(a.candidates)
            if a.category:
                candidates = candidates.where(F.col("category").isin(a.category))
        else:
            wanted = a.category or list(dict.fromkeys(c for group in (settings.get("wikimedia_categories") or {}).values() for c in group or []))
            candidates = commands.list_candidates(spark, wanted, a.thumbs, a.limit)
        out = commands.recover(spark, records, candidates)
    elif a.command == "fetch":
        secrets = config.load(a.secrets) if a.secrets and os.path.exists(a.secrets) else {}
        out = commands.fetch(spark, records, a.source or ["wikimedia"], _queries(settings, a.klass), a.limit, a.allow_unknown_license, secrets, None if a.dry_run else a.images)
    elif a.command == "refilter":
        out = commands.refilter(records, a.min_short_side, a.klass)
    elif a.command == "relicense":
        out = commands.relicense(records)
    elif a.command == "synthesize":
        from sievewright.operators.ingest import list_references

        out = commands.synthesize(spark, records, list_references(spark, a.reference_dir), a.count, a.seed)
    elif a.command == "classify":
        out = commands.classify(spark, records, a.overwrite, settings)
    elif a.command == "caption":
        out = commands.caption(records, a.overwrite)
    elif a.command == "sheet":
        shown = records.where("rejected") if a.only_rejected else records
        shown = shown.where(F.col("klass") == a.klass) if a.klass else shown
        thumbs = pixels.thumb_uris(spark, a.images).select(F.col("name").alias("filename"), "uri") if os.path.isdir(a.images) else None
        with_uri = shown.join(thumbs, "filename", "left") if thumbs is not None else shown.withColumn("uri", F.lit(None).cast("string"))
        tree.write_sheet(with_uri, a.out, a.title, F.col("uri"))
        out = commands.Outcome()
    elif a.command == "export":
        out = commands.export_tree(spark, records, a.images)
        if not a.keep:
            tree.clean(a.out)
        paths = written(out.report["paths"], "export-paths")
        done = tree.write_tree(paths.where("not converted"), a.images, a.out).unionByName(tree.write_recoded(paths.where("converted"), pixels.decoded(spark, a.images), a.out))
        out.report["written"] = written(done, "export-done")
        tree.write_csv(out.report["paths"], f"{a.out}/captions_SDXL.csv")
        tree.write_readme(out.report["paths"], f"{a.out}/README.md")
    elif a.command == "reject":
        out = commands.reject(records, names(), a.reason)
    elif a.command == "restore":
        out = commands.restore(records, names())
    else:
        out = commands.report(records)
        if a.attributions:
            tree.write_attributions(records, a.attributions)
    if save and out.records is not None:
        manifest.save(out.records, a.manifest)
    return out


def main(argv: list[str] | None = None) -> int:
    spark = SparkSession.builder.appName("sievewright").getOrCreate()
    words = sys.argv[1:] if argv is None else argv
    print(render.report(parser().parse_args(words).command, run(spark, words).report))
    return 0


if __name__ == "__main__":
    sys.exit(main())
