"""The commands: each a short plan over the manifest, from one table to the next.

A command returns what it found (small frames) and, where it changes records, the
new manifest; writing it back is the caller's last step, so a dry run is one that
does not take that step.
"""

from __future__ import annotations

import shutil
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright import sources
from sievewright.functions.bits import from_hex
from sievewright.functions.text import CaptionWords, none_if_empty
from sievewright.functions.verdicts import add_reason, filter_reasons, is_panoramic, is_rejected, mode_note
from sievewright.operators import classes, discovery, duplicates, export, ingest, manifest, pixels, provenance, reports, tree
from sievewright.plans import config
from sievewright.schema import RECORD, Thresholds
from sievewright.scratch import written
from sievewright.sources import europepmc, http


@dataclass
class Outcome:
    """``records`` is the manifest afterwards (None: unchanged), ``report`` small frames by name."""

    records: DataFrame | None = None
    report: dict[str, DataFrame] = field(default_factory=dict)


def _conform(df: DataFrame) -> DataFrame:
    """The record's columns in order, missing ones null, then its defaults."""
    kinds = {f.name: f.dataType for f in RECORD.fields}
    return manifest.with_defaults(df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in RECORD.names]))


def judged(records: DataFrame, metrics: DataFrame, t: Thresholds, order: Column | None = None) -> DataFrame:
    """Records with their metrics and the pixel verdicts; unreadable pictures keep their old metrics and get that reason."""
    m = metrics.select(F.col("name").alias("filename"), F.struct(*[c for c in metrics.columns if c not in ("name", "error")]).alias("m_"), F.col("error").alias("error_"))
    rows = records.join(m, "filename", "left")
    good = F.col("m_").isNotNull() & F.col("error_").isNull()
    copied = ("width", "height", "mode", "bytes", "phash", "sharpness", "saturation")
    bad = F.when(F.col("error_").isNotNull(), add_reason(F.col("reject_reasons"), "unreadable")).otherwise(F.col("reject_reasons"))
    note = F.concat(F.lit("no se pudo leer: "), F.regexp_extract("error_", "^([^:]*)", 1))
    out = rows.withColumns(
        {
            **{c: F.when(good, F.col(f"m_.{c}")).otherwise(F.col(c)) for c in copied},
            "reject_reasons": F.when(good, filter_reasons(F.col("reject_reasons"), F.col("m_"), t)).otherwise(bad),
            "panoramic": F.when(good, is_panoramic(F.col("m_"), t)).otherwise(F.col("panoramic")),
            "needs_review": F.when(good, mode_note(F.col("needs_review"), F.col("m_.mode"))).when(F.col("error_").isNotNull(), add_reason(F.col("needs_review"), note)).otherwise(F.col("needs_review")),
        }
    )
    return out.withColumn("rejected", is_rejected(F.col("reject_reasons"))).select(*RECORD.names)


def audit(spark: SparkSession, records: DataFrame, folder: str, t: Thresholds = Thresholds()) -> Outcome:
    """Measure a folder's pictures, judge them anew, and find duplicates among them."""
    listed = ingest.list_images(spark, folder).select(F.col("name").alias("filename"))
    known = listed.join(records, "filename", "left").withColumn("source", F.coalesce("source", F.lit("local")))
    after = written(judged(_conform(known), pixels.measure(spark, folder, t), t), "audit")
    rows = after.select(F.col("filename").alias("ord"), "filename", "sha256", from_hex(F.col("phash")).alias("phash64"))
    dups = duplicates.find_duplicates(rows, t.hamming)
    marked = after.join(dups.select(F.col("ord").alias("filename"), F.lit(True).alias("dup_")), "filename", "left")
    out = marked.withColumn("reject_reasons", F.when(F.col("dup_"), add_reason(F.col("reject_reasons"), "duplicate")).otherwise(F.col("reject_reasons"))).withColumn("rejected", is_rejected(F.col("reject_reasons")))
    out = written(out, "audited")
    readable = ~F.array_contains("reject_reasons", "unreadable")
    report = {
        "files": ingest.list_files(spark, folder).agg(F.count("*").alias("files"), F.sum("length").alias("bytes")),
        "usable": reports.usable(out, F.col("dup_"), readable),
        "summary": reports.file_summary(out),
        "short_side": reports.nearest_rank(out.select(F.least("width", "height").alias("side")), "side", {"p10": 0.1, "p90": 0.9}),
        "sharpness": reports.nearest_rank(out, "sharpness", {"p10": 0.1, "p90": 0.9}),
        "modes": reports.histogram(out, F.col("mode"), "mode"),
        "reasons": reports.reasons(out),
        "duplicates": dups,
        "captioned": export.caption_twins(ingest.list_files(spark, folder).select(F.lit("").alias("folder"), "name")).agg(F.count("*").alias("n")),
    }
    return Outcome(manifest.upsert(records, out.select(*RECORD.names)), report)


def ingest_folder(spark: SparkSession, records: DataFrame, folder: str, target: str, source_name: str = "local") -> Outcome:
    """Copy the new or changed pictures of a folder, and seed records with their digests; one that cannot be copied stays out."""
    new = written(ingest.new_or_changed(ingest.list_images(spark, folder), ingest.list_files(spark, target)), "new-files")
    copied = written(tree.copy(new.select(F.col("name").alias("filename")), folder, target), "copied")
    done = copied.where("error is null").select(F.col("filename").alias("name"))
    seeds = ingest.seed_records(ingest.with_sha256(spark, folder).join(done, "name", "left_semi"), records, source_name)
    fresh = seeds.withColumnsRenamed({"sha256": "sha_", "source": "source_"}).join(records, "filename", "left").withColumn("sha256", F.col("sha_")).withColumn("source", F.col("source_"))
    return Outcome(manifest.upsert(records, _conform(fresh)), {"copy": new, "errors": copied.where("error is not null")})


def fetch(spark: SparkSession, records: DataFrame, source_names: list[str], queries: dict[str, list[str]], limit: int = 100, allow_unknown: bool = False, options: dict | None = None, folder: str | None = None, get=None, t: Thresholds = Thresholds(), tasks: int = 4) -> Outcome:
    """Discover candidates, gate and name them, and take what is accepted into ``folder`` and the manifest.

    ``queries`` maps a class to its queries, ``options`` a source to its own.  A file
    that was fetched is measured and judged: one that cannot be read is kept and
    marked ``unreadable``, one whose perceptual hash is known, or came before in this
    run, ``duplicate``.  A file that could not be fetched is counted and stays
    unknown, so a later run tries it again.  Without a folder (a dry run) nothing is
    fetched and the manifest does not change.
    """
    found, broken = [], []
    for place, name in enumerate(source_names):
        own = (options or {}).get(name) or {}
        if not sources.available(name, own):
            continue
        for k, (klass, terms) in enumerate(queries.items()):
            raw = written(sources.listed(spark, name, terms, limit=limit, **own), "listed")  # asked once, read twice
            broken.append(raw.where("error is not null").select(F.lit(name).alias("source"), "error"))
            found.append(sources.to_records(name, raw, klass).withColumn("seq_", F.lit((place * 64 + k) << 45) + F.col("seq")))
    if not found:
        return Outcome(report={"counters": spark.createDataFrame([], "kind string, name string, n long")})
    names = [*RECORD.names, "seq_"]
    kinds = {f.name: f.dataType for f in RECORD.fields}
    all_ = reduce(DataFrame.unionByName, [f.select(*[(F.col(c) if c in f.columns else F.lit(None).cast(kinds[c])).alias(c) for c in names]) for f in found])
    all_ = written(manifest.with_defaults(all_), "candidates")
    judged_ = written(discovery.candidate_status(all_, records, "seq_", allow_unknown), "fetch-status")
    accepted = discovery.unique_filename(judged_.where("status = 'accepted'"), records, "seq_").withColumn("filename", F.col("final_name"))
    denied = judged_.where("status = 'skipped_license'")
    report = {
        "counters": discovery.counters(judged_),
        "denied": discovery.top_counts(denied, F.substring("license", 1, 34), "seq_", 8),
        "listing_errors": provenance.error_counts(reduce(DataFrame.unionByName, broken)),
    }
    if folder is None:
        return Outcome(report=report)
    accepted = written(accepted.select(*names), "accepted")
    new, got = _taken_in(spark, accepted, records, folder, get, t, tasks)
    report["download_errors"] = provenance.error_counts(got)
    report["verdicts"] = reports.reasons(new)
    report["taken"] = got.agg(F.count_if(F.col("error").isNull()).alias("downloaded"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return Outcome(manifest.upsert(records, new), report)


def _taken_in(spark: SparkSession, accepted: DataFrame, records: DataFrame, folder: str, get, t: Thresholds, tasks: int) -> tuple[DataFrame, DataFrame]:
    """(the records of what was fetched, with their verdicts; (filename, source, error) of every fetch).

    Files land beside the folder, are measured there without a look at older ones,
    and move in last.
    """
    get = get or http.get
    staging = f"{folder.rstrip('/')}.incoming-{uuid.uuid4().hex}"
    member = F.contains("download_url", F.lit(europepmc.MEMBER))
    wanted = accepted.select("filename", "source", "download_url")
    plain = tree.download(wanted.where(~member), staging, lambda row: get(row["download_url"]), tasks, folder)
    members = tree.store(europepmc.read_members(wanted.where(member), get), staging)
    got = written(plain.unionByName(members).join(wanted.select("filename", "source"), "filename"), "fetched")
    kept = got.where("error is null").select("filename")
    try:
        if not kept.limit(1).count():
            return accepted.select(*RECORD.names).limit(0), got
        digests = ingest.with_sha256(spark, staging).select(F.col("name").alias("filename"), F.col("sha256").alias("sha_"))
        there = accepted.join(kept, "filename", "left_semi")
        seen = judged(there, pixels.measure(spark, staging, t), t).join(digests, "filename").join(accepted.select("filename", "seq_"), "filename")
        readable = ~F.array_contains("reject_reasons", "unreadable")
        seen = written(seen.withColumn("sha256", F.when(readable, F.col("sha_"))).withColumn("phash", F.when(readable, F.col("phash"))), "measured")
        claimed = duplicates.claim_exact_phash(seen, records, F.col("seq_"))
        claimed = claimed.withColumn("reject_reasons", F.when(F.col("phash_duplicate"), add_reason(F.col("reject_reasons"), "duplicate")).otherwise(F.col("reject_reasons")))
        new = written(claimed.withColumn("rejected", is_rejected(F.col("reject_reasons"))).select(*RECORD.names), "taken-in")
        moved = written(tree.copy(kept, staging, folder, move=True), "moved").where("error is not null")
        return new.join(moved.select("filename"), "filename", "left_anti"), got
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def list_candidates(spark: SparkSession, categories: list[str], folder: str, limit: int = 600, **options) -> DataFrame:
    """Candidates of wiki categories with the hashes of their thumbnails, which are kept in ``folder``; failed ones have an error."""
    import json

    from sievewright.sources import http, mediawiki

    spark.dataSource.register(mediawiki.MediaWikiSource)
    pages = spark.read.format("mediawiki").options(queries=json.dumps([f"Category:{c}" for c in categories]), thumbs="true", limit=str(limit), **options).load()
    found = written(mediawiki.thumb_candidates(pages, most=limit), "thumb-candidates")
    return written(provenance.hash_thumbs(spark, found, folder, lambda row: http.get(row["download_url"])), "hashed-candidates")


def recover(spark: SparkSession, records: DataFrame, candidates: DataFrame, radius: int = 5) -> Outcome:
    """Match candidates (seq, phash, title, description_url, url, meta, category) to records without provenance."""
    listed, candidates = candidates, candidates.where("phash is not null")
    matches = written(provenance.match_candidates(records, candidates, radius), "matches")
    hit = matches.join(candidates.drop("phash"), "seq")
    left = provenance.pending(records).join(matches.select("filename"), "filename", "left_anti")
    report = {"matches": matches, "distances": provenance.match_buckets(records, candidates, matches), "unmatched": left.select("filename").orderBy("filename"), "counts": provenance.recovery_counts(records, listed, matches)}
    return Outcome(provenance.apply_metadata(records, hit), report)


def refilter(records: DataFrame, least: int, klass: str | None = None) -> Outcome:
    out = reports.refilter(records, least, klass)
    return Outcome(out.select(*records.columns), {"counts": reports.refilter_counts(out)})


def relicense(records: DataFrame) -> Outcome:
    return Outcome(reports.relicense(records).select(*records.columns), {"changes": reports.relicense_delta(records)})


def classify(spark: SparkSession, records: DataFrame, overwrite: bool = False, settings: dict | None = None) -> Outcome:
    index = classes.group_index(classes.config_items(spark, settings or config.DEFAULT))
    out = classes.classify_all(records, index, overwrite)
    return Outcome(out, {"counts": out.groupBy("klass").agg(F.count("*").alias("n"))})


def caption(records: DataFrame, overwrite: bool = False, words: CaptionWords = CaptionWords()) -> Outcome:
    out = classes.caption_all(records, overwrite, words)
    return Outcome(out, {"examples": out.where(none_if_empty(F.col("caption")).isNotNull()).select("filename", "caption").orderBy("filename").limit(6)})


def synthesize(spark: SparkSession, records: DataFrame, references: DataFrame, count: int, seed: int, words: CaptionWords = CaptionWords()) -> Outcome:
    made = provenance.synth_records(spark, references, count, seed, words=words)
    return Outcome(manifest.upsert(records, _conform(made)), {"by_reference": made.groupBy("reference").agg(F.count("*").alias("n"))})


def reject(records: DataFrame, names: DataFrame, note: str | None = None) -> Outcome:
    marked = manifest.mark_manually(records, names, note)
    hit = marked.where("status <> 'missing'").select(*records.columns)
    return Outcome(manifest.upsert(records, hit), {"status": marked.select("filename", "status")})


def restore(records: DataFrame, names: DataFrame) -> Outcome:
    marked = manifest.restore_manually(records, names)
    hit = marked.where("status in ('restored', 'still_rejected')").select(*records.columns)
    return Outcome(manifest.upsert(records, hit), {"status": marked.select("filename", "status")})


def report(records: DataFrame) -> Outcome:
    return Outcome(report={"totals": reports.totals(records), "classes": reports.by_class(records), "licenses": reports.by_license(records), "reasons": reports.reasons(records)})


def export_tree(spark: SparkSession, records: DataFrame, folder: str, repeats: dict[str, int] | None = None) -> Outcome:
    """The gates and paths of an export; :mod:`sievewright.operators.tree` writes the files."""
    there = ingest.list_files(spark, folder).select(F.col("name").alias("filename"), F.lit(True).alias("there_"))
    gated = export.gate_status(records.join(there, "filename", "left"), F.col("there_")).drop("there_")
    paths = export.export_paths(gated.where("export_status = 'ok'"), repeats)
    return Outcome(report={"status": gated.groupBy("export_status").agg(F.count("*").alias("n")), "paths": paths, "folders": export.folder_totals(paths), "csv": export.captions_csv(paths)})
