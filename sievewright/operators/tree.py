"""File sinks: the training tree, its README, credits and contact sheet, and downloads."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.functions.text import CaptionWords
from sievewright.operators import export, jpeg, pixels, reports


def put(path: str, data: bytes) -> None:
    """Write beside the target and rename: a reader sees all of a file or none, however often a task is retried."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{os.getpid()}.part"
    try:
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
    except BaseException:
        try:
            os.remove(part)
        except OSError:
            pass
        raise


def _each(rows: DataFrame, act: Callable[[dict], str | None]) -> DataFrame:
    """(filename, error) of doing something with each row where it is; an error, raised or returned, loses no other row."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):  # row by row: a row may hold a whole file
                (row,) = batch.slice(at, 1).to_pylist()
                error = None
                try:
                    error = act(row)
                except Exception as e:
                    error = f"{type(e).__name__}: {str(e)[:80]}"
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (row["filename"], error)], ["filename", "error"])

    return rows.mapInArrow(run, "filename string, error string")


def download(rows: DataFrame, folder: str, fetch: Callable[[dict], bytes], tasks: int = 4, have: str | None = None) -> DataFrame:
    """(filename, error) of fetching each row (filename, download_url, ...) to a folder that executors share.

    Files that exist are not fetched again (those of ``have`` are copied); an error
    is the row's (its type and the first 80 characters), leaves no file, and loses no
    other row.  ``tasks`` bounds how many fetches run at once.
    """

    def act(row: dict) -> None:
        path, old = os.path.join(folder, row["filename"]), os.path.join(have, row["filename"]) if have else None
        if not os.path.exists(path):
            put(path, Path(old).read_bytes() if old and os.path.exists(old) else fetch(row))

    return _each(rows.repartition(tasks, "filename"), act)


def store(rows: DataFrame, folder: str) -> DataFrame:
    """(filename, error) of writing rows (filename, content, error) to a folder; rows that have an error keep it."""
    return _each(rows.select("filename", "content", "error"), lambda row: row["error"] or put(os.path.join(folder, row["filename"]), row["content"]))


def copy(names: DataFrame, source: str, target: str, move: bool = False) -> DataFrame:
    """(filename, error) of copying files (filename) from one shared folder to another, or of moving them."""

    def act(row: dict) -> None:
        old, new = os.path.join(source, row["filename"]), os.path.join(target, row["filename"])
        if not move:
            put(new, Path(old).read_bytes())
        elif os.path.exists(old) or not os.path.exists(new):  # a task that runs again finds its file moved
            os.makedirs(os.path.dirname(new), exist_ok=True)
            os.replace(old, new)

    return _each(names.select("filename"), act)


def write_tree(paths: DataFrame, source: str, out: str, encode: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Write pictures and captions of :func:`export.export_paths` below ``out``; (filename, converted, error).

    Pictures that must become JPEG go through ``encode``; without an encoder they
    are an error, not a wrong file.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            done = []
            for r in batch.to_pylist():
                error = None
                try:
                    data = Path(source, r["filename"]).read_bytes()
                    if r["converted"]:
                        if encode is None:
                            raise ValueError("no encoder for a picture that is not RGB JPEG")
                        data = encode(data)
                    put(os.path.join(out, r["folder"], r["image_name"]), data)
                    put(os.path.join(out, r["folder"], r["caption_name"]), r["caption"].encode())
                except Exception as e:
                    error = f"{type(e).__name__}: {str(e)[:80]}"
                done.append((r["filename"], r["converted"], error))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.bool_()), pa.array([x[2] for x in done], pa.string())], ["filename", "converted", "error"])

    return paths.select("filename", "folder", "image_name", "caption_name", "caption", "converted").mapInArrow(run, "filename string, converted boolean, error string")


def write_recoded(paths: DataFrame, pictures: DataFrame, out: str, quality: int = 95) -> DataFrame:
    """Write pictures as JPEG, and their captions, below ``out``; (filename, converted, error).

    ``pictures`` are those of :func:`pixels.decoded`; they meet ``paths`` by name, are
    encoded where they are, one after the other, and never leave their task.  One that
    cannot be decoded is an error.
    """

    def act(row: dict) -> None:
        if row["data"] is None or (row["width"] or 0) <= 0:
            raise ValueError("not an image")
        data = jpeg.encode(pixels.to_rgb(row["data"], row["height"], row["width"], row["nChannels"]), quality)
        put(os.path.join(out, row["folder"], row["image_name"]), data)
        put(os.path.join(out, row["folder"], row["caption_name"]), row["caption"].encode())

    wanted = paths.select("filename", "folder", "image_name", "caption_name", "caption")
    done = _each(pictures.join(wanted, pictures["name"] == wanted["filename"]), act)
    return done.select("filename", F.lit(True).alias("converted"), "error")


def clean(out: str) -> None:
    """Take away what an export left before; the folder itself is there afterwards."""
    import shutil

    shutil.rmtree(out, ignore_errors=True)
    os.makedirs(out, exist_ok=True)


def write_csv(paths: DataFrame, target: str) -> None:
    """``file_name,text`` with CRLF line ends and quotes only where needed, sorted; streamed row by row."""
    rows = export.captions_csv(paths).select(export.csv_line(F.col("file_name"), F.col("text")).alias("line"))
    _stream(rows, "line", target, head="file_name,text\r\n", end="\r\n")


def _stream(rows: DataFrame, column: str, target: str, head: str = "", end: str = "\n", tail: str = "") -> None:
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    part = f"{target}.part"
    with open(part, "w", encoding="utf-8", newline="") as f:
        f.write(head)
        for r in rows.select(column).toLocalIterator(prefetchPartitions=True):
            f.write(r[0] + end)
        f.write(tail)
    os.replace(part, target)


def write_readme(paths: DataFrame, target: str, words: CaptionWords = CaptionWords()) -> None:
    """A table of the tree's folders: pictures, repeats and views of an epoch."""
    rows = export.folder_totals(paths).collect()  # one row for each class
    lines = ["# Training tree", "", f"Trigger word: `{words.trigger}`", "", "The number before a folder's name is how often an epoch repeats it.", "", "| Folder | Pictures | Repeats | Views per epoch |", "|---|---:|---:|---:|"]
    lines += [f"| `{r['folder']}` | {r['images']} | {r['repeats']} | {r['views']} |" for r in rows]
    lines += [f"| **Total** | **{sum(r['images'] for r in rows)}** | | **{sum(r['views'] for r in rows)}** |", ""]
    put(target, "\n".join(lines).encode())


def write_attributions(records: DataFrame, target: str) -> int:
    """Credits of the active records, by source; returns how many have a title."""
    n = reports.attribution_counts(records).first()
    # The page's headings.
    head = f"# Atribuciones del dataset\n\n- Imágenes activas: **{n['active']}**\n- Con procedencia identificada: **{n['with_title']}**\n- Sin licencia identificada: **{n['unknown_license']}**\n\n"
    lines = export.attribution_lines(records)
    first = lines.groupBy(F.col("source").alias("s_")).agg(F.min("filename").alias("f_"))
    lines = lines.join(first, (F.col("source") == F.col("s_")) & (F.col("filename") == F.col("f_")), "left")
    rows = lines.orderBy("source", "filename").select(F.concat(F.when(F.col("s_").isNotNull(), F.concat(F.lit("\n## "), "source", F.lit("\n\n"))).otherwise(""), "line").alias("line"))
    _stream(rows, "line", target, head=head)
    unknown = records.where(~F.col("rejected") & (F.col("license") == "UNKNOWN")).orderBy("filename").select(F.concat(F.lit("- "), "filename").alias("line"))
    if n["unknown_license"]:
        with open(target, "a", encoding="utf-8") as f:
            f.write("\n## Sin procedencia identificada\n\n")
            for r in unknown.toLocalIterator():
                f.write(r[0] + "\n")
    return n["with_title"]


def write_sheet(records: DataFrame, target: str, title: str = "Revisión del dataset", image=None) -> None:
    """One page with a figure for each record, with no reference to anything outside it."""
    n = records.agg(F.count("*").alias("n"), F.count_if("rejected").alias("bad")).first()
    style = "body{font-family:sans-serif}.grid{display:grid;grid-template-columns:repeat(auto-fill,minmax(240px,1fr));gap:8px}figure{margin:0;border:3px solid #5aa87a}figure.warn{border-color:#c9a53f}figure.bad{border-color:#c76b6b}img{width:100%}"
    head = f"<!doctype html><meta charset='utf-8'>\n<title>{_escape(title)}</title>\n<style>{style}</style>\n<h1>{_escape(title)}</h1>\n<div class='sub'>{n['n']} imágenes · {n['n'] - n['bad']} activas · {n['bad']} descartadas</div>\n<div class='grid'>\n"
    _stream(export.sheet_rows(records, image).orderBy("filename"), "figure", target, head=head, tail="</div>\n")


def _escape(s: str) -> str:
    import html

    return html.escape(s)


