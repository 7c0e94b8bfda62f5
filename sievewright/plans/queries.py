"""Each operator over the benchmark tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import licenses, text, verdicts
from sievewright.operators import classes, discovery, duplicates, export, ingest, manifest, pixels, provenance, reports
from sievewright.plans import commands, config
from sievewright.plans.tables import HASHES_SQL, RECORDS_SQL, _list, hashes, records, table
from sievewright.schema import RECORD, UNCLASSIFIED
from sievewright.sources import europepmc, mediawiki

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

Query = Callable[[SparkSession, str], DataFrame]


def query(sql: str | None = None, over_records: bool = True) -> Callable[[Query], Query]:
    """Register a query under its name; ``sql`` may use the record view ``r``."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"WITH {RECORDS_SQL}{sql}" if over_records else sql
        return f

    return keep


def _joined(c: str) -> F.Column:
    return F.array_join(c, "|")


# SQL twins of the column functions -------------------------------------------------------------


def _low(c: str) -> str:
    return f"regexp_replace(lower({c}), '^\\s+|\\s+$', '', 'g')"


def _any_sql(c: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({c}, '{p}')" for p in parts) + ")"


def allowed_sql(c: str) -> str:
    return f"(CASE WHEN coalesce({c}, '') IN ('', 'UNKNOWN') THEN FALSE ELSE NOT {_any_sql(_low(c), licenses.DENIED_CLAUSES)} AND {_any_sql(_low(c), licenses.ALLOWED_MARKERS)} END)"


def explain_sql(c: str) -> str:
    denied = " ".join(f"WHEN contains({_low(c)}, '{d}') THEN '{licenses.DENIED.format(d.strip())}'" for d in licenses.DENIED_CLAUSES)
    return f"CASE WHEN coalesce({c}, '') IN ('', 'UNKNOWN') THEN '{licenses.UNIDENTIFIED}' {denied} WHEN {_any_sql(_low(c), licenses.ALLOWED_MARKERS)} THEN '{licenses.ADMITTED}' ELSE '{licenses.UNRECOGNISED}' END"


def clean_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({c}, ''), '(?i){text.NOISE}', ' ', 'g'), '[^\\p{{L}}\\p{{N}}_\\s,.-]', ' ', 'g'), '\\s+', ' ', 'g'), '^[ ,.-]+|[ ,.-]+$', '', 'g')"


def sentence_sql(c: str) -> str:
    first = f"(CASE WHEN regexp_matches({c}, '[.;]\\s') THEN regexp_extract({c}, '^(.*?[.;])\\s', 1) ELSE {c} END)"
    return f"(CASE WHEN {c} <> '' AND len(string_split({first}, ' ')) BETWEEN 2 AND 22 THEN regexp_replace(lower({first}), '\\.+$', '') END)"


def tags_sql(c: str) -> str:
    """A list: the table's tags found in the joined categories, distinct (they are in the table), the first six."""
    low = f"lower(array_to_string({c}, ' '))"
    found = ", ".join(f"CASE WHEN contains({low}, '{n}') THEN '{t}' END" for n, t in text.CATEGORY_TAGS.items())
    return f"list_filter([{found}], lambda x: x IS NOT NULL)[1:6]"


def distinct_sql(c: str) -> str:
    kept = f"list_filter(list_transform({c}, lambda x: trim(x)), lambda x: x IS NOT NULL AND x <> '')"
    return f"list_filter({kept}, lambda x, i: list_position(list_transform({kept}, lambda y: lower(y)), lower(x)) = i)"


def escape_sql(c: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        c = f"replace({c}, '{a}', '{b}')"
    return c


def caption_sql(klass: str = "klass") -> str:
    words = text.CaptionWords()
    hint = f"CASE {klass} WHEN '01_real_estratos' THEN 'sedimentary strata' WHEN '02_real_plastiglomerado' THEN 'plastiglomerate' WHEN '03_proxy_materiales' THEN 'fused industrial conglomerate' WHEN '04_synth_plastiglomerado' THEN '{words.synthetic}, plastiglomerate' END"
    parts = f"list_concat(list_concat(['{words.trigger}', {hint}], {tags_sql('categories')}), [{sentence_sql('cl')}, CASE WHEN saturation < {text.DESATURATED_BELOW} THEN '{text.DESATURATED}' END, CASE WHEN panoramic THEN '{text.PANORAMIC_FRAME}' ELSE '{text.CLOSE_FRAME}' END])"
    return f"array_to_string({distinct_sql(parts)}, ', ')"


_INDEX_SQL = "idx_raw(seq, grp, item) AS (VALUES " + ", ".join("({}, '{}', '{}')".format(s, g, i.replace("'", "''")) for s, _, g, i in classes.flatten(config.DEFAULT)) + "), idx AS (SELECT lower(item) AS item, arg_max(grp, seq) AS grp FROM idx_raw GROUP BY 1)"
_VOTES_SQL = f""", {_INDEX_SQL},
cv AS (SELECT filename, unnest(categories) AS cat, generate_subscripts(categories, 1) AS pos FROM r),
ck AS (SELECT filename, pos, grp FROM cv LEFT JOIN idx ON {_low('cat')} = idx.item),
cn AS (SELECT filename, grp, count(*) AS n, min(pos) AS first FROM ck GROUP BY 1, 2),
cb AS (SELECT filename, grp FROM (SELECT filename, grp, row_number() OVER (PARTITION BY filename ORDER BY n DESC, first) AS rn FROM cn WHERE grp IS NOT NULL) WHERE rn = 1),
vt AS (SELECT cn.filename, CASE WHEN coalesce(bool_or(cn.grp = 'plastiglomerado'), FALSE) THEN '02_real_plastiglomerado' WHEN any_value(cb.grp) = 'estratos' THEN '01_real_estratos' WHEN any_value(cb.grp) = 'proxy' THEN '03_proxy_materiales' ELSE '_unclassified' END AS voted,
  coalesce(bool_or(cn.grp = 'legacy_noise'), FALSE) AND bool_and(coalesce(cn.grp = 'legacy_noise', TRUE)) AS all_noise, CAST(sum(CASE WHEN cn.grp IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS n_votes
  FROM cn LEFT JOIN cb ON cn.filename = cb.filename GROUP BY cn.filename)"""


# Licences -------------------------------------------------------------------------------------


@query(f" SELECT license, {allowed_sql('license')} AS allowed, count(*) AS n FROM r GROUP BY 1, 2")
def license_allowed(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.groupBy("license", licenses.is_allowed(F.col("license")).alias("allowed")).agg(F.count("*").alias("n"))


@query(f" SELECT filename, {explain_sql('license')} AS reason FROM r")
def license_explain(spark, sf_dir):
    return records(spark, sf_dir).select("filename", licenses.explain(F.col("license")).alias("reason"))


_RELICENSED = f"""CASE WHEN {allowed_sql('license')} THEN list_filter(reject_reasons, lambda x: x <> 'license_denied') WHEN list_contains(reject_reasons, 'license_denied') THEN reject_reasons ELSE list_append(reject_reasons, 'license_denied') END"""


@query(f" SELECT filename, array_to_string({_RELICENSED}, '|') AS reasons, len({_RELICENSED}) > 0 AS rejected FROM r")
def relicense(spark, sf_dir):
    return reports.relicense(records(spark, sf_dir)).select("filename", _joined("reject_reasons").alias("reasons"), "rejected")


@query(f" SELECT filename, license, CASE WHEN {allowed_sql('license')} THEN 'freed' ELSE 'denied' END AS change FROM r WHERE list_contains(reject_reasons, 'license_denied') = {allowed_sql('license')}")
def relicense_delta(spark, sf_dir):
    return reports.relicense_delta(records(spark, sf_dir))


@query(f" SELECT substr(license, 1, 34) || ' — ' || {explain_sql('license')} AS name, count(*) AS n FROM r WHERE NOT {allowed_sql('license')} GROUP BY 1 ORDER BY n DESC, min(doc_id) LIMIT 8")
def topk_denied_licenses(spark, sf_dir):
    r = records(spark, sf_dir).where(~licenses.is_allowed(F.col("license")))
    name = F.concat(F.substring("license", 1, 34), F.lit(" — "), licenses.explain(F.col("license")))
    return discovery.top_counts(r, name, "doc_id", 8)


# Text ----------------------------------------------------------------------------------------


@query("SELECT page_id, nullif(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), '') AS text FROM pages", False)
def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.html_strip(F.col("html")).alias("text"))


@query("SELECT page_id, lower(regexp_replace(regexp_replace(url, '[^\\p{L}\\p{N}_.-]+', '_', 'g'), '^_+|_+$', '', 'g')) AS name FROM pages", False)
def safe_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.safe_filename(F.col("url")).alias("name"))


@query(" SELECT filename, lower(regexp_extract(filename, '(\\.[^.]+)$', 1)) AS suffix, regexp_replace(filename, '\\.[^.]+$', '') AS stem FROM r")
def path_parts(spark, sf_dir):
    return records(spark, sf_dir).select("filename", text.suffix(F.col("filename")).alias("suffix"), text.stem(F.col("filename")).alias("stem"))


@query(f" SELECT doc_id, {clean_sql('description')} AS cleaned FROM r")
def caption_clean(spark, sf_dir):
    return records(spark, sf_dir).select("doc_id", text.clean(F.col("description")).alias("cleaned"))


@query(f", k AS (SELECT doc_id, {clean_sql('description')} AS cl FROM r) SELECT doc_id, {sentence_sql('cl')} AS sentence FROM k")
def first_sentence(spark, sf_dir):
    return records(spark, sf_dir).select("doc_id", text.first_sentence(text.clean(F.col("description"))).alias("sentence"))


_PART = "string_split(p_type || ' ' || p_name, ' ')"


@query(f"WITH p AS (SELECT p_partkey, list_concat([['sandstone', 'cliff', 'Marine debris', 'cross-bedding fold', 'slag'][CAST(p_partkey % 5 + 1 AS BIGINT)], ['plastic', 'volcanic breccia', 'x'][CAST(p_partkey % 3 + 1 AS BIGINT)]], {_PART}) AS c FROM part) SELECT p_partkey, array_to_string({tags_sql('c')}, '|') AS tags FROM p", False)
def category_tags(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    at = lambda v, n: F.element_at(F.array(*[F.lit(x) for x in v]), (F.col("p_partkey") % n + 1).cast("int"))
    cats = F.concat(F.array(at(["sandstone", "cliff", "Marine debris", "cross-bedding fold", "slag"], 5), at(["plastic", "volcanic breccia", "x"], 3)), F.split(F.concat_ws(" ", "p_type", "p_name"), " "))
    return p.select("p_partkey", F.array_join(text.category_tags(cats), "|").alias("tags"))


@query(f"WITH p AS (SELECT p_partkey, list_concat(list_concat({_PART}, string_split(upper(p_type), ' ')), ['  ', ' x ', 'X', NULL]) AS c FROM part) SELECT p_partkey, array_to_string({distinct_sql('c')}, ', ') AS parts FROM p", False)
def caption_parts_dedup(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    parts = F.concat(F.split(F.concat_ws(" ", "p_type", "p_name"), " "), F.split(F.upper("p_type"), " "), F.array(F.lit("  "), F.lit(" x "), F.lit("X"), F.lit(None).cast("string")))
    return p.select("p_partkey", F.array_join(text.distinct_parts(parts), ", ").alias("parts"))


@query(f", k AS (SELECT *, {clean_sql('description')} AS cl FROM r) SELECT filename, {caption_sql()} AS caption FROM k")
def build_caption(spark, sf_dir):
    c = [F.col(x) for x in ("klass", "categories", "description", "saturation", "panoramic")]
    return records(spark, sf_dir).select("filename", text.caption(*c).alias("caption"))


@query(f", k AS (SELECT *, {clean_sql('description')} AS cl FROM r) SELECT filename, CASE WHEN coalesce(caption, '') = '' AND klass <> '_unclassified' THEN {caption_sql()} ELSE caption END AS caption FROM k")
def caption_all(spark, sf_dir):
    return classes.caption_all(records(spark, sf_dir)).select("filename", "caption")


# Classes -------------------------------------------------------------------------------------


def _index(spark: SparkSession) -> DataFrame:
    return classes.group_index(classes.config_items(spark, config.DEFAULT))


@query(f"WITH {_INDEX_SQL} SELECT item, grp AS \"group\" FROM idx", False)
def group_index(spark, sf_dir):
    return _index(spark)


@query(_VOTES_SQL + " SELECT filename, voted AS klass, all_noise, n_votes FROM vt")
def classify_votes(spark, sf_dir):
    return classes.votes(records(spark, sf_dir), _index(spark))


def _studio_sql(touched: str) -> str:
    spec, wide = "lower(coalesce(description, ''))", "lower(filename || ' ' || coalesce(origin_title, ''))"
    a = f"CASE WHEN {touched} AND {_any_sql(spec, text.SPECIMEN_WORDS)} THEN list_append(needs_review, '{text.SPECIMEN_NOTE.replace(chr(39), chr(39) * 2)}') ELSE needs_review END"
    return f"CASE WHEN {touched} AND {_any_sql(wide, text.MUSEUM_WORDS)} THEN list_append({a}, '{text.MUSEUM_NOTE}') ELSE {a} END"


@query(
    _VOTES_SQL
    + f""", cl AS (SELECT r.*, klass = '_unclassified' AS touched, coalesce(voted, '_unclassified') AS new, coalesce(all_noise, FALSE) AS noise FROM r LEFT JOIN vt ON r.filename = vt.filename)
SELECT filename, CASE WHEN touched THEN new ELSE klass END AS klass, CASE WHEN touched AND new <> klass THEN NULL ELSE caption END AS caption,
  array_to_string(CASE WHEN touched AND new = '_unclassified' AND noise THEN list_append({_studio_sql("(touched AND NOT rejected)")}, '{classes.CATALOGUE_NOTE}') ELSE {_studio_sql("(touched AND NOT rejected)")} END, '|') AS notes,
  array_to_string(CASE WHEN touched AND new = '_unclassified' AND noise THEN list_append(reject_reasons, 'out_of_scope') ELSE reject_reasons END, '|') AS reasons,
  rejected OR (touched AND new = '_unclassified' AND noise) AS rejected FROM cl"""
)
def classify_all(spark, sf_dir):
    out = classes.classify_all(records(spark, sf_dir), _index(spark))
    return out.select("filename", "klass", "caption", _joined("needs_review").alias("notes"), _joined("reject_reasons").alias("reasons"), "rejected")


@query(_VOTES_SQL + " SELECT coalesce(voted, '_unclassified') AS klass, count(*) AS n FROM r LEFT JOIN vt ON r.filename = vt.filename GROUP BY 1")
def classify_counts(spark, sf_dir):
    return classes.classify_all(records(spark, sf_dir), _index(spark), overwrite=True).groupBy("klass").agg(F.count("*").alias("n"))


@query("SELECT event_type AS item, min(event_id) AS seq FROM events GROUP BY 1", False)
def ordered_distinct(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("item"), F.col("event_id").alias("seq"))
    return classes.ordered_distinct(e)


@query(f" SELECT filename, array_to_string({_studio_sql('TRUE')}, '|') AS notes FROM r")
def studio_language_flags(spark, sf_dir):
    c = [F.col(x) for x in ("needs_review", "description", "filename", "origin_title")]
    return records(spark, sf_dir).select("filename", F.array_join(classes.studio_notes(*c), "|").alias("notes"))


# Filters -------------------------------------------------------------------------------------

_METRICS_SQL = """m AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity * 60) AS INTEGER) AS width, CAST(floor(l_extendedprice / 30) + 1 AS INTEGER) AS height,
  CASE l_returnflag WHEN 'A' THEN 'RGB' WHEN 'N' THEN 'L' ELSE 'RGBA' END AS mode, l_discount * 2500 AS border_mean, l_tax * 1000 AS border_std, l_discount * 5 AS dark_frac, l_tax * 4.5 AS light_frac, l_quantity * 2 AS sharpness,
  CASE l_linenumber % 4 WHEN 0 THEN ['too_small', 'manual'] WHEN 1 THEN ['duplicate', 'blurry'] ELSE CAST([] AS VARCHAR[]) END AS reasons FROM lineitem)"""
_STUDIO_SQL = "((border_std < 32 AND (border_mean < 62 OR border_mean > 205)) OR dark_frac > 0.40 OR light_frac > 0.32)"


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    arr = lambda *v: F.array(*[F.lit(x) for x in v]).cast("array<string>")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.floor(F.col("l_quantity") * 60).cast("int").alias("width"),
        (F.floor(F.col("l_extendedprice") / 30) + 1).cast("int").alias("height"),
        F.when(F.col("l_returnflag") == "A", "RGB").when(F.col("l_returnflag") == "N", "L").otherwise("RGBA").alias("mode"),
        (F.col("l_discount") * 2500).alias("border_mean"),
        (F.col("l_tax") * 1000).alias("border_std"),
        (F.col("l_discount") * 5).alias("dark_frac"),
        (F.col("l_tax") * 4.5).alias("light_frac"),
        (F.col("l_quantity") * 2).alias("sharpness"),
        F.when(F.col("l_linenumber") % 4 == 0, arr("too_small", "manual")).when(F.col("l_linenumber") % 4 == 1, arr("duplicate", "blurry")).otherwise(arr()).alias("reasons"),
    )


@query(f"WITH {_METRICS_SQL} SELECT {_STUDIO_SQL} AS studio, mode, count(*) AS n FROM m GROUP BY 1, 2", False)
def studio_background(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    return m.groupBy(verdicts.studio_background(*[F.col(c) for c in ("border_mean", "border_std", "dark_frac", "light_frac")]).alias("studio"), "mode").agg(F.count("*").alias("n"))


@query(
    f"""WITH {_METRICS_SQL}, a AS (SELECT *, CASE WHEN width <> 0 AND height <> 0 THEN CAST(greatest(width, height) AS DOUBLE) / least(width, height) END AS aspect FROM m),
f AS (SELECT *, list_concat(list_filter(reasons, lambda x: x NOT IN ('too_small', 'studio_background', 'blurry', 'extreme_aspect')), list_filter([CASE WHEN least(width, height) < 1024 THEN 'too_small' END, CASE WHEN {_STUDIO_SQL} THEN 'studio_background' END, CASE WHEN sharpness < 40 THEN 'blurry' END, CASE WHEN aspect > 3.5 THEN 'extreme_aspect' END], lambda x: x IS NOT NULL)) AS after FROM a)
SELECT l_orderkey, l_linenumber, array_to_string(after, '|') AS reasons, len(after) > 0 AS rejected, coalesce(aspect >= 2.0 AND aspect <= 3.5, FALSE) AS panoramic, CASE WHEN mode NOT IN ('RGB', 'L') THEN 'convertir a RGB (mode=' || mode || ')' ELSE '' END AS notes FROM f""",
    False,
)
def apply_filters(spark, sf_dir):
    m = F.struct("width", "height", "mode", "border_mean", "border_std", "dark_frac", "light_frac", "sharpness")
    rows = _metrics(spark, sf_dir).withColumn("m", m).withColumn("after", verdicts.filter_reasons(F.col("reasons"), F.col("m")))
    notes = verdicts.mode_note(F.array().cast("array<string>"), F.col("mode"))
    return rows.select("l_orderkey", "l_linenumber", F.array_join("after", "|").alias("reasons"), verdicts.is_rejected(F.col("after")).alias("rejected"), verdicts.is_panoramic(F.col("m")).alias("panoramic"), F.array_join(notes, "|").alias("notes"))


_REFILTER_SQL = """, f AS (SELECT *, CASE WHEN width <> 0 AND height <> 0 THEN least(width, height) END AS side, list_contains(reject_reasons, 'too_small') AS had FROM r),
g AS (SELECT *, coalesce((side < 640) <> had, FALSE) AS changed FROM f),
h AS (SELECT *, CASE WHEN NOT changed THEN reject_reasons WHEN had THEN list_filter(reject_reasons, lambda x: x <> 'too_small') ELSE list_append(reject_reasons, 'too_small') END AS after FROM g),
k AS (SELECT *, CASE WHEN changed THEN len(after) > 0 ELSE rejected END AS now FROM h)"""


@query(_REFILTER_SQL + " SELECT filename, changed, array_to_string(after, '|') AS reasons, now AS rejected FROM k")
def refilter_min_side(spark, sf_dir):
    return reports.refilter(records(spark, sf_dir), 640).select("filename", "changed", _joined("reject_reasons").alias("reasons"), "rejected")


@query(_REFILTER_SQL + " SELECT count(*) FILTER (WHERE changed) AS changed, count(*) FILTER (WHERE changed AND rejected) AS rescued, count(*) FILTER (WHERE changed AND NOT rejected) AS newly_rejected, count(*) FILTER (WHERE changed AND rejected AND NOT now) AS rescued_truly, count(*) FILTER (WHERE changed AND NOT rejected AND now) AS newly_rejected_truly FROM k")
def refilter_counts(spark, sf_dir):
    return reports.refilter_counts(reports.refilter(records(spark, sf_dir), 640))


_NAMES_SQL = ", ask AS (SELECT DISTINCT CASE WHEN doc_id % 9 = 0 THEN 'no_such_' || doc_id || '.jpg' ELSE filename END AS filename FROM r WHERE doc_id % 3 = 0)"


def _names(r: DataFrame) -> DataFrame:
    return r.where("doc_id % 3 = 0").select(F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("no_such_"), F.col("doc_id").cast("string"), F.lit(".jpg"))).otherwise(F.col("filename")).alias("filename"))


@query(_NAMES_SQL + " SELECT ask.filename, CASE WHEN r.filename IS NULL THEN 'missing' WHEN list_contains(reject_reasons, 'manual') THEN 'noop' WHEN rejected THEN 'reinforced' ELSE 'newly' END AS status, CASE WHEN r.filename IS NOT NULL THEN array_to_string(CASE WHEN list_contains(reject_reasons, 'manual') THEN reject_reasons ELSE list_append(reject_reasons, 'manual') END, '|') END AS reasons FROM ask LEFT JOIN r ON ask.filename = r.filename")
def manual_reject_status(spark, sf_dir):
    r = records(spark, sf_dir)
    return manifest.mark_manually(r, _names(r)).select("filename", "status", _joined("reject_reasons").alias("reasons"))


@query(_NAMES_SQL + " SELECT ask.filename, CASE WHEN r.filename IS NULL THEN 'missing' WHEN NOT list_contains(reject_reasons, 'manual') THEN 'not_manual' WHEN len(reject_reasons) > 1 THEN 'still_rejected' ELSE 'restored' END AS status FROM ask LEFT JOIN r ON ask.filename = r.filename")
def manual_restore_status(spark, sf_dir):
    r = records(spark, sf_dir)
    return manifest.restore_manually(r, _names(r)).select("filename", "status")


@query(" SELECT filename, source, klass FROM r WHERE NOT rejected")
def active_records(spark, sf_dir):
    return manifest.active(records(spark, sf_dir)).select("filename", "source", "klass")


# Discovery -----------------------------------------------------------------------------------

_SPLIT_SQL = ", known AS (SELECT * FROM r WHERE doc_id % 4 = 0), cand AS (SELECT * FROM r WHERE doc_id % 4 <> 0)"
_STATUS_SQL = (
    _SPLIT_SQL
    + f""", u AS (SELECT DISTINCT download_url AS url FROM known WHERE download_url <> ''),
c AS (SELECT cand.*, u.url IS NOT NULL AS is_known, {allowed_sql('license')} AS ok FROM cand LEFT JOIN u ON cand.download_url = u.url),
t AS (SELECT download_url, min(doc_id) AS taken FROM c WHERE NOT is_known AND download_url <> '' AND ok GROUP BY 1),
s AS (SELECT c.*, CASE WHEN c.download_url = '' OR is_known OR coalesce(doc_id > taken, FALSE) THEN 'skipped_known' WHEN NOT ok THEN 'skipped_license' ELSE 'accepted' END AS status FROM c LEFT JOIN t ON c.download_url = t.download_url)"""
)


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = records(spark, sf_dir)
    return r.where("doc_id % 4 <> 0"), r.where("doc_id % 4 = 0")


@query(_SPLIT_SQL + " SELECT doc_id, download_url FROM cand WHERE download_url NOT IN (SELECT download_url FROM known WHERE download_url <> '')")
def anti_join_known_urls(spark, sf_dir):
    candidates, known = _run(spark, sf_dir)
    return discovery.anti_join_known(candidates, known).select("doc_id", "download_url")


@query(f" SELECT download_url, min(doc_id) AS doc_id FROM r WHERE {allowed_sql('license')} AND download_url <> '' GROUP BY 1")
def first_seen_url(spark, sf_dir):
    r = records(spark, sf_dir)
    return discovery.candidate_status(r, r.limit(0), "doc_id").where("status = 'accepted'").select("download_url", "doc_id")


@query(_STATUS_SQL + " SELECT doc_id, status FROM s")
def fetch_candidate_status(spark, sf_dir):
    candidates, known = _run(spark, sf_dir)
    return discovery.candidate_status(candidates, known, "doc_id").select("doc_id", "status")


@query(_STATUS_SQL + ", k AS (SELECT 'status' AS kind, status AS name FROM s UNION ALL SELECT 'source', source FROM s WHERE status = 'accepted' UNION ALL SELECT 'class', klass FROM s WHERE status = 'accepted' UNION ALL SELECT 'license', license FROM s WHERE status = 'accepted') SELECT kind, name, count(*) AS n FROM k GROUP BY 1, 2")
def fetch_counters(spark, sf_dir):
    candidates, known = _run(spark, sf_dir)
    return discovery.counters(discovery.candidate_status(candidates, known, "doc_id"))


@query(
    """, x AS (SELECT doc_id, download_url, lang || '_' || (doc_id % 40) || CASE WHEN doc_id % 10 = 0 THEN '' ELSE '.jpg' END AS filename FROM r),
k AS (SELECT filename, arg_min(download_url, doc_id) AS old_url FROM x WHERE doc_id % 4 = 0 GROUP BY 1),
c AS (SELECT x.*, k.filename AS old, old_url, row_number() OVER (PARTITION BY x.filename ORDER BY doc_id) AS rn FROM x LEFT JOIN k ON x.filename = k.filename WHERE doc_id % 4 <> 0)
SELECT doc_id, CASE WHEN rn = 1 AND (old IS NULL OR old_url IS NOT DISTINCT FROM download_url) THEN filename WHEN contains(filename, '.') THEN regexp_extract(filename, '^(.*)\\.[^.]*$', 1) || '_' || substr(sha1(CASE WHEN download_url = '' THEN filename ELSE download_url END), 1, 8) || '.' || regexp_extract(filename, '\\.([^.]*)$', 1)
  ELSE filename || '_' || substr(sha1(CASE WHEN download_url = '' THEN filename ELSE download_url END), 1, 8) END AS final_name FROM c"""
)
def unique_filename(spark, sf_dir):
    i = F.col("doc_id")
    x = records(spark, sf_dir).select("doc_id", "download_url", F.concat("lang", F.lit("_"), (i % 40).cast("string"), F.when(i % 10 == 0, "").otherwise(".jpg")).alias("filename"))
    known = x.where("doc_id % 4 = 0").groupBy("filename").agg(F.min_by("download_url", "doc_id").alias("download_url"))
    return discovery.unique_filename(x.where("doc_id % 4 <> 0"), known, "doc_id").select("doc_id", "final_name")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE rn <= 600", False)
def limit_per_group(spark, sf_dir):
    return discovery.limit_per_group(table(spark, sf_dir, "events"), "event_type", F.col("event_id"), 600).select("event_type", "event_id")


@query("WITH s(source) AS (VALUES ('wikimedia'), ('europepmc'), ('flickr')), " + _INDEX_SQL + " SELECT source, grp AS \"group\", item AS term FROM s, idx_raw", False)
def query_plan_cross(spark, sf_dir):
    items = classes.config_items(spark, config.DEFAULT)
    sources = spark.createDataFrame([("wikimedia",), ("europepmc",), ("flickr",)], "source string")
    return discovery.query_plan(sources, items.select("group", F.col("item").alias("term")))


# Duplicates ----------------------------------------------------------------------------------


@query(", f AS (SELECT filename, doc_id, first_value(filename) OVER (PARTITION BY sha256 ORDER BY doc_id) AS keeper FROM r) SELECT filename, keeper FROM f WHERE filename <> keeper")
def sha_duplicates(spark, sf_dir):
    return duplicates.exact_duplicates(records(spark, sf_dir), order="doc_id")


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents", False)
def sha256_content(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ingest.sha256(F.col("text")).alias("sha256"))


@query(", k AS (SELECT DISTINCT sha256 AS h FROM r WHERE doc_id % 4 = 0), c AS (SELECT doc_id, sha256, row_number() OVER (PARTITION BY sha256 ORDER BY doc_id) AS rn FROM r WHERE doc_id % 4 <> 0) SELECT doc_id, k.h IS NOT NULL OR rn > 1 AS duplicate FROM c LEFT JOIN k ON c.sha256 = k.h")
def phash_exact_dup(spark, sf_dir):
    candidates, known = (x.select("doc_id", F.col("sha256").alias("phash")) for x in _run(spark, sf_dir))
    return duplicates.claim_exact_phash(candidates, known, F.col("doc_id")).select("doc_id", F.col("phash_duplicate").alias("duplicate"))


_HEX_SQL = "array_to_string(list_transform(range(0, 16), lambda k: substr('0123456789abcdef', CAST(1 + 8 * CAST(substr(bits, 4 * k + 1, 1) AS INTEGER) + 4 * CAST(substr(bits, 4 * k + 2, 1) AS INTEGER) + 2 * CAST(substr(bits, 4 * k + 3, 1) AS INTEGER) + CAST(substr(bits, 4 * k + 4, 1) AS INTEGER) AS BIGINT), 1)), '')"


@query(f"WITH {HASHES_SQL} SELECT vec_id, {_HEX_SQL} AS phash FROM hb", False)
def phash_bits(spark, sf_dir):
    return hashes(spark, sf_dir).select("vec_id", "phash")


@query(f"WITH {HASHES_SQL} SELECT a.vec_id AS a, b.vec_id AS b, CAST(hamming(a.bits, b.bits) AS INTEGER) AS distance FROM hb a JOIN hb b ON a.vec_id < b.vec_id AND hamming(a.bits, b.bits) <= 20", False)
def hamming_pairs(spark, sf_dir):
    return duplicates.hamming_pairs(hashes(spark, sf_dir), "vec_id", "h", 20)


_FLIP_SQL = ", x AS (SELECT vec_id * 2 AS k, bits FROM hb UNION ALL SELECT vec_id * 2 + 1, array_to_string(list_transform(range(0, 64), lambda i: CASE WHEN i IN (63 - vec_id % 64, 63 - vec_id * 7 % 64) THEN CAST(1 - CAST(substr(bits, i + 1, 1) AS INTEGER) AS VARCHAR) ELSE substr(bits, i + 1, 1) END), '') FROM hb WHERE vec_id % 64 <> vec_id * 7 % 64)"


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes and copies with two bits turned."""
    h, v = hashes(spark, sf_dir), F.col("vec_id")
    one = lambda n: F.expr(f"shiftleft(1L, cast({n} as int))")
    turned = F.col("h").bitwiseXOR(one("vec_id % 64")).bitwiseXOR(one("vec_id * 7 % 64"))
    return h.select((v * 2).alias("k"), "h").union(h.where("vec_id % 64 <> vec_id * 7 % 64").select(v * 2 + 1, turned))


@query(f"WITH {HASHES_SQL}{_FLIP_SQL} SELECT a.k AS a, b.k AS b, CAST(hamming(a.bits, b.bits) AS INTEGER) AS distance FROM x a JOIN x b ON a.k < b.k AND hamming(a.bits, b.bits) <= 5", False)
def hamming_pairs_banded(spark, sf_dir):
    return duplicates.hamming_pairs(_planted(spark, sf_dir), "k", "h", 5)


@query()
def near_dup_greedy(spark, sf_dir):
    return duplicates.near_duplicates(hashes(spark, sf_dir), "vec_id", "h", 20)


def _candidates_and_locals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    h = hashes(spark, sf_dir)
    return h.where("vec_id % 2 = 1").select(F.col("vec_id").alias("seq"), "h"), h.where("vec_id % 2 = 0").select(F.col("vec_id").cast("string").alias("local"), "h")


@query()
def recover_nn_match(spark, sf_dir):
    return provenance.match_hashes(*_candidates_and_locals(spark, sf_dir), 20)


@query()
def nn_distance_buckets(spark, sf_dir):
    candidates, locals_ = _candidates_and_locals(spark, sf_dir)
    matches = provenance.match_hashes(candidates, locals_, 20)
    return duplicates.distance_buckets(candidates, locals_, matches, (18, 20, 22, 24))


@query(f"WITH {HASHES_SQL}, d AS (SELECT c.vec_id AS seq, l.vec_id AS loc, hamming(c.bits, l.bits) AS d FROM hb c JOIN hb l ON c.vec_id % 2 = 1 AND l.vec_id % 2 = 0 AND hamming(c.bits, l.bits) <= 20) SELECT seq, CAST(loc AS VARCHAR) AS local, CAST(d AS INTEGER) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY d, CAST(loc AS VARCHAR)) AS rn FROM d) WHERE rn = 1", False)
def nn_nearest(spark, sf_dir):
    return provenance.nearest(provenance.cross_distances(*_candidates_and_locals(spark, sf_dir), 20))


@query("WITH d AS (SELECT source, lang, min(doc_id) AS pos FROM documents GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN lang IN ('en', 'fr') THEN 0 ELSE 1 END, pos) AS rn FROM d) SELECT source, lang FROM k WHERE rn = 1", False)
def best_member_top1(spark, sf_dir):
    """A source's languages as the members of an archive, of which two are pictures."""
    d = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.min("doc_id").alias("pos"))
    names = F.transform(F.sort_array(F.collect_list(F.struct("pos", "lang"))), lambda x: F.concat(F.lit("Fig."), F.when(x["lang"] == "en", "jpg").when(x["lang"] == "fr", "png").otherwise(F.coalesce(x["lang"], F.lit("")))))
    best = F.nullif(F.regexp_extract(europepmc.best_member_of(F.lit("fig"), F.col("names")), "[.](.*)", 1), F.lit(""))
    return d.groupBy("source").agg(names.alias("names")).select("source", F.when(best == "jpg", "en").when(best == "png", "fr").otherwise(best).alias("lang"))


@query(" SELECT filename FROM r WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY filename LIMIT 15")
def recover_unmatched(spark, sf_dir):
    """Records without provenance; the labelled documents are candidates with the same hash."""
    phash = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 16)
    r = records(spark, sf_dir).withColumn("phash", phash).withColumn("license", F.lit("UNKNOWN"))
    none = F.lit(None).cast("string")
    candidates = table(spark, sf_dir, "labels").select("doc_id").distinct().select(F.col("doc_id").alias("seq"), phash.alias("phash"), F.lit("T").alias("title"), none.alias("description_url"), none.alias("url"), F.create_map(F.lit("LicenseShortName"), F.lit("CC0")).alias("meta"), F.lit("Shale").alias("category"))
    return commands.recover(spark, r.select(*RECORD.names), candidates).report["unmatched"].limit(15)


# Reports -------------------------------------------------------------------------------------


@query(", c(klass) AS (VALUES ('01_real_estratos'), ('02_real_plastiglomerado'), ('03_proxy_materiales'), ('04_synth_plastiglomerado'), ('_unclassified')) SELECT c.klass, count(r.filename) AS n FROM c LEFT JOIN r ON c.klass = r.klass AND NOT rejected GROUP BY 1")
def report_by_class(spark, sf_dir):
    return reports.by_class(records(spark, sf_dir))


@query(" SELECT license, count(*) AS n FROM r WHERE NOT rejected GROUP BY 1")
def report_by_license(spark, sf_dir):
    return reports.by_license(records(spark, sf_dir))


@query(" SELECT reason, count(*) AS n FROM (SELECT unnest(reject_reasons) AS reason FROM r) GROUP BY 1")
def report_reasons(spark, sf_dir):
    return reports.reasons(records(spark, sf_dir))


@query(", t AS (SELECT count(*) AS entries, count(*) FILTER (WHERE NOT rejected) AS active, count(*) FILTER (WHERE rejected) AS rejected, count(*) FILTER (WHERE NOT rejected AND license <> 'UNKNOWN' AND coalesce(origin_title, '') <> '') AS with_provenance, count(*) FILTER (WHERE NOT rejected AND coalesce(caption, '') <> '') AS captioned FROM r) SELECT *, CASE WHEN active > 0 THEN CAST(floor(100 * with_provenance / active) AS BIGINT) ELSE 0 END AS provenance_pct FROM t")
def report_totals(spark, sf_dir):
    return reports.totals(records(spark, sf_dir))


@query(" SELECT count(*) FILTER (WHERE NOT rejected) AS active, count(*) FILTER (WHERE NOT rejected AND coalesce(origin_title, '') <> '') AS with_title, count(*) FILTER (WHERE NOT rejected AND license = 'UNKNOWN') AS unknown_license FROM r")
def attribution_counts(spark, sf_dir):
    return reports.attribution_counts(records(spark, sf_dir))


@query(" SELECT mode, count(*) AS n FROM r GROUP BY 1")
def mode_histogram(spark, sf_dir):
    return reports.histogram(records(spark, sf_dir), F.col("mode"), "mode")


@query("WITH o AS (SELECT n_chars AS v, row_number() OVER (ORDER BY n_chars) - 1 AS k, count(*) OVER () AS n FROM documents WHERE n_chars IS NOT NULL) SELECT count(*) AS n, min(v) AS least, max(v) AS most, CAST(median(v) AS DOUBLE) AS median, min(v) FILTER (WHERE k = least(CAST(floor(n * 0.1) AS BIGINT), n - 1)) AS p10, min(v) FILTER (WHERE k = least(CAST(floor(n * 0.9) AS BIGINT), n - 1)) AS p90 FROM o", False)
def audit_quantiles(spark, sf_dir):
    return reports.nearest_rank(table(spark, sf_dir, "documents"), "n_chars", {"p10": 0.1, "p90": 0.9})


@query(", f AS (SELECT doc_id, list_contains(reject_reasons, 'too_small') AS bad, doc_id > min(doc_id) OVER (PARTITION BY sha256) AS dup, doc_id % 29 <> 0 AS readable FROM r) SELECT count(*) FILTER (WHERE readable) AS readable, count(*) FILTER (WHERE readable AND NOT bad AND NOT dup) AS usable FROM f")
def audit_usable(spark, sf_dir):
    r = records(spark, sf_dir)
    dups = duplicates.exact_duplicates(r, order="doc_id").select("filename", F.lit(True).alias("dup"))
    return reports.usable(r.join(dups, "filename", "left"), F.col("dup"), F.col("doc_id") % 29 != 0)


@query(" SELECT count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) FILTER (WHERE lower(regexp_extract(filename, '(\\.[^.]+)$', 1)) IN ('.jpg', '.jpeg', '.png')) AS images, min(width) AS least_width, max(width) AS most_width, CAST(median(height) AS DOUBLE) AS median_height, count(*) FILTER (WHERE mode NOT IN ('RGB', 'L')) AS odd_modes FROM r")
def audit_summary(spark, sf_dir):
    return reports.file_summary(records(spark, sf_dir))


# Export --------------------------------------------------------------------------------------

_GATE_SQL = f", g AS (SELECT *, CASE WHEN rejected OR klass = '_unclassified' THEN 'inactive' WHEN NOT {allowed_sql('license')} THEN 'skipped_license' WHEN coalesce(caption, '') = '' THEN 'skipped_no_caption' WHEN doc_id % 11 = 0 THEN 'missing_source' ELSE 'ok' END AS export_status FROM r), p AS (SELECT *, CASE klass WHEN '01_real_estratos' THEN 10 WHEN '02_real_plastiglomerado' THEN 15 WHEN '03_proxy_materiales' THEN 8 WHEN '04_synth_plastiglomerado' THEN 5 ELSE 1 END AS repeats, regexp_replace(filename, '\\.[^.]+$', '') AS stem FROM g WHERE export_status = 'ok')"


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.gate_status(records(spark, sf_dir), F.col("doc_id") % 11 != 0)


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.export_paths(_gated(spark, sf_dir).where("export_status = 'ok'"))


@query(_GATE_SQL + " SELECT filename, export_status FROM g")
def export_gate_status(spark, sf_dir):
    return _gated(spark, sf_dir).select("filename", "export_status")


@query(_GATE_SQL + " SELECT filename, repeats || '_' || klass || '/' || stem || '.jpg' AS image, repeats || '_' || klass || '/' || stem || '.txt' AS caption_file FROM p")
def export_paths(spark, sf_dir):
    return _exported(spark, sf_dir).select("filename", F.concat_ws("/", "folder", "image_name").alias("image"), F.concat_ws("/", "folder", "caption_name").alias("caption_file"))


@query(_GATE_SQL + " SELECT filename, NOT (mode = 'RGB' AND lower(regexp_extract(filename, '(\\.[^.]+)$', 1)) IN ('.jpg', '.jpeg')) AS converted FROM p")
def export_converted_flag(spark, sf_dir):
    return _exported(spark, sf_dir).select("filename", "converted")


@query(_GATE_SQL + " SELECT repeats || '_' || klass AS folder, count(*) AS images, CAST(repeats AS BIGINT) AS repeats, CAST(count(*) * repeats AS BIGINT) AS views FROM p GROUP BY klass, repeats")
def export_folder_totals(spark, sf_dir):
    return export.folder_totals(_exported(spark, sf_dir))


@query(_GATE_SQL + """ SELECT stem || '.jpg' AS file_name, caption AS text, stem || '.jpg,' || CASE WHEN regexp_matches(caption, '[,"\r\n]') THEN '"' || replace(caption, '"', '""') || '"' ELSE caption END AS line FROM p""")
def captions_csv(spark, sf_dir):
    rows = export.captions_csv(_exported(spark, sf_dir))
    return rows.withColumn("line", export.csv_line(F.col("file_name"), F.col("text")))


def _sheet_sql() -> str:
    tag = lambda c, k: f"array_to_string(list_transform({c}, lambda x: '<span class=''tag{k}''>' || {escape_sql('x')} || '</span>'), '')"
    return f""" SELECT filename, CASE WHEN rejected THEN 'bad' WHEN len(needs_review) > 0 THEN 'warn' ELSE 'ok' END AS css,
 '<figure class=''' || CASE WHEN rejected THEN 'bad' WHEN len(needs_review) > 0 THEN 'warn' ELSE 'ok' END || '''><img alt=''no se pudo leer''><figcaption><div class=''name''>' || {escape_sql('filename')} || '</div><div class=''meta''>' || CASE WHEN coalesce(width, 0) <> 0 THEN width || '×' || height ELSE '?' END || ' · ' || {escape_sql("CASE WHEN license = '' THEN '?' ELSE license END")} || '</div><div class=''tags''>'
 || {tag('reject_reasons', '')} || {tag('needs_review', ' warn')} || CASE WHEN panoramic THEN '<span class=''tag info''>panorámica</span>' ELSE '' END || CASE WHEN klass <> '_unclassified' THEN '<span class=''tag info''>' || klass || '</span>' ELSE '' END || '</div>' || CASE WHEN coalesce(caption, '') <> '' THEN '<div class=''cap''>' || {escape_sql('substr(caption, 1, 110)')} || '</div>' ELSE '' END || '</figcaption></figure>' AS figure FROM r"""


@query(_sheet_sql())
def contact_sheet_rows(spark, sf_dir):
    return export.sheet_rows(records(spark, sf_dir))


@query(" SELECT source, filename, '- **' || filename || '** — ' || origin_title || CASE WHEN attribution <> '' THEN ' por ' || attribution ELSE '' END || ' (' || license || ')' || CASE WHEN origin_url IS NOT NULL THEN ' <' || origin_url || '>' ELSE '' END AS line FROM r WHERE NOT rejected AND coalesce(origin_title, '') <> ''")
def attribution_lines(spark, sf_dir):
    return export.attribution_lines(records(spark, sf_dir))


# Manifest ------------------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 3 = 0", False)
def upsert_manifest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = o.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("new").alias("o_orderstatus"))
    return manifest.upsert(o.where("o_orderkey % 5 <> 0"), new, "o_orderkey")


@query(", k AS (SELECT source || '_' || (doc_id % 7) AS filename, doc_id, CASE WHEN doc_id % 31 = 0 THEN FALSE WHEN doc_id % 37 = 0 THEN FALSE ELSE TRUE END AS good FROM r), l AS (SELECT filename, max(doc_id) AS line_no FROM k WHERE good GROUP BY 1) SELECT * FROM l")
def scan_manifest_latest_wins(spark, sf_dir):
    r = records(spark, sf_dir).withColumn("filename", F.concat("source", F.lit("_"), (F.col("doc_id") % 7).cast("string")))
    line = F.to_json(F.struct("filename", "source", F.when(F.col("doc_id") % 37 == 0, "no_such_class").otherwise(F.col("klass")).alias("klass"), "reject_reasons"))
    lines = r.select(F.col("doc_id").alias("line_no"), F.when(F.col("doc_id") % 31 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    rows = manifest.parse_lines(lines)
    return manifest.latest(rows.where(F.col("corrupt_").isNull() & manifest.valid(rows)), "filename", F.col("line_no")).select("filename", "line_no")


@query(" SELECT filename, license, klass, rejected, coalesce(origin_title, 'none') AS title, len(reject_reasons) AS n_reasons, origin_title IS NULL AS title_left_out FROM r")
def manifest_json_lines(spark, sf_dir):
    lines = manifest.to_lines(records(spark, sf_dir))
    back = manifest.parse_lines(lines.select("line"), "line")
    return back.select("filename", "license", "klass", "rejected", F.coalesce("origin_title", F.lit("none")).alias("title"), F.size("reject_reasons").cast("long").alias("n_reasons"), (~F.contains(F.col("line_"), F.lit('"origin_title":'))).alias("title_left_out"))


@query(" SELECT count(DISTINCT sha256) AS n_sha256, count(DISTINCT NULLIF(CASE WHEN doc_id % 2 = 0 THEN md5(text) ELSE '' END, '')) AS n_phash, count(DISTINCT NULLIF(download_url, '')) AS n_urls FROM r")
def known_index_sizes(spark, sf_dir):
    r = records(spark, sf_dir).withColumn("phash", F.when(F.col("doc_id") % 2 == 0, F.md5("text")).otherwise(""))
    return manifest.index_sizes(r)


@query(", a AS (SELECT filename AS name, bytes AS length FROM r), b AS (SELECT filename AS name, CASE WHEN doc_id % 5 = 0 THEN bytes + 1 ELSE bytes END AS length FROM r WHERE doc_id % 2 = 0) SELECT name, length FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.name = a.name AND b.length = a.length)")
def ingest_new_or_changed(spark, sf_dir):
    r = records(spark, sf_dir)
    a = r.select(F.col("filename").alias("name"), F.col("bytes").alias("length"))
    b = r.where("doc_id % 2 = 0").select(F.col("filename").alias("name"), F.when(F.col("doc_id") % 5 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("length"))
    return ingest.new_or_changed(a, b)


# Documents from outside ----------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1", False)
def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", text.parsed(F.col("props"), "k long")["k"].alias("k"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


def _pages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a media wiki as its API would send them, one JSON text a row."""
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    value = lambda c: F.struct(c.alias("value"))
    meta = F.map_filter(
        F.create_map(
            F.lit("LicenseShortName"), value(F.when(i % 3 != 0, F.lit("CC BY 4.0"))),
            F.lit("UsageTerms"), value(F.when(i % 6 == 0, F.lit("<b>Public</b>  domain"))),
            F.lit("Artist"), value(F.when(i % 2 == 0, F.lit("<a href='x'>Ann</a>"))),
            F.lit("Credit"), value(F.lit("Own work")),
            F.lit("ImageDescription"), value(F.concat(F.lit("<p>page "), i.cast("string"), F.lit("</p>"))),
        ),
        lambda _, v: v["value"].isNotNull(),
    )
    info = F.struct(F.when(i % 10 != 0, F.col("url")).alias("url"), F.concat(F.lit("http://d/"), i.cast("string")).alias("descriptionurl"), (800 + i * 31 % 900).cast("int").alias("width"), (900 + i * 17 % 900).cast("int").alias("height"), meta.alias("extmetadata"))
    title = F.concat(F.lit("File:Pic, Nº "), i.cast("string"), F.when(i % 4 == 0, ".PNG").when(i % 4 == 1, ".svg").otherwise(".jpg"))
    page = F.struct(i.alias("pageid"), title.alias("title"), F.array(info).alias("imageinfo"), F.array(F.struct(F.lit("Category:Shale").alias("title"))).alias("categories"))
    return p.select("page_id", F.to_json(page).alias("page"))


@query(
    """WITH p AS (SELECT page_id, url, 800 + page_id * 31 % 900 AS width, 900 + page_id * 17 % 900 AS height, CASE WHEN page_id % 4 = 0 THEN '.PNG' WHEN page_id % 4 = 1 THEN '.svg' ELSE '.jpg' END AS ext FROM pages)
SELECT 'wm_' || page_id || '_pic_nº_' || page_id || lower(ext) AS filename, 'File:Pic, Nº ' || page_id || ext AS origin_title, url AS download_url, CASE WHEN page_id % 3 <> 0 THEN 'CC BY 4.0' WHEN page_id % 6 = 0 THEN 'Public domain' ELSE 'UNKNOWN' END AS license,
 CASE WHEN page_id % 2 = 0 THEN 'Ann' ELSE 'Own work' END AS attribution, 'page ' || page_id AS description, 'Shale|Outcrops' AS categories, CAST(width AS INTEGER) AS width, CAST(height AS INTEGER) AS height FROM p WHERE page_id % 10 <> 0 AND page_id % 4 <> 1 AND width >= 1024 AND height >= 1024""",
    False,
)
def page_to_record(spark, sf_dir):
    rows = mediawiki.pages_to_records(_pages_json(spark, sf_dir), "page", F.lit("01_real_estratos"), F.lit("Outcrops"))
    return rows.select("filename", "origin_title", "download_url", "license", "attribution", "description", _joined("categories").alias("categories"), "width", "height")


@query(
    f""", c AS (SELECT *, doc_id % 3 = 0 AS hit, CASE WHEN doc_id % 2 = 0 THEN 'CC BY 4.0' END AS lic, CASE WHEN doc_id % 9 = 0 THEN 'Shale| Cliffs |' END AS cats FROM r), a AS (SELECT doc_id, filename, hit, CASE WHEN hit THEN 'wikimedia' ELSE source END AS source, CASE WHEN hit THEN coalesce(lic, license) ELSE license END AS license, CASE WHEN hit THEN 'Title ' || doc_id ELSE origin_title END AS origin_title,
  CASE WHEN NOT hit THEN categories WHEN cats IS NULL THEN ['Limestone'] ELSE ['Shale', 'Cliffs', 'Limestone'] END AS categories, reject_reasons, rejected FROM c), b AS (SELECT *, CASE WHEN hit THEN {_RELICENSED} ELSE reject_reasons END AS after FROM a)
SELECT filename, source, license, origin_title, array_to_string(categories, '|') AS categories, array_to_string(after, '|') AS reasons, CASE WHEN hit THEN len(after) > 0 ELSE rejected END AS rejected FROM b"""
)
def apply_metadata(spark, sf_dir):
    r, i = records(spark, sf_dir), F.col("doc_id")
    meta = F.map_filter(F.create_map(F.lit("LicenseShortName"), F.when(i % 2 == 0, F.lit("CC BY <i>4.0</i>")), F.lit("Categories"), F.when(i % 9 == 0, F.lit("Shale| Cliffs |"))), lambda _, v: v.isNotNull())
    matched = r.where("doc_id % 3 = 0").select("filename", F.concat(F.lit("Title "), i.cast("string")).alias("title"), F.lit("http://d").alias("description_url"), F.lit("http://f").alias("url"), meta.alias("meta"), F.lit("Limestone").alias("category"))
    out = provenance.apply_metadata(r, matched)
    return out.select("filename", "source", "license", "origin_title", _joined("categories").alias("categories"), _joined("reject_reasons").alias("reasons"), "rejected")


# Pixels --------------------------------------------------------------------------------------


@query(
    """WITH s AS (SELECT max(vec_id) + 1 AS h, 64 AS w FROM embeddings), b AS (SELECT h, w, greatest(2, CAST(floor(least(h, w) * 0.12) AS BIGINT)) AS m FROM s), p AS (SELECT vec_id AS row, generate_subscripts(embedding, 1) - 1 AS col, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
q AS (SELECT v FROM p, b WHERE row < m UNION ALL SELECT v FROM p, b WHERE row >= h - m UNION ALL SELECT v FROM p, b WHERE col < m UNION ALL SELECT v FROM p, b WHERE col >= w - m)
SELECT count(*) AS n, round(avg(v), 6) AS border_mean, round(stddev_pop(v), 6) AS border_std, (SELECT round(avg(CASE WHEN v < -0.1 THEN 1.0 ELSE 0.0 END), 6) FROM p) AS dark_frac, (SELECT round(avg(CASE WHEN v > 0.1 THEN 1.0 ELSE 0.0 END), 6) FROM p) AS light_frac FROM q""",
    False,
)
def pixel_border_stats(spark, sf_dir):
    return pixels.border_stats(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64, -0.1, 0.1)


@query(
    """WITH p AS (SELECT vec_id AS row, generate_subscripts(embedding, 1) - 1 AS col, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), l AS (SELECT v, lag(v) OVER c AS u, lead(v) OVER c AS d, lag(v) OVER r AS a, lead(v) OVER r AS b FROM p WINDOW c AS (PARTITION BY col ORDER BY row), r AS (PARTITION BY row ORDER BY col))
SELECT count(*) AS n, round(var_pop(u + d + a + b - 4 * v), 6) AS variance FROM l WHERE u IS NOT NULL AND d IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL""",
    False,
)
def laplacian_variance(spark, sf_dir):
    return pixels.laplacian_of_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


# Synthesis -----------------------------------------------------------------------------------


@query("WITH n AS (SELECT n_name AS name, row_number() OVER (ORDER BY n_name) - 1 AS k FROM nation), i AS (SELECT range AS i FROM range(100)) SELECT name AS reference, count(*) AS n FROM i JOIN n ON i.i % 25 = n.k GROUP BY 1", False)
def round_robin_assign(spark, sf_dir):
    refs = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return provenance.round_robin(spark.range(100).select(F.col("id").alias("i")), refs).groupBy("reference").agg(F.count("*").alias("n"))


def _pick_sql(values: tuple[str, ...], number: str, salt: str) -> str:
    return f"list_extract({_list(list(values))}, CAST(CAST('0x' || substr(md5('{salt}/' || {number}), 1, 7) AS BIGINT) % {len(values)} + 1 AS BIGINT))"


def _description_sql(number: str) -> str:
    return f"{_pick_sql(provenance.MIXES, number, 'mix')} || ', ' || {_pick_sql(provenance.CONTEXTS, number, 'context')} || ', ' || {_pick_sql(provenance.COMPOSITIONS, number, 'composition')}"


@query(f"SELECT range AS seed, '{text.CaptionWords().trigger}, {text.CaptionWords().synthetic}, plastiglomerate, ' || {_description_sql('range')} || ', photographic detail, natural lighting' AS caption FROM range(200)", False)
def synth_caption(spark, sf_dir):
    return spark.range(200).select(F.col("id").alias("seed"), provenance.synth_caption(provenance.synth_description(F.col("id"))).alias("caption"))


@query(f"WITH n AS (SELECT r_name AS name, row_number() OVER (ORDER BY r_name) - 1 AS k FROM region), i AS (SELECT range AS i FROM range(60)) SELECT 'synth_' || lpad(CAST(i AS VARCHAR), 3, '0') || '_' || name || '.jpg' AS filename, CAST(i + 42 AS VARCHAR) AS source_id, {_description_sql('(i + 42)')} AS description FROM i JOIN n ON i % 5 = k", False)
def synth_records(spark, sf_dir):
    refs = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    return provenance.synth_records(spark, refs, 60, 42).select("filename", "source_id", "description")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence report: active, classified records by licence and verdict."""
    r = records(spark, sf_dir).where(~F.col("rejected") & (F.col("klass") != UNCLASSIFIED))
    return r.groupBy("license", licenses.is_allowed(F.col("license")).alias("allowed"), licenses.explain(F.col("license")).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "license")


