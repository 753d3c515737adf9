"""Audit and change data (X*), sinks (SNK*) and streams (ST*)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions import names, phones
from ..operators import exports, funnel, history, keyed, marts
from ..session import keep_table, scratch_dir
from ..sources import files, sinks
from ..streaming import imports as streamed, stages
from . import duck
from .registry import query
from .resolving import batch, run_upsert
from .scored import CAPS, G01_SQL, capable, name_scored
from .shared import DK, keyed_dealers


@query(
    "x01_file_fingerprints",
    """WITH l AS (SELECT source_file, dealer_id, dealer_id || chr(9) || coalesce(name, '') || chr(13) || chr(10) AS line FROM dealers),
        f AS (SELECT source_file, string_agg(line, '' ORDER BY dealer_id) AS content, count(*) AS row_count FROM l GROUP BY 1)
        SELECT source_file, sha256(content) AS file_hash, octet_length(encode(content)) AS size_bytes, row_count FROM f""",
)
def x01(t):
    path = scratch_dir(t.spark, "x01")
    line = F.concat(F.col("dealer_id").cast("string"), F.lit("\t"), F.coalesce("name", F.lit("")), F.lit("\r"))
    rows = t.dealers.select("dealer_id", "source_file", line.alias("value")).repartition("source_file")
    rows.sortWithinPartitions("source_file", "dealer_id").drop("dealer_id").write.partitionBy("source_file").text(path)
    return history.file_fingerprints(t.spark, path, "*.txt").select(
        F.regexp_extract("path", "source_file=([^/]+)", 1).alias("source_file"),
        "file_hash", "size_bytes", "row_count",
    )


@query(
    "x02_not_yet_imported",
    """SELECT import_id, file_name FROM imports WHERE status <> 'completed' AND file_hash NOT IN (SELECT file_hash FROM imports WHERE status = 'completed')""",
)
def x02(t):
    rows = t.imports.select("import_id", "file_name", "file_hash", "status")
    waiting = rows.where("status <> 'completed'")
    return history.not_yet_imported(waiting, rows.where("status = 'completed'")).select("import_id", "file_name")


@query(
    "x03_import_records",
    f"""WITH {DK}, m AS (SELECT source_file, phone_key IS NOT NULL AND row_number() OVER (PARTITION BY phone_key ORDER BY dealer_id) > 1 AS later FROM dk)
        SELECT source_file, 'completed' AS status, count(*) AS rows_read, count(*) FILTER (NOT later) AS rows_new, count(*) FILTER (later) AS rows_merged FROM m GROUP BY 1""",
)
def x03(t):
    rows = keyed_dealers(t, "source_file").select("dealer_id", "phone_key", "source_file")
    marked = keyed.mark_later(rows, "phone_key", "dealer_id")
    return history.import_records(marked, "source_file", "is_duplicate")


FIELDS = ["company_name", "city", "state", "primary_phone", "primary_email"]
SHIFT = 1_000_000_000_000


def snapshots(t):
    """Before and after: deleted rows are gone, some cities moved, ranked companies came in."""
    before = t.contractors.select("id", *FIELDS)
    moved = F.when(F.col("source_type") == "both", "Tampa").otherwise(F.col("city"))
    kept = t.contractors.where("coalesce(is_deleted, 0) = 0").select(
        "id", "company_name", moved.alias("city"), "state", "primary_phone",
        F.coalesce("primary_email", "website_url").alias("primary_email"),
    )
    none = F.lit(None).cast("string")
    added = t.rankings.select(
        (F.col("ranking_id") + SHIFT).alias("id"), "company_name", none.alias("city"),
        F.col("headquarters_state").alias("state"), none.alias("primary_phone"), none.alias("primary_email"),
    )
    return before, kept.unionByName(added)


def _pairs(values):
    """k=v text of a map in field order, as the check writes it."""
    entry = lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("NULL")))
    return F.array_join(F.transform(F.map_entries(values), entry), ";")


def _changed(side: str) -> str:
    return "concat_ws(';', " + ", ".join(
        f"CASE WHEN o.{f} IS DISTINCT FROM n.{f} THEN '{f}=' || coalesce({side}.{f}, 'NULL') END" for f in FIELDS
    ) + ")"


def _all(side: str) -> str:
    return "concat_ws(';', " + ", ".join(f"'{f}=' || coalesce({side}.{f}, 'NULL')" for f in FIELDS) + ")"


@query(
    "x04_change_log",
    f"""WITH o AS (SELECT id, {', '.join(FIELDS)} FROM contractors), n AS (SELECT id, company_name, CASE WHEN source_type = 'both' THEN 'Tampa' ELSE city END AS city, state, primary_phone,
        coalesce(primary_email, website_url) AS primary_email FROM contractors WHERE coalesce(is_deleted, 0) = 0 UNION ALL
        SELECT ranking_id + {SHIFT}, company_name, NULL, headquarters_state, NULL, NULL FROM rankings),
        j AS (SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'INSERT' WHEN n.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change_type,
        CASE WHEN n.id IS NULL THEN {_all('o')} WHEN o.id IS NOT NULL THEN {_changed('o')} END AS old_values,
        CASE WHEN o.id IS NULL THEN {_all('n')} WHEN n.id IS NOT NULL THEN {_changed('n')} END AS new_values FROM o FULL OUTER JOIN n ON o.id = n.id)
        SELECT * FROM j WHERE change_type <> 'UPDATE' OR new_values <> ''""",
)
def x04(t):
    before, after = snapshots(t)
    return history.change_log(before, after, "id", FIELDS).select(
        "id", "change_type", _pairs("old_values").alias("old_values"), _pairs("new_values").alias("new_values")
    )


@query(
    "x05_history_of_entity",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events WHERE user_id = 7 ORDER BY ts DESC""",
)
def x05(t):
    return history.history_of(t.events, "user_id", 7, "ts", "props", "k BIGINT").select(
        "event_id", "values.k", "event_type"
    )


@query(
    "x06_soft_delete",
    """SELECT c.id, CASE WHEN coalesce(is_deleted, 0) = 0 AND a.contractor_id IS NOT NULL THEN 1 ELSE coalesce(is_deleted, 0) END AS is_deleted,
       CASE WHEN coalesce(is_deleted, 0) = 0 AND a.contractor_id IS NOT NULL THEN 'Disqualified lead' END AS deletion_reason
       FROM contractors c LEFT JOIN (SELECT contractor_id FROM attribution WHERE stage = 'DISQUALIFIED') a ON a.contractor_id = c.id""",
)
def x06(t):
    doomed = t.attribution.where("stage = 'DISQUALIFIED'").select(
        F.col("contractor_id").alias("id"), F.lit("Disqualified lead").alias("reason")
    )
    return history.soft_delete(t.contractors.select("id", "is_deleted"), doomed)


@query(
    "x07_rollback",
    """WITH f AS (SELECT contractor_id AS id, min_by(source_file, license_id) AS source_file FROM licenses GROUP BY 1)
       SELECT c.id, CASE WHEN coalesce(is_deleted, 0) = 0 AND f.id IS NOT NULL THEN 1 ELSE coalesce(is_deleted, 0) END AS is_deleted,
       CASE WHEN coalesce(is_deleted, 0) = 0 AND f.id IS NOT NULL THEN 'Rollback of import fl_2024.csv' END AS deletion_reason
       FROM contractors c LEFT JOIN (SELECT id FROM f WHERE source_file = 'fl_2024.csv') f USING (id)""",
)
def x07(t):
    inserted = t.licenses.groupBy(F.col("contractor_id").alias("id")).agg(
        F.min_by("source_file", "license_id").alias("source_file")
    )
    return history.rollback(t.contractors.select("id", "is_deleted"), inserted, "source_file", "fl_2024.csv")


@query(
    "x08_run_ledger",
    """SELECT import_id, state, CAST(imported_on AS VARCHAR) AS imported_on, row_number() OVER (PARTITION BY state ORDER BY imported_on DESC, import_id DESC) AS rank_in_group
       FROM imports QUALIFY rank_in_group <= 3""",
)
def x08(t):
    newest = history.run_ledger(t.imports.select("import_id", "state", "imported_on"), "state", "imported_on", "import_id", 3)
    return newest.select(
        "import_id", "state", F.col("imported_on").cast("string").alias("imported_on"),
        F.col("rank_in_group").cast("long").alias("rank_in_group"),
    )


@query("x09_audited_upsert")
def x09(t):
    records = keep_table(batch(t), "batch")
    log = history.merge_log(run_upsert(t, records).assignments, records, ["company_name", "phone", "email", "state"])
    return log.select("entity_id", "record_id", "change_type", F.to_json("new_values").alias("new_values"))


STAGE_TIMES = """SELECT event_id, contractor_id, lag(stage_to) OVER w AS stage_from, stage_to,
    CAST(floor((epoch_us(date_trunc('second', ts)) - epoch_us(date_trunc('second', lag(ts) OVER w))) / 3600000000) AS BIGINT) AS hours_in_previous
    FROM funnel_events WINDOW w AS (PARTITION BY contractor_id ORDER BY ts, event_id)"""


@query("x10_time_in_previous_stage", STAGE_TIMES)
def x10(t):
    return funnel.time_in_previous_stage(t.funnel_events, "contractor_id", "ts", "stage_to")


# --- sinks -----------------------------------------------------------------------------------------------


@query("snk01_csv", f"WITH {G01_SQL} SELECT entity_key, icp_tier, CAST(score_hundredths AS VARCHAR) AS score_hundredths FROM final")
def snk01(t):
    path = scratch_dir(t.spark, "snk01")
    sinks.write_csv(name_scored(t), path, ["icp_tier", "entity_key", "score_hundredths"])
    return files.read_header_csv(t.spark, path)


@query("snk02_json_with_header", f"WITH {G01_SQL} SELECT 'SCORED' AS kind, count(*) AS total_records, (SELECT count(*) FROM final) AS records FROM final")
def snk02(t):
    path = scratch_dir(t.spark, "snk02")
    sinks.write_json_with_header(name_scored(t).select("entity_key", "icp_tier"), path, kind="SCORED")
    records = t.spark.read.schema("entity_key STRING, icp_tier STRING").json(f"{path}/records")
    head = t.spark.read.schema("total_records BIGINT, kind STRING").json(f"{path}/metadata")
    return head.join(F.broadcast(records.agg(F.count(F.lit(1)).alias("records"))))


@query("snk03_one_output_per_tier", f"WITH {G01_SQL} SELECT icp_tier, count(*) AS records FROM final GROUP BY 1")
def snk03(t):
    path = scratch_dir(t.spark, "snk03")
    sinks.write_per_value(name_scored(t).select("entity_key", "name", "icp_tier"), path, "icp_tier")
    rows = t.spark.read.option("header", True).csv(path)
    return rows.groupBy("icp_tier").agg(F.count(F.lit(1)).alias("records"))


@query(
    "snk04_json_cells",
    """WITH l AS (SELECT contractor_id, brand, max_by(certification_tier, cert_id) AS tier FROM certifications GROUP BY 1, 2)
       SELECT contractor_id, '["' || string_agg(brand, '","' ORDER BY brand) || '"]' AS brands,
       '{' || string_agg('"' || brand || '":"' || tier || '"', ',' ORDER BY brand) || '}' AS tiers FROM l GROUP BY 1""",
)
def snk04(t):
    held = marts.brand_tiers(t.certifications).withColumn("brands", F.array_sort(F.map_keys("tiers")))
    return exports.json_cells(held, ["brands", "tiers"])


@query("snk05_flattened", f"WITH {CAPS} SELECT dealer_id, has_hvac, has_solar, has_electrical, len(tr) >= 2 AS is_multi_trade FROM c4")
def snk05(t):
    flags = ["has_hvac", "has_solar", "has_electrical", "is_multi_trade"]
    nested = capable(t).select("dealer_id", F.struct(*flags).alias("capabilities"))
    return exports.flattened(nested, "capabilities")


LOCAL_PHONE = f"CASE WHEN NOT {duck.toll_free(duck.phone10('phone'))} THEN '(' || substr({duck.phone10('phone')}, 1, 3) || ') ' || substr({duck.phone10('phone')}, 4, 3) || '-' || substr({duck.phone10('phone')}, 7, 4) END"
GENERATORS = "brand IN ('Generac', 'Briggs & Stratton', 'Cummins', 'Kohler')"
SUNNY = "brand IN ('Enphase', 'SolarEdge', 'SMA')"


@query(
    "snk06_lead_payload",
    f"""SELECT dealer_id, {duck.clean('name')} AS company_name, {LOCAL_PHONE} AS contact_phone, {duck.clean('email')} AS contact_email, 'OEM:' || brand AS source, 'new' AS status_label,
        'silver' AS icp_tier, 50 AS fit_score, 0 AS qualification_score, brand IN ('Carrier', 'Mitsubishi', 'York', 'Trane', 'Rheem') AS has_hvac, false AS has_plumbing,
        {GENERATORS} OR brand = 'Tesla' AS has_electrical, {SUNNY} OR brand = 'Tesla' AS has_solar, {GENERATORS} OR {SUNNY} OR brand = 'Tesla' AS has_energy, false AS is_atl
        FROM dealers WHERE {duck.clean('name')} IS NOT NULL""",
)
def snk06(t):
    return exports.brand_payload(t.dealers)


@query(
    "snk07_staged_rows",
    """SELECT dealer_id, row_number() OVER (ORDER BY dealer_id) AS row_number, '{"dealer_id":' || dealer_id || ',"city":"' || city || '","state":"' || state || '"}' AS raw_data,
       concat_ws(',', nullif(CASE WHEN has_hvac = 'True' THEN brand ELSE '' END, ''), nullif(CASE WHEN has_generator = 'True' THEN 'Generator' ELSE '' END, '')) AS brand_list,
       'oem_dealer' AS source FROM dealers""",
)
def snk07(t):
    from ..operators.numbering import number_rows

    rows = t.dealers.select(
        "dealer_id", "city", "state", F.lit(None).cast("string").alias("source"),
        F.when(F.col("has_hvac") == "True", F.col("brand")).otherwise("").alias("brand_1"),
        F.when(F.col("has_generator") == "True", "Generator").otherwise("").alias("brand_2"),
    )
    staged = exports.staged_rows(rows, "oem_dealer", ["dealer_id", "city", "state"], ["brand_1", "brand_2"])
    return number_rows(staged, "dealer_id").select(
        "dealer_id", F.col("row_number").cast("long").alias("row_number"), "raw_data", "brand_list", "source"
    )


@query(
    "snk08_directory_leads",
    f"""SELECT dealer_id, {duck.clean('name')} AS company_name, {duck.company_key('name')} AS normalized_name, coalesce({LOCAL_PHONE}, {duck.clean('phone')}) AS phone,
        {duck.clean('email')} AS email, {duck.clean('website')} AS website, brand AS brand_name, {duck.clean('tier')} AS brand_tier, {duck.clean('phone')} IS NOT NULL AS has_phone,
        {duck.clean('email')} IS NOT NULL AS has_email, {duck.clean('website')} IS NOT NULL AS has_website, 'pending' AS enrichment_status, 'not_synced' AS crm_status FROM dealers""",
)
def snk08(t):
    rows = t.dealers.withColumn("contact_name", F.lit(None).cast("string"))
    return exports.directory_leads(rows, names.company_key("name"))


# --- streams -----------------------------------------------------------------------------------------------


@query(
    "st1_incremental_import",
    f"""WITH {DK} SELECT phone_key, dealer_id, brand FROM dk WHERE phone_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY phone_key ORDER BY source_file, dealer_id) = 1""",
)
def st1(t):
    """The directory files arrive one after the other; the table ends as a batch load would."""
    root = scratch_dir(t.spark, "st1")
    rows = t.dealers.select("dealer_id", "source_file", "brand", phones.phone10("phone").alias("phone_key"))
    for wave in range(4):
        rows.where(F.col("source_file") == f"dir_{wave}").write.mode("append").parquet(f"{root}/in")
        arriving = streamed.read_arriving(t.spark, f"{root}/in", rows.schema)
        streamed.import_into_master(arriving, f"{root}/master", f"{root}/checkpoint", "phone_key", "dealer_id")
    return streamed.read_master(t.spark, f"{root}/master", rows.schema).select("phone_key", "dealer_id", "brand")


def _event_files(t, root: str):
    """Funnel events in files that follow each other in time."""
    events = t.funnel_events.withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"{root}/in")
    return streamed.read_arriving(t.spark, f"{root}/in", events.schema)


@query("st2_distinct_keys", "SELECT DISTINCT contractor_id, stage_to FROM funnel_events")
def st2(t):
    root = scratch_dir(t.spark, "st2")
    kept = streamed.distinct_keys(_event_files(t, root), ["contractor_id", "stage_to"], "ts", "3650 days")
    streamed.write_stream(kept.select("contractor_id", "stage_to"), f"{root}/out", f"{root}/checkpoint")
    return t.spark.read.schema("contractor_id BIGINT, stage_to STRING").parquet(f"{root}/out")


@query(
    "st2b_distinct_per_window",
    """SELECT DISTINCT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M') AS window_start, contractor_id, stage_to FROM funnel_events""",
)
def st2b(t):
    """Keys once a day; a day's keys leave the state an hour after its end."""
    root = scratch_dir(t.spark, "st2b")
    kept = streamed.distinct_keys_per_window(
        _event_files(t, root), ["contractor_id", "stage_to"], "ts", "1 day", "1 hour")
    streamed.write_stream(kept, f"{root}/out", f"{root}/checkpoint")
    done = t.spark.read.schema("window_start TIMESTAMP, contractor_id BIGINT, stage_to STRING").parquet(f"{root}/out")
    return done.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query(
    "st3_stage_counts",
    """SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M') AS window_start, stage_to, count(*) AS events FROM funnel_events
       WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM funnel_events) GROUP BY 1, 2""",
)
def st3(t):
    root = scratch_dir(t.spark, "st3")
    counts = stages.stage_counts(_event_files(t, root), "ts", "stage_to", "1 day", "1 hour")
    streamed.write_stream(counts, f"{root}/out", f"{root}/checkpoint")
    done = t.spark.read.schema("window_start TIMESTAMP, stage_to STRING, events BIGINT").parquet(f"{root}/out")
    return done.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("st4_stage_times", STAGE_TIMES)
def st4(t):
    """Keyed state: the files arrive in two waves, the second run goes on from the state of the first."""
    root = scratch_dir(t.spark, "st4")
    events = t.funnel_events.withColumn("ts", F.col("ts").cast("timestamp"))
    cut = events.agg(F.percentile_approx("event_id", 0.5).alias("mid"))
    halves = events.join(F.broadcast(cut)).withColumn("late", F.col("event_id") > F.col("mid")).drop("mid")
    with stages.keyed_state(t.spark):
        for late in (False, True):
            halves.where(F.col("late") == late).drop("late").write.mode("append").parquet(f"{root}/in")
            arriving = streamed.read_arriving(t.spark, f"{root}/in", events.schema)
            timed = stages.stage_times(arriving, "contractor_id", "ts", "stage_to", "1 hour", timedelta(days=3650))
            streamed.write_stream(timed, f"{root}/out", f"{root}/checkpoint")
    done = t.spark.read.schema(
        "event_id BIGINT, contractor_id BIGINT, stage_from STRING, stage_to STRING, hours_in_previous BIGINT, status STRING"
    ).parquet(f"{root}/out")
    return done.where("status = 'in order'").drop("status")
