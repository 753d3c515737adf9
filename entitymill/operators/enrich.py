"""Joins that carry matched data back to records: overlap, fill, master list, nested children."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_sorted
from .linkage import key_index, keyed_hits, match_by_keys
from .skew import lookup_join

CONFIDENCE = {"phone": 100, "domain": 90}


def licence_index(licences: DataFrame, signals: list[str]) -> DataFrame:
    """Earliest licence per phone and per domain."""
    rows = licences.withColumn("entity_id", F.col("pos"))
    columns = {"phone": "phone_key", "domain": "domain_key"}
    return key_index([
        (rows, columns[s], s, s, rank) for rank, s in enumerate(signals, start=1)
    ])


def dealer_licences(dealers: DataFrame, licences: DataFrame) -> DataFrame:
    """Dealer to licence by phone (100), else root domain (90). licences carry pos."""
    index = licence_index(licences, ["phone", "domain"])
    hit = match_by_keys(
        dealers, "dealer_id", {"phone": "phone_key", "domain": "domain_key"}, index
    )
    confidence = F.when(F.col("match_type") == "phone", CONFIDENCE["phone"]).otherwise(
        CONFIDENCE["domain"]
    )
    return hit.select(
        "dealer_id", F.col("entity_id").alias("license_id"),
        F.col("match_type").alias("match_method"), confidence.alias("match_confidence"),
    )


def licence_dealers(licences: DataFrame, dealers: DataFrame) -> DataFrame:
    """Licence to all dealers of its phone, else all of its domain, as count and brand list.

    Dealers are folded to one row per key first, so a shared number never multiplies rows.
    """
    def folded(column: str, signal: str) -> DataFrame:
        return (
            dealers.where(F.col(column).isNotNull())
            .groupBy(F.concat(F.lit(f"{signal}:"), F.col(column)).alias("key"))
            .agg(
                F.count(F.lit(1)).alias("dealers"),
                join_sorted(F.collect_set("brand")).alias("brands"),
            )
        )

    table = folded("phone_key", "phone").unionByName(folded("domain_key", "domain"))
    keys = F.array_compact(
        F.array(F.concat(F.lit("phone:"), "phone_key"), F.concat(F.lit("domain:"), "domain_key"))
    )
    exploded = licences.select("pos", F.explode(keys).alias("key"))
    hits = lookup_join(exploded, table, "key", "pos").withColumn(
        "match_type", F.split_part("key", F.lit(":"), F.lit(1))
    )
    order = F.when(F.col("match_type") == "phone", 0).otherwise(1)
    best = hits.groupBy("pos").agg(
        F.min_by(F.struct("match_type", "dealers", "brands"), order).alias("b")
    )
    return best.select(
        "pos", "b.*",
        F.when(F.col("b.match_type") == "phone", CONFIDENCE["phone"]).otherwise(CONFIDENCE["domain"]).alias("confidence"),
    )


def phone_overlap(licences: DataFrame, dealers: DataFrame) -> DataFrame:
    """Licence rows whose phone a dealer shares, one row each, with the brands of that phone."""
    brands = (
        dealers.where("phone_key IS NOT NULL")
        .groupBy("phone_key")
        .agg(F.collect_set("brand").alias("s"))
        .select("phone_key", join_sorted(F.col("s")).alias("brands"), F.size("s").cast("long").alias("brand_count"))
    )
    return lookup_join(licences.where("phone_key IS NOT NULL"), brands, "phone_key", "pos")


def fill_from_contacts(entities: DataFrame, licences: DataFrame, contacts: DataFrame) -> DataFrame:
    """Missing phone or e-mail of entities licensed in two or more states, from their contacts.

    The first contact (by contact_id) that has the value gives it.
    """
    spread = (
        licences.groupBy("entity_id").agg(F.countDistinct("state").alias("n")).where("n >= 2")
    )
    def first(column: str) -> Column:
        return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.col("contact_id")))

    known = contacts.groupBy("entity_id").agg(
        first("phone").alias("contact_phone"), first("email").alias("contact_email")
    )
    fill = spread.join(known, "entity_id").select("entity_id", "contact_phone", "contact_email")
    return entities.join(fill, "entity_id", "left").withColumns({
        "phone": F.coalesce("phone", "contact_phone"),
        "email": F.coalesce("email", "contact_email"),
    }).drop("contact_phone", "contact_email")


def membership(members: DataFrame) -> DataFrame:
    """Two member lists as one row per domain; the solar list gives the name before the other."""
    order = F.struct(F.when(F.col("list_name") == "solar", 0).otherwise(1), F.col("member_id"))
    return (
        members.where("domain IS NOT NULL")
        .groupBy("domain")
        .agg(
            F.min_by("company_name", order).alias("company_name"),
            F.bool_or(F.col("list_name") == "solar").alias("in_solar_coop"),
            F.bool_or(F.col("list_name") == "om").alias("in_om_coop"),
        )
        .withColumn(
            "cooperative_count",
            F.col("in_solar_coop").cast("int") + F.col("in_om_coop").cast("int"),
        )
    )


def master_list(entities: DataFrame, ranked: DataFrame, coop: DataFrame) -> DataFrame:
    """Licensed entities with what rankings (by name) and cooperatives (by domain) know of them."""
    ranks = ranked.select("name_key", "kw_installed", "list_count", F.lit(True).alias("in_ranking"))
    no = F.lit(False)
    with_rank = lookup_join(entities, ranks, "name_key", "entity_id", "left")
    joined = lookup_join(with_rank, coop.drop("company_name"), "domain", "entity_id", "left")
    in_coop = F.coalesce(F.col("in_solar_coop") | F.col("in_om_coop"), no)
    return joined.select(
        "entity_id", "company_name", "name_key", "domain", "state",
        F.lit(True).alias("has_state_license"),
        F.coalesce("in_ranking", no).alias("in_ranking"),
        F.coalesce("in_solar_coop", no).alias("in_solar_coop"),
        F.coalesce("in_om_coop", no).alias("in_om_coop"),
        (F.lit(1) + F.coalesce("in_ranking", no).cast("int") + in_coop.cast("int")).alias("source_count"),
        F.coalesce("kw_installed", F.lit(0).cast("long")).alias("kw_installed"),
        F.coalesce("list_count", F.lit(0).cast("long")).alias("list_count"),
    )


def outside_master(master: DataFrame, ranked: DataFrame, coop: DataFrame, coop_key: Column) -> DataFrame:
    """Rows for cooperative members and ranked companies that the master list lacks."""
    no = F.lit(False)
    ranks = ranked.select("name_key", "kw_installed", "list_count")
    members = coop.withColumn("name_key", coop_key).join(
        master.select("domain").where("domain IS NOT NULL").distinct(), "domain", "left_anti"
    )
    coop_rows = members.join(ranks.withColumn("_ranked", F.lit(True)), "name_key", "left").select(
        "company_name", "name_key", "domain", F.lit(None).cast("string").alias("state"),
        F.coalesce("_ranked", no).alias("in_ranking"), "in_solar_coop", "in_om_coop",
        (F.coalesce("_ranked", no).cast("int") + 1).alias("source_count"),
        F.coalesce("kw_installed", F.lit(0).cast("long")).alias("kw_installed"),
        F.coalesce("list_count", F.lit(0).cast("long")).alias("list_count"),
    )
    taken = master.select("name_key").unionAll(members.select("name_key")).where(
        "name_key IS NOT NULL"
    ).distinct()
    rank_rows = ranked.where("name_key IS NOT NULL").join(taken, "name_key", "left_anti").select(
        F.col("name_key").alias("company_name"), "name_key", F.lit(None).cast("string").alias("domain"),
        F.col("headquarters_state").alias("state"), F.lit(True).alias("in_ranking"),
        no.alias("in_solar_coop"), no.alias("in_om_coop"), F.lit(1).alias("source_count"),
        "kw_installed", "list_count",
    )
    return coop_rows.unionByName(rank_rows)


def in_several_lists(lists: list[DataFrame]) -> DataFrame:
    """Names that occur more than once over the lists (name_key, source, email, licence)."""
    rows = reduce(lambda a, b: a.unionByName(b), lists).where("name_key IS NOT NULL")
    grouped = rows.groupBy("name_key").agg(
        F.count(F.lit(1)).alias("source_count"),
        join_sorted(F.collect_set("source")).alias("sources"),
        F.count("email").alias("emails"),
        F.countDistinct("licence").alias("licences"),
    )
    return grouped.where("source_count > 1").withColumns({
        "has_email": F.col("emails") > 0, "is_multi_trade": F.col("licences") >= 2,
    })


CHUNK = 1000


def nested_children(
    entities: DataFrame, children: dict[str, DataFrame], chunk: int = CHUNK
) -> DataFrame:
    """Entity rows with sorted child lists per kind, at most about `chunk` children per row.

    Each child frame holds entity_id and item (one text per child). An entity with more than
    `chunk` children spans several rows (part 0, 1, ...), so no list grows without bound.
    """
    rows = reduce(
        lambda a, b: a.unionAll(b),
        [df.select("entity_id", F.lit(kind).alias("kind"), "item") for kind, df in children.items()],
    ).distinct()
    sizes = rows.groupBy("entity_id").agg(
        F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts")
    )
    placed = lookup_join(rows, sizes, "entity_id", "item", hot_rows=1_000_000).withColumn(
        "part", F.pmod(F.xxhash64("kind", "item"), F.col("parts")).cast("int")
    )
    nested = placed.groupBy("entity_id", "part").agg(
        *[
            join_sorted(F.collect_list(F.when(F.col("kind") == kind, F.col("item"))), ";").alias(kind)
            for kind in children
        ]
    )
    return entities.join(nested, "entity_id", "left").withColumn(
        "part", F.coalesce("part", F.lit(0))
    ).fillna("", subset=list(children))


def category_flags(entities: DataFrame, licences: DataFrame, categories: list[str]) -> DataFrame:
    """has_<category> by existence of a licence: one pass over the licences for all flags."""
    flags = {f"has_{c.lower()}": F.col("license_category") == c for c in categories}
    found = licences.groupBy("entity_id").agg(*[F.bool_or(t).alias(n) for n, t in flags.items()])
    return entities.join(found, "entity_id", "left").fillna(False, subset=list(flags))


def pending_sync(entities: DataFrame, status: DataFrame, score: str) -> DataFrame:
    """Entities not yet synced, best score first, unscored last."""
    joined = entities.join(status, "entity_id", "left")
    return joined.where("sync_status IS NULL OR sync_status = 'pending'").withColumn(
        "sync_status", F.coalesce("sync_status", F.lit("pending"))
    ).orderBy(F.desc_nulls_last(score), "entity_id")


def needs_update(entities: DataFrame, status: DataFrame, score: str) -> DataFrame:
    return entities.join(status.where("sync_status = 'needs_update'"), "entity_id").orderBy(
        F.desc_nulls_last(score), "entity_id"
    )


def rank_links(rankings: DataFrame, entities: DataFrame) -> DataFrame:
    """Ranking to the first entity of the same name, in its state where the ranking names one."""
    def key(state: Column) -> Column:
        return F.concat("name_key", F.lit("|"), state)

    rows = entities.where("name_key IS NOT NULL").withColumn("pos", F.col("entity_id"))
    index = key_index([
        (rows.where("state IS NOT NULL").withColumn("k", key(F.col("state"))), "k", "state", "state", 1),
        (rows, "name_key", "name", "name", 2),
    ])
    asked = rankings.where("name_key IS NOT NULL").select(
        "ranking_id",
        F.when(F.col("headquarters_state").isNotNull(), key(F.col("headquarters_state"))).alias("in_state"),
        F.when(F.col("headquarters_state").isNull(), F.col("name_key")).alias("anywhere"),
    )
    hits = keyed_hits(asked, "ranking_id", {"state": "in_state", "name": "anywhere"}, index)
    return rankings.select("ranking_id").join(
        hits.select("ranking_id", "entity_id"), "ranking_id", "left"
    )
