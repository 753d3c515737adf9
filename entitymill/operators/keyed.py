"""Keep-first and merge operators on exact keys.

"First" always means least by an explicit order column; Spark has no row order of its own.
All of them are aggregates with a map-side step, so one key holding a third of the rows
sends one row per task, not its whole group, to the reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import percent
from ..functions.text import join_sorted


def _need_order(df: DataFrame, order: str) -> None:
    if order not in df.columns:
        raise ValueError(f"a unique order column is needed, {order!r} is not there")


def first_per_key(df: DataFrame, keys: list[str], order: str, keep_missing: bool = False) -> DataFrame:
    """The earliest row of every key; rows without a key are dropped, or all kept."""
    _need_order(df, order)
    row = F.struct(*[F.col(c) for c in df.columns])
    missing = None
    for k in keys:
        test = F.col(k).isNull()
        missing = test if missing is None else missing | test
    if keep_missing:
        alone = F.when(missing, F.col(order)).alias("_alone")
        grouped = df.groupBy(*keys, alone)
    else:
        grouped = df.where(~missing).groupBy(*keys)
    return grouped.agg(F.min_by(row, F.col(order)).alias("_row")).select("_row.*")


def first_per_phone_else_name(df: DataFrame, phone: str, name: str, order: str) -> DataFrame:
    """First row per phone; a row without phone stays unless its name was kept before it."""
    _need_order(df, order)
    columns = df.columns
    row = F.struct(*[F.col(c) for c in columns])
    with_phone = first_per_key(df.where(F.col(phone).isNotNull()), [phone], order)
    loose = df.where(F.col(phone).isNull())
    contest = with_phone.where(F.col(name).isNotNull()).unionByName(
        loose.where(F.col(name).isNotNull())
    )
    winners = (
        contest.groupBy(name)
        .agg(
            F.min(F.when(F.col(phone).isNotNull(), F.col(order))).alias("_phone_first"),
            F.min_by(
                F.when(F.col(phone).isNull(), row),
                F.when(F.col(phone).isNull(), F.col(order)),
            ).alias("_row"),
        )
        .where(
            F.col("_row").isNotNull()
            & (F.col("_phone_first").isNull() | (F.col("_phone_first") > F.col(f"_row.{order}")))
        )
        .select("_row.*")
    )
    return with_phone.unionByName(winners).unionByName(loose.where(F.col(name).isNull()))


def mark_later(df: DataFrame, key: str, order: str, flag: str = "is_duplicate") -> DataFrame:
    """Flags every row whose key occurred before.

    The flag comes back by a join on the unique order column, so a hot key stays spread out.
    """
    _need_order(df, order)
    firsts = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(order).alias(order))
        .select(order, F.lit(True).alias("_first"))
    )
    flagged = df.join(firsts, order, "left")
    return flagged.withColumn(flag, F.col(key).isNotNull() & F.col("_first").isNull()).drop("_first")


def phone_then_domain(df: DataFrame, phone: str, domain: str, order: str) -> DataFrame:
    """Two passes: first row per phone, then first row per domain among the survivors."""
    by_phone = first_per_key(df, [phone], order, keep_missing=True)
    return first_per_key(by_phone, [domain], order, keep_missing=True)


def phase_counts(df: DataFrame, phone: str, domain: str, order: str) -> DataFrame:
    by_phone = first_per_key(df, [phone], order, keep_missing=True)
    by_domain = first_per_key(by_phone, [domain], order, keep_missing=True)
    parts = [
        part.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("phase"), "rows")
        for name, part in [("raw", df), ("phone", by_phone), ("domain", by_domain)]
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def contact_key(phone: str, domain: str) -> Column:
    """Phone if there is one, else domain; the prefix keeps the two apart."""
    return F.coalesce(
        F.concat(F.lit("phone_"), F.col(phone)), F.concat(F.lit("domain_"), F.col(domain))
    )


def brand_overlap(
    df: DataFrame, phone: str, domain: str, brands: Column, order: str, base: list[str],
    flags: list[str] | None = None,
) -> DataFrame:
    """One row per business: base columns of its first record, its brands, its merged flags.

    `brands` is an array column; the set of brand names is a small vocabulary, so what a business
    gathers is bounded by it, not by the combinations of brands that its records have.
    """
    _need_order(df, order)
    # a record counts once for each of its brands; first and flags do not mind
    keyed = df.withColumn("entity_key", contact_key(phone, domain)).where("entity_key IS NOT NULL").withColumn(
        "_brand", F.explode_outer(brands))
    first = F.min_by(F.struct(*base), F.col(order))
    found = F.array_sort(F.collect_set("_brand"))
    merged = [F.bool_or(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags or []]
    return (
        keyed.groupBy("entity_key")
        .agg(first.alias("_b"), found.alias("_brands"), *merged)
        .select(
            "entity_key",
            "_b.*",
            *(flags or []),
            F.size("_brands").cast("long").alias("brand_count"),
            F.array_join("_brands", ", ").alias("brands"),
        )
    )


def source_overlap(dealers: DataFrame, licences: DataFrame) -> DataFrame:
    """One row per phone over both kinds of source.

    Both inputs carry phone, name, city, state, source and a unique pos; a dealer record gives
    the name before a licence does.
    """
    both = dealers.select(
        "phone", "name", "city", "state", F.struct(F.lit(0), "pos").alias("pos"),
        F.col("source").alias("brand"), F.lit(None).cast("string").alias("registry"),
    ).unionAll(
        licences.select(
            "phone", "name", "city", "state", F.struct(F.lit(1), "pos").alias("pos"),
            F.lit(None).cast("string"), F.col("source"),
        )
    )
    sets = both.where("phone IS NOT NULL").groupBy("phone").agg(
        F.min_by(F.struct("name", "city", "state"), "pos").alias("b"),
        F.collect_set("brand").alias("brand_set"),
        F.collect_set("registry").alias("registry_set"),
    )
    return sets.select(
        "phone",
        "b.*",
        F.size("brand_set").cast("long").alias("num_brands"),
        F.size("registry_set").cast("long").alias("num_licences"),
        (F.size("brand_set") + F.size("registry_set")).cast("long").alias("num_overlaps"),
        join_sorted(F.col("brand_set")).alias("brand_sources"),
        join_sorted(F.col("registry_set")).alias("licence_sources"),
        join_sorted(F.concat("brand_set", "registry_set")).alias("overlap_sources"),
    )


def best_of_lists(
    df: DataFrame, key: str, order: str, highest: list[str], first_filled: list[str], lists: str
) -> DataFrame:
    """Rows of one company over several lists: highest numbers, first filled text, the lists."""
    _need_order(df, order)
    firsts = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
        for c in first_filled
    ]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *[F.max(c).alias(c) for c in highest],
            *firsts,
            F.countDistinct(lists).alias("list_count"),
            join_sorted(F.collect_set(lists)).alias("lists"),
        )
    )


def match_log(edges: DataFrame, fingerprint: Column, source: str) -> DataFrame:
    """Why a record was merged: entity, hash of the record, signal, value, confidence."""
    return edges.select(
        "entity_id",
        fingerprint.alias("record_hash"),
        "match_type",
        "match_value",
        F.lit(1.0).alias("confidence"),
        F.lit(source).alias("source_file"),
    )


def dedup_report(df: DataFrame, key: str, order: str, by: str) -> DataFrame:
    """Raw, unique and removed rows with the removal rate, by one column."""
    marked = mark_later(df.select(order, key, by), key, order, "_later")
    return marked.groupBy(by).agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(~F.col("_later")).alias("unique_rows"),
        F.count_if("_later").alias("removed"),
    ).withColumn("removed_pct", percent(F.col("removed"), F.col("raw")))


def most_repeated(df: DataFrame, key: str, order: str, name: str, top: int = 20) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"), F.min_by(name, order).alias("first_name"))
        .where("rows > 1")
        .orderBy(F.desc("rows"), key)
        .limit(top)
    )


def new_children(candidates: DataFrame, existing: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Children to insert: the first per key that the table does not hold yet."""
    firsts = first_per_key(candidates, keys, order)
    return firsts.join(existing.select(*keys).distinct(), keys, "left_anti")
