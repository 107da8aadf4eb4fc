"""The paid-period chain, refreshed for the companies that changed (A2 + A6).

Every model of the chain is computed company by company, so a company's rows change only
when one of its own input rows does.  The store keeps a digest of each company's inputs
beside the models.  A refresh

1. computes the digests anew, from the narrow columns the models read, summed per contract
   before the company is joined in, and compares them with the stored ones;
2. reads the inputs of the touched companies alone past that point, and computes their rows;
3. rewrites the buckets that hold a touched company: the other companies' stored rows of
   these buckets are copied, all other buckets are shared with the version before;
4. commits all models and the digests as one version, so readers see the chain as a whole
   before or after the refresh, and of two refreshes at a time one gets ``Conflict``.

A new, vanished or altered company is touched alike.  An altered SKU map touches the
companies with an item of an altered SKU.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.intervals import rejected_intervals
from ledgerline.plans import paid_calendar, paid_periods
from ledgerline.sources.tables import materialize
from ledgerline.sources.versions import Store, Version, bucket_of

KEY = "company_id"
DIGESTS = "company_digests"
BUCKETS = 64
MODELS = ("paid_periods", "paid_financial_years", "paid_months", "paid_quarters", "rejected_items")
SERVICE = paid_calendar.SERVICE


def row_digest(columns: Sequence[str]) -> Column:
    """A hash of a row's values; NULL differs from every value and by its place."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]).cast("decimal(38,0)")


def _sums(prefix: str) -> list[Column]:
    return [F.sum("digest").alias(f"{prefix}_sum"), F.count("digest").alias(f"{prefix}_rows")]


def company_digests(
    contracts: DataFrame, contract_items: DataFrame, sku_for_tickets: DataFrame, financial_years: DataFrame
) -> DataFrame:
    """company_id and digest: of the multiset of all input rows its models are made from.
    Row hashes are added up, so neither the order nor the layout of the inputs matters."""
    services = sku_for_tickets.select("item_code", SERVICE).distinct()
    services = services.groupBy(F.col("item_code").alias("product_sku")).agg(F.sum(row_digest(["item_code", SERVICE])).alias("services"))
    items = contract_items.select("contract_id", "start_at", "finish_at", "price", "product_sku").join(services, "product_sku", "left")
    items = items.withColumn("digest", row_digest(["start_at", "finish_at", "price", "product_sku", "services"]))
    per_contract = items.groupBy("contract_id").agg(*_sums("items"))
    owned = contracts.select("contract_id", KEY, "status").join(per_contract, "contract_id", "left")
    owned = owned.withColumn("digest", row_digest(["contract_id", "status", "items_sum", "items_rows"]))
    years = financial_years.withColumn("digest", row_digest(financial_years.columns))
    sides = owned.select(KEY, F.lit(1).alias("side"), "digest").unionByName(years.select(KEY, F.lit(2).alias("side"), "digest"))
    per_side = sides.groupBy(KEY, "side").agg(F.sum("digest").alias("total"), F.count(F.lit(1)).alias("rows"))
    digest = F.concat_ws("/", F.sort_array(F.collect_list(F.concat_ws(":", "side", "total", "rows"))))
    return per_side.groupBy(KEY).agg(digest.alias("digest"))


def changed_keys(old: DataFrame, new: DataFrame, key: str = KEY) -> DataFrame:
    """The keys whose digest differs, or that only one side has (NULL is a key as well)."""
    o, n = old.select(F.col(key).alias("old_key"), F.col("digest").alias("old")), new.select(F.col(key).alias("new_key"), F.col("digest").alias("new"))
    both = o.join(n, F.col("old_key").eqNullSafe(F.col("new_key")), "full")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(F.when(F.col("new").isNull(), F.col("old_key")).otherwise(F.col("new_key")).alias(key))


def of_keys(df: DataFrame, keys: DataFrame, key: str = KEY, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose key is among ``keys`` (``left_anti``: is not), NULL included."""
    k = keys.select(F.col(key).alias("__ll_key"))
    return df.join(k, F.col(key).eqNullSafe(F.col("__ll_key")), how)


def chain_models(
    contracts: DataFrame, contract_items: DataFrame, sku_for_tickets: DataFrame, financial_years: DataFrame,
    models: Sequence[str] = MODELS,
) -> dict[str, DataFrame]:
    """The models of the chain; ``rejected_items`` are counted per company and service."""
    items = paid_periods.items_by_service(contracts, contract_items, sku_for_tickets)
    periods = materialize(paid_periods.paid_periods(items), "touched-periods")
    built = {
        "paid_periods": lambda: periods,
        "paid_financial_years": lambda: paid_calendar.paid_years(financial_years, periods),
        "paid_months": lambda: paid_calendar.paid_months(financial_years, periods),
        "paid_quarters": lambda: paid_calendar.paid_quarters(financial_years, periods),
        "rejected_items": lambda: rejected_intervals(items, [KEY, SERVICE], "start_date", "finish_date"),
    }
    return {name: built[name]() for name in models}


def refresh_paid_chain(
    contracts: DataFrame, contract_items: DataFrame, sku_for_tickets: DataFrame, financial_years: DataFrame,
    out_dir: str, models: Sequence[str] = MODELS, buckets: int = BUCKETS,
) -> Version:
    """Bring the models stored at ``out_dir`` up to date with the inputs; the first call
    builds them.  Returns the current version, which is the one before if nothing changed;
    ``Store(spark, out_dir).read(model)`` reads a model."""
    store = Store(contracts.sparkSession, out_dir)
    base = store.current()
    inputs = (contracts, contract_items, sku_for_tickets, financial_years)
    digests = materialize(company_digests(*inputs), "company-digests")
    if DIGESTS not in base.tables:
        built = {DIGESTS: digests, **chain_models(*inputs, models=models)}
        return store.commit({name: store.write_buckets(df, KEY, buckets) for name, df in built.items()}, base)
    buckets = base.tables[DIGESTS].buckets
    touched = materialize(changed_keys(store.read(DIGESTS, base), digests), "touched")
    rewritten = [str(r[0]) for r in touched.select(bucket_of(KEY, buckets)).distinct().collect()]  # ``buckets`` at most
    if not rewritten:
        return base
    some = of_keys(contracts, touched)
    items = contract_items.join(some.select("contract_id"), "contract_id", "left_semi")
    built = {DIGESTS: of_keys(digests, touched), **chain_models(some, items, sku_for_tickets, of_keys(financial_years, touched), models)}
    tables = {}
    for name, fresh in built.items():
        before = base.tables[name]
        kept = of_keys(store.read(name, base, rewritten), touched, how="left_anti")
        tables[name] = store.write_buckets(kept.unionByName(fresh.select(kept.columns)), KEY, buckets, before, rewritten)
    version = store.commit(tables, base)
    store.expire()
    return version
