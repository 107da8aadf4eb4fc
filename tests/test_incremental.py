"""A2: after a change the refreshed chain equals a full build, and only touched companies are read."""

import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import incremental as inc
from ledgerline.sources.fixtures import Fixtures
from ledgerline.sources.tables import Tables, materialize
from ledgerline.sources.versions import Conflict, Store
from tests.conftest import SF_SMALL


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def inputs(spark):
    fx = Fixtures(Tables(spark, SF_SMALL))
    return {n: materialize(fx[n], n) for n in ("contracts", "contract_items", "sku_for_tickets", "financial_years")}


@pytest.fixture(scope="module")
def store(spark, inputs):
    made = Store(spark, tempfile.mkdtemp(prefix="ledgerline-inc-") + "/chain")
    inc.refresh_paid_chain(*inputs.values(), made.path, buckets=16)
    return made


def check(store, inputs, version):
    for name, df in inc.chain_models(*inputs.values()).items():
        assert rows(store.read(name, version)) == rows(df), name


def shared(a, b, name):
    return {k for k, f in a.tables[name].folders.items() if b.tables[name].folders.get(k) == f}


def test_the_first_call_builds_and_an_unchanged_input_changes_nothing(store, inputs):
    first = store.current()
    check(store, inputs, first)
    shuffled = {n: df.repartition(5) for n, df in inputs.items()}
    assert inc.refresh_paid_chain(*shuffled.values(), store.path).number == first.number


def changes(inputs):
    """One per kind of change: the altered inputs and the companies they touch."""
    contracts, items, sku, years = inputs.values()
    owner = contracts.select("contract_id", "company_id")
    a = contracts.filter("company_id = 4").first()
    price = items.withColumn("price", F.when(F.col("contract_id") == a.contract_id, F.col("price") + 1).otherwise(F.col("price")))
    yield "an item", {**inputs, "contract_items": price}, {4}
    yield "a company gone", {**inputs, "contracts": contracts.filter("company_id <> 7"), "financial_years": years.filter("company_id <> 7")}, {7}
    moved = contracts.withColumn("company_id", F.when(F.col("contract_id") == a.contract_id, F.lit(5)).otherwise(F.col("company_id")).cast("long"))
    yield "a contract of another company", {**inputs, "contracts": moved}, {4, 5}
    new = contracts.limit(1).select(F.lit(10**9).cast("long").alias("contract_id"), F.lit(None).cast("long").alias("company_id"), F.lit("active").alias("status"))
    new_items = items.limit(3).withColumn("contract_id", F.lit(10**9).cast("long"))
    yield "a company without id", {**inputs, "contracts": contracts.unionByName(new), "contract_items": items.unionByName(new_items)}, {None}
    later = years.withColumn("end_date", F.when(F.col("company_id") == 11, F.date_add("end_date", 1)).otherwise(F.col("end_date")))
    yield "a financial year", {**inputs, "financial_years": later}, {11}
    code = sku.filter("process_definition_key is not null").orderBy("item_code").first().item_code
    hit = {r.company_id for r in items.filter(F.col("product_sku") == code).join(owner, "contract_id").select("company_id").distinct().collect()}
    yield "the services of a SKU", {**inputs, "sku_for_tickets": sku.filter(F.col("item_code") != code)}, hit


def test_each_kind_of_change(store, inputs):
    """One after the other: each refresh also undoes the change before."""
    undone = set()
    for what, altered, companies in changes(inputs):
        base = store.current()
        old, new = store.read(inc.DIGESTS, base), inc.company_digests(*altered.values())
        assert {r.company_id for r in inc.changed_keys(old, new).collect()} == companies | undone, what
        version = inc.refresh_paid_chain(*altered.values(), store.path)
        check(store, altered, version)
        assert version.number == base.number + 1
        if len(companies) < 3:
            assert len(shared(base, version, "paid_periods")) >= 16 - len(companies | undone), what
        undone = companies
    inc.refresh_paid_chain(*inputs.values(), store.path)
    check(store, inputs, store.current())


def test_only_touched_companies_pass_the_digests(store, inputs, monkeypatch):
    """The models are computed from the rows of the touched companies alone."""
    seen = {}
    whole = inc.chain_models

    def watched(*frames, **kw):
        seen.update(zip(inputs, frames))
        return whole(*frames, **kw)

    monkeypatch.setattr(inc, "chain_models", lambda c, i, s, y, m: watched(c, i, s, y, models=m))
    later = inputs["financial_years"].withColumn("end_date", F.when(F.col("company_id") == 8, F.date_add("end_date", 1)).otherwise(F.col("end_date")))
    inc.refresh_paid_chain(*{**inputs, "financial_years": later}.values(), store.path)
    assert {r.company_id for r in seen["contracts"].select("company_id").distinct().collect()} == {8}
    mine = {r.contract_id for r in inputs["contracts"].filter("company_id = 8").collect()}
    assert {r.contract_id for r in seen["contract_items"].collect()} <= mine
    assert {r.company_id for r in seen["financial_years"].collect()} == {8}
    inc.refresh_paid_chain(*inputs.values(), store.path)


def test_a_refresh_that_loses_against_another_changes_nothing(store, inputs, monkeypatch):
    later = {**inputs, "financial_years": inputs["financial_years"].filter("company_id <> 12")}
    base = store.current()
    monkeypatch.setattr(Store, "current", lambda self: base)
    other = inc.refresh_paid_chain(*later.values(), store.path)
    with pytest.raises(Conflict):
        inc.refresh_paid_chain(*later.values(), store.path)
    monkeypatch.undo()
    assert store.current() == other
    inc.refresh_paid_chain(*inputs.values(), store.path)
