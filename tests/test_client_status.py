
import datetime as dt

from ledgerline.plans.client_status import client_status

AS_OF = dt.date(2024, 6, 1)
LATER, EARLIER = dt.date(2024, 12, 31), dt.date(2023, 1, 1)


def build(spark):
    comp = [
        (i, f"co{i}", "SG", False, dt.date(2020, 1, 1), True, dt.date(2019, 1, 1))
        for i in range(1, 10)
    ] + [
        (10, "test", "SG", True, dt.date(2020, 1, 1), True, None),
        (11, "unpaid", "SG", False, None, True, None),
        (12, "other branch", "HK", False, dt.date(2020, 1, 1), True, None),
        (13, "no contract", "SG", False, dt.date(2020, 1, 1), False, None),
    ]
    companies = spark.createDataFrame(
        comp,
        "company_id long, name string, branch string, is_test_company boolean, "
        "first_invoice_paid_at date, has_accounting_contract boolean, incorporation_date date",
    )
    contracts = spark.createDataFrame(
        [(i, i, "active") for i in range(1, 14)], "contract_id long, company_id long, status string"
    )
    items = spark.createDataFrame(
        [
            (1, "i1", dt.date(2024, 1, 1), LATER, 10.0, "yearly", 100, 1),
            (2, "i2", dt.date(2024, 1, 1), LATER, 10.0, "yearly", 100, 2),
            (3, "i3", dt.date(2024, 1, 1), LATER, 10.0, "yearly", 100, 3),
            (6, "i6", dt.date(2022, 1, 1), EARLIER, 10.0, "yearly", 100, 5),
            (7, "i7", dt.date(2022, 1, 1), EARLIER, 10.0, "yearly", 100, 4),
            (8, "i8", dt.date(2022, 1, 1), EARLIER, 10.0, "yearly", 101, 5),
            (9, "i9a", dt.date(2024, 1, 1), LATER, 10.0, "yearly", 101, 3),
            (9, "i9b", dt.date(2022, 1, 1), EARLIER, 10.0, "yearly", 100, 5),
            (10, "i10", dt.date(2024, 1, 1), LATER, 10.0, "yearly", 100, 1),
        ],
        "contract_id long, contract_item_id string, start_at date, finish_at date, price double, "
        "duration_type string, product_id long, subscription_id long",
    )
    products = spark.createDataFrame(
        [(100, "Plan", "accounting", "b"), (101, None, "accounting", "b")],
        "product_id long, name string, service_group string, main_bucket string",
    )
    subs = spark.createDataFrame(
        [(1, True, None), (2, False, None), (3, None, None), (4, False, "price"), (5, False, None)],
        "subscription_id long, is_auto_renew boolean, churn_reason string",
    )
    tickets = spark.createDataFrame(
        [(1, "open ticket", 4, "svc", "open", dt.datetime(2024, 5, 1)),
         (2, "done", 5, "svc", "resolved", dt.datetime(2024, 5, 1))],
        "ticket_id long, name string, company_id long, process_definition_key string, "
        "status string, due_at timestamp",
    )
    sku = spark.createDataFrame([("X", "svc")], "item_code string, process_definition_key string")
    return client_status(
        companies, contracts, items, products, subs, tickets, sku, AS_OF, "p/"
    )


def test_status_truth_table(spark):
    got = {r.company_id: r.accounting_client_status for r in build(spark).collect()}
    assert got == {
        1: "Active",
        2: "Finishing",
        3: None,
        4: "Finishing",
        5: "TBR or lead",
        6: "TBR or lead",
        7: "Lost",
        8: "Lost",
        # running, auto-renew unknown, product unnamed; earlier named one, no churn reason:
        9: "TBR or lead",
    }


def test_ticket_text_and_link(spark):
    rows = {r.company_id: r for r in build(spark).collect()}
    assert rows[1].ticket_name == "Ticket will be created in future"
    assert rows[4].ticket_name == "open ticket"
    assert rows[4].due_date == dt.date(2024, 5, 1)
    assert rows[5].ticket_name is None
    assert rows[1].link == "p/1"


def test_finish_on_as_of_is_active_and_null_finish_is_neither(spark):
    from ledgerline.plans.client_status import accounting_items, last_active, last_inactive

    contracts = spark.createDataFrame([(1, 1, "active"), (2, 2, "active")],
                                      "contract_id long, company_id long, status string")
    items = spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 1), AS_OF, 5.0, "yearly", 100, 1),
         (2, "b", dt.date(2024, 1, 1), None, 5.0, "yearly", 100, 1)],
        "contract_id long, contract_item_id string, start_at date, finish_at date, price double, "
        "duration_type string, product_id long, subscription_id long",
    )
    products = spark.createDataFrame([(100, "Plan", "accounting", "b")],
                                     "product_id long, name string, service_group string, main_bucket string")
    subs = spark.createDataFrame([(1, True, None)], "subscription_id long, is_auto_renew boolean, churn_reason string")
    acc = accounting_items(contracts, items, products, subs)
    assert [r.company_id for r in last_active(acc, AS_OF).collect()] == [1]
    assert last_inactive(acc, AS_OF).count() == 0
