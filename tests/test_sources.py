"""Input tables, seeds and the account look-up."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows

from asiento.operators.invoices import invoice_rows
from asiento.operators.payments import payment_rows
from asiento.operators.seeds import SEEDS, lookup_accounts, seed_payment_accounts, seed_rows
from asiento.slices import SliceSet
from asiento.sources.schemas import PAYMENT_ACCOUNT_MAP, check_columns
from asiento.sources.tables import SCHEMAS, Tables

RUN_TS = datetime(2024, 3, 1)


def test_a_table_with_missing_or_odd_columns_is_refused(spark):
    df = spark.createDataFrame([("1", "x")], "pp_cuenta string, pp_id_empresa string")
    with pytest.raises(ValueError) as error:
        Tables(payment_account_map=df)
    message = str(error.value)
    assert "pp_id_param is missing" in message
    assert "pp_id_empresa is string, not int" in message


def test_wide_keys_and_decimal_money_fit(spark):
    df = spark.createDataFrame(
        [], "cu_cuenta string, cu_uni_neg string, cu_descripcion string, extra binary"
    )
    assert check_columns(df, SCHEMAS["ledger_account"], "ledger_account") is df
    df = spark.createDataFrame([], "fa_numero bigint, fa_ord_tra decimal(10,0),"
                                   " fa_fecha timestamp, fa_cod_empresa smallint")  # fmt: skip
    Tables(invoice=df)


def test_tables_from_files_and_catalog(spark, tmp_path):
    seed = seed_rows(spark, 3, RUN_TS)
    seed.write.parquet(str(tmp_path / "map"))
    tables = Tables.from_parquet(spark, {"payment_account_map": str(tmp_path / "map")})
    assert tables.payment_account_map.count() == 8
    tables.payment_account_map.createOrReplaceTempView("account_map_view")
    tables = Tables.from_catalog(spark, {"payment_account_map": "account_map_view"})
    assert tables.payment_account_map.count() == 8


def test_unknown_branches_are_refused(billing, spark, ctx):
    slices = SliceSet.of(spark, [("2024-01-05", 1, "G")])
    with pytest.raises(ValueError):
        invoice_rows(billing(), slices, ctx, ["nothing"])
    with pytest.raises(ValueError):
        payment_rows(billing(), slices, ctx, ["nothing"])


def test_no_slices_post_nothing(billing, spark, ctx):
    tables = billing(invoice_line=[dict()], payment_form=[dict(fp_forma_pago="EFE")])
    none = SliceSet.of(spark, [])
    assert invoice_rows(tables, none, ctx).count() == 0
    assert payment_rows(tables, none, ctx).count() == 0


def test_slices_of_one_company_keep_their_numbers(spark):
    slices = SliceSet.of(spark, [("2024-01-05", 2, "G"), ("2024-01-05", 1, "G")])
    one = slices.for_company(1)
    assert one.only[0] == 2
    assert rows(one.df, "slice_id", "empresa") == [(2, 1)]


def test_seeding_twice_doubles_unless_upserting(spark):
    empty = spark.createDataFrame([], PAYMENT_ACCOUNT_MAP)
    once = seed_payment_accounts(empty, 2, RUN_TS)
    assert once.count() == len(SEEDS[2])
    assert seed_payment_accounts(once, 2, RUN_TS).count() == 2 * len(SEEDS[2])
    assert seed_payment_accounts(once, 2, RUN_TS, upsert=True).count() == len(SEEDS[2])
    assert seed_payment_accounts(once, 3, RUN_TS, upsert=True).count() == 16


def test_seeds_differ_in_two_parameters():
    differing = {a[2] for a, b in zip(SEEDS[2], SEEDS[3], strict=True) if a != b}
    assert differing == {7, 8}
    assert [row[2] for row in SEEDS[3]] == [1, 2, 3, 6, 7, 8, 10, 14]


def test_lookup_by_account_and_unit(spark):
    ledger = spark.createDataFrame(
        [("1111005", "HSI", "a"), ("1111005", "OTR", "b"), ("9", "HSI", "c"), (None, "HSI", "d")],
        "cu_cuenta string, cu_uni_neg string, cu_descripcion string",
    )
    assert rows(lookup_accounts(ledger), "cu_descripcion") == [("a",)]
    assert lookup_accounts(ledger).columns == ledger.columns
