"""The plans keep their shape: few scans, pushed filters, no cross joins, split hot keys."""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from asiento.operators import invoices, payments, state
from asiento.operators.invoices import invoice_rows, post_invoices
from asiento.operators.payments import payment_rows
from asiento.operators.reversals import reversal_calls, reversed_documents
from asiento.plans import posting
from asiento.plans.rules import INSURER_BRANCH, INVOICE_BRANCHES
from asiento.slices import ROW_COLUMNS, SliceSet
from asiento.sources.facts import write_by_day
from asiento.sources.shared import scratch
from asiento.sources.tables import Tables
from catalogue import fixtures
from catalogue.queries import QUERIES, invoice_calendar, one_call, payment_calendar


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The billing tables as files of their own, so that scans show in the plans by name."""
    folder = tmp_path_factory.mktemp("billing")
    for name, make in fixtures.PROJECTIONS.items():
        make(spark, sf_dir).write.parquet(f"{folder}/{name}")
    return Tables.from_parquet(spark, {n: f"{folder}/{n}" for n in fixtures.PROJECTIONS})


@contextmanager
def settings(spark, **values):
    names = {key: "spark.sql." + key.replace("__", ".") for key in values}
    before = {key: spark.conf.get(name, None) for key, name in names.items()}
    for key, name in names.items():
        spark.conf.set(name, values[key])
    yield
    for key, name in names.items():
        if before[key] is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before[key])


NO_BROADCAST = {"autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1"}


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def scans(df, table):
    return len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{table}\]", plan(df)))


def test_invoices_scan_the_lines_twice(spark, stored, ctx):
    df = post_invoices(stored, invoice_calendar(spark), ctx)
    assert scans(df, "invoice_line") == 2
    by_product = [branch for branch in INVOICE_BRANCHES if branch != INSURER_BRANCH]
    df = invoice_rows(stored, invoice_calendar(spark), ctx, by_product)
    assert scans(df, "invoice_line") == 1


def test_payments_scan_the_forms_of_each_system_once(spark, stored, ctx):
    df = payment_rows(stored, payment_calendar(spark), ctx)
    assert scans(df, "payment_form") == 1
    assert scans(df, "ext_payment_form") == 1
    assert scans(df, "payment_line") == 1
    assert scans(df, "payment") == 2
    assert scans(df, "payment_account_map") == 3
    assert scans(df, "bank_account_map") == 1
    assert scans(df, "ledger_account") == 1


@pytest.mark.parametrize("many", [False, True])
def test_slices_reach_the_scan(spark, stored, ctx, many):
    slices = [("1997-03-01", 1, "G")] + [("1997-04-01", 2, "G")] * many
    text = plan(invoice_rows(stored, SliceSet.of(spark, slices), ctx, ["tax"]))
    pushed = re.search(r"/invoice_line\].*?PushedFilters: (.*?)\n", text, re.S).group(1)
    assert "GreaterThanOrEqual(de_fecha,1997-03-01T00:00)" in pushed
    assert "LessThan(de_fecha,1997-0" in pushed
    assert "de_cod_empresa" in pushed
    assert "EqualTo(de_estado,G)" in pushed
    schema = re.search(r"/invoice_line\].*?ReadSchema: (.*?)\n", text, re.S).group(1)
    assert "de_total" not in schema and "de_itbis" in schema


def test_a_replay_pushes_its_constants_and_days(spark, stored, ctx):
    found = posting.replay_reversals(stored, one_call(spark), ctx)
    assert found.slices.empresa == 1 and found.slices.estado == "R"
    assert len(found.slices.days) > 1
    text = plan(found.journal_by_slice)
    for table, state in (("invoice_line", "de"), ("payment_form", "fp")):
        for pushed in re.findall(rf"/{table}\].*?PushedFilters: (.*?)\n", text, re.S):
            assert f"EqualTo({state}_estado,R)" in pushed
            assert f"EqualTo({state}_cod_empresa,1)" in pushed
            assert f"GreaterThanOrEqual({state}_fecha," in pushed and f"LessThan({state}_fecha," in pushed
            assert pushed.count("GreaterThan") == 1
    # Days in between are left to the join, not compared one by one.
    for condition in re.findall(r"Condition : (.*?)\n", text):
        assert condition.count(" OR ") <= 8


def test_zero_amounts_are_dropped_at_the_scan(spark, stored, ctx):
    text = plan(post_invoices(stored, invoice_calendar(spark), ctx, ["insurer_receivable"]))
    pushed = re.search(r"/invoice_line\].*?PushedFilters: (.*?)\n", text, re.S).group(1)
    assert "Not(EqualTo(de_descuento_sa_bse,0.0))" in pushed


def test_one_slice_needs_no_join_with_slices(spark, stored, ctx):
    df = invoice_rows(stored, SliceSet.of(spark, [("1997-03-01", 1, "G")]), ctx, ["tax"])
    assert len(re.findall(r"Join", plan(df, "simple"))) == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_joins(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    for options in ({}, NO_BROADCAST):
        with settings(spark, **options):
            text = plan(df.select("*"), "simple")
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "PythonUDF" not in text and "InPandas" not in text


def test_reversals_of_other_companies_skip_the_second_system(spark, stored, ctx):
    df = reversed_documents(stored, reversal_calls(spark, [("2024-02-05", 2)]), ctx)
    assert scans(df, "ext_payment_reversal") == 0
    assert scans(df, "payment_reversal") == 1


def same_rows(left, right):
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


@pytest.mark.parametrize("post", [post_invoices, posting.post_payments])
def test_without_broadcasts_the_rows_are_the_same(spark, stored, ctx, post):
    slices = invoice_calendar(spark) if post is post_invoices else payment_calendar(spark)
    expected = post(stored, slices, ctx).drop(*ROW_COLUMNS)
    with settings(spark, **NO_BROADCAST):
        shuffled = post(stored, slices, ctx).drop(*ROW_COLUMNS)
        assert "BroadcastHashJoin" not in plan(shuffled)
        same_rows(expected, shuffled)


@pytest.mark.parametrize("keys_first", [False, True])
def test_maps_invoices_and_work_orders_do_not_pass_through_the_driver(spark, sf_dir, ctx, keys_first):
    """However few bytes their files have: the map unfolds ten rows from each row read."""
    tables = fixtures.tables(spark, sf_dir, fixtures.INVOICE_TABLES)
    for slices in (SliceSet.of(spark, [("1997-03-01", 1, "G")]), invoice_calendar(spark)):
        text = plan(post_invoices(tables, slices, replace(ctx, keys_first=keys_first)), "simple")
        joins = re.findall(r"(\w+Join) .*(?:pf_id_producto|ot_codigo|fa_numero)#", text)
        assert "SortMergeJoin" in joins
        # What is asked for may be broadcast: its files hold numbers only.
        looked_up = [line for line in text.splitlines() if "BroadcastHashJoin" in line and "asked#" not in line]
        assert not re.search("pf_id_producto|ot_codigo|fa_numero", " ".join(looked_up))


def broadcast_files(df):
    """Files that the plan reads into broadcasts, as Spark makes it from the sizes of files."""
    found = []

    def walk(node, inside):
        name = node.nodeName()
        inside = inside or name.startswith("BroadcastExchange")
        if inside and name.startswith("Scan"):
            found.append(node.relation().location().rootPaths().mkString(","))
        children = node.children()
        for at in range(children.size()):
            walk(children.apply(at), inside)

    top = df._jdf.queryExecution().executedPlan()
    walk(top.initialPlan() if top.nodeName() == "AdaptiveSparkPlan" else top, False)
    return found


@pytest.fixture
def broadcast(monkeypatch):
    """Files that are read into broadcasts by any table that is written meanwhile."""
    found = []
    write = DataFrameWriter.parquet

    def parquet(writer, *args, **options):
        found.extend(broadcast_files(writer._df))
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return found


SORTED = (
    "inv_9_post_one_slice", "inv_9_post_one_slice_keys_first", "inv_post_all_months", "rvs_6_final_state",
    "rvs_6_replay", "rvs_6_replay_all_calls", "snk_01_replace_invoices", "snk_journal_earlier_version",
    "snk_journal_invoices", "snk_journal_invoices_in_parts",
)


@pytest.mark.parametrize("name", SORTED)
def test_tables_that_grow_do_not_pass_through_the_driver(spark, sf_dir, broadcast, name):
    """Here all files are so small that Spark broadcasts whatever it may."""
    found = broadcast_files(QUERIES[name](spark, sf_dir)) + broadcast
    grow = [file for file in found if re.search(r"/(lineitem|orders|customer|part|events)\.parquet", file)]
    assert not grow


@pytest.mark.parametrize("source", ["payments", "invoices", "ext_payments"])
def test_documents_are_sorted_to_meet_their_reversals(spark, stored, ctx, source):
    found = broadcast_files(reversed_documents(stored, one_call(spark), ctx, [source]))
    assert not [file for file in found if "slices" not in file]


def test_many_names_are_sorted_not_broadcast(spark, stored, ctx, monkeypatch, broadcast):
    """Names of invoices and work orders take a twentieth in files of what they take in memory."""
    keys_first, slices = replace(ctx, keys_first=True), invoice_calendar(spark)
    few = post_invoices(stored, slices, keys_first)
    assert any("/asked-" in file for file in broadcast) and any("/asked-" in file for file in broadcast_files(few))
    broadcast.clear()
    monkeypatch.setattr(invoices, "BROADCAST_NAMES", 1)
    many = post_invoices(stored, slices, keys_first)
    assert not any("/asked-" in file for file in broadcast + broadcast_files(many))
    same_rows(few.drop(*ROW_COLUMNS), many.drop(*ROW_COLUMNS))


def test_a_hot_product_is_split_over_tasks(spark, ctx):
    """A third of all lines on one product: the join splits it and keeps every row."""
    given = fixtures.tables(
        spark, "/root/testdata/sf0.01", ["invoice_line", "invoice_account_map"]
    )
    hot = given.invoice_line.withColumn(
        "de_item", F.when(F.col("de_num_linea") <= 3, 1).otherwise(F.col("de_item"))
    ).repartition(16)
    tables = replace(given, invoice_line=hot)
    slices = invoice_calendar(spark)
    branches = ["tax", "receivable", "insurer_premium"]
    expected = invoice_rows(tables, slices, ctx, branches).groupBy("in_param").count().collect()
    small = {
        "adaptive__skewJoin__skewedPartitionThresholdInBytes": "10KB",
        "adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "adaptive__advisoryPartitionSizeInBytes": "10KB",
    }
    with settings(spark, **NO_BROADCAST, **small):
        df = invoice_rows(tables, slices, ctx, branches)
        counted = df.groupBy("in_param").count()
        assert sorted(map(tuple, counted.collect()), key=str) == sorted(
            map(tuple, expected), key=str
        )
        assert re.search(r"SortMergeJoin\(skew=true\).*LeftOuter", plan(executed(df), "simple"))


def executed(df):
    """The frame after its plan has run, with the plan that AQE settled on."""
    df.collect()
    return df


def test_facts_written_by_day_are_read_by_partition(spark, stored, ctx, tmp_path):
    write_by_day(stored.invoice_line, str(tmp_path / "lines"), "de_fecha", "de_cod_empresa")
    by_day = spark.read.parquet(str(tmp_path / "lines"))
    tables = replace(stored, invoice_line=by_day)
    given = [("1997-03-01", 1, "G")], [("1997-03-01", 1, "G"), ("1998-07-01", 2, "R")]
    for slices in (SliceSet.of(spark, one) for one in given):
        df = post_invoices(tables, slices, ctx)
        text = plan(df)
        assert len(re.findall(r"PartitionFilters: .*de_fecha_dia", text)) == 2
        assert len(re.findall(r"PartitionFilters: .*de_cod_empresa", text)) == 2
        expected = post_invoices(stored, slices, ctx)
        same_rows(
            df.withColumn("in_cod_empresa", F.col("in_cod_empresa").cast("bigint")), expected
        )
    # With the slices in a table, the days to read are only known at run time.
    present = SliceSet.from_frame(slices.df)
    assert "dynamicpruning" in plan(post_invoices(tables, present, ctx))


def test_work_orders_of_other_days_are_dropped_before_they_move(spark, stored, ctx):
    slices = SliceSet.of(spark, [("1997-03-01", 1, "G")])
    branch = ["insurer_receivable"]
    with scratch(spark):
        df = executed(invoice_rows(stored, slices, replace(ctx, keys_first=True), branch))
        with settings(spark, adaptive__enabled="false"):
            tree = plan(invoice_rows(stored, slices, replace(ctx, keys_first=True), branch), "simple")
        same_rows(df, invoice_rows(stored, slices, ctx, branch))
        same_rows(invoice_rows(stored, slices, ctx, branch), df)
        assert "LeftSemi" in tree and tree.index("LeftSemi") < tree.rindex("ot_codigo")
        # Between the scan of the work orders and the join that drops most of them nothing is exchanged.
        part = tree[tree.index("LeftSemi") :]
        part = part[: part.index("ot_cia_seguros")]
        assert "Exchange hashpartitioning" not in part
        with settings(spark, **NO_BROADCAST):
            same_rows(invoice_rows(stored, slices, replace(ctx, keys_first=True), branch), df)


def test_one_slice_reads_one_file_of_the_forms(spark, stored, ctx, tmp_path):
    """Day and company are partitions, and rows of a state lie together in their file."""
    write_by_day(stored.payment_form, str(tmp_path / "forms"), "fp_fecha", "fp_cod_empresa", order=("fp_estado",))
    forms = spark.read.parquet(str(tmp_path / "forms"))
    files = forms.inputFiles()
    slices = SliceSet.of(spark, [("2024-01-05", 1, "G")])
    kept = slices.select_from(forms, ctx, "fp_fecha", "fp_cod_empresa", "fp_estado")
    kept.collect()
    scan = re.search(r"Scan parquet", kept._jdf.queryExecution().executedPlan().toString())
    assert scan and len(files) > 50
    read = kept.select(F.input_file_name().alias("file")).distinct().count()
    node = kept._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    assert read == 1 and node.metrics().apply("numFiles").value() == 1
    for file in files[:5]:
        states = pq.read_table(file.removeprefix("file://"))["fp_estado"].to_pylist()
        assert states == sorted(states)
    tables = replace(stored, payment_form=forms.withColumn("fp_cod_empresa", F.col("fp_cod_empresa").cast("int")))
    same_rows(posting.post_payments(tables, slices, ctx), posting.post_payments(stored, slices, ctx))


def test_payments_written_by_day(spark, stored, ctx, tmp_path):
    dates = {
        "payment": "p_fecha", "payment_line": "dp_fecha_documento", "payment_form": "fp_fecha",
        "ext_payment_form": "fp_fecha",
    }
    by_day = {}
    for name, column in dates.items():
        write_by_day(getattr(stored, name), str(tmp_path / name), column)
        by_day[name] = spark.read.parquet(str(tmp_path / name))
    slices = SliceSet.of(spark, [("2024-01-04", 2, "G"), ("2024-01-05", 1, "R")])
    same_rows(
        posting.post_payments(replace(stored, **by_day), slices, ctx),
        posting.post_payments(stored, slices, ctx),
    )


def test_purged_payments_are_computed_once(spark, stored, ctx):
    """The anti join is planned in each branch of the union, over one shared exchange."""
    with settings(spark, **NO_BROADCAST):
        df = executed(posting.post_payments(stored, payment_calendar(spark), ctx))
        final = plan(df, "simple").split("== Initial Plan ==")[0]
    assert len(re.findall(r"ReusedExchange \[purged", final)) == 2


def test_one_slice_filters_its_look_ups_before_they_shuffle(spark, stored, ctx):
    """Bloom filters of the slice's lines reach the scans of the tables these look up."""
    bloom = {
        "optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "1",
        "optimizer__runtime__bloomFilter__creationSideThreshold": "100g",
    }
    invoices = SliceSet.of(spark, [("1997-03-01", 1, "G")])
    payments = SliceSet.of(spark, [("2024-01-05", 1, "G")])
    with settings(spark, **NO_BROADCAST, **bloom):
        text = plan(invoice_rows(stored, invoices, ctx, ["insurer_receivable"]), "simple")
        assert re.search(r"isnotnull\(fa_numero.*might_contain", text)
        assert re.search(r"isnotnull\(ot_codigo.*might_contain", text)
        text = plan(payment_rows(stored, payments, ctx, ["receivable"]), "simple")
        assert re.search(r"p_tipo_docum.*might_contain", text)
        assert re.search(r"fa_cod_empresa.*might_contain", text)


@pytest.mark.parametrize("many", [False, True], ids=["one", "many"])
def test_no_cross_joins_on_plain_tables(spark, stored, sf_dir, ctx, many):
    """The same with tables whose columns are not expressions of each other."""
    journal = fixtures.initial_journal(spark, sf_dir)
    given = [("2024-01-05", 1, "G"), ("2024-01-06", 3, "R")] if many else [("2024-01-05", 1, "G")]
    listed = SliceSet.of(spark, given)
    for slices in (listed, SliceSet.from_frame(listed.df)):
        for options in ({}, NO_BROADCAST):
            with settings(spark, **options):
                for df in (
                    post_invoices(stored, slices, ctx),
                    posting.post_payments(stored, slices, ctx),
                    posting.final_state(journal, stored, slices, ctx),
                ):
                    text = plan(df, "simple")
                    assert "NestedLoop" not in text and "Cartesian" not in text


def test_payment_lines_take_their_slices_last(spark, stored, ctx):
    """A line that many calls replay is sorted and moved once, with or without purges."""
    calls = [("2024-01-05", 1, "G")] * 30
    slices = SliceSet.of(spark, calls)
    purged = state.purged_payments(stored.payment, slices)
    for lines in (
        payment_rows(stored, slices, ctx, ["receivable"]),
        payments.settled_lines(stored, slices, ctx, state.purged_by_day(purged)),
        posting.lasting_lines(stored, slices, ctx, purged),
    ):
        text = plan(lines, "simple")
        taken = re.search(r"Join \[[^\]]*\], \[slice_fecha#[^\]]*slice_estado#[^\]]*\], Inner", text)
        joined = re.search(r"Join \[[^\]]*\], \[(fa_numero|p_numero)#", text)
        assert taken.start() < joined.start()
        assert "SortMergeJoin" not in text[: taken.start()]
