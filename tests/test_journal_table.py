"""The journal on files holds what the pure functions compute."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows, ts
from pyspark.errors import StreamingQueryException

from asiento.operators.reversals import reversal_calls
from asiento.operators.state import append_rows
from asiento.plans import posting
from asiento.slices import SliceSet
from asiento.sources.schemas import JOURNAL
from asiento.sources.journal import INVOICES, OTHERS, JournalTable, Manifest
from asiento.sources.shared import shared_folder
from asiento.streaming.requests import post_requests
from catalogue import fixtures

SLICES = [("2024-01-04", 2, "G"), ("1997-03-01", 1, "G"), ("2024-01-05", 3, "G")]


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return fixtures.tables(spark, sf_dir)


@pytest.fixture
def initial(spark, sf_dir):
    return fixtures.initial_journal(spark, sf_dir)


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def test_runs_on_files_equal_the_final_state(spark, tables, initial, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    same(table.read(), initial)
    slices = SliceSet.of(spark, SLICES)
    table.run(tables, slices, ctx)
    same(table.read(), posting.final_state(initial, tables, slices, ctx))


def files(table, kind="data"):
    return {str(p) for p in Path(table.path).glob(f"{kind}/**/*.parquet")}


def test_a_company_without_new_rows_is_emptied(spark, tables, initial, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    nothing = SliceSet.of(spark, [("2030-01-01", 2, "G")])
    table.run_invoices(tables, nothing, ctx)
    left = table.read().filter("in_tipo_documento = 6").select("in_cod_empresa").distinct()
    assert rows(left, "in_cod_empresa") == [(1,), (3,)]


def test_a_run_writes_its_own_rows_only(spark, tables, initial, ctx, tmp_path):
    """Also where payments go to companies that the run does not clear, and documents are purged."""
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    before = files(table)
    slices = SliceSet.of(spark, [("2024-01-05", 2, "G")])
    table.run(tables, slices, ctx)
    assert before < files(table)
    posted = posting.journal_by_slice(tables, slices, ctx).count()
    new = spark.read.option("basePath", f"{table.path}/data").parquet(*(files(table) - before))
    assert 0 < new.count() <= posted
    # Company 1 has rows of the second system now, in a folder beside those that it had.
    others = [e for e in table.manifest().entries if e.doc_class == OTHERS and 1 in e.companies]
    assert len(others) == 2 and len(table.manifest().markers) == 1
    same(table.read(), posting.final_state(initial, tables, slices, ctx))


def test_a_run_reads_no_stored_rows(spark, tables, initial, ctx, tmp_path, monkeypatch):
    """Neither the purge nor the clearing of a company looks at what the journal holds."""
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    read = []
    folders = table._folders
    monkeypatch.setattr(table, "_folders", lambda entries: read.extend(e.run for e in entries) or folders(entries))
    stored = {e.run for e in table.manifest().entries}
    table.run(tables, SliceSet.of(spark, [("2024-01-05", 3, "G")]), ctx)
    assert not stored & {*read}


def test_readers_see_a_run_whole_or_not_at_all(spark, tables, initial, ctx, tmp_path, monkeypatch):
    """The run is stopped when all its files are written, and when its manifest is."""
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    slices = SliceSet.of(spark, [("2024-01-05", 3, "G")])
    held = table.read()  # planned before the run

    def lost(*_):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr("asiento.sources.journal.claim", lost)
        with pytest.raises(InterruptedError):
            table.run_payments(tables, slices, ctx, once=str(tmp_path / "run"))
    same(table.read(), initial)
    staged = files(table)
    table.run_payments(tables, slices, ctx, once=str(tmp_path / "run"))
    assert files(table) == staged  # published as it was written
    expected = posting.payments_state(initial, tables, slices, ctx)
    same(table.read(), expected)
    same(held, initial)
    same(table.read(version=1), initial)


def test_two_writers_give_one_order(spark, tables, initial, ctx, tmp_path, monkeypatch):
    """Each has staged its run when both publish; the second finds its number taken."""
    one, two = (JournalTable(spark, str(tmp_path / "journal")) for _ in range(2))
    one.create(initial)
    first, second = (SliceSet.of(spark, [s]) for s in (("2024-01-04", 2, "G"), ("2024-01-05", 1, "G")))
    publish = one.publish
    tried = []

    def late(change):
        two.run_payments(tables, second, ctx)
        return publish(change)

    manifest = one.manifest

    def stale(version=None):
        tried.append(version)
        return Manifest.of(old) if len(tried) == 1 else manifest(version)

    old = manifest().text()
    monkeypatch.setattr(one, "publish", late)
    monkeypatch.setattr(one, "manifest", stale)
    one.run_payments(tables, first, ctx)
    assert len(tried) == 2  # its first number was taken
    expected = posting.payments_state(initial, tables, second, ctx)
    same(two.read(), posting.payments_state(expected, tables, first, ctx))
    assert two.versions() == [1, 2, 3]


def test_many_writers_at_once(spark, billing, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create()
    forms = [dict(fp_num_pago=n, fp_forma_pago="EFE", fp_cod_empresa=n) for n in range(1, 7)]
    tables = billing(payment_form=forms)

    def post(company):
        slices = SliceSet.of(spark, [("2024-01-05", company, "G")])
        JournalTable(spark, table.path).run_payments(tables, slices, ctx)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(post, range(1, 7)))
    assert rows(table.read(), "in_num_documento", "in_cod_empresa") == [(n, n) for n in range(1, 7)]
    assert table.versions() == [*range(1, 8)]


def test_compaction_keeps_the_rows(spark, tables, initial, ctx, tmp_path, monkeypatch):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    state = initial
    for one in (("2024-01-04", 2, "G"), ("2024-01-05", 3, "G"), ("2024-01-04", 3, "G")):
        slices = SliceSet.of(spark, [one])
        table.run(tables, slices, ctx)
        state = posting.final_state(state, tables, slices, ctx)
    kept = {(e.run, c) for e in table.manifest().entries for c in e.companies if e.doc_class == INVOICES}
    assert table.compact() and not table.compact()
    found = table.manifest()
    assert not found.markers and all(len(found.where(e.doc_class, c)) == 1 for e in found.entries for c in e.companies)
    # Companies of one folder that no marker is newer than are left where they are.
    assert kept <= {(e.run, c) for e in found.entries for c in e.companies}
    same(table.read(), state)
    assert table.vacuum() and not table.vacuum()
    same(table.read(), state)


def test_markers_do_not_pass_through_the_driver(spark, billing, initial, ctx, tmp_path):
    """Purged documents grow with the payments; their files say little of them in memory."""
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    purging = billing(payment=[dict(p_numero=n, p_tipo_docum=5) for n in range(1, 500)])
    table.run_payments(purging, SliceSet.of(spark, [("2024-01-05", 9, "G")]), ctx)
    read = table.read()
    # Other joins of the plan there are none.
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text
    left = initial.filter("in_tipo_documento = 6 or in_num_documento >= 500")
    same(read, left)


def test_a_run_during_a_compaction_wins(spark, tables, initial, ctx, tmp_path, monkeypatch):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    first, second = (SliceSet.of(spark, [s]) for s in (("2024-01-04", 2, "G"), ("2024-01-05", 1, "G")))
    table.run(tables, first, ctx)
    publish = table._publish

    def late(next_):
        JournalTable(spark, table.path).run(tables, second, ctx)
        return publish(next_)

    monkeypatch.setattr(table, "_publish", late)
    table.compact()
    state = posting.final_state(initial, tables, first, ctx)
    same(table.read(), posting.final_state(state, tables, second, ctx))


def test_a_repeated_replay_posts_nothing(spark, billing, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create()
    calls = reversal_calls(spark, [("2024-02-05", 1)])

    def replay(value, run_ts):
        cash = dict(fp_forma_pago="EFE", fp_estado="R", fp_valor=value)
        tables = billing(payment=[dict(), dict(p_numero=5, p_tipo_docum=5)], payment_form=[cash], payment_reversal=[dict()])
        table.replay(tables, calls, replace(ctx, run_ts=ts(run_ts)), only_changed=True)
        return len(table.versions()), rows(table.read(), "in_valor", "in_fecha_ing")

    first = replay(100.0, "2024-03-01")
    assert first[1] == [(100.0, ts("2024-03-01"))]
    written = files(table)
    assert replay(100.0, "2024-04-01") == first
    assert spark.read.option("basePath", f"{table.path}/data").parquet(*written).count() == 1
    assert replay(7.0, "2024-04-01") == (first[0] + 1, [(7.0, ts("2024-04-01"))])


def test_a_repeated_replay_adds_what_it_would_add(spark, tables, initial, ctx, tmp_path):
    """Stray lines go to companies that the replay does not clear: they come again; company 1 is left alone."""
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    calls = reversal_calls(spark, [("2024-02-05", 1)])
    slices, ctx = posting.replay_slices(tables, calls, ctx)[1:]
    held = []
    state = initial
    for _ in range(2):
        table.run_payments(tables, slices, ctx, only_changed=True)
        held.append([e.run for e in table.manifest().where(OTHERS, 1)])
        state = posting.payments_state(state, tables, slices, ctx)
    assert held[0] == held[1]
    same(table.read(), state)


def test_a_new_journal_takes_a_first_run(spark, tables, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"), sink_decimal=(18, 2))
    table.create()
    assert table.read().count() == 0
    table.run_invoices(tables, SliceSet.of(spark, [("1997-03-01", 1, "G")]), ctx)
    assert table.read().count() > 0
    assert table.read().schema["in_valor"].dataType.simpleString() == "decimal(18,2)"


def test_a_decimal_journal_purges_what_rounds_to_zero(spark, billing, ctx, tmp_path):
    forms = [dict(fp_num_pago=n, fp_forma_pago="EFE", fp_valor=v) for n, v in ((1, 0.004), (2, 0.006))]
    table = JournalTable(spark, str(tmp_path / "journal"), sink_decimal=(18, 2))
    table.create()
    table.run(billing(payment_form=forms), SliceSet.of(spark, [("2024-01-05", 1, "G")]), ctx)
    assert rows(table.read(), "in_num_documento", "in_valor") == [(2, Decimal("0.01"))]


def test_rows_without_company_stay(spark, billing, ctx, tmp_path):
    kept = [(7, 6, None), (8, None, 1), (9, 0, None)]
    given = spark.createDataFrame(
        kept, "in_num_documento bigint, in_tipo_documento int, in_cod_empresa bigint"
    )
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(append_rows(spark.createDataFrame([], JOURNAL), given))
    # Document 9 is purged, and its partition is the one without company.
    tables = billing(payment=[dict(p_numero=9, p_tipo_docum=5)])
    table.run(tables, SliceSet.of(spark, [("2024-01-05", 1, "G")]), ctx)
    assert rows(table.read(), "in_num_documento") == [(7,), (8,)]


def test_nothing_staged_is_left(spark, tables, initial, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    before = set(Path(shared_folder(spark)).glob("journal-*"))
    table.run(tables, SliceSet.of(spark, [("2024-01-05", 3, "G")]), ctx)
    assert set(Path(shared_folder(spark)).glob("journal-*")) == before


@pytest.mark.parametrize("lost", ["before", "after"])
def test_a_repeated_batch_is_posted_once(spark, tables, initial, ctx, tmp_path, monkeypatch, lost):
    """Company 2 posts forms of the second system as company 1: a second run would add them again."""
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    schema = "pedido bigint, fecha string, empresa int, estado string"
    given = [("2024-01-05", 2, "G")]
    asked = spark.createDataFrame([(1, *given[0])], schema)
    asked.coalesce(1).write.json(str(tmp_path / "requests"))
    publish = table.publish

    def failing(change):
        if lost == "after":
            publish(change)
        if change.doc_class == OTHERS:
            raise InterruptedError
        if lost == "before":
            publish(change)

    def start():
        arriving = spark.readStream.schema(schema).json(str(tmp_path / "requests"))
        post_requests(arriving, table, tables, ctx, str(tmp_path / "checkpoint")).awaitTermination()

    monkeypatch.setattr(table, "publish", failing)
    with pytest.raises(StreamingQueryException):
        start()
    monkeypatch.undo()
    start()
    expected = posting.final_state(initial, tables, SliceSet.of(spark, given), ctx)
    same(table.read(), expected)
    folder = str(tmp_path / "checkpoint/posted/0")
    table.run(tables, SliceSet.of(spark, given), ctx, once=folder)
    same(table.read(), expected)


def test_a_replay_on_files_equals_the_final_state(spark, tables, initial, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    calls = reversal_calls(spark, [("2024-02-05", 1), ("2024-02-03", 2)])
    table.replay(tables, calls, ctx)
    replay = posting.replay_reversals(tables, calls, ctx)
    same(table.read(), posting.final_state(initial, tables, replay.slices, ctx))


def test_requests_from_a_stream_are_posted_in_order(spark, tables, initial, ctx, tmp_path):
    table = JournalTable(spark, str(tmp_path / "journal"))
    table.create(initial)
    asked = [(n, *one) for n, one in enumerate(SLICES, start=1)]
    schema = "pedido bigint, fecha string, empresa int, estado string"
    arriving = tmp_path / "requests"
    stream = spark.readStream.schema(schema)
    spark.createDataFrame(asked[:2], schema).coalesce(1).write.json(str(arriving))
    for more in ([], asked[2:]):
        if more:
            spark.createDataFrame(more, schema).coalesce(1).write.mode("append").json(str(arriving))
        query = post_requests(
            stream.json(str(arriving)), table, tables, ctx, str(tmp_path / "checkpoint")
        )
        query.awaitTermination()
    same(
        table.read(),
        posting.final_state(initial, tables, SliceSet.of(spark, SLICES), ctx),
    )
