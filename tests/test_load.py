import csv
import shutil
import time
from datetime import date
from decimal import Decimal

import pytest
from conftest import flat_rows, rows
from pyspark.errors import AnalysisException

from salesmart.plans.quality import dq_bad_rows
from salesmart.plans.warehouse import Warehouse
from salesmart.schema import FLAT_COLUMNS
from salesmart.sinks.tables import LoadAudit, load_csv, read_staging, staged_sales
from salesmart.sources.base import from_flat
from salesmart.sources.csv import (
    csv_files,
    read_sales_csv,
    stitched_records,
)


def write(path, *changes, extra_lines=()):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(FLAT_COLUMNS)
        for row in flat_rows(*changes):
            out.writerow(["" if v is None else v for v in row.values()])
        f.writelines(extra_lines)


@pytest.fixture
def folder(tmp_path):
    inbox = tmp_path / "in box"
    inbox.mkdir()
    return inbox


def load(spark, folder):
    return load_csv(spark, str(folder), str(folder.parent / "staging"))


def staged(spark, folder):
    return staged_sales(spark, str(folder.parent / "staging"))


def test_many_files_load_with_types(spark, folder):
    write(folder / "mock_data(1).csv", {}, {"id": 2})
    write(folder / "mock_data(2).csv", {"id": 3, "sale_total_price": Decimal("1.25")})
    assert load(spark, folder) == LoadAudit(2, 3, 3, 0)
    frame = staged(spark, folder)
    assert frame.columns == list(FLAT_COLUMNS)
    row = frame.where("id = 3").first()
    assert row.sale_total_price == Decimal("1.25")
    assert row.seller_postal_code is None
    assert row.product_rating == 4.5


def test_single_file_and_bad_path(spark, folder):
    write(folder / "one.csv", {})
    assert len(csv_files(spark, str(folder / "one.csv"))) == 1
    with pytest.raises(AnalysisException):
        load_csv(spark, str(folder / "missing"), str(folder / "s"))


def test_folder_without_csv_is_a_no_op(spark, folder):
    (folder / "notes.txt").write_text("no sales here\n")
    assert load(spark, folder) == LoadAudit(0, 0, 0, 0)
    assert read_sales_csv(spark, []).count() == 0


def test_line_break_inside_quotes_is_one_row(spark, folder):
    write(folder / "a.csv", {"product_description": 'two\nlines, "quoted"'}, {"id": 2})
    write(folder / "b.csv", {"id": 3, "product_description": 'says "hi"'})
    assert load(spark, folder) == LoadAudit(2, 3, 3, 0)
    texts = {r.product_description for r in staged(spark, folder).collect()}
    assert texts == {'two\nlines, "quoted"', "a bowl", 'says "hi"'}


BREAKS = [
    "plain",
    "two\nlines",
    'a "quoted\n\nword"',
    '"\n"',
    "many\n" * 30,
    'no break but "quotes"',
    '\n,\n"",",\n',
]


def at_block_sizes(spark, read, blocks=("64", "700", "100000")):
    """What ``read`` returns for each size of the blocks that files are split into."""
    found = []
    for block in blocks:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            found.append(read())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    return found


def test_records_over_lines_and_blocks(spark, folder):
    for name in ("a", "b"):
        write(
            folder / f"{name}.csv",
            *({"id": i, "product_description": t} for i, t in enumerate(BREAKS * 3)),
            extra_lines=["\n", "7,too,short\n", "\n"],
        )
    files = csv_files(spark, str(folder))
    for got in at_block_sizes(spark, lambda: rows(read_sales_csv(spark, files))):
        assert len(got) == 2 * (3 * len(BREAKS) + 1)
        assert {r[FLAT_COLUMNS.index("product_description")] for r in got} == {*BREAKS, None}


def line(**change):
    (row,) = flat_rows(change)
    return ",".join("" if v is None else str(v) for v in row.values()) + "\n"


FAULTS = {
    "inch mark": ([line(id=50, product_description='5" bowl')], {50}, 0),
    "two inch marks": ([line(id=50, product_description='5" to 7" bowl')], {50}, 0),
    "two lines with one": (
        [line(id=50, product_description='5" bowl'), line(id=51, store_name='6" shop')],
        {50, 51},
        0,
    ),
    "open quote": ([line(id=50, product_description='"never closed')], set(), 1),
    "two open quotes": (
        [line(id=50, product_description='"never'), line(id=51, product_description='"closed')],
        set(),
        2,
    ),
    "open quote in a short line": (['3,"never closed\n'], set(), 1),
    "quote after a closed one": ([line(id=50, product_description='"closed" or "not"')], None, None),
    "quote at a line's end": ([line(id=50)[:-1] + '"\n'], {50}, 0),
    "only a quote": (['"\n'], set(), 1),
}


@pytest.mark.parametrize("with_breaks", [False, True])
@pytest.mark.parametrize("fault", FAULTS)
def test_a_bad_quote_costs_its_own_line(spark, folder, fault, with_breaks):
    lines, loaded, rejected = FAULTS[fault]
    before = [{"id": 1}, {"id": 2, "product_description": "two\nlines" if with_breaks else "one"}]
    after = [{"id": i} for i in range(10, 40)]
    after += [{"id": 40, "product_description": 'three\nmore "lines"\n' if with_breaks else "x"}]
    write(folder / "a.csv", *before, extra_lines=lines)
    with open(folder / "a.csv", "a", newline="") as f:
        out = csv.writer(f)
        for row in flat_rows(*after):
            out.writerow(["" if v is None else v for v in row.values()])
    files = csv_files(spark, str(folder))
    results = at_block_sizes(spark, lambda: read_sales_csv(spark, files).collect())
    assert len({tuple(sorted(map(repr, r))) for r in results}) == 1
    good = {r.id for r in results[0] if r[-2] is None}
    bad = [r for r in results[0] if r[-2] is not None]
    others = {1, 2, *range(10, 41)}
    assert good - {50, 51} == others
    if loaded is not None:
        assert good - others == loaded and len(bad) == rejected
    assert len(results[0]) == len(others) + len(lines)
    text = {r.id: r.product_description for r in results[0]}
    assert not with_breaks or (text[2], text[40]) == ("two\nlines", 'three\nmore "lines"\n')


def test_a_bad_number_in_a_record_over_lines_is_one_row(spark, folder):
    write(folder / "a.csv", {"product_price": "n/a", "product_description": "two\nlines"}, {"id": 2})
    assert load(spark, folder) == LoadAudit(1, 2, 1, 1)


def test_a_record_without_an_end_is_taken_by_lines(spark, folder):
    write(folder / "a.csv", {"id": 1}, extra_lines=['3,"open\n', *["no column at all\n"] * 200])
    files = csv_files(spark, str(folder))
    found = at_block_sizes(spark, lambda: stitched_records(spark, files, max_chars=1000).count())
    assert found == [202] * 3
    assert at_block_sizes(spark, lambda: read_sales_csv(spark, files).count()) == found


def test_names_that_look_like_globs(spark, folder):
    write(folder / "sales[1].csv", {"id": 1})
    write(folder / "sales1.csv", {"id": 2, "product_description": "two\nlines"})
    write(folder / "s{a,b}*.csv", {"id": 3, "product_description": "two\nlines"})
    assert load(spark, folder) == LoadAudit(3, 3, 3, 0)
    assert sorted(r.id for r in staged(spark, folder).collect()) == [1, 2, 3]


def test_bad_rows_are_set_aside_with_reasons(spark, folder):
    write(
        folder / "a.csv",
        {},
        {"id": "x1"},
        {"product_price": "cheap"},
        {"sale_date": "02/30/2021"},
        {"sale_date": "soon", "product_expiry_date": "never"},
        {"sale_date": ""},
        extra_lines=["\n", "7,too,short\n"],
    )
    audit = load(spark, folder)
    assert audit == LoadAudit(1, 7, 2, 5)
    reasons = dq_bad_rows(read_staging(spark, str(folder.parent / "staging"))).collect()
    assert {r.reason: r.row_count for r in reasons} == {
        "malformed_record": 3,
        "bad_sale_date": 2,
        "bad_product_expiry_date": 1,
    }
    rejected = read_staging(spark, str(folder.parent / "staging")).where("status = 'rejected'")
    assert "7,too,short" in {r._corrupt_record for r in rejected.collect()}


def test_second_load_adds_only_new_files(spark, folder):
    write(folder / "a.csv", {}, {"id": 2})
    load(spark, folder)
    assert load(spark, folder) == LoadAudit(0, 0, 0, 0)
    write(folder / "b.csv", {"id": 3})
    assert load(spark, folder) == LoadAudit(1, 1, 1, 0)
    assert sorted(r.id for r in staged(spark, folder).collect()) == [1, 2, 3]


def test_a_repeated_load_reads_the_lists_of_files_only(spark, folder, monkeypatch):
    from salesmart.sinks import tables
    from salesmart.sinks.snapshots import Attempt

    write(folder / "a.csv", {}, {"id": 2, "sale_total_price": Decimal("1.50")}, {"id": 3, "sale_date": "soon"})
    staging = str(folder.parent / "staging")
    load(spark, folder)
    (note,) = tables.staged_loads(spark, staging).values()
    assert (note["files"], note["rows_read"], note["rows_loaded"], note["rows_rejected"]) == (1, 3, 2, 1)
    assert Decimal(note["revenue"]) == sum(r.sale_total_price for r in staged(spark, folder).collect())
    names = FLAT_COLUMNS
    digest = read_staging(spark, staging).agg(tables.row_digest(*names)).first()[0]
    assert Decimal(note["digest"]) == digest
    shutil.rmtree(folder.parent / "staging" / "rows")
    assert load(spark, folder) == LoadAudit(0, 0, 0, 0)


def test_a_load_that_dies_leaves_nothing(spark, folder, monkeypatch):
    from salesmart.sinks.snapshots import Attempt

    write(folder / "a.csv", {}, {"id": 2})
    load(spark, folder)
    write(folder / "b.csv", {"id": 3})

    def dies(self):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Attempt, "commit", dies)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, folder)
    assert sorted(r.id for r in staged(spark, folder).collect()) == [1, 2]
    assert load(spark, folder) == LoadAudit(1, 1, 1, 0)
    assert sorted(r.id for r in staged(spark, folder).collect()) == [1, 2, 3]


def test_odd_names_are_known_the_second_time(spark, folder):
    names = ("a b", "a+b", "50%", "x%20y", "é", "[1]")
    for i, name in enumerate(names):
        write(folder / f"{name}.csv", {"id": i})
    assert load(spark, folder) == LoadAudit(len(names), len(names), len(names), 0)
    assert load(spark, folder) == LoadAudit(0, 0, 0, 0)


def test_loaded_files_reach_the_marts(spark, folder):
    write(folder / "a.csv", {"sale_date": "5/4/2021"}, {"sale_date": "05/04/2021"})
    load(spark, folder)
    w = Warehouse(spark, from_flat(staged(spark, folder)))
    (day,) = w.plan("dim_dates").where("date > '2021-01-01' and date < '2022-01-01'").collect()
    assert day.date == date(2021, 5, 4)
    (month,) = w.plan("sales_by_time").collect()
    assert (month.year, month.month, month.total_orders) == (2021, 5, 2)


def test_the_feed_is_packed_and_loads_from_one_read_of_stored_rows(spark, flat, tmp_path):
    from salesmart.plans.feed import write_feed
    from salesmart.sinks.tables import load_csv, staged_sales

    rows = flat(*({"id": i, "supplier_city": "City-3" if i % 3 else "Lima"} for i in range(20)))
    write_feed(rows, f"{tmp_path}/feed")
    files = sorted(p.name for p in (tmp_path / "feed").glob("part-*"))
    assert files and all(f.endswith(".csv.gz") for f in files)
    audit = load_csv(spark, f"{tmp_path}/feed", f"{tmp_path}/staging")
    assert audit.files == len(files) and audit.rows_read == audit.rows_loaded == 20
    assert sorted(r.id for r in staged_sales(spark, f"{tmp_path}/staging").collect()) == list(range(20))


def test_the_rows_of_a_load_are_read_once_and_not_sorted_by_status(spark, folder, monkeypatch):
    from salesmart.sinks.snapshots import Attempt

    setting, plans, write_part = "spark.sql.maxConcurrentOutputFileWriters", [], Attempt._write

    def written(self, name, frame, how):
        if name == "rows":
            plan = frame._jdf.queryExecution().executedPlan().toString()
            plans.append((plan.count("FileScan text"), spark.conf.get(setting)))
        return write_part(self, name, frame, how)

    monkeypatch.setattr(Attempt, "_write", written)
    before = spark.conf.get(setting)
    texts = ("two\nlines", 'three\nmore "lines"\n', "one")
    write(folder / "a.csv", *({"id": i, "product_description": t} for i, t in enumerate(texts)), {"sale_date": "soon"})
    assert load(spark, folder) == LoadAudit(1, 4, 3, 1)
    assert plans == [(1, "3")] and spark.conf.get(setting) == before
    assert {r.product_description for r in staged(spark, folder).collect()} == set(texts)
    assert not list((folder.parent / "staging").glob("pieces/*"))


def test_a_load_leaves_no_shuffle_files(spark, folder):
    def shuffles():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    write(folder / "a.csv", *({"id": i, "product_description": "two\nlines"} for i in range(9)))
    before = shuffles()
    assert load(spark, folder) == LoadAudit(1, 9, 9, 0)
    until = time.time() + 10
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
