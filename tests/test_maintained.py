"""Tables that merges keep up to date, clustered Silver and the completeness stream."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from pricegrid.fixed_values import MONTHLY_TABLE, STATE_TABLE
from pricegrid.operators.catalogue import catalogue_entries, catalogue_mapping
from pricegrid.operators.marts import monthly_mart, state_mart
from pricegrid.operators.outliers import GROUP, PRICE, iqr_outliers, price_counts
from pricegrid.operators.quality import eligible_records
from pricegrid.operators.quantiles import group_quantiles
from pricegrid.plans import incremental as merging
from pricegrid.plans.gold import build_marts, refresh_gold
from pricegrid.plans.incremental import merge_silver
from pricegrid.plans.price_counts import PriceCounts
from pricegrid.settings import SchemaError, Settings
from pricegrid.sources.clustered import bucket_count, read_clustered, write_clustered
from pricegrid.sources.landed import PAGE_SCHEMA
from pricegrid.sources.tables import read_of_codes, read_silver
from pricegrid.staging import path_exists, stage
from pricegrid.streaming import completeness
from pricegrid.streaming.completeness import EVENTS, added, gaps, start_completeness_stream
from pricegrid.streaming.pages import page_stream
from test_runs import cleaned

SETTINGS = Settings(base_period="2024-01")


@pytest.fixture(scope="module")
def mapping(spark):
    return catalogue_mapping(catalogue_entries(spark, [{"catmat": c, "material_id": f"M{c}", "nome": c} for c in ("a", "b")]))


def versions(spark, mapping, batch, r):
    """Some lines, new and old ones, with other prices and dates from batch to batch."""
    rows = []
    for _ in range(40):
        line, code = str(r.randrange(60)), r.choice(["a", "a", "a", "b", None])
        price = r.choice([1.0, 2.0, 2.5, 3.0, 4.0, 100.0, -5.0, None])
        date = r.choice(["2024-01-05", "2024-01-20", "2024-02-03", "2024-03-01", None])
        rows.append((code, line, "1", price, 1.0, date, f"h{r.randrange(10**9)}", f"2024-06-{batch + 1:02d}", "d", "kg", r.choice(["SP", "RJ", None])))
    return cleaned(spark, rows, mapping)


def shown(df):
    return sorted(map(str, df.collect()))


def test_limits_from_counts_after_merges(spark, mapping, tmp_path):
    silver, counts = str(tmp_path / "s"), str(tmp_path / "c")
    r = random.Random(4)
    for batch in range(4):
        merge_silver(spark, silver, versions(spark, mapping, batch, r), SETTINGS, counts_path=counts)
    columns = ["id_compra", "catmat", "ano_mes", PRICE, "is_outlier", "outlier_reason"]
    merged = read_silver(spark, silver)
    again = iqr_outliers(merged.drop("is_outlier", "outlier_reason"))
    assert shown(again.select(*columns)) == shown(merged.select(*columns)) and merged.filter("is_outlier").count()
    kept = PriceCounts(spark, counts, silver)
    assert shown(kept.read()) == shown(price_counts(merged))
    assert not path_exists(spark, kept._note)


def test_a_written_batch_is_not_copied(spark, mapping, tmp_path, monkeypatch):
    """The same table and counts, without a copy of the batch; a copy that is made goes
    before the table is written."""
    staged, left = [], []

    def noted(df, name):
        out = stage(df, name)
        staged.append((name, out.inputFiles()[0]))
        return out

    write = merging.write_silver
    monkeypatch.setattr(merging, "stage", noted)
    monkeypatch.setattr(merging, "write_silver", lambda *a: left.append([n for n, f in staged if n == "merge-batch" and path_exists(spark, f)]) or write(*a))
    r = random.Random(6)
    batches = [stage(versions(spark, mapping, i, r), "versions") for i in range(2)]
    found = []
    for written in (True, False):
        silver, counts = (str(tmp_path / f"{n}{written}") for n in "sc")
        got = [merge_silver(spark, silver, b, SETTINGS, counts_path=counts, written=written).first() for b in batches]
        table = read_silver(spark, silver)
        found.append((got, shown(table.select(sorted(table.columns))), shown(PriceCounts(spark, counts, silver).read())))
        assert [n for n, _ in staged].count("merge-batch") == (0 if written else 2)
    assert found[0] == found[1] and left == [[]] * 4


def test_counts_are_mended_after_a_break(spark, mapping, tmp_path, monkeypatch):
    silver, counts = str(tmp_path / "s"), str(tmp_path / "c")
    r = random.Random(5)
    batches = [stage(versions(spark, mapping, i, r), "versions") for i in range(3)]
    merge_silver(spark, silver, batches[0], SETTINGS)  # the table is older than its counts
    kept = PriceCounts(spark, counts, silver)
    for broken, batch in (("write_silver", batches[1]), ("drop_emptied", batches[2])):
        with monkeypatch.context() as m:
            m.setattr(merging, broken, lambda *a, **k: (_ for _ in ()).throw(OSError("broken")))
            with pytest.raises(OSError):
                merge_silver(spark, silver, batch, SETTINGS, counts_path=counts)
        assert path_exists(spark, kept._note)
        merge_silver(spark, silver, batch, SETTINGS, counts_path=counts)
        assert shown(kept.read()) == shown(price_counts(read_silver(spark, silver)))
    kept.rebuild()
    assert shown(kept.read()) == shown(price_counts(read_silver(spark, silver)))


@pytest.mark.parametrize("group_rows", [1_000_000, 3])
def test_quantiles_of_counts(spark, group_rows):
    r = random.Random(3)
    rows = [(r.choice("xyz"), r.choice([None, *map(float, range(-5, 9))])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, v double")
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    plain, _ = group_quantiles(df, ["k"], "v", probs)
    counted, _ = group_quantiles(counts, ["k"], "v", probs, group_rows, "n")
    assert shown(counted) == shown(plain)


def test_refreshed_marts_equal_rebuilt_ones(spark, mapping, tmp_path):
    silver, gold, touched = (str(tmp_path / n) for n in ("s", "g", "t"))
    r = random.Random(6)
    for batch in range(3):
        merge_silver(spark, silver, versions(spark, mapping, batch, r), SETTINGS, touched_path=touched)
        if batch == 1:
            continue  # two merges, one refresh
        done = refresh_gold(spark, silver, gold, touched, SETTINGS).first()
        marts = build_marts(read_silver(spark, silver), SETTINGS)
        for table, mart in ((MONTHLY_TABLE, marts.monthly), (STATE_TABLE, marts.state)):
            got = read_of_codes(spark, f"{gold}/{table}").drop("_gold_processed_at")
            assert shown(got.select(*sorted(got.columns))) == shown(mart.select(*sorted(got.columns)))
        assert done.partitions_read > 0 and not path_exists(spark, touched)
    assert refresh_gold(spark, silver, gold, touched, SETTINGS).first().asDict() == {"partitions_read": 0, "monthly_records": 0, "regional_records": 0}


def test_a_refresh_reads_touched_groups_only(spark, mapping, tmp_path):
    silver, gold, touched = (str(tmp_path / n) for n in ("s", "g", "t"))
    row = lambda code, line, price, date, at: (code, line, "1", price, 1.0, date, f"{code}{line}{at}", at, "d", "kg", "SP")
    merge_silver(spark, silver, cleaned(spark, [row("a", "1", 1.0, "2024-01-01", "2024-05-01"), row("a", "2", 2.0, "2024-02-01", "2024-05-01"), row("b", "3", 3.0, "2024-01-01", "2024-05-01")], mapping), SETTINGS, touched_path=touched)
    assert refresh_gold(spark, silver, gold, touched, SETTINGS).first().partitions_read == 3
    stamps = lambda: {r["codigo_item_catalogo"]: r["t"] for r in read_of_codes(spark, f"{gold}/{MONTHLY_TABLE}").groupBy("codigo_item_catalogo").agg(F.max("_gold_processed_at").alias("t")).collect()}
    before = stamps()
    # the line of code a moves from January to March, which empties January
    merge_silver(spark, silver, cleaned(spark, [row("a", "1", 9.0, "2024-03-01", "2024-05-02")], mapping), SETTINGS, touched_path=touched)
    assert refresh_gold(spark, silver, gold, touched, SETTINGS).first().partitions_read == 2
    after = stamps()
    assert after["b"] == before["b"] and after["a"] > before["a"]
    rows = read_of_codes(spark, f"{gold}/{MONTHLY_TABLE}").filter("codigo_item_catalogo = 'a'").collect()
    assert sorted((r["ano_mes"], r["preco_mediano"]) for r in rows) == [("2024-02", 2.0), ("2024-03", 9.0)]


def test_clustered_silver_is_not_shuffled(spark, mapping):
    rows = versions(spark, mapping, 0, random.Random(7))
    table = "clustered_test"
    write_clustered(rows, table, buckets=4)
    try:
        read = read_clustered(spark, table)
        assert shown(read.select(*GROUP, PRICE)) == shown(rows.select(*GROUP, PRICE))

        def plan(df):
            return df._jdf.queryExecution().executedPlan().toString()

        limits, _ = group_quantiles(read.select(*GROUP, PRICE).dropna(subset=GROUP), GROUP, PRICE, (0.25, 0.75))
        assert "Exchange" not in plan(limits)
        eligible = eligible_records(read)
        assert "Exchange" not in plan(monthly_mart(eligible, dated=True))
        assert "Exchange" not in plan(state_mart(eligible, dated=True))
        assert "Exchange" in plan(monthly_mart(eligible_records(rows)))
        whole = ["ano_mes", "preco_mediano", "percentil_75", "quantidade_compras", "quantidade_orgaos"]
        assert shown(monthly_mart(eligible, dated=True).select(*whole)) == shown(monthly_mart(eligible_records(rows)).select(*whole))
        flagged = iqr_outliers(read)
        assert shown(flagged.select(*GROUP, PRICE, "is_outlier")) == shown(iqr_outliers(rows).select(*GROUP, PRICE, "is_outlier"))
    finally:
        spark.sql(f"DROP TABLE {table}")
    with pytest.raises(SchemaError):
        read_clustered(spark, table)
    with pytest.raises(SchemaError):
        write_clustered(spark.range(1), table)
    assert [bucket_count(n, 100) for n in (0, 1, 100, 101, 128, 200, 10_000)] == [1, 1, 1, 1, 1, 2, 128]


def test_a_bucket_stays_small_in_a_large_table():
    # Rows of the 6 GB tables; shuffled at about 185 bytes a row, and unevenly.
    assert 185_000_000 / bucket_count(185_000_000) * 185 < 500e6


# ---- completeness


def test_ranges_and_gaps():
    r = random.Random(1)
    for _ in range(200):
        pages = [r.randrange(1, 30) for _ in range(r.randrange(1, 25))]
        ranges = []
        for start in range(0, len(pages), 3):
            ranges = added(ranges, pages[start : start + 3])
        assert {p for a, b in ranges for p in range(a, b + 1)} == set(pages)
        assert all(x[1] + 1 < y[0] for x, y in zip(ranges, ranges[1:], strict=False))
        stop = r.choice([None, r.randrange(1, 35)])
        end = stop or max(pages)
        found = gaps(ranges, stop)
        assert {p for a, b in found for p in range(a, b + 1)} == set(range(1, end + 1)) - set(pages)
        assert len(found) == len({a for a, _ in found}) and all(x[1] + 1 < y[0] for x, y in zip(found, found[1:], strict=False))


def test_a_sequence_without_events_makes_no_frame():
    class State:
        exists, hasTimedOut, kept = False, False, None

        def update(self, value):
            self.kept = value

        def getCurrentWatermarkMs(self):
            return 0

        def setTimeoutTimestamp(self, at):
            self.due = at

    state, rows = State(), pd.DataFrame({"mark": [2 * 3 + 1, 2 * 1, 2 * 5 + 1], "landed_ms": [7, 9, 8]})
    assert list(completeness._follow(("r", "a"), iter([rows]), state)) == []
    assert state.kept == ("1-1,3-3,5-5", 3, False, 9) and state.due == 9
    last = pd.DataFrame({"mark": [2 * 2], "landed_ms": [10]})
    state.exists, state.get = True, state.kept
    (found,) = completeness._follow(("r", "a"), iter([last]), state)
    assert found.values.tolist() == [["r", "a", "complete", 1, 3]]


def test_completeness_of_late_and_shuffled_pages(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("pages", "events", "state"))
    at = datetime(2024, 1, 1)
    schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField("landed_at", T.TimestampType())])

    def land(*pages):
        rows = [("r", code, "full", n, "/e", body, at + timedelta(minutes=minute)) for code, n, body, minute in pages]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        query = start_completeness_stream(spark, page_stream(spark, folder), out, state, page_size=2, delay="60 minutes")
        query.awaitTermination()
        assert query.exception() is None

    def events():
        if not path_exists(spark, out):
            return []
        return sorted(tuple(r)[1:] for r in spark.read.schema(EVENTS).parquet(out).collect())

    full, short, none = '{"data":[{"a":1},{"a":2}]}', '{"data":[{"a":1}]}', '{"data":[]}'
    land(("a", 3, short, 0), ("b", 1, full, 0), ("c", 1, full, 0), ("c", 9, full, 0), ("d", 4, none, 0), ("e", 1, "oops", 0))
    land(("a", 1, full, 5), ("a", 1, full, 5), ("c", 4, full, 5))
    assert events() == []
    land(("a", 2, full, 50), ("d", 2, full, 50))  # each start goes on from the checkpoint
    assert events() == [("a", "complete", 1, 3)]
    land(("z", 1, full, 100))  # time passes over b, whose last page is from minute 0
    land(("z", 2, full, 101))
    assert ("b", "unfinished", 1, 1) in events() and ("a", "complete", 1, 3) in events()
    land(("y", 1, full, 1_000))
    land(("y", 2, full, 1_001))
    got = [e for e in events() if e[0] in "abcde"]
    assert got == [
        ("a", "complete", 1, 3), ("b", "unfinished", 1, 1), ("c", "gap", 2, 3), ("c", "gap", 5, 8), ("c", "unfinished", 1, 9),
        ("d", "gap", 1, 1), ("d", "gap", 3, 3),
    ]
