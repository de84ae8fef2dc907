"""Order, groups, stores and streams against plain versions, with large keys, ties, nulls and repeated runs."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import checks, contract, events, groups, order, physics, zones
from sensorloom.sources import files, stores
from sensorloom.streaming import stateful


def test_order_statistics_of_many_keys(spark, monkeypatch):
    monkeypatch.setattr(order, "FEW", 60)
    monkeypatch.setattr(order, "BINS", 64)
    rng = random.Random(1)
    kinds = (lambda: rng.gauss(0, 1e6), lambda: float(rng.randrange(3)), lambda: 10.0 ** rng.randrange(-9, 9), lambda: 7.5, lambda: rng.choice([-1e308, 1e308, 0.0]))
    rows = [(k, float(make())) for k, make in enumerate(kinds) for _ in range(400)]
    rows += [(10 + n, float(rng.randrange(100))) for n in range(1, 9) for _ in range(n)] + [(0, None), (0, float("nan")), (30, None)]
    rows += [(40, v) for v in (float("-inf"), float("inf"), 1.0, 2.0, 3.0) * 9]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double")
    lists = {}
    for k, v in rows:
        if v is not None and v == v:
            lists.setdefault(k, []).append(v)
    got = {r.k: r for r in order.quartiles(df, ["k"], "v").collect()}
    assert set(got) == set(lists)
    for k, values in lists.items():
        assert got[k].n == len(values)
        if k == 40:
            continue
        if len(values) < 4:
            assert got[k].median == statistics.median(values) and got[k].iqr is None
        elif k != 4:
            a, b, c = statistics.quantiles(values, n=4)
            assert got[k].median == pytest.approx(b) and got[k].iqr == pytest.approx(c - a)
    assert {r.k: r["median"] for r in order.medians(df.where("k < 20 and k <> 4"), ["k"], "v").collect()} == pytest.approx({k: statistics.median(v) for k, v in lists.items() if k < 20 and k != 4})
    wanted = spark.createDataFrame([(k, p) for k in lists for p in (0, 1, 5, 44, 10**6)], "k int, pos long")
    found = {(r.k, r.pos): r.v for r in order.at_positions(df, ["k"], "v", wanted).collect()}
    assert found == {(k, p): sorted(v)[p] for k, v in lists.items() for p in (0, 1, 5, 44, 10**6) if p < len(v)}
    assert order.quartiles(df.limit(0), ["k"], "v").count() == 0


def test_numbers_over_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab"), rng.randrange(1000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(7)
    whole = [r.i for r in sorted(order.numbered(df, [F.desc("v"), F.col("i")]).collect(), key=lambda r: r.number)]
    assert whole == [i for _, _, i in sorted(rows, key=lambda r: (-r[1], r[2]))]
    keyed = {r.i: r.rank for r in order.numbered(df, [F.col("v"), F.col("i")], "rank", ["k"]).collect()}
    for k in "ab":
        assert [keyed[i] for _, _, i in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))] == list(range(1, sum(r[0] == k for r in rows) + 1))
    assert order.numbered(df.limit(0), [F.col("v")]).count() == 0


def test_lines_of_a_file_in_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(lines))
    (tmp_path / "b.txt").write_text("one\ntwo")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        text = spark.read.text(str(tmp_path)).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
        assert text.rdd.getNumPartitions() > 5
        got = {(r.file, r.line): r.value for r in order.split_numbers(text).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {("a.txt", i + 1): v for i, v in enumerate(lines)} | {("b.txt", 1): "one", ("b.txt", 2): "two"}


def test_greedy_choice_of_many_overlapping_spans(spark):
    n = 200_000
    spans = spark.range(n).select(F.lit("B").alias("building"), F.lit("Z").alias("zone"), F.col("id").alias("i0"), (F.col("id") + 3 + F.col("id") % 5).alias("close"))
    kept = sorted(r.i0 for r in events.greedy(spans).collect())
    end, want = -1, []
    for i in range(n):
        if i >= end:
            want.append(i)
            end = i + 3 + i % 5
    assert kept == want


def test_correlations_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(groups, "TILE", 16)
    monkeypatch.setattr(groups, "TIMES", 7)
    rng = np.random.default_rng(3)
    base, rows, value = rng.normal(size=40), [], {}
    for k in range(120):
        for t in range(40):
            if rng.random() < 0.7:
                v = float(5.0 if k % 11 == 0 else (base[t] if k % 3 == 0 else 0) + rng.normal() * (0.2 if k % 2 else 1))
                rows.append((f"L{k}", f"t{t:02d}", v))
                value[f"L{k}", f"t{t:02d}"] = v
    members = spark.createDataFrame([(f"L{k}", "same_system", "s" if k < 100 else "r") for k in range(120)] + [(f"L{k}", "same_controller", "c") for k in range(5)] + [("L0", "same_equipment", "alone")], "raw_label string, kind string, key string")
    series = spark.createDataFrame(rows, "raw_label string, ts_text string, value double")
    flat = spark.createDataFrame([("L110",)], "raw_label string")

    def correlation(a, b):
        common = [t for t in (f"t{t:02d}" for t in range(40)) if (a, t) in value and (b, t) in value]
        x, y = ([value[k, t] for t in common] for k in (a, b))
        return len(common), None if len(common) < 2 or min(x) == max(x) or min(y) == max(y) else float(np.corrcoef(x, y)[0, 1])

    want = {}
    for part in ([f"L{k}" for k in range(100)], [f"L{k}" for k in range(100, 120) if k != 110]):
        for i, a in enumerate(part):
            for b in part[i + 1 :]:
                want[tuple(sorted((a, b)))] = correlation(a, b)
    got = {(r.a, r.b): (r.n, r.r) for r in groups.pair_correlations(series, members, flat).collect()}
    assert set(got) == set(want)
    for k, (n, r) in want.items():
        assert got[k][0] == n and ((r is None) == (got[k][1] is None)) and (r is None or got[k][1] == pytest.approx(r, abs=1e-9))
    counts = {(r.key, r.raw_label): r for r in groups.correlation_counts(series, members, flat).collect()}
    for label in ("L0", "L3", "L17", "L99"):
        mine = {k[0] if k[1] == label else k[1]: r for k, (_, r) in want.items() if label in k}
        r = counts["s", label]
        assert (r.supported, r.no_signal, r.skipped) == (sum(v is not None and abs(v) >= 0.3 for v in mine.values()), sum(v is not None and abs(v) < 0.3 for v in mine.values()), sum(v is None for v in mine.values()))
        best = min(((-abs(round(v, 6)), k) for k, v in mine.items() if v is not None), default=(None, None))
        assert r.best == best[1]
    assert len([k for k in counts if k[0] == "c"]) == 5 and ("alone", "L0") not in counts
    assert {(r.raw_label, r.others) for r in groups.memberships(members).where("key = 'c'").collect()} == {(f"L{k}", 4) for k in range(5)}
    assert checks.co_behaviour(series, members, flat).where("verdict = 'SKIPPED'").count() == sum(r is None for _, r in want.values())


def test_stores_do_not_add_twice(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    read = lambda t: sorted(((r.k, r.v) for r in t.collect()), key=str)
    stores.append_once(rows(("a", 1), ("b", 2), ("b", 3), (None, 4)), path, ["k"], "one")
    for _ in range(2):
        table = stores.append_once(rows(("b", 9), ("c", 5), (None, 6)), path, ["k"], "two")
        assert read(table) == sorted([("a", 1), ("b", 2), ("c", 5), (None, 4)], key=str)
    assert {(r.batch, r.n) for r in stores.ledger(table).collect()} == {("one", 3), ("two", 1)}
    assert stores.append_once(rows().limit(0), path, ["k"], "three").count() == 4
    path = str(tmp_path / "merged")
    for batch in ((("a", 1), ("b", 2)), (("a", 5), ("c", 3)), (("a", 4), ("c", 3))):
        table = stores.merge(rows(*batch), path, ["k"], "v")
    assert read(table) == [("a", 5), ("b", 2), ("c", 3)]


def test_rescan_of_changed_files(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    parse = lambda lines: lines.select("path", "value")
    seen = lambda: sorted((r.path.rsplit("/", 1)[1], r.value, r.scan) for r in stores.scanned(spark, store).collect())
    for name in "abc":
        (folder / f"{name}.csv").write_text(f"{name}1\n{name}2")
    assert stores.rescan(spark, str(folder), store, parse) == 3
    first = seen()
    (folder / "b.csv").write_text("b3\nb4\nb5")
    (folder / "d.csv").write_text("d1")
    (folder / "c.csv").unlink()
    (folder / "note.txt").write_text("no")
    assert stores.rescan(spark, str(folder), store, parse) == 2
    assert seen() == [r for r in first if r[0] == "a.csv"] + [("b.csv", "b3", 1), ("b.csv", "b4", 1), ("b.csv", "b5", 1), ("d.csv", "d1", 1)]
    assert stores.rescan(spark, str(folder), store, parse) == 0 and len(seen()) == 6
    # a scan that wrote rows but no manifest does not count, and the next one takes its number
    lost = spark.createDataFrame([("x", "y", 1, dt.datetime(2024, 1, 1), 3)], "path string, value string, size long, modified timestamp, scan int")
    lost.write.mode("append").partitionBy("scan").parquet(f"{store}/rows")
    (folder / "a.csv").write_text("a9")
    assert stores.rescan(spark, str(folder), store, parse) == 1 and len(seen()) == 5 and ("a.csv", "a9", 3) in seen()


def grid(rows):
    """Zone samples of ``(zone, actual, setpoint, gain)`` in order, a minute each."""
    out, at = [], {}
    for zone, t, sp, g in rows:
        at[zone] = i = at.get(zone, 0) + 1
        out.append(("B", zone, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), t, sp, g, i, t is None and sp is None and g is None, False))
    return out


SAMPLES = "building string, zone string, ts timestamp, actual double, setpoint double, gain double, grid_idx long, is_empty boolean, is_bad boolean"


@pytest.mark.parametrize("seed", [1, 2])
def test_open_events_of_a_stream(spark, seed):
    rng = random.Random(seed)
    rows = []
    for zone in ("Z1", "Z2", "Z3"):
        temp, night = 21.0, False
        for i in range(1500):
            if i % 170 == 100:
                night = not night
            temp = max(15.0, temp - 0.02) if night else min(21.0, temp + 0.05)
            gain = (30.0 if rng.random() < 0.01 else 0.0) if night else 50.0
            none = lambda v, p=0.1: None if rng.random() < p else v
            rows.append((zone, none(round(temp + rng.random() / 10, 3)), none(17.0 if night else 21.0), none(gain)) if rng.random() > 0.05 else (zone, None, None, None))
    df = spark.createDataFrame(grid(rows), SAMPLES)
    want = events.decay_events(df).drop("season")
    cuts = sorted(rng.sample(range(2, 1499), 4))
    slices = [df.where((F.col("grid_idx") > a) & (F.col("grid_idx") <= b)) for a, b in zip([0, *cuts], [*cuts, 9999])]
    tick = spark.createDataFrame([("clock", "clock", dt.datetime(2024, 2, 1), None, None, None, 1, False, False)], SAMPLES)
    got = stateful.run_in_slices([*slices, tick], stateful.open_decays)
    names = want.columns
    close = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert {close(r) for r in got.select(*names).collect()} == {close(r) for r in want.collect()} and want.count() > 5


def test_late_rows_of_a_stream(spark):
    rng = random.Random(4)
    rows = [(f"L{rng.randrange(3)}", f"2024-01-{rng.randrange(1, 20):02d}", None if rng.random() < 0.1 else float(rng.randrange(9)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "raw_label string, ts_text string, value double, arrival long")
    got = stateful.run_in_slices([df.where(F.floor(F.col("arrival") / 100) == k) for k in range(4)], stateful.late_rows)
    last = {}
    for r in got.collect():
        last[r.raw_label] = max(last.get(r.raw_label, (0, 0, 0)), (r.n_num, r.out_of_order, r.n_decreases))
    want = {}
    for label in ("L0", "L1", "L2"):
        top, before, n, late, falls = "", None, 0, 0, 0
        for name, ts, v, _ in rows:
            if name != label or v is None:
                continue
            n += 1
            if ts < top:
                late += 1
                continue
            top = ts
            falls += before is not None and v < before
            before = v
        want[label] = (n, late, falls)
    assert last == want


def test_records_against_the_contract(spark):
    whole = '{"raw_label": "x", "source_type": "other", "confidence": 0.1, "validated": false, "carrier": null, "location": {"building": "B1", "zone": null}, "relationships": []}'
    cases = {
        whole: [],
        '{"source_type": "kiona", "confidence": 0.5, "validated": false}': [("(root)", "lacks raw_label")],
        whole.replace('"carrier": null', '"carrier": "not-a-carrier"'): [("carrier", "is none of the known values")],
        whole.replace('"relationships": []', '"relationships": null'): [("relationships", "is no array")],
        whole.replace(', "zone": null', ""): [("location", "lacks zone")],
        whole.replace('"zone": null', '"zone": null, "room": 3'): [("location", "has unknown room")],
        whole.replace('"relationships": []', '"relationships": [{"type": "feeds", "target_raw_label": "a"}, {"type": 5}]'): [("relationships/1", "lacks target_raw_label"), ("relationships/1/type", "is no string")],
        whole.replace("0.1", "-1"): [("confidence", "is below 0")],
        whole.replace("0.1", "1"): [],
        whole.replace('"x"', "7"): [("raw_label", "is no string")],
        "[1]": [("(root)", "is no object")],
        "{": [("(root)", "is no JSON")],
        None: [("(root)", "is no JSON")],
    }
    rows = spark.createDataFrame([(k,) for k in cases], "record string")
    got = {r.record: [tuple(v) for v in r.violations] for r in contract.violations(rows, contract.RECORD).collect()}
    assert got == cases


def test_duty_checks_and_votes(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    duty = spark.createDataFrame([(b, d, float(i if b != "C" else 40 - i)) for b in "ABC" for i, d in enumerate(days) if b != "B" or i < 20], "building string, day date, duty double")
    weather = spark.createDataFrame([(d, 10.0 - i * 0.5) for i, d in enumerate(days)], "day date, temp double")
    meters = spark.createDataFrame([(b, d, float(i)) for b in "AC" for i, d in enumerate(days)], "building string, day date, energy double")
    got = {(r.building, r.measure): (r.n, r.verdict) for r in physics.duty_checks(duty, weather, meters, spark.createDataFrame([("A",), ("C",)], "building string")).collect()}
    assert got == {("A", "outdoor"): (40, "PASS"), ("B", "outdoor"): (20, "INCONCLUSIVE"), ("C", "outdoor"): (40, "CONFLICT"), ("A", "meter"): (40, "PASS"), ("C", "meter"): (40, "CONFLICT")}
    steps = lambda *r: spark.createDataFrame([("B", z, m, i) for i, (z, m) in enumerate(r)], "building string, zone string, minute int, grid_idx long")
    votes = physics.shift_votes(steps(("a", 360), ("a", 400), ("a", 400), ("b", 300), ("b", 310), ("c", 5)), steps(("a", 340), ("b", 299), ("d", 1)))
    assert {(r.zone, r["shift"], r.vote) for r in votes.collect()} == {("a", 60, "utc"), ("b", 1, "local")}
    assert physics.timestamp_verdict(votes).first().verdict == "INCONCLUSIVE"


def test_zone_files_of_all_kinds(spark, tmp_path):
    rows = [("Buildings/X 1/Thermal zone(s)/Z+1.csv", n, line) for n, line in enumerate(["Timestamp,T_Actualvalue,T_Setvalue,T_Gain", "2024-01-01 00:00:00,20.5,21,0", "2024-01-01 00:01:00,,,", "2024-01-01 00:02:00,x,21,0", "2024-01-01 00:03:00,20"])]
    rows += [("Buildings/Y/Thermal zones/Z2.csv", n, line) for n, line in enumerate(["Timestamp,COOL_Gain", "2024-01-01 00:00:00,", "2024-01-01 00:01:00,5"])]
    stores.write_named(spark.createDataFrame(rows, "name string, n int, line string"), str(tmp_path))
    lines = files.zone_files(spark, str(tmp_path))
    got = {(r.building, r.zone, r.kind): r.n for r in lines.groupBy("building", "zone", "kind").agg(F.count("*").alias("n")).collect()}
    assert got == {("X 1", "Z+1", "t_triple"): 4, ("Y", "Z2", "cool_gain"): 2}
    grid_rows = sorted((r.grid_idx, r.actual, r.is_empty, r.is_bad) for r in files.zone_samples(lines).collect())
    assert grid_rows == [(1, 20.5, False, False), (2, None, True, False), (3, None, False, True), (4, None, False, True)]
    other = files.other_zones(files.zone_files(spark, str(tmp_path), ["y"])).first()
    assert (other.n_grid, other.n_data, other.first_ts) == (2, 1, "2024-01-01 00:01:00")


def test_halos_match_whole_windows(spark, monkeypatch):
    rng = random.Random(6)
    rows = grid([("Z", rng.choice([None, 19.0, 20.0, 21.5]), 21.0, rng.choice([None, 0.0, 3.0, 60.0, 90.0])) for _ in range(900)])
    df = spark.createDataFrame(rows, SAMPLES)
    whole = {tuple(r) for r in events.rise_events(df, width=40).collect()}, zones.control_behaviour(df).first()
    for m in (events, zones):
        monkeypatch.setattr(m, "CHUNK", 50)
    assert ({tuple(r) for r in events.rise_events(df, width=40).collect()}, zones.control_behaviour(df).first()) == whole


@pytest.mark.parametrize("chunk", [1, 7, 10**6])
def test_order_defects_by_chunks(spark, chunk):
    from sensorloom.operators import series

    rng = random.Random(chunk)
    rows = [(f"L{rng.randrange(4)}", f"2024-01-{rng.randrange(1, 9):02d}", None if rng.random() < 0.1 else float(rng.randrange(5)), i) for i in range(300)]
    df = spark.createDataFrame(rows, "raw_label string, ts_text string, value double, arrival long").repartition(3)
    want = {tuple(r) for r in series.ordered_rows(df, chunk).groupBy("raw_label").agg(F.count_if("stray"), F.count_if("decrease")).collect()}
    assert {tuple(r) for r in series.order_defects(df, chunk).collect()} == want
