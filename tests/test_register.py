import pytest
from histories import as_dict, fold, frames, random_history, settle
from pyspark.sql import functions as F

from driftledger.operators import register, reports
from driftledger.operators.register import STEPS
from driftledger.schemas import REGISTER, REGISTER_MOVES


def fold_with_sync(spark, history):
    """Load a scan, sync, load the next."""
    current = spark.createDataFrame([], REGISTER)
    counts = []
    for n in range(1, len(history) + 1):
        synced = register.sync(current, *frames(spark, history[:n]))
        counts.append(tuple(register.count_transitions(synced).first()))
        current = settle(synced, REGISTER)
    return current, counts


def advance_in(spark, history, sizes):
    """Carry the register over deliveries of the given sizes."""
    current, counts, synced, start = spark.createDataFrame([], REGISTER), [], None, 0
    for size in sizes:
        batch = history[start : start + size]
        finding, runs = frames(spark, batch)
        rows = [(r.scan_run_id, r.scanned_at) for r in runs.orderBy("scanned_at").collect()]
        known = ([synced] if synced else []) + rows
        steps = spark.createDataFrame([(*r, i) for i, r in enumerate(known, 0 if synced else 1)], STEPS)
        advanced = settle(register.advance(current, finding, steps), REGISTER_MOVES)
        moved = register.count_moves(advanced, steps).filter("step > 0").orderBy("step").collect()
        counts += [(m.opened, m.reopened, m.closed) for m in moved]
        current, synced, start = advanced.select(*REGISTER.names), rows[-1], start + size
    return current, counts


@pytest.mark.parametrize("seed", [1, 3])
def test_all_forms_agree_with_a_plain_fold(spark, seed):
    history = random_history(seed)
    want, want_counts = fold(history)
    folded, counts = fold_with_sync(spark, history)
    assert as_dict(folded) == want
    assert counts == want_counts

    finding, runs = frames(spark, history)
    assert as_dict(register.rebuild(finding, runs)) == want
    moved = register.transitions(finding, runs).orderBy("scanned_at").collect()
    assert [(m.opened, m.reopened, m.closed) for m in moved] == want_counts

    for sizes in ([7], [3, 1, 1, 2]):
        carried, counts = advance_in(spark, history, sizes)
        assert as_dict(carried) == want
        assert counts == want_counts
        promised = {tuple(r) for r in carried.drop("first_seen").collect()}
        assert promised == {tuple(r) for r in folded.drop("first_seen").collect()}


def test_fold_equals_rebuild_on_given_tables(spark, sf_dir):
    """Advance over the events relation in three deliveries gives its rebuild."""
    from driftledger.plans import relations as rel

    finding, runs = rel.finding_a(spark, sf_dir), rel.scan_run_a(spark, sf_dir)
    chain = register.scan_chain(runs)
    current = spark.createDataFrame([], REGISTER)
    for low, high in ((1, 9), (10, 10), (11, 1000)):
        steps = chain.filter(F.col("scan_rank").between(low - 1, high)).select(
            "scan_run_id", "scanned_at", (F.col("scan_rank") - low + 1).alias("step")
        )
        batch = finding.join(chain.filter(F.col("scan_rank").between(low, high)).select("scan_run_id"), "scan_run_id")
        current = settle(register.advance(current, batch, steps), REGISTER)
    assert {tuple(r) for r in current.collect()} == {tuple(r) for r in register.rebuild(finding, runs).collect()}


def test_counts_balance(spark):
    history = random_history(11, scans=9)
    finding, runs = frames(spark, history)
    moved = register.transitions(finding, runs).orderBy("scanned_at").collect()
    still_open = 0
    for (_, found), m in zip(history, moved):
        still_open += m.opened + m.reopened - m.closed
        assert still_open == len(found)
    newest = {r.status: r.n for r in reports.delta(finding, runs).collect()}
    assert newest.get("new", 0) == moved[-1].opened + moved[-1].reopened
    assert newest.get("resolved", 0) == moved[-1].closed


def test_promise_is_fixed_at_open(spark):
    history = [(t, f) for t, f in random_history(5, scans=3)]
    t = [h[0] for h in history]
    history = [
        (t[0], {("h", 1): ("old name", 4)}),
        (t[1], {}),
        (t[2], {("h", 1): ("new name", 1)}),
    ]
    finding, runs = frames(spark, history)
    row = register.rebuild(finding, runs).first()
    assert (row.plugin_name, row.severity, row.rom_hours) == ("old name", 4, 16)
    assert (row.opened_on, row.closed_on) == (t[0].date(), None)
    assert (row.due_on - row.opened_on).days == 15


def test_empty_newest_scan_closes_everything(spark):
    history = random_history(4, scans=3)
    history.append((history[-1][0].replace(month=6), {}))
    finding, runs = frames(spark, history)
    assert all(r[3] is not None for r in as_dict(register.rebuild(finding, runs)).values())


def test_sync_once_after_loading_everything_opens_only_the_newest(spark):
    history = random_history(8)
    finding, runs = frames(spark, history)
    synced = register.sync(spark.createDataFrame([], REGISTER), finding, runs)
    assert set(as_dict(synced)) == set(history[-1][1])
    first = {}
    for time, found in history:
        for key in found:
            first.setdefault(key, time.date())
    assert all(row[2] == first[key] for key, row in as_dict(synced).items())


def test_two_sources_at_one_instant(spark):
    """Only the lesser run id is ever the newest scan; the other's facts still
    count as first sightings."""
    time = random_history(1)[0][0]
    later = time.replace(month=3)
    a, runs_a = frames(spark, [(time, {("h", 1): ("x", 2)}), (later, {("h", 2): ("y", 2)})], "a")
    b, runs_b = frames(spark, [(time, {("h", 2): ("y", 2)})], "b")
    built = register.rebuild(a.unionByName(b), runs_a.unionByName(runs_b))
    assert as_dict(built) == {
        ("h", 1): ("x", 2, time.date(), later.date()),
        ("h", 2): ("y", 2, time.date(), None),
    }


def test_aging_from_state_equals_aging_from_history(spark):
    finding, runs = frames(spark, random_history(21, scans=8, hosts=9))
    from_history = reports.aging(finding, runs).collect()
    from_state = reports.aging(finding, runs, first_seen=register.rebuild(finding, runs)).collect()
    assert from_history == from_state and from_history


def backfill(seed, scans, share):
    """A long history of few keys, with runs and gaps that cross the words of 64 scans."""
    import random
    from datetime import timedelta

    from histories import START

    rng = random.Random(seed)
    seen, history = {key: False for key in [("h", c) for c in range(4)]}, []
    for i in range(scans):
        for key in seen:
            if rng.random() < share:
                seen[key] = not seen[key]
        history.append((START + timedelta(hours=i), {k: (f"check {k[1]}", k[1]) for k, on in seen.items() if on}))
    return history


@pytest.mark.parametrize("seed, sizes, share", [(1, [200], 0.5), (2, [64, 64, 72], 0.02), (3, [1, 63, 65, 71], 0.3), (4, [127, 73], 0.01)])
def test_presence_words_equal_the_fold(spark, seed, sizes, share):
    history = backfill(seed, 200, share)
    want, want_counts = fold(history)
    carried, counts = advance_in(spark, history, sizes)
    assert as_dict(carried) == want and counts == want_counts


def test_one_word_and_many_agree(spark):
    """Telling the number of steps changes the plan, not the rows."""
    history = backfill(9, 40, 0.3)
    finding, runs = frames(spark, history)
    rows = [(r.scan_run_id, r.scanned_at, i) for i, r in enumerate(runs.orderBy("scanned_at").collect(), 1)]
    steps = spark.createDataFrame(rows, STEPS)
    none = spark.createDataFrame([], REGISTER)
    told, untold = (register.advance(none, finding, steps, n_steps=n) for n in (40, None))
    assert sorted(map(repr, told.collect())) == sorted(map(repr, untold.collect()))
    # One exchange less for the facts.
    assert untold._jdf.queryExecution().executedPlan().toString().count("Exchange") > told._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_five_thousand_scans_of_one_key(spark):
    """A backfill whose one key comes and goes: words, not arrays of scans, and no square of them."""
    import time

    from pyspark.sql import Row

    def load(n):
        steps = spark.range(1, n + 1).select(
            F.concat(F.lit("run"), "id").alias("scan_run_id"), F.timestamp_seconds(F.col("id") * 3600).alias("scanned_at"), F.col("id").cast("int").alias("step")
        )
        seen = steps.filter("step % 3 != 0").select(
            "scan_run_id", "scanned_at", F.lit("h").alias("host"), F.lit(1).alias("plugin_id"), F.lit("x").alias("plugin_name"), F.lit(2).cast("smallint").alias("severity")
        )
        advanced = settle(register.advance(spark.createDataFrame([], REGISTER), seen, steps), REGISTER_MOVES)
        row = advanced.first()
        assert len(row.moves) <= 4 * (n // 64 + 1)
        totals = register.count_moves(advanced, steps).agg(F.sum("opened"), F.sum("reopened"), F.sum("closed")).first()
        return row, tuple(totals)

    load(5000)  # code is compiled
    start = time.perf_counter()
    row, totals = load(5000)
    took = time.perf_counter() - start
    assert totals == (1, 1666, 1666) and row.closed_on is None and isinstance(row, Row)
    start = time.perf_counter()
    load(20000)
    assert time.perf_counter() - start < 8 * max(took, 0.5)


def test_equal_instants_in_any_order(spark):
    """Two sources at one time are one step, whichever comes first and also in two deliveries."""
    t, later = random_history(1)[0][0], random_history(1)[1][0]
    a, runs_a = frames(spark, [(t, {("h", 1): ("x", 2)})], "a")
    b, runs_b = frames(spark, [(t, {("h", 2): ("y", 2)}), (later, {("h", 1): ("x", 2)})], "b")
    built = as_dict(register.rebuild(a.unionByName(b), runs_a.unionByName(runs_b)))
    assert built == {("h", 1): ("x", 2, t.date(), None), ("h", 2): ("y", 2, t.date(), later.date())}
    none, at_t = spark.createDataFrame([], REGISTER), runs_a.select("scan_run_id", "scanned_at", F.lit(1).alias("step"))
    for first, second in ((a, b.filter(F.col("scanned_at") == F.lit(t))), (b.filter(F.col("scanned_at") == F.lit(t)), a)):
        current = settle(register.advance(none, first, at_t), REGISTER)
        current = settle(register.advance(current, second, at_t.withColumn("step", F.lit(0))), REGISTER)
        last = runs_b.filter(F.col("scanned_at") == F.lit(later)).select("scan_run_id", "scanned_at", F.lit(1).alias("step"))
        steps = at_t.withColumn("step", F.lit(0)).unionByName(last)
        current = settle(register.advance(current, b.filter(F.col("scanned_at") == F.lit(later)), steps), REGISTER)
        assert as_dict(current) == built


def test_by_source_equals_a_plain_state_machine(spark):
    """Two sources with histories of their own over shared problems."""
    from datetime import timedelta

    a = random_history(41, scans=6)
    b = [(t + timedelta(days=3), f) for t, f in random_history(42, scans=5)]
    frames_a, frames_b = frames(spark, a, "a"), frames(spark, b, "b")
    finding, runs = (x.unionByName(y) for x, y in zip(frames_a, frames_b))
    newest, want, counts = {}, {}, {}
    for time, found, source in sorted([(t, f, "a") for t, f in a] + [(t, f, "b") for t, f in b], key=lambda x: x[0]):
        newest[source] = found
        held = {k for f in newest.values() for k in f}
        opened = reopened = closed = 0
        for k in held:
            if k not in want:
                want[k] = [*found[k], time.date(), None]
                opened += 1
            elif want[k][3]:
                want[k][3] = None
                reopened += 1
        for k, row in want.items():
            if k not in held and row[3] is None:
                row[3] = time.date()
                closed += 1
        counts[time] = (opened, reopened, closed)
    assert as_dict(register.rebuild_by_source(finding, runs)) == {k: tuple(v) for k, v in want.items()}
    moved = register.transitions_by_source(finding, runs).withColumn("at", F.col("scanned_at").cast("string")).collect()
    assert {r.at: (r.opened, r.reopened, r.closed) for r in moved} == {str(t): c for t, c in counts.items()}


def test_by_source_of_one_source_is_the_register(spark):
    finding, runs = frames(spark, random_history(43))
    assert as_dict(register.rebuild_by_source(finding, runs)) == as_dict(register.rebuild(finding, runs))
    one, two = (sorted(map(tuple, f(finding, runs).collect())) for f in (register.transitions, register.transitions_by_source))
    assert one == two
