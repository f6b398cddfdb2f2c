"""Small scan histories, and the register recomputed from them in plain Python."""

import random
from datetime import date, datetime, timedelta

START = datetime(2026, 1, 1, 9)


def random_history(seed, scans=7, hosts=4, checks=3, gap_days=7):
    """[(time, {(host, plugin): (name, severity)})], oldest first; some scans are empty."""
    rng = random.Random(seed)
    history = []
    for i in range(scans):
        found = {}
        for h in range(hosts):
            for c in range(checks):
                if rng.random() < 0.45:
                    found[f"h{h}", c] = (f"check {c} v{rng.randint(1, 2)}", rng.randint(0, 4))
        if rng.random() < 0.15:
            found = {}
        history.append((START + timedelta(days=gap_days * i), found))
    return history


def fold(history):
    """Register and per-scan (opened, reopened, closed) after a sync per scan."""
    register, counts, seen = {}, [], {}
    for time, found in history:
        opened = reopened = closed = 0
        for key, (name, severity) in found.items():
            seen[key] = min(seen.get(key, time), time)
            if key not in register:
                register[key] = [name, severity, seen[key].date(), None]
                opened += 1
            elif register[key][3] is not None:
                register[key][3] = None
                reopened += 1
        for key, row in register.items():
            if key not in found and row[3] is None:
                row[3] = time.date()
                closed += 1
        counts.append((opened, reopened, closed))
    return {k: tuple(v) for k, v in register.items()}, counts


def frames(spark, history, source="s"):
    """(finding, scan_run) holding the history."""
    runs = [(f"run-{source}-{t:%Y%m%d%H}", t, source) for t, _ in history]
    facts = [
        (t, run, host, plugin, name, severity, None, f"{t:%Y_%m}")
        for (t, found), (run, _, _) in zip(history, runs)
        for (host, plugin), (name, severity) in found.items()
    ]
    from driftledger.schemas import FINDING

    return (
        spark.createDataFrame(facts, FINDING),
        spark.createDataFrame(runs, "scan_run_id string, scanned_at timestamp, source string"),
    )


def as_dict(register):
    rows = register.filter("opened_on IS NOT NULL").collect()
    return {(r.host, r.plugin_id): (r.plugin_name, r.severity, r.opened_on, r.closed_on) for r in rows}


def settle(df, schema):
    """Collect and recreate, so that a test's fold does not grow one plan."""
    return df.sparkSession.createDataFrame(df.select(*schema.names).collect(), schema)


__all__ = ["START", "as_dict", "date", "fold", "frames", "random_history", "settle"]
