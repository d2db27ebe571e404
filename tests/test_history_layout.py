"""Histories whose batches touch many keys, or one key many times."""

import random

import pytest
from test_versions import brute, changes, spans

from tidewater.operators import keyed as K
from tidewater.operators import versions as V
from tidewater.operators.timecells import CELL_ROWS
from tidewater.session import work_dir


def batches():
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(12)}", rng.choice("ABC"), rng.randrange(900)) for _ in range(250)]
    rng.shuffle(rows)
    return rows, [rows[i::3] for i in range(3)]


@pytest.mark.parametrize("few, cell_rows", [(0, CELL_ROWS), (3, CELL_ROWS), (0, 20), (200, 20)])
def test_history_is_the_same_however_it_is_laid_out(spark, monkeypatch, few, cell_rows):
    monkeypatch.setattr(K, "BROADCAST_KEYS", few)
    monkeypatch.setattr(K, "CELL_ROWS", cell_rows)
    rows, parts = batches()
    path = work_dir(spark, "laid")
    for part in parts:
        K.apply_changes(spark, path, changes(spark, part), "k", ["v"], "at", buckets=2, cell_seconds=60)
    assert spans(K.read_history(spark, path)) == brute(spark, rows)
    seen = {r["k"]: r["t"] for r in V.read_table(spark, path).where("_side = 'open'").selectExpr("k", "unix_timestamp(_last_seen) as t").collect()}
    assert seen == {k: max(t for key, _, t in rows if key == k) for k, _, _ in rows}


def test_changes_of_many_keys_are_laid_out_without_a_join(spark, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_KEYS", 0)
    plans, write = [], V.write_version
    monkeypatch.setattr(V, "write_version", lambda rows, *args, **options: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or write(rows, *args, **options))
    path = work_dir(spark, "joins")
    for part in batches()[1]:
        K.apply_changes(spark, path, changes(spark, part), "k", ["v"], "at", buckets=2, cell_seconds=60)
    assert len(plans) == 3 and not any("Join" in plan for plan in plans)
