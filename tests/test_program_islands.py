"""Program windows folded by islands against one fold over all of a key's advisories."""

import random

from isobar.operators.ordered import program_windows


def plain(events):
    done, cur = [], None
    for t, cancel, a, b, day in sorted(events, key=lambda e: (e[0], e[1], e[2] is not None, e[2] or 0, e[3] is not None, e[3] or 0, e[4])):
        if cancel:
            if cur and (cur["end"] is None or t < cur["end"]):
                cur = cur | {"end": None if cur["start"] is None else max(cur["start"], t), "cancelled": True}
            done, cur = done + [cur] if cur else done, None
            continue
        period = a is not None and b is not None
        if cur and (cur["days"][-1] == day if cur["end"] is None else t <= cur["end"] or (period and a <= cur["end"] + 60)):
            timed = period and cur["start"] is not None
            cur = {"start": min(cur["start"], a) if timed else None, "end": b if timed else None, "days": cur["days"] if day in cur["days"] else [*cur["days"], day], "cancelled": False}
        else:
            done = done + [cur] if cur else done
            cur = {"start": a if period else None, "end": b if period else None, "days": [day], "cancelled": False}
    return [(w["start"], w["end"], tuple(w["days"]), w["cancelled"]) for w in (done + [cur] if cur else done)]


def test_islands_equal_one_fold(spark):
    rng = random.Random(6)
    rows = []
    for key in ["hot"] * 6 + ["a", "b", "c", None]:
        for _ in range(rng.choice([1, 5, 60, 150])):
            t = rng.randrange(40 * 86_400)
            a = rng.choice([None, t, t - 3_600, t + 7_200])
            b = rng.choice([None, t + 600, t + 9_000, t + 200_000])
            rows.append((key, t, rng.random() < 0.2, a, b, f"day {t // 86_400 + rng.choice([0, 0, 0, 1]):02d}"))
    rows += rows[:20]
    df = spark.createDataFrame(rows, "code string, t long, cancel boolean, p_start long, p_end long, day string").repartition(6)
    got = sorted(((r.code, r.start, r.end, tuple(r.days), r.cancelled) for r in program_windows(df, ["code"]).collect()), key=str)
    want = sorted(((c, *w) for c in {r[0] for r in rows} for w in plain([r[1:] for r in rows if r[0] == c])), key=str)
    assert got == want


def test_no_advisories(spark):
    df = spark.createDataFrame([], "code string, t long, cancel boolean, p_start long, p_end long, day string")
    assert program_windows(df, ["code"]).collect() == []
