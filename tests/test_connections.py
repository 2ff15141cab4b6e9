import random
from datetime import timedelta

from helpers import at, view
from logtally.operators import connections
from logtally.plans import recipes

DAY = "2026-08-20T"
GAP = timedelta(minutes=30)


def brute(rows, gap=GAP):
    """(account, first, last, events, connects, disconnects, closed) per session."""
    signs = {}
    for i, account, action, time, detail in rows:
        refused = action == "SOCKET_DISCONNECT" and (detail or {}).get("ownedSlot") is False
        if account is not None and time is not None and not refused:
            signs.setdefault(account, []).append((at(time), i, action))
    out = []
    for account, found in signs.items():
        session = []
        for sign in [*sorted(found), None]:
            if session and (sign is None or sign[0] - session[-1][0] > gap):
                actions = [a for *_, a in session]
                out.append(
                    (account, session[0][0], session[-1][0], len(session), actions.count("SOCKET_CONNECT"),
                     actions.count("SOCKET_DISCONNECT"), actions[-1] == "SOCKET_DISCONNECT")
                )
                session = []
            if sign:
                session.append(sign)
    return sorted(out)


def found(v, **more):
    return sorted(
        (r.account_id, r.started_at, r.ended_at, r.events, r.connects, r.disconnects, r.closed)
        for r in connections.connection_session(v, **more).collect()
    )


def test_sessions_end_after_the_gap(spark):
    rows = [
        (1, 1, "SOCKET_CONNECT", DAY + "10:00:00", None),
        (2, 1, "ITEM_BUY", DAY + "10:30:00", None),  # exactly the gap
        (3, 1, "SOCKET_DISCONNECT", DAY + "11:00:00", {"ownedSlot": True}),
        (4, 1, "SOCKET_CONNECT", DAY + "11:30:00.000001", None),
        (5, 1, "SOCKET_DISCONNECT", DAY + "11:40:00", {"ownedSlot": False}),
        (6, 2, "SOCKET_DISCONNECT", DAY + "23:59:59", None),
        (7, 2, "SOCKET_CONNECT", DAY + "23:59:59", None),  # the greater id is last
        (8, None, "SOCKET_CONNECT", DAY + "10:00:00", None),
        (9, 3, "SOCKET_CONNECT", None, None),
    ]
    got = found(view(spark, rows))
    assert got == brute(rows)
    assert [(g[0], g[3], g[-1]) for g in got] == [(1, 3, True), (1, 1, False), (2, 2, False)]
    assert found(view(spark, rows).where("false")) == []


def test_sessions_across_cells_match_brute_force(spark):
    rng = random.Random(5)
    start, rows = at("2026-08-19T22:00:00"), []
    actions = ["SOCKET_CONNECT", "SOCKET_DISCONNECT", "MAP_CHANGE", "ITEM_BUY"]
    for account in range(4):
        time = start
        for _ in range(150):
            time += timedelta(minutes=rng.choice([0, 1, 5, 25, 30, 31, 61, 200]))
            detail = {"ownedSlot": rng.choice([True, False, None])}
            rows.append((len(rows), account, rng.choice(actions), time.isoformat(), detail))
    v = view(spark, rows)
    assert found(v) == brute(rows)
    assert found(v, gap_minutes=90) == brute(rows, timedelta(minutes=90))


def test_daily_figures(spark):
    rows = [
        (1, 1, "SOCKET_CONNECT", "2026-08-20T14:50:00", None),
        (2, 1, "SOCKET_DISCONNECT", "2026-08-20T15:10:00", None),  # 15:00 UTC is the next local day
        (3, 2, "SOCKET_CONNECT", "2026-08-20T10:00:00", None),
        (4, 2, "MAP_CHANGE", "2026-08-20T10:10:00", None),
    ]
    (day,) = connections.connection_daily(connections.connection_session(view(spark, rows))).collect()
    assert (str(day.d_kst), day.sessions, day.users, day.closed_sessions) == ("2026-08-20", 2, 2, 1)
    assert (day.mean_sec_per_user, day.length_median_sec) == (900.0, 900.0)


def attempts(account, hours):
    """Rows with the given number of attempts in each hour."""
    rows = []
    for hour, n in enumerate(hours):
        clock = at("2026-08-10T00:00:00") + timedelta(hours=hour)
        rows += [
            (len(rows) + account * 100_000, account, "POKEMON_CATCH_ATTEMPT",
             (clock + timedelta(seconds=s)).isoformat(), {"mapId": "s001", "wildUid": "w"})
            for s in range(n)
        ]
    return rows


def test_zscore_counts_empty_hours_as_zero(spark):
    steady = [2, 4] * 15 + [4]
    sudden = [3] + [0] * 29 + [40]
    rows = attempts(1, steady) + attempts(2, sudden)
    rows += [(9, None, "POKEMON_CATCH_ATTEMPT", "2026-08-11T06:00:00", {"wildUid": "w"})]
    found = recipes.attempt_zscore(
        view(spark, rows), "2026-08-12", baseline_hours=24, min_attempts=5, min_z=1
    ).collect()
    # The 24 hours before it have no attempt at all, so nothing to compare with.
    assert found == []
    found = recipes.attempt_zscore(
        view(spark, rows), "2026-08-12", baseline_hours=48, min_attempts=4, min_z=0.5
    ).collect()
    (hit,) = [r for r in found if r.account_id == 2]
    mean, sd = 3 / 30, (9 / 30 * 30 - 9 / 30) ** 0.5 / 29**0.5
    assert (hit.attempts, hit.hours, str(hit.hour_utc)) == (40, 30, "2026-08-11 06:00:00")
    assert hit["mean"] == 0.1 and abs(hit.sd - sd) < 1e-4 and abs(hit.z - (40 - mean) / sd) < 1e-3
    assert {(r.account_id, r.hours) for r in found if r.account_id == 1} >= {(1, 30)}
