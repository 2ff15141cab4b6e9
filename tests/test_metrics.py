import datetime


from helpers import at, view
from logtally.operators import drilldown, metrics
from logtally.plans import recipes, series

DAY = "2026-08-20T"


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_attempts_pair_by_ordinal(spark):
    def attempt(i, clock, account=1, uid="w", **more):
        return (i, account, "POKEMON_CATCH_ATTEMPT", DAY + clock,
                {"mapId": "s001", "wildUid": uid, **more})

    def fail(i, clock, reason, uid="w"):
        return (i, 1, "POKEMON_CATCH_FAIL", DAY + clock, {"wildUid": uid, "reason": reason})

    v = view(
        spark,
        [
            attempt(1, "10:00:00"), fail(2, "10:00:01", "break_out"),
            attempt(3, "10:01:00"), fail(4, "10:01:01", None),
            attempt(5, "10:02:00"),
            attempt(6, "10:03:00", uid="x"), fail(7, "10:03:09", "odd", uid="x"),
            attempt(8, "10:04:00", account=None), attempt(9, "10:04:00", uid=None),
        ],
    )
    got = by_id(metrics.catch_attempt(v))
    assert sorted(got) == [1, 3, 5, 6]
    assert (got[1].outcome, got[1].outcome_inferred) == ("break_out", False)
    # A failure without a reason counts as caught but leaves its time.
    assert (got[3].outcome, got[3].outcome_inferred) == ("caught", True)
    assert got[3].failed_at == at(DAY + "10:01:01")
    assert (got[5].outcome, got[5].failed_at) == ("caught", None)
    assert got[6].outcome == "odd"


def test_only_the_next_event_closes_a_session(spark):
    def move(i, clock, what, place="s001", account=1):
        return (i, account, what, DAY + clock, {"mapId": place})

    v = view(
        spark,
        [
            move(1, "10:00:00", "SAFARI_ENTER"),
            move(2, "10:10:00", "SAFARI_ENTER"),
            move(3, "10:15:00", "SAFARI_EXIT", "s002"),
            move(4, "10:20:00", "SAFARI_ENTER"),
            move(5, "10:21:00", "SAFARI_EXIT", "s000"),
            move(6, "10:30:00", "SAFARI_ENTER", account=None),
        ],
    )
    got = sorted(metrics.safari_session(v).collect(), key=lambda r: r.entered_at)
    assert [(r.closed, r.dwell_sec, r.exit_map) for r in got] == [
        (False, None, None), (True, 300.0, "s002"), (False, None, None),
    ]


def test_session_over_local_midnight_and_tutorial(spark):
    v = view(
        spark,
        [
            (1, 11, "SAFARI_ENTER", DAY + "14:55:00", {"mapId": "s001"}),
            (2, 11, "SAFARI_EXIT", DAY + "15:10:00", {"mapId": "s002"}),
            (3, 12, "SAFARI_ENTER", DAY + "14:56:00", {"mapId": "s001"}),
            (4, 99, "SAFARI_EXIT", DAY + "15:10:00", {"mapId": "s000"}),
            (5, 13, "POKEMON_CATCH_ATTEMPT", DAY + "00:00:00",
             {"mapId": "s001", "wildUid": "a", "bait": True}),
            (6, 13, "POKEMON_CATCH_FAIL", DAY + "00:00:01",
             {"mapId": "s001", "wildUid": "a", "reason": "break_out"}),
            (7, 14, "POKEMON_CATCH_ATTEMPT", DAY + "00:00:00",
             {"mapId": "s000", "wildUid": "t"}),
        ],
    )
    source = drilldown.rollups(v)
    out = {k: f.collect() for k, f in series.all_series(source).items()}
    session, catch = out["safari_session"][0], out["catch_rate"][0]
    assert (session.sessions, session.dwell_median_min, session.unclosed_rate) == (2, 15.0, 0.5)
    assert (catch.attempts, catch.catch_rate) == (1, 0.0)
    counts = drilldown.drill_counts(source)
    preview = {
        (r.metric, r.category): (r.account_id, r["count"])
        for r in drilldown.drill_preview(counts).collect() if r.rank == 1
    }
    assert preview["safari_session", "completed"] == (11, 1)
    assert preview["catch_rate", "all"] == (13, 1)
    assert ("catch_rate", "caught") not in preview and ("catch_rate", "plain") not in preview
    totals = {
        (r.metric, r.category): r.total_users for r in drilldown.drill_totals(counts).collect()
    }
    assert totals["safari_session", "all"] == 2 and totals["catch_rate", "broke_out"] == 1


def test_balance_series(spark):
    def trade(i, clock, account, action, money, **more):
        return (i, account, action, DAY + clock, {"money": money, **more})

    v = view(
        spark,
        [
            trade(1, "10:00:00", 1, "ITEM_BUY", 900, totalCost=100),
            trade(2, "10:00:30", 1, "ITEM_SELL", 950, totalGain=50),
            trade(3, "10:01:00", 1, "ITEM_BUY", None, totalCost=1),
            trade(4, "10:02:00", 1, "ITEM_BUY", 5_000_900, totalCost=50),
            trade(5, "10:00:00", None, "ITEM_SELL", 10, totalGain=1),
            trade(6, "10:00:09", None, "ITEM_SELL", 11, totalGain=1),
        ],
    )
    got = by_id(metrics.money_series(v))
    assert sorted(got) == [1, 2, 4, 5, 6]
    assert (got[2].money_before, got[2].money_delta, got[2].secs_since_prev) == (900, 50, 30.0)
    assert got[1].money_before is None and got[6].money_delta == 1  # no account is a group
    jump = recipes.money_unexplained(metrics.money_series(v), "2026-08-25 00:00:00").collect()
    assert [(r.account_id, r.unexplained) for r in jump] == [(1, 5_000_000)]
    day = metrics.economy_daily(v).first()
    assert (day.faucet, day.sink, day.n_sell, day.n_buy, day.traders) == (52, 151, 3, 3, 1)


def test_spine_fills_counts_not_rates_and_keeps_90_days(spark):
    rows = [
        (1, 1, "POKEMON_CATCH_ATTEMPT", "2026-01-01T00:00:00", {"mapId": "s001", "wildUid": "a"}),
        (2, 1, "POKEMON_CATCH_ATTEMPT", "2026-05-01T00:00:00", {"mapId": "s001", "wildUid": "a"}),
        (3, 1, "POKEMON_CATCH_ATTEMPT", "2026-05-03T00:00:00", {"mapId": "s001", "wildUid": "a"}),
        (4, 1, "POKEMON_CATCH_ATTEMPT", None, {"mapId": "s001", "wildUid": "a"}),
    ]
    got = series.to_series(metrics.catch_rate_daily(view(spark, rows)), "catch_rate").collect()
    assert [r.d for r in got] == [
        datetime.date(2026, 5, 3) - datetime.timedelta(days=n) for n in range(89, -1, -1)
    ]
    assert [(r.attempts, r.catch_rate) for r in got[-3:]] == [(1, 1.0), (0, None), (1, 1.0)]
    assert got[0].attempts == 0 and got[0].catch_rate is None


def test_empty_input_gives_empty_series(spark):
    v = view(spark, [(1, 1, "X", "2026-01-01T00:00:00", None)]).where("false")
    source = drilldown.rollups(v)
    out = series.all_series(source)
    assert all(f.count() == 0 for f in out.values())
    assert drilldown.drill_counts(source).count() == 0
    summary = series.period_summary(out, 7).first()
    assert summary.mean_dau is None and summary.catch_rate is None
    assert series.period_notes(out, 30).first().gap_flag is False


def test_drilldown_of_many_users_and_no_account(spark):
    rows = [(i, 700 + i, "CREATE_USER", DAY + "01:00:00", {}) for i in range(125)]
    rows.append((900, None, "SAFARI_BAIT", DAY + "01:00:00", {"result": "stay"}))
    v = view(spark, rows)
    counts = drilldown.drill_counts(drilldown.rollups(v)).cache()
    totals = {
        (r.metric, r.category): (r.total_users, r.unidentified_records)
        for r in drilldown.drill_totals(counts).collect()
    }
    assert totals["dau", "new"] == totals["dau", "active"] == (125, 0)
    assert totals["bait_rock", "bait"] == (0, 1)
    day = datetime.date(2026, 8, 20)
    pages = [
        [r.account_id for r in drilldown.drill_page(counts, "dau", "new", day, page=p).collect()]
        for p in range(4)
    ]
    assert [len(p) for p in pages] == [50, 50, 25, 0]
    assert pages[0] + pages[1] + pages[2] == list(range(700, 825))
    found = drilldown.drill_page(counts, "dau", "new", day, " 80 ").collect()
    assert [r.account_id for r in found] == [780, *range(800, 810)]
    counts.unpersist()


def test_tickets_are_counted_in_pieces(spark):
    def row(i, action, account=1, **detail):
        return (i, account, action, DAY + "01:00:00", detail)

    v = view(
        spark,
        [
            row(1, "SAFARI_TICKET_CLAIM", claimed=3, quantity=9),
            *[row(10 + i, "SAFARI_ENTER") for i in range(3)],
            row(20, "ITEM_BUY", account=2, item="safari-zone-ticket", quantity=2),
            *[row(30 + i, "SAFARI_ENTER", account=2) for i in range(4)],
        ],
    )
    got = recipes.ticket_ledger(v, "2026-08-25 00:00:00").collect()
    assert [(r.account_id, r.enters, r.acquired, r.deficit) for r in got] == [(2, 4, 2, 2)]


def test_even_steps_look_like_a_bot(spark):
    def events(account, steps, first):
        now, rows = at(DAY + "00:00:00"), []
        for i, step in enumerate(steps):
            now += datetime.timedelta(seconds=step)
            rows.append((first + i, account, "X", now.isoformat(), None))
        return rows

    v = view(
        spark,
        events(1, [5] * 40, 0) + events(2, [1, 9] * 20, 100) + events(3, [5] * 9, 200)
        + events(4, [0.05] * 40 + [400] * 40, 300),
    )
    got = recipes.bot_screen(
        v, "2026-08-21 00:00:00", min_events=30
    ).collect()
    assert [(r.account_id, r.n, r.median_s, r.sd_s) for r in got] == [
        (1, 39, 5.0, 0.0), (2, 39, 9.0, 4.05),
    ]


def test_freshness(spark):
    log = spark.createDataFrame([(at(DAY + "00:00:00"),)], "run_at timestamp_ntz")
    assert not series.freshness(log, "2026-08-21 12:00:00").first().stale
    assert series.freshness(log, "2026-08-21 12:00:01").first().stale
    assert series.freshness(log.where("false"), "2026-08-21 12:00:01").first().stale
