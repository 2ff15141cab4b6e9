import datetime

import pytest
from pyspark.sql import functions as F

from helpers import audit, view
from logtally.functions import values
from logtally.operators import dimensions
from logtally.schema import POKEMON_FILE


def one(spark, text, expression):
    df = spark.createDataFrame([(text,)], "s string")
    return df.select(expression(F.col("s")).alias("r")).first().r


@pytest.mark.parametrize(
    "text, expected",
    [
        ("7", 7), ("3.7", 4), ("2.5", 3), ("-2.5", -3), ("2.49", 2), ("2.4999999", 2),
        ("1e3", 1000), (" 8 ", 8), ("", None), ("x", None), ("true", None),
        ("99999999999", None), (None, None),
    ],
)
def test_whole_numbers(spark, text, expected):
    assert one(spark, text, values.try_int) == expected


def test_bigint_keeps_all_digits(spark):
    assert one(spark, "123456789012345678", values.try_bigint) == 123456789012345678


@pytest.mark.parametrize(
    "text, expected", [("1.5", 1.5), ("1e-3", 0.001), ("1.5d", None), ("2f", None), ("", None)]
)
def test_doubles(spark, text, expected):
    assert one(spark, text, values.try_double) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("true", True), ("F", False), ("1", True), ("yes", True), ("2", None), (None, None)],
)
def test_booleans(spark, text, expected):
    assert one(spark, text, values.try_bool) is expected


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_wall_clock_ignores_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, expected in [
            ("2026-08-20T23:30:00.789+00:00", "2026-08-20 23:30:00.789000"),
            ("2026-08-20T23:30:00Z", "2026-08-20 23:30:00"),
            ("2026-08-21T08:30:00+09:00", "2026-08-20 23:30:00"),
            ("2026-08-20T23:30:00", "2026-08-20 23:30:00"),
            ("not a time", None),
        ]:
            got = one(spark, text, values.utc_wallclock)
            assert (None if got is None else str(got)) == expected
        v = view(spark, [(1, 1, "X", "2026-08-20T23:30:00", None)])
        assert v.select(values.kst_day().alias("d")).first().d == datetime.date(2026, 8, 21)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_binary_rounding(spark):
    assert one(spark, "1.005", lambda c: values.round_to(c.cast("double"), 2)) == 1.0
    assert one(spark, "-0.5", lambda c: values.round_to(c.cast("double"), 0)) == -1.0


def test_ratio_of_nothing_is_unknown(spark):
    assert one(spark, "0", lambda c: values.ratio(F.lit(1), c.cast("bigint"))) is None


def test_odd_payloads_give_null_not_errors(spark):
    odd = ["plain", ["a", 1], 5, True, None, {}, {"mapId": {"b": 1}, "level": "x", "body": "s"}]
    rows = [(i, 1, "X", "2026-08-20T00:00:00", d) for i, d in enumerate(odd)]
    got = {r.id: r for r in view(spark, rows).collect()}
    assert len(got) == len(odd)
    assert all(got[i].map_id is None for i in range(6))
    assert got[6].map_id == '{"b":1}' and got[6].level is None
    assert all(r.body_truncated is False and r.is_starter is False for r in got.values())
    assert got[4].detail is None


def test_json_null_detail_becomes_sql_null(spark):
    df = spark.range(1).select(F.parse_json(F.lit("null")).alias("detail"))
    assert df.select(values.null_if_json_null("detail").isNull().alias("n")).first().n


def test_view_masks_and_prefers(spark):
    rows = [
        (1, 1, "REQUEST_REJECTED", "2026-08-20T00:00:00", {"url": "/a?code=1?x", "method": "GET"}),
        (2, None, "LOGIN_FAILED", "2026-08-20T00:00:00",
         {"url": "/b", "body": {"username": "me", "_truncated": "2k"}}),
        (3, 1, "MAP_CHANGE", "2026-08-20T00:00:00", {"from": "a", "to": "b"}),
        (4, 1, "ITEM_SELL", "2026-08-20T00:00:00", {"totalGain": 5, "money": "9000000000"}),
        (5, 1, "SAFARI_BAIT", "2026-08-20T00:00:00", {"uid": "w", "result": "stay"}),
        (6, 1, "POKEMON_CATCH", "2026-08-20T00:00:00", {"pokedexId": "0058_hisui", "isShiny": "t"}),
    ]
    v = view(spark, rows)
    got = {r.id: r for r in v.collect()}
    assert got[1].req_url == "/a" and got[2].body_truncated
    assert got[3].map_id == "b" and got[3].map_from == "a"
    assert got[4].trade_amount == 5 and got[4].money_after == 9_000_000_000
    assert got[5].wild_uid == "w" and got[6].pokedex_id == "0058_hisui" and got[6].is_shiny
    assert not [c for c in v.columns if "username" in c or c == "ip"]
    assert len(v.columns) == 33


def dim_rows(spark, *pairs):
    blank = {f: None for f in POKEMON_FILE.names}
    rows = [tuple({**blank, **p}.values()) for p in pairs]
    return spark.createDataFrame(rows, POKEMON_FILE)


def test_dimension_keys(spark):
    dim = dimensions.pokemon_dim(
        dim_rows(
            spark,
            {"id": "1\r", "tier": "S\r\r", "type2": "\r", "rate_flee": "0.5\r"},
            {"id": "1025"}, {"id": "10255"}, {"id": "0003-mega", "base_exp": "n/a"},
        )
    )
    got = {r.pokedex_id: r for r in dim.collect()}
    assert sorted(got) == ["0001", "0003-mega", "1025", "10255"]
    assert got["0001"].tier == "S" and got["0001"].type2 is None
    assert got["0001"].rate_flee == 0.5 and got["0001"].pokedex_num == 1
    assert got["0003-mega"].pokedex_num is None and got["0003-mega"].base_exp is None


def test_orphans_only_against_a_delivered_dimension(spark):
    v = view(
        spark,
        [(i, 1, "POKEMON_CATCH", "2026-08-20T00:00:00", {"pokedexId": p})
         for i, p in enumerate(["0001", "9999", "9999", "0058_hisui"])],
    )
    full = dimensions.pokemon_dim(dim_rows(spark, {"id": "1"}, {"id": "0058_hisui"}))
    empty = dimensions.pokemon_dim(spark.createDataFrame([], POKEMON_FILE))
    found = dimensions.orphan_keys(v, full, "pokedex_id").collect()
    assert [r.pokedex_id for r in found] == ["9999", "9999"]
    assert dimensions.orphan_keys(v, empty, "pokedex_id").count() == 0


def test_audit_helper_has_the_stored_columns(spark):
    from logtally import schema

    assert audit(spark, [(1, 1, "X", None, None)]).columns == schema.AUDIT.names
