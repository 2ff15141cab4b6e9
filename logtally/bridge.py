"""Audit rows and dimension files derived from the star-schema test tables.

The test tables have an ``events`` stream but no audit log. One SQL text, which
both Spark and the checking engine run, rewrites every event as an audit row
whose payload varies with the event; ``part`` becomes the creature dimension.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtally.sources import files
from logtally.sources.dims import Dims
from logtally.sources.store import Store

AS_OF = "2024-01-31 00:00:00"
OBJECT_ROWS = 1000  # of the one sampled object

SPARK_K = "CAST(get_json_object(props, '$.k') AS INT)"

AUDIT_ROWS = """
SELECT
  event_id + 1000000 AS id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS account_id,
  action,
  CASE WHEN action IN ('REQUEST_REJECTED', 'LOGIN_FAILED')
       THEN CAST(400 AS SMALLINT) END AS status,
  CASE action
    WHEN 'POKEMON_CATCH_ATTEMPT' THEN concat(
      '{{"mapId":"', mp, '","wildUid":"', wu, '","pokedexId":"', pk,
      '","level":', CAST(k AS VARCHAR(5)),
      ',"isShiny":', CASE WHEN k % 11 = 0 THEN 'true' ELSE 'false' END,
      ',"bait":', CASE WHEN k % 4 = 1 THEN 'true' ELSE 'false' END,
      ',"rock":', CASE WHEN k % 4 = 2 THEN 'true' ELSE 'false' END,
      ',"partyBonus":0.0', CAST(k % 8 AS VARCHAR(3)), '}}')
    WHEN 'POKEMON_CATCH_FAIL' THEN concat(
      '{{"mapId":"', mp, '","wildUid":"', wu, '","reason":',
      CASE WHEN k % 10 = 4 THEN 'null' WHEN k % 2 = 0 THEN '"flee"'
           ELSE '"break_out"' END,
      ',"fled":', CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, '}}')
    WHEN 'POKEMON_CATCH' THEN concat(
      '{{"mapId":"', mp, '","pokedexId":"', pk, '","level":"',
      CAST(k AS VARCHAR(5)), CASE WHEN k % 6 = 0 THEN '.5' ELSE '' END,
      '","isShiny":', CASE WHEN k % 11 = 0 THEN 'true' ELSE 'false' END,
      ',"isS000Starter":', CASE WHEN k % 4 = 0 THEN 'true' ELSE 'false' END, '}}')
    WHEN 'SAFARI_ENTER' THEN concat('{{"mapId":"', mp, '","ticketConsumed":true}}')
    WHEN 'SAFARI_EXIT' THEN concat('{{"mapId":"', mp, '","to":"p001"}}')
    WHEN 'SAFARI_BAIT' THEN concat(
      '{{"uid":"', wu, '","result":"',
      CASE WHEN k % 3 = 0 THEN 'flee' ELSE 'stay' END, '"}}')
    WHEN 'SAFARI_ROCK' THEN concat(
      '{{"uid":"', wu, '","result":"',
      CASE WHEN k % 3 = 0 THEN 'stay' ELSE 'flee' END, '"}}')
    WHEN 'SAFARI_TICKET_CLAIM' THEN concat(
      '{{"claimed":', CAST(k % 3 + 1 AS VARCHAR(3)), ',"quantity":3}}')
    WHEN 'POKEMON_SPAWN' THEN concat(
      '{{"count":', CAST(k % 7 AS VARCHAR(3)), ',"wilds":[{{"mapId":"', mp, '"}}]}}')
    WHEN 'ITEM_BUY' THEN concat(
      '{{"item":"', CASE WHEN k % 3 = 0 THEN 'safari-zone-ticket'
                         ELSE 'rare-candy' END,
      '","quantity":', CAST(k % 9 + 1 AS VARCHAR(3)),
      ',"totalCost":', CAST(cents AS VARCHAR(20)),
      CASE WHEN k % 20 = 0 THEN ''
           ELSE concat(',"money":', CAST(cents * 3 AS VARCHAR(20))) END, '}}')
    WHEN 'ITEM_SELL' THEN concat(
      '{{"item":"fire-stone","quantity":1,"totalGain":', CAST(cents AS VARCHAR(20)),
      ',"money":', CAST(cents * 5 AS VARCHAR(20)), '}}')
    WHEN 'MAP_CHANGE' THEN concat(
      '{{"from":"', mp, '","to":"s00', CAST(k % 3 AS VARCHAR(3)), '","x":1,"y":2}}')
    WHEN 'SOCKET_DISCONNECT' THEN concat('{{"ownedSlot":', CASE
      WHEN k % 3 = 0 THEN 'false' WHEN k % 3 = 1 THEN 'true' ELSE 'null' END, '}}')
    WHEN 'LOGIN_FAILED' THEN
      '{{"url":"/api/auth/login","method":"POST","errorCode":"FAILED_ACCOUNT","body":{{"username":"x@example.com"}}}}'
    WHEN 'REQUEST_REJECTED' THEN
      CASE WHEN k % 2 = 0
             THEN '{{"url":"/api/cb?code=S&state=a?b","method":"GET","errorCode":"E"}}'
           WHEN k % 5 = 0 THEN '{{"url":"/api/p","body":{{"_truncated":"xx"}}}}'
           WHEN k % 7 = 0 THEN '[1,2,3]'
           ELSE '"plain string detail"' END
    ELSE NULL END AS detail,
  CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN '' ELSE 'agent' END AS user_agent,
  CASE WHEN action IN ('MAP_CHANGE', 'SOCKET_CONNECT', 'SOCKET_DISCONNECT') THEN 'socket'
       WHEN action = 'POKEMON_SPAWN' THEN 'worker' ELSE 'api' END AS source,
  ts AS created_at
FROM (
  SELECT event_id, user_id, ts, k, cents,
    CASE
      WHEN event_type = 'click'                   THEN 'POKEMON_CATCH_ATTEMPT'
      WHEN event_type = 'error' AND k % 3 <> 0    THEN 'POKEMON_CATCH_FAIL'
      WHEN event_type = 'error'                   THEN 'REQUEST_REJECTED'
      WHEN event_type = 'view' AND k % 4 = 0      THEN 'SAFARI_ENTER'
      WHEN event_type = 'view' AND k % 4 = 1      THEN 'SAFARI_EXIT'
      WHEN event_type = 'view' AND k % 4 = 2      THEN 'SAFARI_BAIT'
      WHEN event_type = 'view'                    THEN 'SAFARI_ROCK'
      WHEN event_type = 'purchase' AND k % 10 = 9 THEN 'SAFARI_TICKET_CLAIM'
      WHEN event_type = 'purchase' AND k % 20 = 6 THEN 'POKEMON_SPAWN'
      WHEN event_type = 'purchase' AND k % 2 = 0  THEN 'ITEM_BUY'
      WHEN event_type = 'purchase'                THEN 'ITEM_SELL'
      WHEN k % 5 = 0 THEN 'CREATE_USER'
      WHEN k % 5 = 1 THEN 'POKEMON_CATCH'
      WHEN k % 5 = 2 THEN 'MAP_CHANGE'
      WHEN k % 5 = 3 AND k % 2 = 0 THEN 'LOGIN_OAUTH'
      WHEN k % 5 = 3 THEN 'SOCKET_CONNECT'
      WHEN k % 4 = 0 THEN 'SOCKET_DISCONNECT'
      ELSE 'LOGIN_FAILED' END AS action,
    concat('s00', CAST(k % 5 AS VARCHAR(3))) AS mp,
    concat('w', CAST(user_id AS VARCHAR(20)), '-', CAST(k % 3 AS VARCHAR(3))) AS wu,
    CASE WHEN k % 7 = 0
         THEN concat(lpad(CAST(k + 1 AS VARCHAR(5)), 4, '0'), '_alt')
         ELSE lpad(CAST(k + 1 AS VARCHAR(5)), 4, '0') END AS pk
  FROM (SELECT event_id, ts, user_id, event_type,
               CAST(floor(value * 100) AS BIGINT) AS cents, {k} AS k
        FROM {events}) e
) a
"""

# Every tenth part gets an id form that no event uses: those keys are orphans.
POKEMON_ROWS = """
SELECT
  CASE WHEN p_partkey % 10 = 0
         THEN concat(lpad(CAST(p_partkey AS VARCHAR(9)), 4, '0'), '-mega')
       WHEN (p_partkey - 1) % 7 = 0 AND p_partkey < 10000
         THEN concat(lpad(CAST(p_partkey AS VARCHAR(9)), 4, '0'), '_alt')
       ELSE CAST(p_partkey AS VARCHAR(9)) END AS id,
  concat(p_name, chr(13)) AS comment,
  p_type AS type1,
  CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END AS type2,
  concat(p_brand, chr(13)) AS tier,
  CAST(p_size % 9 + 1 AS VARCHAR(9)) AS generation,
  'medium' AS growth_group,
  CAST(p_size / CAST(100 AS DOUBLE) AS VARCHAR(20)) AS rate_capture,
  CASE WHEN p_size % 5 = 0 THEN 'none' ELSE concat('0.', CAST(p_size AS VARCHAR(9)), chr(13)) END AS rate_flee,
  CAST(p_size AS VARCHAR(9)) AS height_m,
  CAST(NULL AS VARCHAR(9)) AS weight_kg,
  CASE WHEN p_partkey = 5 THEN 'n/a' ELSE CAST(p_size AS VARCHAR(9)) END AS base_exp
FROM {part}
"""

ITEM_ROWS = """
SELECT
  concat('item-', CAST(p_partkey AS VARCHAR(9))) AS id,
  concat(p_name, chr(13)) AS comment,
  p_type AS category,
  p_brand AS tier,
  CASE WHEN p_size % 4 = 0 THEN '' ELSE CAST(p_size * 100 AS VARCHAR(9)) END AS buy,
  concat(CAST(p_size AS VARCHAR(9)), '.5', chr(13)) AS sell,
  CASE WHEN p_size % 3 = 0 THEN 'TRUE' WHEN p_size % 3 = 1 THEN 'FALSE' END AS purchasable,
  concat(CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'no' END, chr(13)) AS sellable
FROM {part}
"""


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table: all events as audit rows, ``detail`` as variant."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # ``spark.sql`` fills in {events} and undoes the doubled braces itself.
    text = spark.sql(AUDIT_ROWS.replace("{k}", SPARK_K), events=events)
    return text.withColumn("detail", F.parse_json("detail"))


def pokemon_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(POKEMON_ROWS, part=part)


def item_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(ITEM_ROWS, part=part)


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    version = spark.sql("SELECT 'v1' AS sha, TIMESTAMP_NTZ '2024-01-30 00:00:00' AS loaded_at")
    return Dims(pokemon_file(spark, sf_dir), item_file(spark, sf_dir), version)


def folder(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    """A shared folder of this application for data derived from ``sf_dir``."""
    name = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    return f"{files.shared_dir(spark)}/{purpose}/{spark.sparkContext.applicationId}/{name}"


def store(spark: SparkSession, sf_dir: str) -> Store:
    """The bridged tables as a loaded store in the shared folder.

    Written once per application, like the daily load; queries then read typed
    Parquet columns. Nothing but the given tables goes in.
    """
    loaded = Store(spark, folder(spark, sf_dir, "bridge"))
    if loaded.last_number() == 0:
        # One run with all parts: a failure leaves no store with rows but no dimensions.
        run = loaded.new_run("append")
        run.write_audit(audit(spark, sf_dir))
        for part, table in dims(spark, sf_dir)._asdict().items():
            run.write(part, table)
        run.commit()
    return loaded


def lines(rows: DataFrame, *others: Column) -> DataFrame:
    """Audit rows as the columns of an archive line, and ``others``."""
    return rows.select(
        "id",
        "account_id",
        "action",
        "status",
        "detail",
        F.lit("192.0.2.1").alias("ip"),
        "user_agent",
        "source",
        F.concat(
            F.translate(F.col("created_at").cast("string"), " ", "T"), F.lit("+00:00")
        ).alias("created_at"),
        *others,
    )


def export_object(spark: SparkSession, sf_dir: str, base: str, name: str) -> None:
    """Ship the newest bridged rows as one object, ``name`` under ``base``."""
    newest = audit(spark, sf_dir).orderBy(F.desc("created_at"), F.desc("id")).limit(OBJECT_ROWS)
    raw = f"{base}/shipped"
    lines(newest).coalesce(1).write.json(raw, compression="gzip", ignoreNullFields=False)
    part = next(n for n in files.children(spark, raw) if n.endswith(".json.gz"))
    files.rename(spark, f"{raw}/{part}", f"{base}/{name}")


def export_archive(
    spark: SparkSession, sf_dir: str, base: str, days_later: int, rows: DataFrame | None = None
) -> None:
    """Ship the bridged rows, or some, as gzip JSON-lines objects, one or more per day.

    The folder's day is the event's day moved by ``days_later``: an archive
    day is when rows were shipped.
    """
    rows = audit(spark, sf_dir) if rows is None else rows
    day = F.date_add(F.col("created_at").cast("date"), days_later)
    raw = f"{base}/shipped-{days_later}"
    # A day of many rows is dealt over several objects.
    lines(rows, day.alias("day")).hint("rebalance", "day").write.partitionBy("day").json(
        raw, compression="gzip", ignoreNullFields=False
    )
    for folder in files.children(spark, raw):
        if not folder.startswith("day="):
            continue
        shipped = folder.removeprefix("day=")
        target = f"{base}/audit/{shipped.replace('-', '/')}"
        for number, name in enumerate(files.children(spark, f"{raw}/{folder}")):
            files.rename(
                spark,
                f"{raw}/{folder}/{name}",
                f"{target}/audit-{shipped}T{days_later:04d}Z-{number}.jsonl.gz",
            )
