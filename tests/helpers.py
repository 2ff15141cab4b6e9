"""Literal audit rows, and archives of them."""

import gzip
import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from logtally.operators.audit_view import audit_v

TEXT = (
    "id bigint, account_id int, action string, status smallint, detail string,"
    " user_agent string, source string, created_at timestamp_ntz"
)


def audit(spark, rows):
    """Rows (id, account_id, action, created_at, detail) as fact rows."""
    full = [
        (i, a, act, None, None if d is None else json.dumps(d), "agent", "api", at(ts))
        for i, a, act, ts, d in rows
    ]
    text = spark.createDataFrame(full, TEXT)
    return text.withColumn("detail", F.parse_json("detail"))


def view(spark, rows):
    return audit_v(audit(spark, rows))


def at(text):
    return None if text is None else datetime.fromisoformat(text)


def line(i, action="CREATE_USER", account=1, created="2026-08-20T12:00:00+00:00", **more):
    record = {
        "id": i,
        "account_id": account,
        "action": action,
        "status": None,
        "detail": {},
        "ip": "192.0.2.1",
        "user_agent": "",
        "source": "api",
        "created_at": created,
    }
    return {**record, **more}


def ship(base, day, lines, name=None, tail=""):
    """Write one archive object; returns its path."""
    folder = Path(base) / "audit" / day.replace("-", "/")
    folder.mkdir(parents=True, exist_ok=True)
    top = max((r["id"] for r in lines), default=0)
    path = folder / (name or f"audit-{day}T0003Z-{top}.jsonl.gz")
    with gzip.open(path, "wt") as out:
        out.writelines(json.dumps(r) + "\n" for r in lines)
        out.write(tail)
    return path


def ids(df):
    return sorted(r.id for r in df.select("id").collect())
