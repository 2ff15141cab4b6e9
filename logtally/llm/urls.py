"""URL filters: rules on hosts and paths, and block decisions of aliases.

A rule fits a host and all its subdomains where the path starts with the rule's
path; of several the longest text wins, then the longest host, then allow.
Candidates are the host's endings, each with the path cut to the lengths that
rules of this host have, so pages and rules meet in equality joins only,
however many rules there are.

Two addresses are the same thing if one redirects to the other (a refresh
element) or names it as canonical: a page's decision is its own rule's; a page
without a rule is blocked if its component of this relation has any address
that a rule blocks, and allowed otherwise. An explicit allow so takes
precedence over blocks that come from aliases. Components are found by
distributed star rounds over row numbers; an address that very many pages name
is one small row with the least of these pages, to which each of them points.

Addresses count as equal without scheme and fragment, hosts lower-cased, an
empty path as ``/``. Text without ``://`` is no address: such a page has an
empty host and path, and only absolute links. Links in comments, scripts, styles and other
raw text are none. Null urls and html count as empty. Rows with equal or null
ids are judged each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtally.llm.shared import components, written
from logtally.llm.words import parts

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# --- links of a page -------------------------------------------------------

_LIKELY = "(?i)canonical|refresh"
_ELEMENT = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(script|style|title|textarea)\b(?:.*?</\1\s*>|.*)"
    r"""|<(link|meta|base)\b((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_REFRESH = re.compile(r"""\s*[\d.]*\s*[;,\s]\s*(?:url\s*=\s*)?["']?([^"']+)""", re.I)


def targets(url: str, html: str) -> list[str]:
    """Absolute addresses that the page redirects to or calls canonical."""
    base, found = url, []
    for element in _ELEMENT.finditer(html):
        name = (element[2] or "").lower()
        if not name:
            continue
        values = {}
        for a in _ATTRIBUTE.finditer(element[3]):
            values.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
        if name == "base":
            base = _joined(url, values.get("href", "")) or base
        elif name == "link" and "canonical" in values.get("rel", "").lower().split():
            found.append(values.get("href", ""))
        elif name == "meta" and values.get("http-equiv", "").strip().lower() == "refresh":
            to = _REFRESH.match(values.get("content", ""))
            found.append(to[1] if to else "")
    joined = [_joined(base, t.strip()) for t in found if t.strip()]
    return sorted({t for t in joined if t})


def _joined(base: str, target: str) -> str | None:
    try:
        whole = urljoin(base, target)
    except ValueError:  # no address, so no link
        return None
    return whole if "://" in whole else None


def _with_targets(rows: DataFrame) -> DataFrame:
    """Rows (row, id, url, html) with their targets instead of the html."""
    kept = rows.drop("html")
    names = kept.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", targets array<string>"

    def links(part: pa.RecordBatch) -> pa.RecordBatch:
        likely = pc.match_substring_regex(part["html"], _LIKELY).to_pylist()
        found = [
            targets(part["url"][i].as_py(), part["html"][i].as_py()) if maybe else []
            for i, maybe in enumerate(likely)
        ]
        columns = [part[c] for c in names]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(found, pa.list_(pa.string()))], names=[*names, "targets"]
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, "html"):
            yield links(part)

    return rows.mapInArrow(each, schema)


# --- addresses and rules ----------------------------------------------------

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What two links to the same thing have in common; null for no address."""
    query = F.regexp_extract(_rest(url), "^[^?#]*(\\?[^#]*)?", 1)
    place = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    return F.concat(host(url), place, query)


def _endings(name: Column) -> Column:
    """The host and all hosts it is a subdomain of."""
    labels = F.split(name, "\\.", -1)
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")
    )


def ruled(places: DataFrame, rules: DataFrame, key: list[str]) -> DataFrame:
    """(key, rule, ruling) for those ``places`` (key, host, path) that a rule fits."""
    lengths = F.collect_set(F.char_length("path"))
    hosts = rules.groupBy("host").agg(lengths.alias("lengths"))
    rule = rules.select(
        "host", F.col("path").alias("start"), F.concat("host", "path").alias("rule"), "verdict"
    )
    starts = F.array_distinct(F.transform("lengths", lambda n: F.left(F.col("path"), n)))
    order = F.struct(
        F.char_length("rule").alias("length"),
        F.char_length("host").alias("host_length"),
        (F.col("verdict") == ALLOW).alias("allows"),
        F.col("rule").alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    return (
        places.select(*key, "path", F.explode(_endings(F.col("host"))).alias("host"))
        .join(hosts, "host")
        .select(*key, "host", F.explode(starts).alias("start"))
        .join(rule, ["host", "start"])
        .groupBy(*key)
        .agg(F.max(order).alias("best"))
        .select(*key, "best.rule", F.col("best.verdict").alias("ruling"))
    )


def judged(
    spark: SparkSession,
    pages: DataFrame,
    rules: list[Rule] | DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(id, url, host, path, rule, verdict, alias) per row of ``pages``.

    ``rules`` is a list or a DataFrame (verdict, host, path). ``rule`` is the
    page's own, null if none fits; ``alias`` is the least row number of its
    component, null for a page that no link concerns. Other columns are left
    out.
    """
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    read = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(url_col, F.lit("")).alias("url"),
        F.coalesce(html_col, F.lit("")).alias("html"),
    )
    found = written(spark, _with_targets(read), "urls")
    url = F.col("url")
    own = found.select(
        "row", "id", "url", host(url).alias("host"), path(url).alias("path"), address(url).alias("address")
    )
    result = own.join(ruled(own, rules, ["row"]), "row", "left")

    linked = found.where(F.size("targets") > 0).select("row", F.explode("targets").alias("url"))
    if linked.isEmpty():
        alias, blocked = F.lit(None).cast("long"), F.lit(False)
    else:
        aliases = written(spark, _aliases(spark, own, linked, rules), "url-aliases")
        result = result.join(aliases, "row", "left")
        alias, blocked = F.col("alias"), F.coalesce("blocked", F.lit(False))
    method = F.when(blocked, BLOCK).otherwise(ALLOW)
    return result.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        "host",
        "path",
        "rule",
        F.coalesce("ruling", method).alias("verdict"),
        alias.alias("alias"),
    )


def _aliases(spark: SparkSession, own: DataFrame, linked: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, alias, blocked) of every page that links concern."""
    to = F.col("url")
    far = linked.select("row", host(to).alias("host"), path(to).alias("path"), address(to).alias("address"))
    near = own.where("address IS NOT NULL").select("row", "host", "path", "address")
    # One row per (row, address). Pages that no link concerns never meet another.
    linking = near.join(far.select("row").distinct(), "row", "left_semi")
    named = far.select("address").unionByName(linking.select("address")).distinct()
    far_ends = far.select("row", "address").unionByName(
        near.join(named, "address", "left_semi").select("row", "address")
    )
    mentions = written(spark, far_ends.distinct(), "url-mentions")
    least = mentions.groupBy("address").agg(F.min("row").alias("b"), F.max("row").alias("last"))
    edges = mentions.join(least.where("b < last"), "address").select(F.col("row").alias("a"), "b")
    # A page that links to addresses no other page has is a component of its own.
    alone = far.select(F.col("row").alias("id"), F.col("row").alias("root"))
    parted = components(spark, edges)
    roots = parted.unionByName(
        alone.join(parted, "id", "left_anti").distinct()
    )
    held = written(spark, roots, "url-components")
    # Every address of a component counts: those of its pages and their targets.
    places = far.unionByName(near.join(held, near.row == held.id, "left_semi"))
    blocks = ruled(places, rules, ["row", "address"]).where(F.col("ruling") == BLOCK)
    bad = (
        held.join(blocks.select(F.col("row").alias("id")).distinct(), "id")
        .select("root")
        .distinct()
        .withColumn("blocked", F.lit(True))
    )
    return held.join(bad, "root", "left").select(
        F.col("id").alias("row"), F.col("root").alias("alias"), "blocked"
    )
