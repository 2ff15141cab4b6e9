"""Main text of web pages by equivalence-class template deduction.

A page is a stream of tokens: tags by their path of open elements, and blocks
of text by path and content. A token's occurrence vector says how often it
stands on each page of its host. Tokens with equal vectors form an equivalence
class; vectors are compared by sums over pages of a page hash times the count,
so they come from one pre-aggregated grouping and no host's pages meet in one
task. A class is valid if it has at least ``CLASS_SIZE`` tokens (a tag counts
with its end, a block by its words), among them a tag, on at least ``SUPPORT``
pages; without a tag it must stand on over half of the host's pages, as shared
paths would make sentences that recur a template.

Valid classes are nested: the classes on most pages first, every one cuts the
pages into its instances, and what lies in an instance lies in one of its gaps.
A token's role is the token with the innermost gap around it and its rank in its
own class, so a token that stands in two places has two roles, and tokens out
of order have no common role. Roles are grouped again by gap and vector; the
blocks of all valid classes of roles are the template, whether on all pages or
some, once or several times a page. What it leaves over are slots, and their
text is extracted. Slots must vary: classes on half of the host's pages or fewer
stay where over ``REPEATED`` of the text left without the other classes recurs on
``SUPPORT`` pages, as this is an article that the host shows more than once.

Slots in elements that hold no article text (menus, page headers and footers,
sidebars, notices, adverts, forms, scripts, styles, comments of readers) are
left out by element, role and class name. A class name counts if it is one of
``_OUTSIDE_NAMES`` as a whole and the element does not hold the marked article.
If a page marks its article (article or main element, or a class that says so),
only slots inside count. Where all
text of a page would be template, as on a host of equal pages, nothing varies
and the deduction is not used for it.

Character references are decoded, white space inside a block (br included)
becomes one space, blocks are trimmed and joined by one newline in page order.
Null and empty pages give an empty text and are no pages of the host. A page without a host (null url) is
grouped with the others without one. Repeated rows are pages of their own.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from logtally.llm.shared import written
from logtally.llm.words import mix, parts

SUPPORT = 5  # pages
CLASS_SIZE = 3  # tokens
REPEATED = 0.9  # of a page's characters

# Element names of HTML, and names that sites give to such parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody tfoot thead tr ul".split()
)
OUTSIDE = frozenset(
    "head nav footer aside form menu dialog button select option fieldset audio video canvas".split()
) | RAW
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
# Whole class names or ids; "has-sidebar" or "comments-open" name no part.
_OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsored sponsors promo promos promotion banner "
    "cookie cookies consent notice notices notification notifications alert alerts sidebar side-bar comment "
    "comments disqus reply replies menu nav navbar navigation breadcrumb breadcrumbs footer masthead related "
    "recommended share sharing social subscribe newsletter popup modal widget widgets pagination pager tags login "
    "signup ad-slot ad-container ad-banner cookie-banner cookie-notice cookie-consent comment-list comments-area "
    "comments-section comment-body post-comments site-footer page-footer site-nav main-nav main-menu nav-menu "
    "site-menu sidebar-left sidebar-right left-sidebar right-sidebar related-posts related-articles share-buttons "
    "social-share social-links newsletter-signup".split()
)
_MAIN_NAMES = re.compile(r"(?:^|\s)(?:article|articlebody|main|post|entry|story|content)(?:[_-](?:body|content|text))?(?=$|\s)")
_P_ENDS = BLOCK - {"html", "body"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _names(attributes: str) -> tuple[str, str]:
    """Class and id in one text, and the role."""
    if "=" not in attributes:
        return "", ""
    found = {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(attributes)}
    return f"{found.get('class', '')} {found.get('id', '')}".strip().lower(), found.get("role", "").lower()


def parse(page: str) -> tuple[list[tuple[str, str, bool]], list[tuple[int, str]]]:
    """(path, text, inside a marked article) of each block; blocks before, and path, of each tag."""
    found: list[tuple[str, str, bool, tuple[int, ...]]] = []
    tags: list[tuple[int, str]] = []
    # name, path, outside, main, ancestors (numbered) whose class names say outside
    stack: list[tuple[str, str, bool, bool, tuple[int, ...]]] = [("", "", False, False, ())]
    wrappers: set[int] = set()  # those that hold or are an article
    free = False  # an article that none of them holds
    text: list[str] = []

    def flush() -> None:
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if block:
                found.append((stack[-1][1], block, stack[-1][3], stack[-1][4]))

    def close(k: int) -> None:
        del stack[k:]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        end = m.start() if m else size
        if end > at and not stack[-1][2]:
            text.append(page[at:end])
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in BLOCK or name in OUTSIDE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                text.append(" ")
            continue
        if name in RAW:
            if name == "svg" and m[3].endswith("/"):
                continue
            shut = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = shut.end() if shut else size
            continue
        if name in BLOCK or name in OUTSIDE:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # an open p ends where a block begins
                if stack[k][0] == "p" and name in _P_ENDS:
                    close(k)
                    break
                if stack[k][0] == name == "li" or (stack[k][0] == name == "tr"):
                    close(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        elif name in ("td", "th"):
            text.append(" ")
        _, path, outside, main, within = stack[-1]
        names, role = _names(m[3])
        article = name in ("article", "main") or role == "main"
        main = main or article or (name in ("div", "section") and bool(_MAIN_NAMES.search(names)))
        outside = (
            outside
            or name in OUTSIDE
            or (name == "header" and not stack[-1][3])
            or role in OUTSIDE_ROLES
        )
        if names and name not in ("html", "body") and not _OUTSIDE_NAMES.isdisjoint(names.split()):
            within = (*within, at)
        if article and not outside:
            free = free or (name == "article" and not within)
            wrappers.update(within)
        path = f"{path}/{name}.{names}" if name in BLOCK else path
        if name in BLOCK:
            tags.append((len(found), path))
        if not m[3].endswith("/") or name in BLOCK:
            stack.append((name, path, outside, main, within))
    flush()
    inside = [b for b in found if not b[3]]
    if wrappers and not free:  # the page's article lies in such an element, unless that holds the lesser part
        lifted = [b for b in found if wrappers.issuperset(b[3])]
        if sum(len(b[1]) for b in lifted if b[3] and b[2]) >= sum(len(b[1]) for b in inside if b[2]):
            inside = lifted
    stays = {id(b) for b in inside}
    before = np.concatenate([[0], np.cumsum([id(b) in stays for b in found], dtype=np.int64)]).tolist()
    return [b[:3] for b in inside], [(before[n], path) for n, path in tags]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def tokens(page: str) -> list[int]:
    """Tokens in page order; the last two bits are 0 for a tag, else words (3 for more)."""
    blocks, tags = parse(page)
    out = [(n, 0, _hash(path) & ~3) for n, path in tags]
    out += [(n, 1, _hash(f"{p}\n{t}") & ~3 | min(3, t.count(" ") + 1)) for n, (p, t, _) in enumerate(blocks)]
    return [token for *_, token in sorted(out, key=lambda t: t[:2])]


def _page_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches, "html"):
        found = [tokens(page) for page in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("host"), part.column("row"), pa.array(found, pa.list_(pa.int64()))],
            names=["host", "row", "tokens"],
        )


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums per host, token and gap: page hashes times counts, pages, occurrences."""
    for batch in batches:
        sums: dict[tuple, list[int]] = {}
        columns = [batch.column(c).to_pylist() for c in ("host", "row", "tokens", "gaps")]
        for host, row, page, gaps in zip(*columns, strict=True):
            once = Counter(zip(page, gaps or [0] * len(page), strict=True))
            once[0, 0] = 1  # every page has it: counts the host's pages
            one, two = row & 0x7FFFFFFF, (row >> 31) & 0x7FFFFFFF
            for token, n in once.items():
                v = sums.setdefault((host, *token), [0, 0, 0, 0])
                v[0] += one * n
                v[1] += two * n
                v[2] += 1
                v[3] += n
        columns = list(zip(*[(*k, *v) for k, v in sums.items()], strict=True)) or [[]] * 7
        kinds = [pa.string(), *[pa.int64()] * 6]
        names = ["host", "token", "gap", "s1", "s2", "pages", "total"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def roles(page: list[int], known: dict[int, tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Role and gap of each token of a page; ``known`` has class, pages and total of tokens in valid classes."""
    n = len(page)
    places: dict[tuple[int, int, int], list[int]] = {}
    for i, token in enumerate(page):
        if token in known:
            c, on, total = known[token]
            places.setdefault((-on, total, c), []).append(i)
    level, rank = np.full(n, len(places)), np.zeros(n, dtype=np.uint64)
    gap = np.zeros(n, dtype=np.uint64)
    order = sorted(places)  # on most pages, then least often, first
    for k, key in enumerate(order):
        level[places[key]] = k
    for k, key in enumerate(order):
        at = np.array(places[key])
        size = len({page[i] for i in at.tolist()})
        rank[at] = np.arange(len(at)) % size
        for a in range(0, len(at), size):
            here = at[a : a + size]
            first, last = (0, n) if k == 0 and len(at) == size else (here[0], here[-1])
            inner = np.flatnonzero(level[first:last] > k) + first
            if len(inner):
                number = np.searchsorted(here, inner).astype(np.uint64)
                gap[inner] = mix(number ^ mix(np.array([key[2]], dtype=np.int64).view(np.uint64))) >> np.uint64(1)
    token = np.array(page, dtype=np.int64).view(np.uint64)
    role = (mix(token ^ mix(gap + rank * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(1)) & ~np.uint64(3) | token & np.uint64(3)
    return role.view(np.int64).tolist(), gap.view(np.int64).tolist()


def _role_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for page, known in zip(batch.column("tokens").to_pylist(), batch.column("known").to_pylist(), strict=True):
            found.append(roles(page, {k["token"]: (k["class"], k["pages"], k["total"]) for k in known or ()}))
        lists_of = [pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("row"), *lists_of], names=["host", "row", "tokens", "gaps"]
        )


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches, "html"):
        texts = []
        columns = [part.column(c).to_pylist() for c in ("html", "fixed")]
        for page, fixed in zip(*columns, strict=True):
            some = [frozenset(f["place"] for f in fixed or () if f["most"] is most) for most in (True, False, None)]
            texts.append(extract(page or "", *some))
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), pa.array(texts, pa.string())], names=["row", "text"]
        )


def extract(
    page: str, most: frozenset[int], some: frozenset[int] = frozenset(), again: frozenset[int] = frozenset()
) -> str:
    """Text of the slots of one page; ``most`` and ``some`` have the numbers of its template blocks, those on
    over half of the host's pages and the others, ``again`` those of blocks that recur outside valid classes."""
    blocks = list(enumerate(parse(page)[0]))
    if any(main for _, (_, _, main) in blocks):
        blocks = [b for b in blocks if b[1][2]]
    slots = [b for b in blocks if b[0] not in most] or blocks
    vary = sum(len(b[1][1]) for b in slots if b[0] not in some and b[0] not in again)
    if vary > 0 and vary >= (1 - REPEATED) * sum(len(b[1][1]) for b in slots):
        slots = [b for b in slots if b[0] not in some]
    return "\n".join(text for _, (_, text, _) in slots)


def _valid(pages: DataFrame, name: str, spark: SparkSession) -> DataFrame:
    """(host, token, class, pages, total, most) of the tokens on SUPPORT pages; most is null outside valid classes."""
    kind = "host string, token long, gap long, s1 long, s2 long, pages long, total long"
    sums = written(
        spark,
        pages.mapInArrow(_sum_rows, kind)
        .groupBy("host", "token", "gap")
        .agg(*[F.sum(c).alias(c) for c in ("s1", "s2", "pages", "total")])
        .where(F.col("pages") >= SUPPORT),
        name,
    )
    key = ["host", "gap", "s1", "s2", "pages", "total"]
    bits = F.col("token").bitwiseAND(3)
    host_pages = sums.where("token = 0").select("host", F.col("pages").alias("n"))
    classes = (
        sums.where("token <> 0").groupBy(*key)
        .agg(F.sum(F.when(bits == 0, 2).otherwise(bits)).alias("size"), F.max(bits == 0).alias("tags"))
        .where(F.col("size") >= CLASS_SIZE)
        .join(host_pages, "host")
        .withColumn("most", 2 * F.col("pages") > F.col("n"))
        .where("tags OR most")
    )
    return sums.where("token <> 0").join(classes, key, "left").select(
        "host", "token", F.xxhash64("gap", "s1", "s2", "pages", "total").alias("class"), "pages", "total", "most"
    )


def templates(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(row, fixed): numbers of the recurring blocks of each page; most: template of most pages (true), of
    others (false) or none (null)."""
    parsed = written(
        spark,
        pages.where("html IS NOT NULL AND trim(html) <> ''")
        .mapInArrow(_page_rows, "host string, row long, tokens array<long>"),
        "pages",
    )
    first = _valid(parsed.withColumn("gaps", F.lit(None).cast("array<long>")), "tokens", spark)
    known = (
        parsed.select("host", "row", F.explode(F.array_distinct("tokens")).alias("token"))
        .join(first.where("most IS NOT NULL"), ["host", "token"])
        .groupBy("row").agg(F.collect_list(F.struct("token", "class", "pages", "total")).alias("known"))
    )
    nested = written(
        spark,
        parsed.join(known, "row", "left")
        .mapInArrow(_role_rows, "host string, row long, tokens array<long>, gaps array<long>"),
        "roles",
    )
    blocks = nested.select(
        "host", "row", F.posexplode(F.filter("tokens", lambda t: t.bitwiseAND(3) > 0)).alias("place", "token")
    )
    return (
        blocks.join(_valid(nested, "roles", spark).select("host", "token", "most"), ["host", "token"])
        .groupBy("row").agg(F.collect_list(F.struct("place", "most")).alias("fixed"))
    )


def main_text(
    spark: SparkSession, pages: DataFrame, url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``pages`` without the html column, plus ``text``."""
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    others = [c for c in pages.columns if c not in (html_col, "text")]
    rows = pages.select(
        F.struct(*others).alias("row"), F.col(html_col).alias("html"), host.alias("host"),
    )
    number = F.xxhash64("row", "html")
    fixed = templates(spark, rows.select("host", number.alias("row"), "html")).withColumnRenamed("row", "number")
    out = rows.withColumn("number", number).join(fixed, "number", "left").select("row", "html", "fixed").mapInArrow(
        _text_rows, rows.select("row").schema.add("text", "string")
    )
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in others], "text")
