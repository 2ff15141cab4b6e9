"""Merkle manifest, fill-in-middle and URL filters against plain versions."""

import hashlib
import re
import zlib
from collections import defaultdict
from urllib.parse import urljoin

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from logtally.llm import fim, merkle, queries, urls
from logtally.llm.queries import URL_RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- op 11 -----------------------------------------------------------------


def plain_leaf(*values):
    texts = [None if v is None else str(v) for v in values]
    return h("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def plain_tree(leaves):
    """Root, and the siblings (left, right) of each leaf from its run upward."""
    proofs = [[] for _ in leaves]
    level, under = list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, covers = [], []
        for start in range(0, len(level), 3):
            run = level[start : start + 3]
            for k in range(len(run)):
                for i in under[start + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h("".join(run)))
            covers.append([i for u in under[start : start + 3] for i in u])
        level, under = above, covers
    return level[0], proofs


def plain_manifest(rows):
    """Per row number: leaf, subroot, root, siblings."""
    groups = defaultdict(list)
    for number, r in enumerate(rows):
        leaf = plain_leaf(r[0], r[3], r[2], r[4], r[1])
        groups[r[3]].append(((r[0] is not None, r[0] or 0, leaf), number))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    out, subroots = {}, []
    for name in names:
        members = sorted(groups[name])
        subroot, proofs = plain_tree([key[2] for key, _ in members])
        subroots.append(subroot)
        for (key, number), proof in zip(members, proofs):
            out[number] = [key[2], subroot, proof, name]
    root, tops = plain_tree(subroots)
    where = {name: tops[i] for i, name in enumerate(names)}
    return {n: (leaf, sub, root, proof + where[g]) for n, (leaf, sub, proof, g) in out.items()}


def manifest(spark, rows, **more):
    docs = spark.createDataFrame(rows, DOCS)
    return merkle.manifest(spark, docs, FIELDS, **more).collect()


def as_found(rows):
    return sorted((r.leaf, r.subroot, r.root, str([tuple(s) for s in r.proof])) for r in rows)


def as_plain(rows):
    return sorted((a, b, c, str(p)) for a, b, c, p in plain_manifest(rows).values())


@pytest.mark.parametrize("sizes", [[1], [1, 1], [3, 4], [2, 27, 28], [243, 244, 1], [760, 5]])
def test_manifest_matches_plain_trees(spark, sizes):
    rows = [(1000 - i, f"t{g}\n{i}", "en", f"s{g}", i) for g, n in enumerate(sizes) for i in range(n)]
    assert as_found(manifest(spark, rows)) == as_plain(rows)


def test_manifest_of_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "x", "de", None, 3), (5, "", None, "", 0),
        (5, "", None, "", 0), (5, "é\n😀", "fr", "Ä", 2), (6, "x" * 70_000, "en", "Z", 70_000),
        (7, "a\nb", "en", "Z", 3), (-7, "a\nb", "en", "z", 3),
    ]
    got = manifest(spark, rows)
    assert len(got) == len(rows) and as_found(got) == as_plain(rows)


def test_manifest_of_more_blocks_than_one_block_holds(spark):
    n = 243 * 243 + 2
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    got = merkle.manifest(spark, docs, FIELDS)
    leaves = [plain_leaf(i, "s", "en", 1, "t") for i in range(n)]
    root, proofs = plain_tree(leaves)
    found = {r.doc_id: r for r in got.where("doc_id % 9999 = 0 OR doc_id > 59047").collect()}
    assert len(found) > 5 and got.count() == n
    for i, r in found.items():
        assert (r.leaf, r.root) == (leaves[i], root)
        assert [tuple(s) for s in r.proof] == proofs[i]


def test_manifest_of_an_empty_table(spark):
    assert manifest(spark, []) == []


def test_manifest_with_clashing_columns(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(5)]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("grp", "pos", "total", "digest", "data", "leaf", "root", "proof", "block", "at", "tie"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert as_found(merkle.manifest(spark, docs, FIELDS).collect()) == as_plain(rows)


def test_query_verifies_untampered_rows_only(spark, tmp_path):
    texts = ["one\ntwo", "one", None, "", "\n\n", "a\nb\nc"] * 30
    rows = [(i, t, "en", f"s{i % 4}", i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    expected = plain_manifest(rows)
    got = {r.doc_id: r for r in queries.op11_merkle(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        leaf, subroot, root, proof = expected[i]
        text, even = texts[i], zlib.crc32(str(i).encode()) % 2 == 0
        claimed = text.replace("\n", "") if text is not None and even else text
        fold = plain_leaf(i, f"s{i % 4}", "en", i, claimed)
        for left, right in proof:
            fold = h(left + fold + right)
        assert (r.leaf, r.subroot, r.root) == (leaf, subroot, root)
        assert r.proof_sha256 == h("".join(a + b for a, b in proof))
        assert r.folded_root == fold and r.verified == (claimed == text)


# --- op 12 -----------------------------------------------------------------


def plain_middle(doc_id, text, unit=r"[^\n]*\n|[^\n]+", spm_percent=50, fim_percent=100):
    text = text or ""
    units = re.findall(unit, text)
    seed = h("7:" + ("" if doc_id is None else str(doc_id)))
    draws = [int(seed[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(d % (len(units) + 1) for d in draws[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= fim_percent:
        return len(units), "plain", None, None, text
    if draws[3] % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [
    None, "", "\n", "\n\n\n", "one", "one\n", "a\nb", "é\n😀😀\nß", "<P>", "a <M> b\nc", "<", "<P\n>S><",
    "x" * 70_000, "line\n" * 20_000, "a b  c\td \r\n e", "\u2028\u0085\n\x0b\x0c",
]


def middles(spark, texts, **more):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = fim.transformed(docs, **more).withColumn("back", fim.restored(F.col("form"), F.col("output")))
    return {r.doc_id: r for r in found.collect()}


def test_middle_matches_plain_version(spark):
    random = np.random.default_rng(3)
    made = ["".join(random.choice(list("ab \né<PSM>"), 60)) for _ in range(200)]
    texts = ODD + made + ODD
    got = middles(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(i, t)
        assert r.back == (t or "")
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


def test_middle_of_other_units_and_shares(spark):
    texts = [t for t in ODD if t is None or len(t) < 1000] * 8
    got = middles(spark, texts, ends=fim.PIECES, fim_percent=70, spm_percent=20)
    unit = r"[^ \t\x0b\x0c\r\n]*[ \t\x0b\x0c\r\n]|[^ \t\x0b\x0c\r\n]+"
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(i, t, unit, 20, 70)
        assert r.back == (t or "")


def test_middle_with_null_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "a\nb"), (4, "a\nb"), (4, "a\nb")], "doc_id int, text string")
    for name in ("id", "h1", "output", "form"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = fim.transformed(docs).collect()
    assert [r.doc_id for r in got] == [None, 4, 4]
    assert [r.output for r in got] == [plain_middle(i, "a\nb")[4] for i in (None, 4, 4)]
    assert fim.transformed(docs.where("false")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=400))
def test_wavelet_ranks(codes):
    codes = np.array(codes, dtype=np.uint8)
    matrix = fim.Wavelet(codes, 3)
    places = np.arange(len(codes) + 1)
    for code in range(8):
        expected = np.concatenate([[0], np.cumsum(codes == code)])
        assert (matrix.rank(code, places) == expected).all()


# --- op 13 -----------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    query = re.match(r"[^?#]*(\?[^#]*)?", rest)[1] or ""
    return host, path, host + (path or "/") + query


def plain_rule(host, path, rules=URL_RULES):
    fits = [
        (len(r.host + r.path), len(r.host), r.verdict == "allow", r.host + r.path)
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits) if fits else None


def plain_verdicts(pages, links):
    """``links``: row number to the absolute addresses it names."""
    own = [plain_parts(u) for u in pages]
    names = defaultdict(set)  # address to rows
    linked = {plain_parts(t)[2] for found in links.values() for t in found}
    linked |= {own[i][2] for i in links} - {None}
    for i, found in links.items():
        for t in found:
            names[plain_parts(t)[2]].add(i)
    for i, (_, _, address) in enumerate(own):
        if address in linked:
            names[address].add(i)
    root = list(range(len(pages)))
    for _ in pages:
        for rows in names.values():
            least = min(root[i] for i in rows)
            for i in rows:
                root[i] = least
    bad = set()
    for i in range(len(pages)):
        concerned = [own[i], *[plain_parts(t) for t in links.get(i, [])]]
        if i in links or own[i][2] in linked:
            if any((best := plain_rule(a[0], a[1])) and not best[2] for a in concerned):
                bad.add(root[i])
    out = []
    for i, (host, path, _) in enumerate(own):
        best = plain_rule(host, path)
        verdict = ("allow" if best[2] else "block") if best else ("block" if root[i] in bad else "allow")
        out.append((host, path, best and best[3], verdict))
    return out


def canonical(target):
    return f'<html><head><LINK REL="x Canonical" data-a=1 href="{target}"></head></html>'


def refresh(target):
    return f"<meta content='3; URL={target}' http-equiv=Refresh>"


def judge(spark, pages):
    rows = [(i, u, html) for i, (u, html) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judged(spark, frame, URL_RULES).collect()}
    assert len(got) == len(pages)
    return [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(pages))]


def test_rules_without_links(spark):
    pages = [
        "http://a.NET/x", "https://net/", "http://net", "http://xnet/", "http://example.net/en/1",
        "http://sub.Example.net/en/", "http://example.net/en", "http://example.com/de/a?b#c",
        "http://example.com/DE/", "http://x.org/fr/", "http://org/fr/1", "http://x.org/fr?/", "no address",
        "://net/x", None, "", "ftp://u@h:1/p/q?x://y", "http://", "http://net:80/", "http://.net/", "a://b://net/",
    ]
    assert judge(spark, [(p, None) for p in pages]) == plain_verdicts(pages, {})


def test_longest_rule_wins_and_ties_allow(spark):
    rules = [
        urls.Rule("block", "a.com", "/x"), urls.Rule("allow", "b.a.com", "/"), urls.Rule("block", "b.a.com", "/xy"),
        urls.Rule("block", "com", "/same"), urls.Rule("allow", "com", "/same"),
    ]
    pages = ["http://b.a.com/x", "http://b.a.com/xyz", "http://c.a.com/x1", "http://d.com/same/1", "http://d.com/"]
    frame = spark.createDataFrame([(i, p, "") for i, p in enumerate(pages)], "page_id int, url string, html string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judged(spark, frame, rules).collect()}
    for i, p in enumerate(pages):
        best = plain_rule(*plain_parts(p)[:2], rules)
        assert got[i] == ((best[3], "allow" if best[2] else "block") if best else (None, "allow"))
    none = urls.judged(spark, frame, []).collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "allow")}


def test_blocks_reach_aliases_but_not_allowed_pages(spark):
    pages = [
        ("http://one.com/a", canonical("http://bad.net/x")),  # names a blocked address
        ("http://two.com/a", refresh("http://one.com/a#part")),  # redirects to the first
        ("https://three.com/", canonical("//TWO.com/a")),  # scheme of its own, same address
        ("http://four.com/p/q", canonical("../a")),  # its own /a
        ("http://four.com/a", ""),
        ("http://x.org/fr/1", canonical("http://one.com/a")),  # explicitly allowed
        ("http://five.com/", canonical("http://six.com/")),
        ("http://seven.com/", canonical("http://six.com/")),  # aliases, none blocked
        ("http://net/", canonical("http://eight.com/")),
        ("http://eight.com", ""),  # blocked page names it
        ("http://nine.com/?a=1", refresh("?a=2")),
        ("http://nine.com/?a=2", canonical("http://bad.net/")),
        ("http://ten.com/", "<!-- " + canonical("http://bad.net/") + " -->"),
        ("http://ten.com/", "<script>'" + canonical("http://bad.net/") + "'</script>"),
        ("http://ten.com/", '<base href="http://bad.net/"><link rel=canonical href="z">'),
        ("http://eleven.com/", canonical("http://bad.net/?a=1&amp;b=2")),
        ("http://twelve.com/", canonical("http://[bad/")),
        ("no address", canonical("http://one.com/a")),
        ("http://thirteen.com/", "x" * 70_000 + refresh("http://one.com/a")),
        (None, None),
    ]
    links = {
        0: ["http://bad.net/x"], 1: ["http://one.com/a"], 2: ["https://two.com/a"], 3: ["http://four.com/a"],
        5: ["http://one.com/a"], 6: ["http://six.com/"], 7: ["http://six.com/"], 8: ["http://eight.com/"],
        10: ["http://nine.com/?a=2"], 11: ["http://bad.net/"], 14: ["http://bad.net/z"],
        15: ["http://bad.net/?a=1&b=2"], 17: ["http://one.com/a"], 18: ["http://one.com/a"],
    }
    got = judge(spark, pages)
    assert got == plain_verdicts([p for p, _ in pages], links)
    verdicts = [v for *_, v in got]
    assert [i for i, v in enumerate(verdicts) if v == "block"] == [0, 1, 2, 8, 9, 10, 11, 12, 13, 14, 15, 17, 18]
    assert urljoin("http://four.com/p/q", "../a") == "http://four.com/a"


def test_many_pages_of_one_canonical_address(spark):
    pages = [(f"http://h{i}.com/{i}", canonical("http://hub.com/")) for i in range(300)]
    pages += [("http://hub.com/", refresh("http://bad.net/")), ("http://other.com/", "")]
    got = judge(spark, pages)
    assert [v for *_, v in got] == ["block"] * 301 + ["allow"]


def test_repeated_ids_clashing_columns_and_empty_tables(spark):
    rows = [(1, "http://a.com/", canonical("http://bad.net/")), (1, "http://b.com/", ""), (None, "http://net/", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("row", "id", "host", "path", "rule", "targets", "address", "alias"):
        frame = frame.withColumn(name, F.lit("clash"))
    got = sorted((str(r.page_id), r.host, r.verdict) for r in urls.judged(spark, frame, URL_RULES).collect())
    assert got == [("1", "a.com", "block"), ("1", "b.com", "allow"), ("None", "net", "block")]
    assert urls.judged(spark, frame.where("false"), URL_RULES).collect() == []
