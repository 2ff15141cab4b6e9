"""The llm operators against brute force, round trips and held-out accuracy."""

import html as html_lib
import math
import pathlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pyspark.sql.classic.dataframe import DataFrame

from logtally.llm import caps, chunks, coder, minhash, mixing, packing, pieces, quality, template, tokens, winnow
from logtally.llm.queries import table, vocabulary
from logtally.llm.shared import components
from logtally.sources import files

SMALL = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(4000)]
ODD = [None, "", " ", "one", "a  b \n c", "É é\tß 😀 ▁", "x" * 70_000, "tie " * 300]
DOCS = "doc_id long, text string, lang string, score double"


def docs_of(spark, texts, start=0):
    rows = [(start + i, t, "en", 0.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def random_texts(n, size=120, seed=0):
    random = np.random.default_rng(seed)
    return [" ".join(random.choice(WORDS, size)) for _ in range(n)]


def edited(text, n, seed):
    random, words = np.random.default_rng(seed), text.split()
    for i in random.choice(len(words), n, replace=False):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = dict(components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_a_round_of_components_is_one_job(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 5)], "a long, b long")
    rounds = []
    real = DataFrame.agg  # the old rounds counted their links by an aggregate of the written table
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrame, "agg", lambda self, *c: rounds.append(c) or real(self, *c))
        assert dict(components(spark, edges).collect()) == {1: 1, 2: 1, 3: 1}
    assert not rounds
    assert components(spark, edges.where("a = 5")).collect() == []  # no link at all


def test_a_round_of_components_takes_three_shuffles(spark, monkeypatch):
    shuffles, real = [], DataFrame.checkpoint

    def seen(df, *rest):
        shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return real(df, *rest)

    monkeypatch.setattr(DataFrame, "checkpoint", seen)
    random = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 400, (260, 2))] + [(500, i) for i in range(450, 500)]
    got = components(spark, spark.createDataFrame(edges * 2, "a long, b long")).collect()
    root = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert sorted(map(tuple, got)) == sorted(root.items())  # each vertex once
    # The large star's two and the small star's one, which both of its sides name.
    assert len(shuffles) > 2 and shuffles[0] == 0 and max(shuffles) <= 6


def test_minhash_matches_all_pairs(spark):
    base = random_texts(3)
    crowd = [edited(base[0], 1 + s % 5, s) for s in range(60)]
    texts = [*base, *crowd, base[1], base[1].upper(), "one two", "One  two", *ODD]
    got = {r.doc_id: r for r in minhash.near_duplicates(spark, docs_of(spark, texts)).collect()}
    sets = []
    for t in texts:
        w = word_list(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    assert [got[i].component_id for i in range(len(texts))] == root
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_block_links_span_components():
    items = [[1, 2, 3, 4], [1, 2, 3, 4, 5], [7, 8, 9], [1, 2, 3, 4, 6]]
    rows = {"id": [1, 2, 3, 4], "root": [1, 2, 3, 4], "first": [True] * 4, "items": items}
    links = minhash._block_links(pa.table(rows)).to_pylist()
    assert {(r["a"], r["b"]) for r in links} == {(1, 2), (1, 4)}


def test_sketch_fills_every_bin():
    sketch = minhash.sketches([np.array([5], np.uint64), np.arange(1000, dtype=np.uint64), np.zeros(0, np.uint64)])
    assert (sketch[:2] != minhash._FULL).all() and (sketch[2] == minhash._FULL).all()


def test_repeated_passage_stays_once(spark):
    texts, passage = random_texts(12, 200, 1), " ".join(random_texts(1, 80, 2))
    for i in (2, 5, 9):
        texts[i] = f"{texts[i][:100]} {passage} {texts[i][100:]}"
    frame = docs_of(spark, [*texts, *ODD])
    got = {r.doc_id: r.text for r in chunks.remove_repeats(spark, frame).collect()}
    middle = " ".join(passage.split()[25:55])
    assert [i for i in range(12) if middle in got[i]] == [2]
    assert all(got[i] == t for i, t in enumerate([*texts, *ODD]) if i not in (5, 9))


def test_passages_are_cut_at_their_ends(spark):
    """Passages of 51 words, plain and of short periods, go whole; those of 50 stay."""
    random = np.random.default_rng(4)
    passages = [" ".join(random.choice(WORDS, 51)) for _ in range(60)]
    passages += [" ".join((random.choice(WORDS, period).tolist() * 51)[:51]) for period in range(1, 13) for _ in range(5)]
    around = [random_texts(3, 30, 100 + i) for i in range(len(passages))]
    first = [f"{a[0]} p{i}x {p} p{i}y {a[1]}" for i, (a, p) in enumerate(zip(around, passages))]
    second = [f"{a[2]} q{i}x {p} q{i}y {a[0]}" for i, (a, p) in enumerate(zip(around, passages))]
    short = [f"{a[1]} r{i}x {p.rsplit(' ', 1)[0]} r{i}y {a[2]}" for i, (a, p) in enumerate(zip(around, passages))]
    rows = chunks.remove_repeats(spark, docs_of(spark, [*first, *second, *short])).collect()
    got = {r.doc_id: r.text for r in rows}
    gone = [t.replace(f"{p} ", "") for t, p in zip(second, passages)]
    assert got == dict(enumerate([*first, *gone, *short]))


def test_chunks_resist_insertions():
    data = random_texts(1, 3000, 3)[0].encode()
    one, two = (np.frombuffer(d, np.uint8) for d in (data, b"inserted words " + data))
    a, b = (set(chunks.digests(d, chunks.ends(d)).tolist()) for d in (one, two))
    assert len(a & b) >= 0.97 * len(a)


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    got = quality.classify(spark, docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    odd = quality.classify(spark, docs_of(spark, ODD), labels.where("false")).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert quality.accepted(spark, docs_of(spark, ODD), labels).columns == ["doc_id", "text", "lang", "score"]


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece(seed):
    random = np.random.default_rng(seed)
    lengths = np.minimum(random.lognormal(6, 1.2, 3000).astype(int) + 1, 4096)
    count = np.bincount(lengths, minlength=4097)
    got, used = np.zeros(4097, int), 0
    for config, times in packing.plan(count):
        assert sum(v * c for v, c in config) <= 4096
        for v, c in config:
            got[v] += c * times
        used += times
    assert (got == count).all()
    assert used <= math.ceil(lengths.sum() / 4096) * 1.01 + 1
    assert packing.plan(np.zeros(4097, int)) == []


def test_packing_is_gapless(spark):
    docs = docs_of(spark, [*random_texts(40, 300, 5), *ODD, random_texts(1, 9000, 6)[0]])
    rows = packing.pack_documents(spark, docs, vocabulary("word_bpe_49k.json")).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert {r.doc_id for r in rows} == set(range(49))


def test_the_end_of_a_text_is_learned(spark):
    texts = [*random_texts(200, 3, 11), *[""] * 20]
    found = mixing.score(spark, docs_of(spark, texts)).where("held_out").collect()
    empty = [r.score for r in found if r.n_tokens == 1]
    assert empty and min(empty) > -4  # the text's class alone costs log10(16)
    words, which, place = mixing.word_bytes([b"ab", b"", b"c"])
    assert words.tobytes() == b"ab \nc " and which.tolist() == [0, 0, 0, 1, 2, 2] and place.tolist() == [0, 1, 2, 0, 0, 1]
    assert len(mixing.word_bytes([])[0]) == 0


def test_words_are_scored_in_their_order(spark):
    random = np.random.default_rng(3)
    lead = {w: random.choice(WORDS[:200], 2) for w in WORDS[:200]}  # two words may follow each
    texts = []
    for _ in range(300):
        words = ["w0"]
        while len(words) < 60:
            words.append(str(random.choice(lead[words[-1]])))
        texts.append(" ".join(words))
    shuffled = [" ".join(random.permutation(t.split())) for t in texts]
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 == 2]
    out = [j for j in range(1000, 4000) if zlib.crc32(str(j).encode()) % 7 == 2][: len(held)]
    rows = [*enumerate(texts), *((j, shuffled[i]) for i, j in zip(held, out))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in mixing.score(spark, frame.repartition(3)).collect()}
    assert all(got[i].score > got[j].score for i, j in zip(held, out))
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)
    again = {r.doc_id: r.score for r in mixing.score(spark, frame.coalesce(1)).collect()}
    assert all(again[i] == pytest.approx(got[i].score) for i in again)  # however the rows lie in files


def held(configs):
    found = np.zeros(packing.CAPACITY + 1, dtype=np.int64)
    for config, times in configs:
        assert sum(length * c for length, c in config) <= packing.CAPACITY
        for length, c in config:
            found[length] += c * times
    return found


def test_program_packs_what_best_fit_does_not():
    count = np.zeros(packing.CAPACITY + 1, dtype=np.int64)
    for length, n in {2053: 600, 1034: 600, 1029: 600, 1014: 1200}.items():  # just over a half and a quarter
        count[length] = n
    packed, program, bound = packing.solve(count)
    assert (held(packed) == count).all()
    assert sum(times for _, times in packed) == program == bound == 900
    assert sum(times for _, times in packing.best_fit(count, packing.CAPACITY)) == 1100


@pytest.mark.parametrize("times", [1, 100])
def test_program_meets_its_bound(times):
    random = np.random.default_rng(3)
    lengths = np.minimum(np.exp(random.normal(6.4, 1.0, 2000)).astype(int) + 1, packing.CAPACITY)
    count = np.bincount(lengths, minlength=packing.CAPACITY + 1) * times
    packed, program, bound = packing.solve(count)
    assert (held(packed) == count).all()
    total = sum(n for _, n in packed)
    assert total <= bound + 1 and program >= 0.95 * (total - count[packing.CAPACITY])


def test_pieces_equal_the_library_cut_at_capacity(spark):
    import zlib

    from tokenizers import Tokenizer

    texts = [*random_texts(6, 200, 7), *ODD, random_texts(1, 9000, 8)[0]]
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    expected = {}
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, a in enumerate(range(0, len(ids), packing.CAPACITY)):
            some = ids[a : a + packing.CAPACITY]
            expected[i, piece] = (a, len(some), zlib.crc32(np.array(some, dtype="<u4").tobytes()))
    rows = packing.pack_documents(spark, docs_of(spark, texts), vocabulary("word_bpe_49k.json")).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)


@pytest.mark.parametrize("name,keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_library(name, keep):
    from tokenizers import Tokenizer

    texts = [*ODD, "x \n y", "a \n", "it's, can't.’s", "a.̧b,c.. d", "<|endoftext|> 12", *random_texts(5)]
    texts += ["a<|endoftext|>b <|startoftext|>", "x <|endoftext|> y", "a\x1cb \x1f", "a\u00a0b\u2003c\u2028d\x85e\x0bf\r\n"]
    library = Tokenizer.from_file(vocabulary(name))
    ids, offs = tokens.Encoder(vocabulary(name), keep).encode(texts, 2)
    for t, a, b in zip(texts, offs[:-1], offs[1:]):
        assert ids[a:b].tolist() == [*library.encode(t or "", add_special_tokens=False).ids, 2]


def test_pieces_equal_the_library_and_read_back():
    from sentencepiece import SentencePieceProcessor

    path = vocabulary("piece_bpe_32k.model")
    library, m = SentencePieceProcessor(model_file=path), pieces.model(path)
    texts = [*ODD[:6], "y" * 400, "a  b   ", "antidisestablishmentarianism 한국어", *random_texts(3)]
    ids, offs = pieces.PieceEncoder(path, True).encode(texts, None)
    for t, a, b in zip(texts, offs[:-1], offs[1:]):
        assert ids[a:b].tolist() == library.encode(t or "")
        assert pieces.decode(ids[a:b], m) == (t or "").replace("▁", " ")


def test_counts_of_a_small_partition_are_small():
    texts = random_texts(20, 200, 3)
    shared = type("Held", (), {"value": mixing.Code(np.zeros(0, np.int64), np.zeros(0, np.int64), 20, 4020)})
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    rows = list(mixing._count_rows(shared, 12, iter([batch])))
    assert sum(r.nbytes for r in rows) < 60 * sum(map(len, texts))  # it was 42 MB at least
    assert max(r.nbytes for r in rows) < 16 * mixing.ROW_ITEMS
    states = {(r["order"], r["block"]): r["states"] for b in mixing._table_rows(shared, 12, iter(rows)) for r in b.to_pylist()}
    assert all(len(s) == 2 * mixing._SLOTS >> mixing.BLOCK_BITS for (k, _), s in states.items() if k >= len(mixing.CONTEXTS))
    seen = sum(int((np.frombuffer(s, np.uint16) > 0).sum()) for (k, _), s in states.items() if k >= len(mixing.CONTEXTS))
    data = mixing.Tokens(mixing.Words(batch.column("text")), shared.value, 12).spell()
    slots = data.byte_base[:, :, None] ^ mixing._NODE_OF[data.data]
    assert seen == sum(len(np.unique(s)) for s in slots)


def test_pieces_that_are_all_known():
    encoder = pieces.PieceEncoder(vocabulary("piece_bpe_32k.model"), True)
    first, again = (encoder.encode(["a few words", None], None) for _ in range(2))
    assert first[0].tolist() == again[0].tolist() and first[1].tolist() == again[1].tolist()


def test_blocks_round_trip_and_checks():
    random = np.random.default_rng(0)
    for ids in ([], [65535], [0] * 9000, random.integers(0, 50257, 5000), random.zipf(1.3, 9000).clip(0, 60000)):
        lengths, checks, coded = coder.write_blocks(np.array(ids, np.uint32))
        assert coder.read_blocks(lengths, checks, coded).tolist() == list(ids)
    with pytest.raises(ValueError):
        coder.read_blocks(lengths, [c ^ 1 for c in checks], coded)


def test_blocks_learn_from_each_other():
    random = np.random.default_rng(1)
    block = random.integers(0, 50257, coder.BLOCK).astype(np.uint32)
    coded = coder.write_blocks(np.concatenate([np.roll(block, 25 * i) for i in range(40)]))[2]
    assert sum(map(len, coded)) < 40 * coder.BLOCK  # afresh in each block: over 2 bytes an id


def test_cuts_of_odd_characters_change_no_ids():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library, random = Tokenizer.from_file(path), np.random.default_rng(2)
    odd = [*" \n\t\r'’.,aszZ19é×÷ŉſẞ漢字\u00a0\u3000\u2003\u0301\u200b\x1c\x85\x00", "  ", "'s", "'ll", "<|endoftext|>", "the", " word", "😀"]
    texts = ["".join(random.choice(odd, random.integers(0, 14))) for _ in range(4000)]
    plain = [c for c in odd if c.isascii() and c not in ("\x1c", "\x85")]
    texts += ["".join(random.choice(plain, random.integers(0, 14))) for _ in range(4000)]
    encoder = tokens.Encoder(path, True)
    for some in (texts[:3000], texts[2000:], texts[:1]):
        ids, offs = encoder.encode(some, 2)
        for t, a, b in zip(some, offs[:-1], offs[1:]):
            assert ids[a:b].tolist() == [*library.encode(t, add_special_tokens=False).ids, 2], repr(t)


def test_byte_vocabulary_encodes_each_word_once():
    encoder = tokens.Encoder(vocabulary("byte_bpe_50k.json"), True)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ora", "eli", "uno")]
    texts = [f"x {w}.\n{v}, {w}!" for w in words for v in words]
    encoder.encode(texts, 2)
    assert len(encoder.end) < 3 * len(words)  # no piece per pair of words around a line's end


def test_token_files(spark):
    texts = [*random_texts(30, 200, 7), *ODD]
    got = coder.round_trip(spark, docs_of(spark, texts), vocabulary("byte_bpe_50k.json"), 2).collect()
    ids, offs = tokens.Encoder(vocabulary("byte_bpe_50k.json"), True).encode(texts, 2)
    for r in got:
        a, b = offs[r.doc_id], offs[r.doc_id + 1]
        assert (r.start, r.n_tokens, r.ids) == (a, b - a, ids[a:b].tolist())
        assert r.ids_crc32 == zlib.crc32(ids[a:b].astype("<u4").tobytes())
    assert len(got) == len(texts)


def test_vectors_match_all_pairs(spark):
    random = np.random.default_rng(1)
    x = random.standard_normal((60, 64))
    near = x[:20] + 0.1 * random.standard_normal((20, 64))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(np.concatenate([x, near, x[:5], x[:5] * 2]))]
    rows += [(200, None, 1), (201, [0.0] * 64, 1), (202, [None] * 64, 1), (203, [math.nan] * 64, 1), (204, x[0].tolist(), None), (205, [], 1)]
    got = {r.vec_id: r for r in caps.near_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    sound = [r for r in rows if r[0] < 200]
    unit = {i: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for i, v, _ in sound}
    links = {i: [j for j, _, m in sound if j != i and m == k and unit[i] @ unit[j] >= 0.98] for i, _, k in sound}
    assert all(got[i].n_links == len(links[i]) for i in links)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(200, 206))
    assert len(got) == len(rows)


def test_list_decoding_finds_all_filters_above_the_cap():
    x = np.random.default_rng(3).standard_normal(64)
    x /= np.linalg.norm(x)
    rotation, codes = caps._code(64)
    y = rotation @ x
    sums = (codes[0] @ y[:32])[:, None] + (codes[1] @ y[32:])[None, :]
    above = np.flatnonzero(sums.reshape(-1) >= caps.CAP / 8 * math.sqrt(2))
    got = caps.filters(x)
    assert set(above) <= set(got) and len(got) >= caps.LEAST


def test_base_scores_by_brute_force(spark):
    texts = [*random_texts(40, 60, 8), *[t for t in ODD if not t or len(t) < 5000]]
    got = {r.doc_id: r for r in mixing.score(spark, docs_of(spark, texts)).collect()}
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    count = Counter(w for t, h in zip(texts, held) if not h for w in [*word_list(t), None])
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(texts):
        w = [*word_list(t), None]
        assert (got[i].held_out, got[i].n_tokens, got[i].train_tokens) == (held[i], len(w), n)
        assert got[i].n_known == sum(count[x] > 0 for x in w)
        assert got[i].base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
        assert got[i].score < 0


def test_scores_prefer_the_corpus(spark):
    docs = table(spark, SMALL, "documents")
    plain = docs.where("lang = 'en'").select("doc_id", "text")
    noise = plain.limit(20).selectExpr("doc_id + 100000 AS doc_id", "reverse(text) AS text")
    got = mixing.score(spark, plain.unionByName(noise)).where("held_out").collect()
    per = [[r.score / r.n_tokens for r in got if (r.doc_id >= 100000) is x] for x in (False, True)]
    assert np.mean(per[0]) > np.mean(per[1])


def test_winnowing_by_brute_force(spark):
    texts = [*random_texts(12, 80, 9), *[t for t in ODD if not t or len(t) < 5000]]
    got = {r.doc_id: r for r in winnow.fingerprints(spark, docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t, after = t or "", texts[i - 1] or ""  # descending ids; the first follows the last
        half = len(t) // 2
        expected = t[: len(t) - half] + after[:half]
        import hashlib

        assert got[i].edited_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert got[i].n_chars == len(t)
        found = [tuple(f.split(":")) for f in got[i].fingerprint.split("|")[0].split()]
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        places = [int(p) for _, p in found]
        assert places == sorted(places) and bool(found) == bool(words)
        if len(words) >= winnow.K + winnow.WINDOW:  # every window has a mark
            assert max(np.diff([-1, *places, len(words) - winnow.K + 1])) <= winnow.WINDOW
    assert got[3].near_edited > 0.15 > got[3].near_next
    assert got[12].near_edited >= 0


def test_rightmost_of_equal_marks(spark):
    frame = docs_of(spark, ["tie " * 20])
    words, characters = winnow.fingerprints(spark, frame).first().fingerprint.split("|")
    assert [int(f.split(":")[1]) for f in words.split()] == list(range(7, 17))
    # Every fourth place has the least run; the rightmost in each window is chosen.
    places = [int(f.split(":")[1]) for f in characters.split()]
    assert places and set(np.diff(places)) == {4}


def winnowed(text):
    """The marks of a text by plain loops: {(level, value, place)}."""
    import xxhash

    def hashed(unit):
        return (xxhash.xxh64_intdigest(unit.encode(), seed=42) & 0x7FFFFFFF) % winnow.PRIME

    units = [c for w in re.split(r"[\x20\x09-\x0D]+", text) if w for c in ([w] if len(w) <= winnow.LONG else w)]
    levels = [(0, units, winnow.K)]
    if 0 < len(text) <= winnow.SHORT:
        levels.append((1, list(text), winnow.SHORT_K))
    out = set()
    for level, units, k in levels:
        if not units:
            continue
        while k > len(units):
            k //= 2
        runs = []
        for i in range(len(units) - k + 1):
            value = 0
            for unit in units[i : i + k]:
                value = (value * winnow.BASE + hashed(unit)) % winnow.PRIME
            runs.append(value)
        for a in range(max(1, len(runs) - winnow.WINDOW + 1)):
            value, place = min((v, -i) for i, v in enumerate(runs[a : a + winnow.WINDOW], a))
            out.add((level, value, -place))
    return out


def test_marks_and_likeness_by_plain_loops(spark):
    texts = [*random_texts(6, 90, 9), *[t for t in ODD if t is None or len(t) < 5000], "y" * 3000, "漢字仮名交" * 300]
    texts += ["two words", "漢字" * 20, "ab " * 7, " ".join(["antidisestablishmentarianism"] * 30)]
    got = {r.doc_id: r for r in winnow.fingerprints(spark, docs_of(spark, texts)).collect()}

    def read(fingerprint):
        return {
            (level, int(v, 16), int(i)) for level, part in enumerate(fingerprint.split("|")) for v, i in (m.split(":") for m in part.split())
        }

    def alike(one, other):
        one, other = ({(m[0], m[1]) for m in marks} for marks in (one, other))
        return len(one & other) / len(one | other) if one | other else 1.0

    for i, t in enumerate(texts):
        t, after = t or "", texts[i - 1] or ""
        half = len(t) // 2
        edited_marks = winnowed(t[: len(t) - half] + after[:half])
        assert read(got[i].fingerprint) == winnowed(t), i
        assert read(got[i].edited_fingerprint) == edited_marks, i
        assert got[i].near_edited == pytest.approx(alike(winnowed(t), edited_marks))
        assert got[i].near_next == pytest.approx(alike(winnowed(t), winnowed(after)))


def test_half_of_a_text_is_always_seen(spark):
    random = np.random.default_rng(4)
    letters = list("abcdefghij漢字仮名😀é")
    texts = []
    for n in (30, 31, 100, 511, 512, 513, 514, 600, 1030, 5000):
        for widest in (1, 4, 15, 16, 40, 10_000):
            text = ""
            while len(text) < n:
                text += "".join(random.choice(letters, int(random.integers(1, widest + 1)))) + " "
            texts.append(text[:n].rstrip() + "." * (n - len(text[:n].rstrip())))
    texts += ["漢" * 2000, "".join(random.choice(letters, 70_000))]
    rows = winnow.fingerprints(spark, docs_of(spark, texts)).collect()
    assert all(r.near_edited > 0 for r in rows)


PAGE = """<html><head><title>T</title></head><body><header>Site {n}</header><div class="top">Fixed words of the site</div>
<nav><ul><li>Menu {n}</li></ul></nav><div class="entry"><h1>Title {n}</h1><p>Text &amp; <b>more</b>
 {n}<br>line<p>Second {n}</p></div><div class="comments"><p>reader {n}</p></div><form>f</form><footer>foot</footer>"""


def test_template_blocks_are_left_out(spark):
    plain = PAGE.replace(' class="entry"', "")
    rows = [(i, "http://a.org/x", PAGE.replace("{n}", str(i))) for i in range(8)]
    rows += [(10 + i, "http://b.org/x", plain.replace("{n}", str(i))) for i in range(8)]
    rows += [(30, None, None), (31, "", ""), (32, "http://c.org", "<p>alone<script>x</script>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in template.main_text(spark, frame).collect()}
    for i in range(8):
        assert got[i] == got[10 + i] == f"Title {i}\nText & more {i} line\nSecond {i}"
    assert (got[30], got[31], got[32]) == ("", "", "alone")


@pytest.mark.parametrize("page", [
    '<div class="layout has-sidebar"><article><p>one</p></article><div class="sidebar"><p>x</p></div></div>',
    '<div class="content no-sidebar"><p>one</p></div>',
    '<article class="post comments-open"><p>one</p></article><div class="comments"><article><p>x</p></article></div>',
    '<div class="widget"><article><p>one</p></article></div>',
    '<article class="notice"><p>one</p></article><p>x</p>',
    '<article><svg width="1"/><p>one</p></article><svg><text>x</text></svg>',
    '<article><p>one<math/></p></article>',
])
def test_article_text_is_kept(page):
    assert template.extract(page, frozenset()) == "one"


def test_comment_and_formula():
    page = '<article><p>a <math><mi>x</mi></math></p><div class="comments"><p>no</p></div></article>'
    assert template.extract(page, frozenset()) == "a x"


def test_template_of_part_of_the_pages(spark):
    """Layouts, blocks on most pages or twice a page, odd and empty pages of one host."""
    rows = []
    for i in range(40):
        a, b = ("<div class=x1><p>Layout one has this</p>", "</div>") if i % 2 else ("<div class=y1><h2>Other layout</h2>", "</div>")
        most = "<section><p>Shown on most of the pages</p></section>" if i % 10 else ""
        twice = "<div class=t><p>Seen here two times</p></div>"
        rows.append((i, "http://a.org/x", f"<body><h3>The host</h3>{a}{twice}<p>Text {i} is of its own</p>{most}{twice}{b}</body>"))
    rows += [(40, "http://a.org/x", None), (41, "http://a.org/x", ""), (42, "http://a.org/x", "<p>odd one")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in template.main_text(spark, frame).collect()}
    assert got == {**{i: f"Text {i} is of its own" for i in range(40)}, 40: "", 41: "", 42: "odd one"}


def test_repeated_article_is_no_template(spark):
    other = "<h3>The host</h3><article><p>{}</p></article>"
    again = "<h3>The host</h3><article><h2>Shown again</h2><p>on six pages of the host</p></article>"
    rows = [(i, "http://a.org/x", again if i < 6 else other.format(f"Text {i}")) for i in range(20)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in template.main_text(spark, frame).collect()}
    assert got == {i: "Shown again\non six pages of the host" if i < 6 else f"Text {i}" for i in range(20)}


def test_pages_against_a_plain_reading(spark):
    pages = {r.page_id: r.html for r in table(spark, SMALL, "pages").collect()}
    got = {r.page_id: r.text for r in template.main_text(spark, table(spark, SMALL, "pages")).collect()}
    for i, page in pages.items():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html_lib.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[i] == "\n".join(b for b in blocks if b)


def test_empty_tables(spark):
    none = docs_of(spark, []).select("doc_id", "text")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = vocabulary("word_bpe_49k.json")
    for found in (
        minhash.near_duplicates(spark, none), chunks.remove_repeats(spark, none), quality.classify(spark, none, labels),
        packing.pack_documents(spark, none, path), coder.round_trip(spark, none, path, 2), winnow.fingerprints(spark, none),
        mixing.score(spark, none), pieces.encoded(none, vocabulary("piece_bpe_32k.model")),
        template.main_text(spark, spark.createDataFrame([], "page_id long, url string, html string")),
        caps.near_vectors(spark, spark.createDataFrame([], "vec_id long, embedding array<float>, label int")),
    ):
        assert found.collect() == []


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(spark, frame).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 0), (1, 1), (1, 1), (2, 1)]
    assert sorted(r.doc_id or 0 for r in minhash.deduplicate(spark, frame).collect()) == [0, 0, 1]
    assert winnow.fingerprints(spark, frame).count() == 5
    assert mixing.score(spark, frame).count() == 5
    assert chunks.remove_repeats(spark, frame).count() == 5


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns
        docs = kept.cache()
        assert 0 < docs.count() <= 200, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("name,keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_full_memo_and_equal_hashes_change_no_ids(name, keep, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(name))
    texts = [*random_texts(6, 300, 11), "word, word. word; other, oth", *ODD]
    monkeypatch.setattr(tokens, "_hashes", lambda pieces: np.array([len(p) for p in pieces], np.int64))
    few = tokens.Encoder(vocabulary(name), keep)
    few.memo = 5
    for _ in range(2):
        ids, offs = few.encode(texts, 2)
        for t, a, b in zip(texts, offs[:-1], offs[1:]):
            assert ids[a:b].tolist() == [*library.encode(t or "", add_special_tokens=False).ids, 2]
    assert len(few.end) == len(few.name_end) == len(few.keys) == 5


def test_the_memo_takes_little_memory():
    words = [f"x{i:06d}" for i in range(100_000)]
    encoder = tokens.Encoder(vocabulary("word_bpe_49k.json"), False)
    encoder.encode(["warm up"], 1)
    tracemalloc.start()
    encoder.encode([" ".join(words)], 1)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 100 * len(words)


def test_substring_scratch_is_removed_when_read(spark):
    scratch = pathlib.Path(files.shared_dir(spark)) / "llm"
    kinds = ("anchors", "known", "runs", "marks")
    before = {k: len(list(scratch.glob(f"{k}-*"))) for k in kinds}
    passage = random_texts(1, 200, 5)[0]
    chunks.remove_repeats(spark, docs_of(spark, [f"a {passage}", f"b {passage} c", "d"])).collect()
    assert {k: len(list(scratch.glob(f"{k}-*"))) - before[k] for k in kinds} == {"anchors": 0, "known": 0, "runs": 0, "marks": 1}
