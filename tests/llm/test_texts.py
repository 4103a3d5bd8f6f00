"""Small cases and brute force for the operators on texts."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinledger.llm import exact_dedup, jaccard_join, language_id, license_scan, packing, quality_bayes, source_mix, substring_dedup, token_counts
from twinledger.llm.queries import tokenizer_file

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").encode())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for i in range(160):
        w = rng.choices(vocabulary, k=rng.choice([0, 1, 3, 5, 19, 20, 21, 80, 200]))
        if i % 5 == 0:
            w[len(w) // 2: len(w) // 2] = passage
        if i % 7 == 0 and rows:
            w = (rows[rng.randrange(len(rows))][1] or "").split()
            if w and i % 14 == 0:
                w[rng.randrange(len(w))] = "changed"
        rows.append((i, "  ".join(w[:3]) + "\n" + " ".join(w[3:]) if i % 11 else " ".join(w).upper(), "en", f"s{i % 3}"))
    rows += [(1000, None, None, None), (1001, "", "en", "s0"), (1002, " \t\n", "en", "s0"), (1003, " ", "en", "s0"), (1004, "word " * 30_000, "en", "s0")]
    rows += [rows[3], rows[10]]  # repeated rows
    return rows


def greedy(vocab, prefix, word):
    starts, continues = vocab
    s, n, at = prefix + word, 0, 0
    while at < len(s):
        known = starts if at == 0 else continues
        for end in range(len(s), at, -1):
            if s[at:end] in known:
                at, n = end, n + 1
                break
        else:
            return -1
    return n


def test_automaton_is_greedy(tmp_path):
    rng = random.Random(1)
    for _ in range(60):
        pieces = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 15))}
        starts = {p.encode() for p in pieces if rng.random() < 0.6}
        continues = {p.encode() for p in pieces if rng.random() < 0.6}
        a = token_counts.Automaton(starts, continues)
        for _ in range(60):
            w = "".join(rng.choices("abc", k=rng.randint(1, 12))).encode()
            assert a.count(w) == greedy((starts, continues), b"", w), (starts, continues, w)


def test_automaton_of_a_public_vocabulary():
    starts, continues, prefix = token_counts.vocabulary(tokenizer_file())
    a = token_counts.Automaton(starts, continues, prefix)
    assert {b" " + bytes([c]) for c in b"ab"} <= set(starts) and len(starts) + len(continues) > 49_000
    for w in ["hello", "tokenization", "Ünïcode", "!!!", "x" * 300, "日本語", "naïveté's"]:
        assert a.count(w.encode()) == greedy((set(starts), set(continues)), prefix, w.encode())


def test_token_counts(spark, frame, corpus):
    starts, continues, prefix = token_counts.vocabulary(tokenizer_file())
    vocab = set(starts), set(continues)
    got = token_counts.token_counts(frame(corpus), tokenizer_file()).collect()
    assert len(got) == len(corpus)
    text = {r[0]: r[1] for r in corpus}
    for r in got:
        w = words(text[r.doc_id])
        assert (r.n_words, r.n_unknown) == (len(w), 0)
        if len(w) < 500:
            assert r.n_tokens == sum(greedy(vocab, prefix, x) for x in w)


def test_unknown_words(spark, frame, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("un\n##able\n##a\nb")
    got = token_counts.token_counts(frame([(1, "unable una b unx x", None, None)]), str(path)).first()
    assert (got.n_words, got.n_tokens, got.n_unknown) == (5, 2 + 2 + 1 + 1 + 1, 2)


def test_language_small_cases(spark, frame):
    rows = [(1, "the cat and the dog", "en", None), (2, "der hund und die katze", "de", None), (3, "THE DOG", "en", None), (4, "123 !!", "en", None),
            (5, None, "en", None), (6, "the", None, None), (7, "", "de", None), (8, "ÿÿÿ ŵŵŵ", None, None)]
    docs = frame(rows)
    profiles = language_id.learn(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, profiles).collect()}
    assert {k: v[0] for k, v in got.items() if k in (1, 2, 3, 6)} == {1: "en", 2: "de", 3: "en", 6: "en"}
    assert got[4] == got[5] == got[7] == ("und", 0.0)
    assert got[8] == ("de", 0.0)  # nothing in common: a tie, the first by name
    assert all(0 <= s <= 1 for _, s in got.values())
    none = language_id.identify(docs, language_id.learn(docs.where("false"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)} and len(none) == len(rows)


def test_language_counts_in_small_parts(spark, frame, corpus, monkeypatch):
    docs = frame(corpus).repartition(3)
    whole = sorted(language_id.learn(docs, size=2000).collect())
    monkeypatch.setattr(language_id, "HELD", 300)
    assert whole and sorted(language_id.learn(docs, size=2000).collect()) == whole


def test_language_held_out(spark):
    df = spark.range(200).select("id", language_id.held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in df.collect())


def removed(rows, width):
    first, out = {}, {}
    docs = sorted(dict((r[0], r) for r in rows).items())
    for key, row in docs:
        w = words(row[1])
        for i in range(len(w) - width + 1):
            first.setdefault(tuple(w[i:i + width]), (key, i))
    for key, row in docs:
        w = words(row[1])
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < (key, i):
                gone[i:i + width] = [True] * width
        out[key] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("piece", [1_000, 400_000])
def test_substrings(spark, frame, corpus, monkeypatch, piece):
    monkeypatch.setattr(substring_dedup, "SLICE", piece)
    got = substring_dedup.remove_repeats(frame(corpus).repartition(5)).collect()
    want = removed(corpus, 20)
    assert len(got) == len(corpus)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id]
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert want[1004][1] == 30_000 - 1  # all but the first word lie in a later window


def test_substrings_null_id(spark, frame):
    text = " ".join(map(str, range(25)))
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame([(None, text, None, None), (-5, text, None, None)])).collect()}
    assert got == {None: 0, -5: 25}
    assert substring_dedup.remove_repeats(frame([])).count() == 0


def test_substring_answers_reach_their_part(spark, frame, corpus):
    def found(parts):
        rows = substring_dedup.repeated_starts(frame(corpus).selectExpr("cast(doc_id as long) as id", "text"), 20, parts).collect()
        assert len(rows) <= parts * (math.isqrt(parts) + 1)
        out = []
        for r in rows:
            ids, places = (substring_dedup._joined(pa.chunked_array([[x]]), kind) for x, kind in ((r.ids, np.int64), (r.places, np.int32)))
            assert {i % parts for i in ids.tolist()} == {r.part}
            out += zip(ids.tolist(), places.tolist())
        return sorted(out)

    few = found(7)
    assert few and few == found(997)


def test_exact_duplicates(spark, frame, corpus):
    rows = corpus + [(2000 + i, "Hot COPY", "en", "s0") for i in range(90)] + [(None, "null id", None, None), (2100, "ÉA", None, None), (2101, "éa", None, None)]
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    text = {r[0]: (r[1] or "").translate(LOWER) for r in rows}
    got = exact_dedup.exact_duplicates(frame(rows), capacity=8).collect()
    assert len(got) == len(rows)
    for r in got:
        g = groups[text[r.doc_id]]
        keep = max((x for x in g if x is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(g), r.doc_id == keep)
        assert r.text_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert exact_dedup.exact_duplicates(frame([])).count() == 0


def test_buckets_split_until_they_hold_no_more_than_the_capacity(spark):
    entries = spark.range(5000).selectExpr("shiftrightunsigned(xxhash64(id), 4) as h", "id as digest").cache()
    placed = exact_dedup.bucket_of(entries, 80, 5000).groupBy("depth", "bucket").count().collect()
    assert sum(r["count"] for r in placed) == 5000 and max(r["count"] for r in placed) <= 80
    assert len({r.depth for r in placed}) > 1


def linked_components(rows, n, percent):
    sets = {}
    for r in rows:
        w = [x.lower() for x in words(r[1])]
        sets[r[0]] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a2, b2 = find(a), find(b)
                parent[max(a2, b2)] = min(a2, b2)
    return {k: (len(sets[k]), find(k)) for k in keys}


def chain_of_copies():
    """Copies that differ from each other at a few places, further and further along a chain."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    near = []
    for i in range(60):
        if i % 6 == 0:
            base[rng.randrange(len(base))] = f"v{i}"
        w = list(base)
        w[rng.randrange(len(w))] = f"u{i}"
        near.append((3000 + i, " ".join(w[: 120 - i // 4]), "en", "s0"))
    return near


def test_jaccard(spark, frame, corpus):
    rows = corpus + chain_of_copies()
    got = jaccard_join.jaccard_components(frame(rows).repartition(4)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked_components(rows, 4, 85)


def test_jaccard_rings(spark, frame, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 10)
    monkeypatch.setattr(jaccard_join, "WHOLE", 10)
    rows = chain_of_copies()
    got = jaccard_join.jaccard_components(frame(rows, extra=False)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked_components(rows, 4, 85)


def copies_and_outliers():
    """A text, copies with one edit each, and outliers that are linked to one copy each but not to the text."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(103)]
    rows = [(0, " ".join(base), "en", "s0")]
    for i in range(60):
        w = list(base)
        w[rng.choice([8, 20, 32])] = f"c{i}"
        rows.append((100 + i, " ".join(w), "en", "s0"))
        if i % 4 == 0:
            w[44 + i % 12], w[60 + i % 30] = f"x{i}", f"y{i}"
            rows.append((10 + i // 4, " ".join(w), "en", "s0"))
    return rows


def test_jaccard_outliers_around_a_pivot(spark, frame, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 10)
    monkeypatch.setattr(jaccard_join, "WHOLE", 20)
    rows = copies_and_outliers()
    expected = linked_components(rows, 4, 85)
    assert {c for _, c in expected.values()} == {0}
    got = jaccard_join.jaccard_components(frame(rows, extra=False)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_jaccard_common_passage(spark, frame):
    # each pair shares 97 of 110 shingles, which is 97 of 123 of both: looked at before, in regions of the passage
    passage = " ".join(f"p{i}" for i in range(100))
    rows = [(i, passage + " " + " ".join(f"u{i}x{j}" for j in range(13)), "en", "s0") for i in range(80)]
    docs = frame(rows, extra=False).select(F.struct(F.col("doc_id").alias("id"), F.col("doc_id").alias("row"), F.lit(None).cast("long").alias("label")).alias("key"), "text")
    counts = jaccard_join.cell_counts(jaccard_join.read_sets(docs, 4).where("chunk is not null").select("chunk", "counts"))
    assert jaccard_join.first_regions(docs, counts, 4, 85).count() == 0


def lines_in_common(rng):
    """Texts of a few lines out of a small pool, some with an edit or cut short."""
    pool = [[f"l{k}w{i}" for i in range(rng.randint(8, 30))] for k in range(9)]
    rows = []
    for i in range(120):
        w = [x for line in rng.sample(pool, rng.randint(3, 6)) for x in line]
        if i % 2:
            w[rng.randrange(len(w))] = f"e{i}"
        rows.append((i, " ".join(w[: len(w) - rng.randrange(9)]), "en", "s0"))
        if i % 3:
            w[rng.randrange(len(w))] = f"f{i}"
            rows.append((1000 - i, " ".join(w), "en", "s0"))
    return rows


@pytest.mark.parametrize("small,whole,n,percent", [(48, 256, 4, 85), (1, 3, 4, 85), (4, 10, 5, 80), (1, 2, 2, 60)])
def test_jaccard_blocks(spark, frame, monkeypatch, small, whole, n, percent):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "WHOLE", whole)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rows = lines_in_common(random.Random(small))
    got = jaccard_join.jaccard_components(frame(rows, extra=False), n, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked_components(rows, n, percent)


def test_jaccard_null_and_repeated_ids(spark, frame):
    words_ = [f"a{i}" for i in range(60)]
    near = words_[:30] + ["changed"] + words_[31:]
    other = [f"b{i}" for i in range(60)]
    rows = [(None, " ".join(words_), None, None), (None, " ".join(near), None, None),
            (7, " ".join(other), None, None), (7, " ".join(other[:-1]), None, None), (7, "x y z " * 9 + "end", None, None), (3, " ".join(other[1:]), None, None),
            (5, " ".join(f"d{i}" for i in range(60)), None, None), (5, " ".join(f"e{i}" for i in range(60)), None, None), (4, " ".join(f"e{i}" for i in range(59)), None, None)]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(rows)).collect())
    sizes = [len({tuple(t.split()[i:i + 4]) for i in range(len(t.split()) - 3)}) for _, t, _, _ in rows]
    linked_to = [None, None, 3, 3, 7, 3, 5, 4, 4]
    assert got == collections.Counter((r[0], n, c) for r, n, c in zip(rows, sizes, linked_to))


def test_jaccard_threshold_is_exact(spark, frame):
    # 17 of 20 shingles shared: just linked; 16 of 20: not
    base = [f"a{i}" for i in range(23)]
    rows = [(5, " ".join(base[:20]), None, None), (2, " ".join(base[:20] + ["b0", "b1", "b2"]), None, None), (9, " ".join(base[:19] + ["c0", "c1", "c2", "c3"]), None, None),
            (7, "one two", None, None), (8, "ONE  two", None, None), (4, None, None, None)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(rows)).collect()}
    assert got == linked_components(rows, 4, 85)
    assert got[5] == (17, 2) and got[9] == (20, 9) and got[8] == (1, 7) and got[4] == (0, 4)
    assert jaccard_join.jaccard_components(frame([])).count() == 0


def test_licenses(spark, frame):
    rows = [(1, license_scan.MIT_BODY.upper(), None, None), (2, "Copyright (c) 2020 Someone\n" + license_scan.MIT_BODY.replace(",", " ,"), None, None),
            (3, "Some text\nReleased under the MIT Licence\n# licensed under cc by-nc 4.0!", None, None), (4, "Released under the MIT License. And more", None, None),
            (5, None, None, None), (6, "", None, None), (6, "", None, None), (7, "x\n" * 20_000, None, None)]
    got = license_scan.scan(frame(rows)).collect()
    by = {r.doc_id: (r.license, r.notices, r.n_notice_lines) for r in got}
    assert len(got) == len(rows)
    assert by[1] == by[2] == ("MIT", [], 0)
    assert by[3] == (None, ["CC-BY-NC-4.0", "MIT"], 2)
    assert by[4] == by[5] == by[6] == by[7] == (None, [], 0)
    assert license_scan.scan(frame([])).count() == 0


def test_mix_budgets(spark):
    leaves = spark.createDataFrame([("a", "x", 100), ("a", "y", 10), ("b", "x", 100), ("b", "y", 1000)], "d string, s string, tokens long")
    get = lambda w, p, e=1: {(r.d, r.s): r.budget for r in source_mix.leaf_budgets(leaves, ["d", "s"], w, p, e).collect()}
    # half each: 60 per domain; y of a has 10 only, its sibling takes the shortage
    assert get({}, 10) == {("a", "x"): 51, ("a", "y"): 10, ("b", "x"): 30, ("b", "y"): 30}
    # a is used up: what it lacks goes to b, where x is used up too
    assert get({}, 50) == {("a", "x"): 100, ("a", "y"): 10, ("b", "x"): 100, ("b", "y"): 395}
    assert get({("b",): 0}, 100) == {("a", "x"): 100, ("a", "y"): 10, ("b", "x"): 0, ("b", "y"): 0}
    # 121 tokens at 3 to 1: 90 and 30, and the odd one goes to a, the fuller of the two
    assert get({("a",): 3, ("a", "y"): 0}, 10, 2)[("a", "x")] == 91
    assert sum(get({("a",): 7, (None, "x"): 3}, 33).values()) == 1210 * 33 // 100


def test_mix(spark, frame, corpus):
    rows = corpus + [(5000 + i, "a b c", "en", "hot") for i in range(200)]
    docs = frame(rows)
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    got = source_mix.mix(docs, levels, {}, 60, max_epochs=2, seed=1, digits=1).collect()
    size = {r[0]: len(words(r[1])) for r in rows}
    total = sum(len(words(r[1])) for r in rows)
    assert sum(r.tokens_taken for r in got) == total * 60 // 100
    assert all(r.n_tokens == size[r.doc_id] and 0 < r.tokens_taken <= 2 * r.n_tokens for r in got)
    leaves = collections.defaultdict(list)
    for r in got:
        leaves[r.lang, r.source].append(r)
    for rs in leaves.values():  # one document at most is taken in part
        assert sum(0 < r.prefix_tokens < r.n_tokens for r in rs) <= 1 and len({r.epochs for r in rs}) == 1
        key = lambda r: hashlib.md5(f"1:{r.epochs}:{r.doc_id}".encode()).hexdigest()
        taken = [r.prefix_tokens == r.n_tokens for r in sorted(rs, key=key)]
        assert taken == sorted(taken, reverse=True)
    assert source_mix.mix(frame([]), levels, {}, 60).count() == 0


def test_packing(spark, frame, corpus):
    from tokenizers import Tokenizer

    rows = corpus[:150] + [(6000, "a  b  c \n d", None, None), (6001, "x <|endoftext|> y's  ", None, None), (6002, None, None, None), (6003, " lead", None, None)]
    pieces = packing.pieces_of(frame(rows), tokenizer_file(), 64, 2, with_ids=True)
    packed = packing.pack(pieces, 64, most_docs=64, most_cost=64 * 64, group_rows=100)
    got = packed.collect()
    encode = Tokenizer.from_file(tokenizer_file()).encode
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    tokens = 0
    for key, text in {r[0]: r[1] for r in rows}.items():
        ids = encode(text or "", add_special_tokens=False).ids + [2]
        tokens += len(ids)
        at = 0
        for r in sorted(by[key], key=lambda r: r.piece):
            assert r.start == at and (r.piece == 0 or r.length == 64)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append(r)
    for rs in bins.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(bins) <= 1.1 * tokens / 64 + 5
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(pieces, packed).collect()}
    assert whole == {k: sum(r.length for r in rs) for k, rs in bins.items()}
    assert packing.pack(packing.pieces_of(frame([]), tokenizer_file(), 64, 2), 64).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.random.default_rng(0).integers(1, 40, 500)
    sequence, offset = packing.best_fit(lengths, 100, 5, 2500, (1, 1, 1), rule)
    for b in set(sequence):
        own = lengths[sequence == b]
        assert own.sum() <= 100 and len(own) <= 5 and (own ** 2).sum() <= 2500


def test_quality(spark, frame):
    rng = random.Random(0)
    good = lambda: " ".join(f"word{rng.randrange(300)}" for _ in range(60)) + "."
    bad = lambda: "SPAM!! " * 50
    rows = [(i, good() if i % 2 else bad(), "en" if i % 3 else "de", "clean" if i % 2 else "junk") for i in range(400)]
    rows += [(1000, None, None, None), (1001, "", "en", "clean"), (1002, good(), "en", "junk"), (1003, "w " * 50_000, "en", "new")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(5, None), (None, 1), (7777, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_bayes.quality(frame(rows), labels).collect()}
    assert len(got) == len(rows)
    held = [r for k, r in got.items() if 200 <= k < 400]
    assert all(r.keep == bool(r.doc_id % 2) for r in held)
    assert all(0 <= x <= 1 for r in got.values() for x in (r.evidence, r.host_posterior, r.path_posterior, r.quality))
    # a site with one document stays near the mean of all
    mean = sum(r.evidence for r in got.values()) / len(got)
    assert got[301].host_posterior > got[1003].host_posterior > got[300].host_posterior and abs(got[1003].host_posterior - mean) < abs(got[1003].evidence - mean)
    plain = {r.doc_id: r.evidence for r in quality_bayes.quality(frame(rows), labels.where("false")).collect()}
    assert set(plain.values()) == {0.5}
    assert quality_bayes.quality(frame([]), labels).count() == 0


def test_encoder_of_batches(monkeypatch):
    """Batches of any cut, with texts that cannot be taken apart, long ones, repeated ones and nulls, against the tokenizer."""
    import pyarrow as pa

    encode = packing.Encoder(tokenizer_file())
    rng = random.Random(2)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "é", "'s", "12", ".", " ", "　", "\x1c", "\x85", "<|endoftext|>", "\0", "日", "​", "D"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)] + [None, "", " ", "word " * 30_000 + "end", None] + ["same text"] * 3
    for size in (24 << 20, 100, 5):
        monkeypatch.setattr(packing, "SLICE", size)
        got = list(encode.batch(pa.array(texts, pa.string())))
        assert got == [encode.whole(t or "") for t in texts]
    assert list(encode.batch(pa.array(texts, pa.string()).slice(7, 50))) == [encode.whole(t or "") for t in texts[7:57]]
    assert list(encode.batch(pa.array([], pa.string()))) == []
