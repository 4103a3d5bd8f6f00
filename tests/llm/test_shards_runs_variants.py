"""Sharding, periodic runs and spelling variants against their laws and brute force."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import periodic_runs, queries, sharding, spelling_variants

EMPTY = hashlib.sha256(b"").hexdigest()


def documents(spark, tmp_path, rows):
    """A folder with the table `documents`, as the registered queries read it."""
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abé", k=rng.randint(4, 7))) for _ in range(300)]
    out = []
    for i in range(220):
        w = rng.choices(vocabulary[: 2 if i % 3 else 300], k=rng.choice([0, 1, 5, 6, 7, 30, 120]))
        if i % 4 == 0:
            w[3:3] = rng.choices(vocabulary, k=rng.randint(1, 5)) * rng.randint(1, 6)
        out.append((i, "\t".join(w) if i % 7 else " \n".join(w).upper(), "en", "s"))
    out += [(1000, None, None, None), (1001, "", "en", "s"), (1002, " \n", "en", "s"), (1004, "word " * 30_000, "en", "s")]
    return out + [(None, "a b a b a b a b", "en", "s"), (None, None, None, None), out[3], out[3], out[8]]


# sharding


def shard_laws(got, rows, shards):
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter((r[0], r[1]) for r in rows)
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got)
    places = collections.defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in places.values())
    counts = [len(places[k]) for k in range(shards)]
    assert set(places) <= set(range(shards)) and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("bucket_bytes", [2_000, 16 << 20])
def test_shards(spark, frame, rows, bucket_bytes):
    got = sharding.shuffle_into_shards(frame(rows).withColumn("shard", F.lit("x")), bucket_bytes=bucket_bytes).collect()
    shard_laws(got, rows, 8)
    again = sharding.shuffle_into_shards(frame(rows).repartition(7), bucket_bytes=bucket_bytes).collect()
    assert {(r.shard, r.slot): (r.doc_id, r.text) for r in got} == {(r.shard, r.slot): (r.doc_id, r.text) for r in again}
    other = sharding.shuffle_into_shards(frame(rows), bucket_bytes=bucket_bytes, seed=12).collect()
    assert [r.doc_id for r in sorted(other, key=lambda r: (r.shard, r.slot))] != [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]


def test_shards_of_one_row_repeated(spark, frame):
    """A third of the rows are the same: they are scattered over the buckets like others."""
    rows = [(i, f"text {i}", None, None) for i in range(12_000)] + [(5, "hot", None, None)] * 6_000
    got = sharding.shuffle_into_shards(frame(rows), bucket_bytes=10_000).collect()
    shard_laws(got, rows, 8)
    hot = collections.Counter(r.bucket for r in got if r.text == "hot")
    assert len(hot) > 10 and max(hot.values()) < 3 * 6_000 / len(hot)
    per_shard = collections.Counter(r.shard for r in got if r.text == "hot")
    assert all(600 < per_shard[k] < 900 for k in range(8))


def test_few_rows_and_files(spark, frame, tmp_path):
    for n in (0, 1, 3, 8, 9):
        rows = [(i, "x", None, None) for i in range(n)]
        shard_laws(sharding.shuffle_into_shards(frame(rows)).collect(), rows, 8)
    rows = [(i, "x" * i, None, None) for i in range(100)]
    sharding.shuffle_into_shards(frame(rows), 4, path=f"{tmp_path}/out", bucket_bytes=500)
    assert [spark.read.parquet(f"{tmp_path}/out/shard={k}").count() for k in range(4)] == [25] * 4


def test_order_is_random(spark, frame):
    """Over seeds, each row takes each place about equally often."""
    at = collections.Counter()
    for seed in range(24):
        for r in sharding.shuffle_into_shards(frame([(i, "t", None, None) for i in range(4)], extra=False), 1, seed=seed, bucket_bytes=3).collect():
            at[r.doc_id, r.slot] += 1
    assert len(at) >= 14 and max(at.values()) <= 14


def test_shard_query(spark, tmp_path, rows):
    got = queries.op11_external_shuffle(spark, documents(spark, tmp_path, rows)).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


# periodic runs


def brute_runs(w, least=6, periods=4):
    """Every maximal stretch of every period whose smallest period it is."""
    n, out = len(w), []
    for q in range(1, n // periods + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s, length = i - q, j - i + q
            if j > i and length >= max(least, periods * q) and not any(all(w[x] == w[x - p] for x in range(s + p, s + length)) for p in range(1, q)):
                out.append((s, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(1)
    for t in range(3000):
        w = [rng.randrange(1 + t % 4) for _ in range(rng.randint(0, 60))]
        for _ in range(t % 3):
            k = rng.randrange(len(w) + 1)
            w[k:k] = (rng.choices(range(4), k=rng.randint(1, 9)) * 8)[: rng.randint(1, 60)]
        got = [tuple(map(int, r)) for r in periodic_runs.runs_of(np.array(w, np.int64))]
        assert got == brute_runs(w), w


def rewritten(key, w):
    n = len(w)
    if key is None or not n or (h := zlib.crc32(str(key).encode())) % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


@pytest.mark.parametrize("piece", [50, 300_000])
def test_run_query(spark, tmp_path, rows, monkeypatch, piece):
    monkeypatch.setattr(periodic_runs, "SLICE", piece)
    got = queries.op12_periodic_runs(spark, documents(spark, tmp_path, rows)).collect()
    want = []
    for key, text, *_ in rows:
        w = rewritten(key, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))
        found = brute_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((key, len(found), *best, 1000 * best[1] // best[2] if found else None,
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert sum(r.n_runs > 0 for r in got) > 40 and {r.collapsed_sha256 for r in got if r.doc_id in (1000, 1001, 1002)} == {EMPTY}


def test_runs_of_clashing_names_and_no_rows(spark, frame):
    docs = frame([(1, "a b a b a b a b c", None, None), (1, None, None, None)]).withColumn("runs", F.lit(0)).withColumn("n_words", F.lit(0))
    got = {r.collapsed_text: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got["a b c"].runs] == [(0, 8, 2)] and got["a b c"].n_dropped == 6
    assert got[""].n_words == 0 and periodic_runs.periodic_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, min_periods=3)


# spelling variants


def one_edit(x, y):
    if len(x) < len(y):
        x, y = y, x
    if x == y or len(x) - len(y) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return any(x[:k] + x[k + 1:] == y for k in range(len(x)))


def brute_variants(n, times=2):
    near = {x: [y for y in n if abs(len(x) - len(y)) < 2 and one_edit(x, y)] for x in n}
    form = {}
    for x, others in near.items():
        best = min(others, key=lambda y: (-n[y], y), default=None)
        form[x] = best if best is not None and n[best] >= times * n[x] else None
    root = {}
    for x in n:
        y = x
        while form[y] is not None:
            y = form[y]
        root[x] = y
    return {x: (n[x], len(near[x]), form[x], n[form[x]] if form[x] else None, root[x]) for x in n}


def brute_counts(rows, typo):
    n = collections.Counter()
    for key, text, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            if key is not None and (h := zlib.crc32(f"{key}:{w}".encode())) % typo == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return n


def as_rows(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("group, dense, cells", [(50_000, 512, 4_000_000), (30, 8, 60), (3, 2, 10)])
def test_variants_against_brute_force(spark, monkeypatch, group, dense, cells):
    """Any words, of one to several characters, also where groups are divided and blocks are small."""
    for name, value in (("DENSE", dense), ("CELLS", cells)):
        monkeypatch.setattr(spelling_variants, name, value)
    whole = spelling_variants.grouped
    monkeypatch.setattr(spelling_variants, "grouped", lambda words: whole(words, group))
    rng = random.Random(group)
    n = {"".join(rng.choices("abé\U0001F600"[: rng.randint(1, 4)], k=rng.randint(1, 9))): rng.choice([1, 2, 4, 5, 9, 20, 77]) for _ in range(250)}
    n |= {"x" * 400: 3, "x" * 401: 9, "x" * 200 + "y" + "x" * 200: 2}
    got = as_rows(spelling_variants.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == brute_variants(n)


def test_variant_query(spark, tmp_path, rows):
    got = queries.op13_spelling_variants(spark, documents(spark, tmp_path, rows))
    n = {w: k for w, k in brute_counts(rows, 97).items() if len(w) >= 5 and k >= 3}
    assert as_rows(got) == brute_variants(n)
    assert sum(v[2] is not None for v in brute_variants(n).values()) > 10


def test_long_chain_and_ties(spark):
    chain = {"a" * k: 2 ** k for k in range(1, 30)}
    assert as_rows(spelling_variants.group_variants(spark.createDataFrame(list(chain.items()), "word string, n long"))) == brute_variants(chain)
    ties = {"abcd": 1, "bbcd": 5, "abce": 5, "ébcd": 5}
    assert as_rows(spelling_variants.group_variants(spark.createDataFrame(list(ties.items()), "word string, n long")))["abcd"] == (1, 3, "abce", 5, "abce")


def test_variants_of_odd_rows(spark, frame):
    docs = frame([(1, None, None, None), (2, "", None, None), (None, "Hello hello HELLO hallo", None, None), (3, "123 你好", None, None)]).withColumn("word", F.lit(0))
    got = as_rows(spelling_variants.spelling_variants(docs, min_count=1, typo=1))
    assert got == {"hello": (3, 1, None, None, "hello"), "hallo": (1, 1, "hello", 3, "hello")}
    assert spelling_variants.spelling_variants(docs.where("false")).count() == 0
