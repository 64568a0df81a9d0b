"""Sharding, divergence of sources and collocations against brute force and on odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stratalog.llm import collocations as phrases
from stratalog.llm import divergence as audit
from stratalog.llm import sharding
from stratalog.llm.skew import heavy_keys, look_up

DDL = "doc_id bigint, text string, lang string, source string, shard int, held string"
ODD = [(1, "a B. a b, A b", "en", "s"), (1, "a B. a b, A b", "en", "s"), (None, None, None, None),
       (2, "", "en", "t"), (3, "é\x00é  \tÉ é", "fr", "s"), (4, "x " * 50000, "en", "u"),
       (5, "... !\n;", "en", "s"), (6, None, "fr", None), (7, "x" * 100000, "en", "t")]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], DDL)


def some_rows(n=300, seed=5):
    """Few words, so that phrases and terms repeat; copies and a text that a third of all rows have."""
    rng = random.Random(seed)
    words = "the of a Cat cat dog, dog. ran; sat été naïve x1 9 don't big? red\n blue\t sky".split(" ")
    rows = []
    for i in range(n):
        if i % 3 == 0:
            text = "The big cat sat. The big dog ran"
        elif rows and rng.random() < 0.2:
            text = rng.choice(rows)[1]
        else:
            text = " ".join(rng.choices(words, k=rng.randrange(40)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None]), rng.choice(["a", "b", "c", None])))
    return rows


# sharding

def test_shards_have_equal_sizes_and_keep_copies_together(spark):
    rows = some_rows()
    got = sharding.shard_documents(frame(spark, rows), sharding.Sharding(rounds=6)).collect()
    assert len(got) == 300
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))
    texts = {i: t for i, t, *_ in rows}
    where = defaultdict(Counter)
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert r.law == "rows" and r.grown_shard is None
        where[r.doc_id % 3 == 0 and "hot" or texts[r.doc_id]][r.shard] += 1
    hot = where.pop("hot")  # 100 copies need three shards; the small groups take room as well
    assert sum(sorted(hot.values())[-4:]) >= 80
    cut = [c for c in where.values() if len(c) > 1]
    assert len(cut) <= 4


def test_shards_of_odd_rows(spark):
    rows = ODD * 3
    got = sharding.shard_documents(frame(spark, rows), sharding.Sharding(rounds=2)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
    assert {r.size for r in got if r.doc_id is None} == {1}
    assert sharding.shard_documents(frame(spark, [])).collect() == []
    one = sharding.shard_documents(frame(spark, ODD[:1])).collect()
    assert len(one) == 1 and one[0].slot == 0


def test_propagation_gathers_members_of_several_groups(spark):
    """Two clubs of 40 joined by chains of groups of two; nothing else to fill up with."""
    members = [(n, f"{n // 40}-{a}") for n in range(80) for a in (n % 40, (n + 1) % 40)]
    nodes = spark.range(80).withColumnRenamed("id", "node")
    links = spark.createDataFrame(members, "node bigint, group string")
    settings = sharding.Sharding(shards=2, rounds=8)
    places = sharding.balanced_shards(nodes, links, settings)
    rows = places.collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [40, 40]
    outside = sharding.cut_edges(links, places).first()
    at_random = nodes.selectExpr("node", "int(pmod(xxhash64(node), 2)) AS shard", "0 AS slot")
    before = sharding.cut_edges(links, at_random).first()
    assert outside["cut_groups"] < before["cut_groups"] and outside["groups"] == 80


def test_numbering_and_moves():
    assert sharding.quotas(10, 4) == [3, 3, 2, 2]
    allowed = sharding._allowed({(0, 1): 5, (1, 0): 2, (2, 1): 4}, [0, 3, 0])
    assert allowed == {(0, 1): 5, (1, 0): 2, (2, 1): 0}


# skew

def test_look_up_deals_heavy_keys_and_loses_nothing(spark):
    left = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 0, id) AS key")
    given = spark.range(9000).selectExpr("id AS key", "id * 2 AS twice")
    heavy = heavy_keys(left, ["key"], 9000)
    assert [r["key"] for r in heavy.collect()] == [0]
    joined = look_up(left, ["key"], given, heavy)
    assert joined.filter("twice = key * 2").count() == joined.count() == 9000
    few = look_up(left, ["key"], given.filter("key = 0"), heavy, "left")
    assert few.count() == 9000 and few.filter("twice IS NOT NULL").count() == 3000


# divergence

def brute_divergence(rows, min_docs, top):
    docs = defaultdict(list)
    for _, text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        docs[lang or ""].append((source or "", words))
    out = set()
    for lang, held in docs.items():
        df = Counter(w for _, words in held for w in set(words))
        kept = {w for w in df if df[w] >= min_docs}
        counts = defaultdict(Counter)
        for source, words in held:
            counts[source].update(w for w in words if w in kept)

        def shares(count):
            n = sum(count.values())
            return {w: 1 + 10**9 * (count[w] + 5) // (n + 5 * len(kept)) for w in kept}

        q = shares(sum(counts.values(), Counter()))
        p = {s: shares(c) for s, c in counts.items()}
        for s in p:
            pairs = [(sum(abs(p[s][w] - p[t][w]) for w in kept), t) for t in p if t != s]
            terms = [(p[s][w] - q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out |= {(lang, s, part, item, value, rank + 1)
                        for rank, (value, item) in enumerate(found[:limit])}
    return out


@pytest.mark.parametrize("settings", [audit.Audit(min_docs=30), audit.Audit(2, top_terms=3, block=2),
                                      audit.Audit(min_docs=10**6)])
def test_divergence_equals_brute_force(spark, settings):
    rows = some_rows() + ODD
    got = audit.divergence(frame(spark, rows), settings).select(
        "lang", "source", "part", "item", "value", "rank").collect()
    want = brute_divergence(rows, settings.min_docs, settings.top_terms)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert audit.divergence(frame(spark, []), settings).collect() == []


def test_copies_are_taken_apart_once(spark):
    rows = audit.collapsed(frame(spark, some_rows())).collect()
    assert len(rows) == len({(r.lang, r.text) for r in rows}) < 300
    assert sum(h.copies for r in rows for h in r.held) == 300


def test_texts_that_occur_once_are_counted_where_they_lie(spark):
    rows = some_rows() + ODD
    times = Counter((lang or "", text or "") for _, text, lang, _ in rows)
    once, others = audit.by_copies(frame(spark, rows))
    assert once.count() == sum(n == 1 for n in times.values()) > 0
    assert others.count() == sum(n for n in times.values() if n > 1) > 0
    few, everything = audit.by_copies(frame(spark, rows), limit=0)
    assert few is None and everything.count() == len(rows)


def test_divergence_without_room_for_hashes(spark, monkeypatch):
    rows = some_rows() + ODD
    monkeypatch.setattr(audit.by_copies, "__defaults__", (0,))
    got = audit.divergence(frame(spark, rows), audit.Audit(2)).select(
        "lang", "source", "part", "item", "value", "rank").collect()
    assert {tuple(r) for r in got} == brute_divergence(rows, 2, 50)


# collocations

def brute_counts(rows, most):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang or "und"] += len(words)
            for k in range(1, most + 1):
                f[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return f, n


def brute_collocations(rows, s):
    f, n = brute_counts(rows, s.max_words)
    out = set()
    for lang, count in f.items():
        cands = {p: a for p, a in count.items() if len(p) > 1 and a >= s.min_count}
        longest = Counter()
        for p, a in cands.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longest[p[i:i + size]] = max(longest[p[i:i + size]], a)
        found = []
        for p, a in cands.items():
            if p in longest and 100 * longest[p] >= s.inside_percent * a:
                continue
            score, _, left, right = min(
                (s.scale * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                for k in range(1, len(p)))
            found.append((" ".join(p), a, left, right, n[lang], score))
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out |= {(lang, i + 1, *r) for i, r in enumerate(found[:s.top])}
    return out


@pytest.mark.parametrize("settings", [
    phrases.Mining(), phrases.Mining(max_words=4, min_count=3, top=25, part_bytes=64),
    phrases.Mining(min_count=2, part_bytes=500, task_entries=50, split_entries=4),
    phrases.Mining(max_words=2, min_count=1)])
def test_collocations_equal_brute_force(spark, settings):
    rows = some_rows() + ODD
    got = phrases.collocations(frame(spark, rows).repartition(3), settings).collect()
    want = brute_collocations(rows, settings)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert phrases.collocations(frame(spark, []), settings).collect() == []


def test_large_numbers_are_exact(spark):
    """Scores of counts whose products pass 64 bits."""
    a, left, right = 3_000_000_019, 5_000_000_021, 4_000_000_007
    row = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    cast = {c: f"CAST({c} AS decimal(19,0))" for c in "alr"}
    got = row.selectExpr(f"({cast['a']} * {cast['a']} * 1000000) div ({cast['l']} * {cast['r']}) AS s")
    assert got.first().s == 10**6 * a * a // (left * right)


@pytest.mark.parametrize("minimum", [1, 3])
def test_equal_partitions_are_counts(minimum):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 5, (3, 400)) ** 2
    keys[2, ::7] = -1
    keys[1:, ::11] = -1
    weight = rng.integers(1, 4, 400)
    shared = keys[0] == 4
    found = {}
    for depth, member, total in phrases.equal_partitions(keys, weight, minimum, shared, 2):
        for m, t in zip(member, total):
            key = tuple(keys[:depth, m])
            assert key not in found
            found[key] = t
    want = Counter()
    for column, w in zip(keys.T, weight):
        for depth in (1, 2, 3):
            if -1 not in column[:depth]:
                want[tuple(column[:depth])] += w
    kept = {k: w for k, w in want.items() if w >= minimum or (k[0] == 4 and len(k) < 3)}
    assert found == kept
