"""Exact, near and line deduplication against brute force and on odd rows."""

import random
import re
from math import comb

import pytest

from stratalog.llm import exact_dedup as exact
from stratalog.llm import line_dedup as lines
from stratalog.llm import near_dedup as near

ODD = [(1, "a  b\tc", "x"), (2, "a b c", "y"), (2, "a b c", "y"), (None, "a b c", "z"),
       (5, None, "n"), (6, "", "e"), (7, " ", "s"), (8, "long word " * 30000, "l"), (None, None, "q")]
DDL = "doc_id bigint, text string, digest string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DDL)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DDL)


def test_perfect_hash_gives_each_digest_a_slot_of_its_own():
    import hashlib

    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    levels, slots = exact.perfect_hash(digests)
    assert sorted(slots) == list(range(3000))
    assert (exact.find_slots(levels, digests) == slots).all()
    strangers = [hashlib.sha256(f"x{i}".encode()).digest() for i in range(100)]
    assert exact.find_slots(levels, strangers).max() < 3000
    assert exact.perfect_hash([])[0] == b""
    with pytest.raises(ValueError):
        exact.perfect_hash(digests[:1] * 2)


def test_exact_dedup_of_odd_rows(odd, nothing):
    rows = exact.exact_dedup(odd).collect()
    assert len(rows) == len(ODD)
    abc = [r for r in rows if r.group_size == 4]
    assert len(abc) == 4 and all(r.keep_id == 1 for r in abc) and sum(r.kept for r in abc) == 1
    blank = {r.doc_id: r for r in rows if r.doc_id in (5, 6, 7)}
    assert blank[5].keep_id == blank[6].keep_id == 5 and blank[5].group_size == 3
    assert blank[7].keep_id == 7 and blank[7].kept  # one space is no empty text
    assert exact.exact_dedup(nothing).collect() == []


def brute_components(docs, k, percent):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup_is_brute_force(spark):
    """Chains of edits, of which neighbours are linked and ends are not, around the threshold."""
    rng = random.Random(3)
    docs, common = [], [f"c{i}" for i in range(60)]
    for start in range(0, 120, 12):
        words = [f"w{rng.randrange(400)}" for _ in range(70)] + common * (start % 24 == 0)
        for i in range(12):
            docs.append((start + i, " ".join(words)))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"W{rng.randrange(400)}"
    for k, percent in ((3, 85), (5, 80)):
        got = near.near_dedup(spark.createDataFrame(docs, "doc_id bigint, text string"),
                              near.Settings(words=k, percent=percent)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(
            docs, k, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_of_odd_rows(odd, nothing):
    rows = near.near_dedup(odd, near.OP_SETTINGS).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.component_id, r.kept) for r in rows if r.n_shingles == 1} == {
        (1, 1, True), (2, 1, False), (None, 1, False)}
    assert all(r.kept for r in rows if r.n_shingles == 0)
    kept = near.without_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == 6
    assert near.near_dedup(nothing).collect() == []


def test_the_sequential_test_keeps_what_can_still_reach_the_threshold():
    settings = near.OP_SETTINGS
    n, least = settings.hashes, near.least_matches(settings)[-1]

    def chance(m):
        return sum(comb(n + 1, j) * .85 ** j * .15 ** (n + 1 - j) for j in range(m + 1))

    assert chance(least) >= settings.miss > chance(least - 1)


def test_lines_run_together_are_the_text():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice("ab .!?\n\tc") for _ in range(rng.randrange(200)))
        assert "".join(line for line, _ in lines.cut_lines(text)) == text


def test_patience_matches_rise_and_are_equal():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(20))] for _ in range(2))
        pairs = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert lines.patience([1, 2, 3, 9], [7, 1, 2, 3]) == [(0, 1), (1, 2), (2, 3)]


def test_line_dedup_cuts_the_later_copy(spark):
    rng = random.Random(4)

    def prose(n):
        return " ".join(f"w{rng.randrange(9999)}" + "." * (i % 7 == 6) for i in range(n)) + "."

    passage, own = prose(80), [prose(60) for _ in range(6)]
    docs = [(i, f"{own[i]} {passage} {prose(30)}", i) for i in range(5)] + [(9, own[5], 9)]
    docs += [(20, docs[0][1], 0), (21, None, 0), (22, "", 0), (None, docs[0][1], 0)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, removed_lines int")
    got = {r.doc_id: r for r in lines.line_dedup(frame).collect()}
    assert len(got) == len(docs)
    assert got[0].text == docs[0][1] and got[9].text == own[5] and got[None].text == docs[0][1]
    for i in range(1, 5):
        assert passage[40:-40] not in got[i].text and own[i][:-40] in got[i].text
    assert got[20].text == "" and got[21].text is None and got[22].text == ""
    assert lines.line_dedup(frame.limit(0)).collect() == []


def brute_cut(docs, n=lines.BLOCK_WORDS):
    """Texts without runs of n words that a document with a smaller id has, words joined by blanks."""
    runs = {}
    for i, text in docs:
        words = text.split()
        for at in range(len(words) - n + 1):
            run = tuple(words[at:at + n])
            runs[run] = min(i, runs.get(run, i))
    out = {}
    for i, text in docs:
        words = text.split()
        gone = {k for at in range(len(words) - n + 1) if runs[tuple(words[at:at + n])] < i
                for k in range(at, at + n)}
        out[i] = " ".join(word for k, word in enumerate(words) if k not in gone)
    return out


def test_line_dedup_meets_the_holder_of_the_whole_block(spark):
    rng = random.Random(12)

    def line(n):
        return " ".join(f"w{rng.randrange(99999)}" for _ in range(n)) + "."

    a, b, c, d = (line(12) for _ in range(4))
    docs = [(1, f"{line(9)} {a} {b} {line(9)}"), (2, f"{line(9)} {c} {d} {line(9)}"),
            (5, f"{line(40)} {a} {b} {c} {d} {line(40)}"), (9, f"{line(30)} {a} {b} {c} {d} {line(30)}")]
    docs += [(10, f"{c} {d} {line(20)} {a} {b} {c}")]
    got = {r.doc_id: r for r in lines.line_dedup(
        spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert [got[i].removed_lines == 0 for i in (1, 2, 5, 9, 10)] == [True, True, True, False, False]
    assert not any(passage in got[9].text for passage in (a, b, c, d))
    assert {i: " ".join(r.text.split()) for i, r in got.items()} == brute_cut(docs)


def test_line_dedup_cuts_passages_that_begin_and_end_mid_sentence(spark):
    rng = random.Random(13)

    def prose(n):
        return " ".join(f"w{rng.randrange(99999)}" + "." * (rng.random() < .1) for _ in range(n))

    docs = []
    for k, n in enumerate([24, 25, 26, 51, 51, 60, 80, 200] * 5):
        passage = prose(n)
        docs += [(2 * k, f"{prose(33)} {passage} {prose(17)}"),
                 (2 * k + 1, f"{prose(12)}\n{passage}  {prose(41)}")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: " ".join(r.text.split()) for r in lines.line_dedup(frame).collect()}
    assert got == brute_cut(docs)
    assert len(got[3].split()) == 12 + 41 and len(got[1].split()) == 12 + 24 + 41


def test_line_stage_of_the_pipeline_is_brute_force(spark):
    import corpus_pipeline

    rng = random.Random(15)

    def prose(n):
        return " ".join(f"w{rng.randrange(99999)}" for _ in range(n))

    passages = [prose(n) for n in (30, 55, 90)]
    docs = [(i, f"{prose(20)} {passages[i % 3]} {prose(9)}. {passages[(i + 1) % 3]}") for i in range(9)]
    docs += [(20, docs[4][1]), (21, prose(8))]
    frame = spark.createDataFrame([(i, text, len(text)) for i, text in docs],
                                  "doc_id bigint, text string, n_chars bigint")
    rows = corpus_pipeline.line_dedup_stage(spark, frame, "").collect()
    want = {i: text for i, text in brute_cut(docs).items() if text}
    assert {r.doc_id: " ".join(r.text.split()) for r in rows} == want and 20 not in want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_aligned_blocks_are_equal_words_of_an_earlier_text(spark, monkeypatch):
    """Also where a passage is in a third of all texts, blocks cross, and lots are small."""
    monkeypatch.setattr(lines, "LOT_ENTRIES", 64)
    rng = random.Random(8)

    def prose(n):
        return [rng.choice("abcdefghij") + str(rng.randrange(4000)) for _ in range(n)]

    hot, a, b = prose(60), prose(40), prose(30)
    docs = [(i, " ".join(prose(30) + (hot if i % 3 == 0 else prose(20)) + prose(10))) for i in range(60)]
    docs += [(100, " ".join(a + prose(5) + b)), (101, " ".join(b + prose(9) + a)), (102, "same " * 300)]
    docs += [(103, "same " * 200), (103, " ".join(a)), (None, " ".join(hot)), (104, None), (105, "")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    words = {}
    for i, text in docs:
        words.setdefault(i, []).append((text or "").split())
    found = lines.aligned_blocks(frame).collect()
    assert {r.doc_id for r in found} == {*range(3, 60, 3), 101, 103}
    for row in found:
        for block in row.blocks:
            n = block.to_word - block.from_word
            assert block.holder < row.doc_id and n >= lines.BLOCK_WORDS
            said = {tuple(w[block.from_word:block.to_word]) for w in words[row.doc_id]}
            assert said & {tuple(w[block.holder_from:block.holder_from + n]) for w in words[block.holder]}
    single = [(i, t) for i, t in docs if i not in (None, 103)]
    got = {r.doc_id: " ".join((r.text or "").split()) for r in lines.line_dedup(frame).collect()}
    want = brute_cut([(i, t or "") for i, t in single])
    assert {i: got[i] for i in want} == want


def test_line_dedup_moves_texts_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    rng = random.Random(1)
    text = " ".join(str(rng.random()) for _ in range(40))
    spark.createDataFrame([(1, text, "x"), (2, text, "y")], "doc_id int, text string, lang string"
                          ).write.parquet(path)
    cut = lines.line_dedup(spark.read.parquet(path))
    assert sorted(r.removed_lines > 0 for r in cut.collect()) == [False, True]
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0], plan


@pytest.mark.parametrize("chars", [1 << 19, 7])
def test_words_are_hashed_alike_wherever_they_are(monkeypatch, chars):
    monkeypatch.setattr(lines, "CHUNK_CHARS", chars)
    word = "ab" * 40
    texts = ["", " ", "one two\tone", f"{word} x\u3000one {word}b", "\x1c na\u00efve\u00a0two \x85 one\n",
             "\U0001F600 b\U0001F600 \U0001F600", None, "ba ab a b aab"]
    known, several = {}, " ".join(text or "" for text in texts)
    for text in [text or "" for text in texts] + [several]:
        starts, hashes = lines._word_hashes(text)
        words = text.split()
        assert [text[at:at + len(w)] for at, w in zip(starts, words, strict=True)] == words
        for w, value in zip(words, hashes.tolist(), strict=True):
            assert known.setdefault(w, value) == value
    assert len(set(known.values())) == len(known) == len(set(several.split()))
    runs = {tuple((texts[n] or "").split()[at:at + 2])
            for numbers, places, *_ in lines._runs(texts, 2) for n, at in zip(numbers, places)}
    assert runs == {pair for t in texts for w in [(t or "").split()] for pair in zip(w, w[1:])}
