"""Packing, personal data, toxicity, mixing and the pipeline."""

import itertools
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratalog.llm import mixing, packing, private_data, queries, toxicity

ODD = [(1, "one two", 0), (1, "one two", 0), (2, None, 0), (3, "", 0), (None, "x", 0),
       (5, "word " * 20000, 0), (6, " a  b\n \n c <|endoftext|> é ", 0)]
DDL = "doc_id bigint, text string, score int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DDL)


def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def test_word_tokens_are_those_of_the_whole_text():
    reference, words = tokenizer(), packing.WordTokens(packing.default_vocabulary())
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "It's", " ", "  ", "\n", "\t", ".", "12", "é", " ", "日", "!?"])
                     for _ in range(rng.randrange(60))) for _ in range(3000)]
    for text in texts:
        ids = np.frombuffer(words(text), "<u4").tolist() if text else []
        assert ids == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_packed_pieces_are_whole_and_gapless(spark, odd):
    reference = tokenizer()
    rng = random.Random(6)
    docs = [(100 + i, " ".join(["word"] * rng.choice([1, 5, 40, 300, 700, 1500])), 0)
            for i in range(300)]
    rows = packing.packed(odd.unionByName(spark.createDataFrame(docs, DDL))).collect()
    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(by_doc[1]) == 2  # rows repeated are documents of their own
    for doc_id, text, _ in docs + [d for d in ODD if d[0] != 1]:
        ids = np.array(reference.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.piece):
            assert r.start == at
            assert zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    lengths = sorted((r.length for r in rows), reverse=True)
    one_by_one, _ = packing.best_fit(lengths, list(range(len(lengths))), [], packing.CAPACITY)
    assert len(sequences) <= len({sequence for _, sequence, _ in one_by_one}) + 1
    assert packing.packed(odd.limit(0)).collect() == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, said):
    digits = [int(c) for c in said if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in said.split("."))
    if kind == "card":
        total = sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_plain_spans_are_those_of_the_patterns():
    rng = random.Random(7)
    for _ in range(20000):
        text = "".join(rng.choice("aB1.@2+- (_%\n49") for _ in range(rng.randrange(60)))
        want = sorted((m.start(), k, m.end(), False) for k, (kind, p) in enumerate(PATTERNS.items())
                      for m in re.finditer(p, text) if _valid(kind, m.group()))
        got = [(s, private_data.KINDS.index(k), e, d) for k, s, e, d in private_data.find_spans(text)
               if not d]
        assert got == want, repr(text)


@pytest.mark.parametrize("text,kind,said", [
    ("to john [at] mail [dot] example (dot) com now", "email", "john [at] mail [dot] example (dot) com"),
    ("ask ann dot lee at mail dot org.", "email", "ann dot lee at mail dot org"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("pay four" + " one" * 15 + " ok", "card", "four" + " one" * 15),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("call plus one five five five one two three four five six seven!", "phone",
     "plus one five five five one two three four five six seven"),
    ("at 192 dot 168 dot 1 dot 7 we", "ip", "192 dot 168 dot 1 dot 7"),
])
def test_disguised_spans_point_into_the_source(text, kind, said):
    spans = [(k, text[s:e]) for k, s, e, disguised in private_data.find_spans(text) if disguised]
    assert spans == [(kind, said)]


@pytest.mark.parametrize("text,kind,said", [
    ("write to john at example.com now", "email", "john at example.com"),
    ("call +1 555 123 45 six now", "phone", "+1 555 123 45 six"),
    ("from 10.0.0.one now", "ip", "10.0.0.one"),
    ("pay 4111 1111 1111 111 one now", "card", "4111 1111 1111 111 one"),
    ("pay 411111111111111 one now", "card", "411111111111111 one"),
])
def test_disguises_are_found_without_other_words(text, kind, said):
    for around in ("", " dot point one two"):
        spans = [(k, (text + around)[s:e]) for k, s, e, d in private_data.find_spans(text + around) if d]
        assert (kind, said) in spans
    assert private_data.find_spans("come at 10.30 or look at 3.5 dots") == []


@pytest.mark.parametrize("text", [
    "We met at noon.Then we left.", "see you at home.It rained", "look at example.com for more",
    "contact us at example.com", "more is available at www.example.org today", "version 1.2 dot 3 dot 4",
    "Version one point two point three point four", "section 4 point 1 point 2 point 3",
    "They arrived at two.Five of them stayed at three.", "the train at platform nine.Seats are free",
])
def test_plain_prose_has_no_disguised_spans(text):
    assert private_data.find_spans(text) == []


def test_planted_disguises_are_found_and_prose_around_them_is_left_alone():
    rng = random.Random(21)
    prose = ("We met at noon.Then the shop opened at nine.It sold version 1.2 of the tool. "
             "Look at example.com for the rest at any time.").split(" ")
    found = 0
    for n in range(200):
        name, host = f"anna{n}", rng.choice(["mail", "post"]) + str(n)
        figures = [str(rng.randrange(1, 256)) for _ in range(4)]
        said, kind = rng.choice([
            (f"{name} at {host} dot com", "email"), (f"{name} [at] {host} [dot] org", "email"),
            (f"{name} at {host}.example.net", "email"), (" dot ".join(figures), "ip"),
            ("[.]".join(figures), "ip")])
        cut = rng.randrange(len(prose))
        text = " ".join([*prose[:cut], "write to", said, "soon", *prose[cut:]])
        spans = [(k, text[s:e]) for k, s, e, _ in private_data.find_spans(text)]
        assert set(spans) <= {(kind, said)}, text
        found += spans == [(kind, said)]
    assert found == 200


def test_the_gate_passes_over_no_disguise(monkeypatch):
    rng = random.Random(14)
    parts = ["one", "Seven", "oh", "1", "555", "10.0.0", "4111", "411111111111111", "+1", "plus", " ", " ",
             "  ", ".", ",", "-", "@", "at", "AT", "_", " at ", " dot ", "dot", "point", "[", "]", "(", ")",
             "a", "john", "example.com", "&#64;", "о", "\u200b", "１"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(2, 16))) for _ in range(40000)]
    gated = [private_data.find_spans(text) for text in texts]
    monkeypatch.setattr(private_data, "_hints", lambda text: (True, True))
    for text, spans in zip(texts, gated, strict=True):
        assert private_data.find_spans(text) == spans, repr(text)


def test_private_data_of_odd_rows(odd):
    rows = private_data.private_data(odd).collect()
    assert len(rows) == len(ODD) and all(r.spans == [] for r in rows)
    long = "1" * 200000 + "@" + "a" * 200000 + " +1" + "(" * 100000
    assert private_data.find_spans(long) == []
    assert private_data.private_data(odd.limit(0)).collect() == []


def brute_subsequences(word):
    """Weights of all subsequences of three and four symbols, and their length over occurrences."""
    marked, weights, square = f"^{word}$", {}, 0.0
    for n in (3, 4):
        for at in itertools.combinations(range(len(marked)), n):
            if at[-1] - at[0] < toxicity.SPAN:
                weight = toxicity.DECAY ** (at[-1] - at[0] + 1 - n)
                symbols = "".join(marked[i] for i in at)
                weights[symbols] = weights.get(symbols, 0.0) + weight
                square += weight ** 2
    return weights, square ** 0.5


def test_kernel_is_that_of_all_gapped_subsequences():
    rng = random.Random(13)
    words = sorted({"".join(rng.choice("abcdefgh1") for _ in range(rng.randint(2, 9))) for _ in range(60)})
    got = toxicity.Landmarks(words).kernel(words)
    plain = [brute_subsequences(word) for word in words]
    want = np.array([[sum(w * b.get(u, 0.0) for u, w in a.items()) / (x * y) for b, y in plain]
                     for a, x in plain])
    off = abs(got - want)
    # Four symbols share hashed numbers: few pairs may meet by chance, and only in part.
    assert (off > 1e-4).mean() < 0.02 and off.max() < 0.1


def test_toxicity_finds_gapped_words(spark):
    rng = random.Random(8)
    parts = ["th", "er", "on", "an", "re", "ing", "ou", "ti"]

    def prose():
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
                        for _ in range(40))

    docs, labels = [], []
    for i in range(600):
        words = prose().split()
        toxic = i % 6 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["muppet", "blockhead", "nitwit"])
        docs.append((i, " ".join(words), 0))
        labels.append((i, 1, int(toxic)))
    extra = {9001: "muxppet", 9002: "b.l.o.c.k.h.e.a.d", 9003: "n i t w i t"}
    docs += [(i, f"{prose()} {word} {prose()}", 0) for i, word in extra.items()]
    docs += [(9101, prose(), 0), (9102, None, 0), (9103, "", 0), (None, prose(), 0)]
    frame = spark.createDataFrame(docs, DDL)
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.scored(frame, model).collect()}
    assert len(got) == len(docs)
    assert all((got[i] >= toxicity.THRESHOLD) == bool(t) for i, _, t in labels)
    assert all(got[i] >= toxicity.THRESHOLD for i in extra)
    assert all(got[i] < toxicity.THRESHOLD for i in (9101, 9102, 9103, None))
    kept = toxicity.without_toxic(frame, model)
    assert kept.columns == frame.columns and kept.count() == len(docs) - 103
    assert toxicity.fit(frame, spark.createDataFrame([], "doc_id bigint, toxic int")) is None
    assert toxicity.scored(frame.limit(0), model).collect() == []
    held = frame.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
               for r in held)


def brute_rates(p, tokens, share, steps=40):
    """The same descent over plain arrays."""
    p, tokens = np.array(p), np.array(tokens, float)
    weighted = p * tokens[:, None]
    targets = np.array(share) / sum(share) * tokens.sum()
    inverse, rate = np.linalg.pinv(weighted.T @ p), np.ones(len(p))
    for _ in range(steps):
        gap = weighted.T @ rate - targets
        if abs(gap).max() <= 1e-6 * tokens.sum():
            break
        rate = np.maximum(0, rate - p @ (inverse @ gap))
    return rate


def test_mixing_meets_its_targets(spark, odd):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("abcdefgh" if i % 4 else "stuvwxyz") for _ in range(
        rng.randint(5, 60))), 0) for i in range(400)] + [(900, None, 0), (901, "", 0), (None, "a b", 0)]
    frame = spark.createDataFrame(docs, DDL)
    known = spark.createDataFrame([(i, "main" if i % 4 else "rare") for i in range(0, 400, 3)],
                                  "doc_id bigint, domain string")
    weights = {"main": 0.4, "rare": 0.6}
    rows = mixing.mixed(frame, known, weights).collect()
    total = sum(r.tokens for r in rows)
    for k, share in enumerate(weights.values()):
        assert abs(sum(r.rate * r.tokens * r.p[k] for r in rows) / total - share) < 1e-4
    want = brute_rates([r.p for r in rows], [r.tokens for r in rows], list(weights.values()))
    assert np.allclose([r.rate for r in rows], want, atol=1e-6)
    assert all(abs(sum(r.p) - 1) < 1e-9 and r.rate >= 0 for r in rows)
    assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in rows)
    more = mixing.remixed(frame, known, weights, mixing.Mixture(keep_all=True))
    assert more.columns == frame.columns
    assert {r.doc_id for r in more.collect()} == {d[0] for d in docs}
    assert mixing.mixed(frame.limit(0), known, weights).collect() == []
    unlearnt = mixing.mixed(odd, known.limit(0), weights).collect()
    assert sorted(str(r.doc_id) for r in unlearnt) == sorted(str(d[0]) for d in ODD)
    for r in unlearnt:  # nothing learnt: every row has the prior, halves, and its rate is defined
        assert np.allclose(r.p, [.5, .5]) and np.isfinite(r.rate) and r.rate >= 0
    repeated = [(r.tokens, r.rate) for r in unlearnt if r.doc_id == 1]
    assert len(repeated) == 2 and repeated[0] == repeated[1]


def test_posteriors_are_those_of_a_plain_classifier(spark):
    rng = random.Random(14)
    docs = [(i, " ".join(rng.choice("abcdef" if i % 2 else "defghi") for _ in range(rng.randrange(9))), 0)
            for i in range(60)]
    frame = spark.createDataFrame(docs, DDL)
    known = {i: "odd" if i % 2 else "even" for i in range(0, 60, 5)}
    names, settings = ["even", "odd"], mixing.Mixture(buckets=1 << 16)
    prior, chances = mixing.learn(
        frame, spark.createDataFrame(list(known.items()), "doc_id bigint, domain string"), names, settings)
    # Word classes are so many here that the nine words have one each.
    counts = {name: dict.fromkeys("abcdefghi", 0.5) for name in names}
    for i, name in known.items():
        for word in docs[i][1].split():
            counts[name][word] += 1
    sums = {name: sum(counts[name].values()) + 0.5 * (settings.buckets - 9) for name in names}
    rows = {name: sum(name == n for n in known.values()) + 0.5 for name in names}
    for r in mixing.posteriors(frame, prior, chances).collect():
        words = docs[r.doc_id][1].split()
        z = []
        for name in names:
            each = sum(np.log(counts[name][w] / sums[name])
                       - np.mean([np.log(counts[n][w] / sums[n]) for n in names]) for w in words)
            z.append(np.log(rows[name] / sum(rows.values())) + each / max(1, len(words)) ** 0.5)
        want = np.exp(np.array(z) - max(z))
        assert r.tokens == len(words)
        assert np.allclose(r.p, want / want.sum(), atol=1e-6)


def made_members(spark, p, seed=10):
    tokens = np.random.default_rng(seed).integers(5, 500, len(p))
    rows = [(int(n), [float(v) for v in line]) for n, line in zip(tokens, p, strict=True)]
    return tokens, spark.createDataFrame(rows, "tokens bigint, p array<double>")


@pytest.mark.parametrize("spread,weights", [([2, 2, 2], [.7, .2, .1]), ([1, 1, 1], [.8, .15, .05])])
def test_mixing_reaches_targets_that_clamp_many_rates(spark, spread, weights):
    p = np.random.default_rng(11).dirichlet(spread, 2000)
    tokens, members = made_members(spark, p)
    rate = np.array([r[0] for r in members.select(
        mixing.fit_rates(members, weights, mixing.Mixture())).collect()])
    assert (rate == 0).mean() > .2
    gap = (rate * tokens) @ p / tokens.sum() - weights
    assert abs(gap).max() < 5e-6


@pytest.mark.parametrize("spread,weights,keep_all", [
    ([5, 5, .05], [.2, .2, .6], False), ([2, 6], [.5, .5], True), ([2, 6], [.85, .15], True)])
def test_mixing_says_how_far_the_nearest_totals_are(spark, spread, weights, keep_all):
    p = np.random.default_rng(12).dirichlet(spread, 2000)
    tokens, members = made_members(spark, p)
    with pytest.warns(UserWarning, match="no rates reach"):
        rate = mixing.fit_rates(members, weights, mixing.Mixture(keep_all=keep_all))
    rate = np.array([r[0] for r in members.select(rate).collect()])
    least, totals = float(keep_all), tokens @ p
    assert rate.min() >= least
    targets = np.array(weights) * ((totals / weights).max() if keep_all else tokens.sum())
    gap = (rate * tokens) @ p - targets
    # Nearest: no row can go up or, above the least rate, down, and bring the totals nearer.
    slope = p @ gap / targets.sum()
    assert slope.min() > -1e-3 and abs((rate - least) * tokens * slope).sum() < 1e-3 * targets.sum()


def test_pipeline_stages_keep_their_contract(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    from stratalog.llm.common import written

    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, sf_dir), name)
        assert after.columns == columns
        if name == "mixing":
            assert {r[0] for r in after.select("doc_id").collect()} == {
                r[0] for r in docs.select("doc_id").collect()}
        else:
            assert after.count() <= docs.count()
        docs = after
    assert before // 2 < docs.select("doc_id").distinct().count() <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r[0] for r in last.select("doc_id").collect()} == {
        r[0] for r in docs.select("doc_id").collect()}


def test_all_queries_are_registered():
    names = {name.split("_")[0] for name in queries.QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}


def test_toxicity_of_held_out_rows(spark):
    """Labelled rows that the model has not seen: toxic ones score higher, clean ones stay unmarked."""
    sf_dir = "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic IN (0, 1)").select(
        "doc_id", "toxic").distinct()
    rows = queries.QUERIES["op5_toxicity"](spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == label] for label in (1, 0))
    above = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean)
    assert above / (len(toxic) * len(clean)) >= 0.75
    assert sum(t >= toxicity.THRESHOLD for t in toxic) >= len(toxic) // 2
    assert sum(c >= toxicity.THRESHOLD for c in clean) <= len(clean) // 20


def test_fitting_holds_few_subsequences_at_once():
    """Words are compared and scored some at a time, with the numbers that all at once give."""
    rng = np.random.default_rng(2)
    words = ["".join(map(chr, rng.integers(97, 123, 24))) for _ in range(6000)]
    landmarks = toxicity.Landmarks(words[:256])
    model = toxicity.WordModel(rng.random(toxicity.TABLE).astype(np.float32), 0.5)
    tracemalloc.start()
    kernel = landmarks.kernel(words[:1000])
    of_kernel = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    scores = model.scores(words)
    of_scores = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert of_kernel < 100e6 and of_scores < 100e6
    assert (kernel[-1] == landmarks.kernel(words[999:1000])[0]).all()
    assert (scores[[0, 2500, -1]] == [model.scores([words[i]])[0] for i in (0, 2500, -1)]).all()
    assert len(model.scores([])) == 0
