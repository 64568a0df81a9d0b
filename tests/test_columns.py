"""Column builders: figures, ages, flags, text, arrays."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.functions import mentions
from stratalog.functions.amounts import magnitude_to_long, round_tenth
from stratalog.functions.arrays import (
    adjacent_pairs, canonical_terms, first_contained, split_badges,
)
from stratalog.functions.dates import relative_date
from stratalog.functions.specs import size_tier, spec_max_context, spec_min_gb, spec_rows
from stratalog.functions.text import (
    SPACE_CHARS, clean_text, key_from_href, keyword_flag, null_like, strip,
)
from stratalog.operators import vocab
from stratalog.operators.vocab import classify_by_table, normalise_arrays_by_table


def column(spark, values, kind, build):
    """``build`` applied to each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").repartition(3)
    rows = df.select("i", build(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


@pytest.mark.parametrize("chunk", [[
    ("110.4M", 110_400_000), ("78.4K", 78_400), ("1.2B", 1_200_000_000), ("5000", 5000),
    ("55m", 55_000_000), ("1,200", 1200), ("", 0), ("N/A", 0), ("  12.5M  ", 12_500_000),
    ("5.5", 0), ("1.2.3M", 0), ("1_000", 1000), ("1dM", 0), ("MK", 0), ("nanM", 0), (None, 0),
    ("\t7k\n", 7000), ("-3", -3), ("1e2K", 100_000),
]])
def test_magnitude(spark, chunk):
    assert column(spark, [t for t, _ in chunk], "string", magnitude_to_long) == [n for _, n in chunk]


AS_OF = dt.date(2026, 3, 31)


@pytest.mark.parametrize("text,date", [
    ("7 months ago", dt.date(2025, 8, 31)), ("2 years ago", dt.date(2024, 3, 31)),
    ("3 weeks ago", dt.date(2026, 3, 10)), ("5 days ago", dt.date(2026, 3, 26)),
    ("1 year ago", dt.date(2025, 3, 31)), ("just now", AS_OF), ("", AS_OF),
    ("1 month ago", dt.date(2026, 2, 28)), ("Updated 2  Weeks  AGO", dt.date(2026, 3, 17)),
    ("99999999999 days ago", AS_OF), ("9999999 years ago", AS_OF),
])
def test_relative_date(spark, text, date):
    as_of = F.lit(AS_OF)
    [row] = column(spark, [text], "string", lambda c: F.struct(*[
        x.alias(n) for x, n in zip(relative_date(c, as_of), "dt")
    ]))
    assert (row["d"], row["t"]) == (date, text.strip().lower())


@pytest.mark.parametrize("key,name,description,expected", [
    ("llama2-uncensored", "Llama2", None, True), ("model-x", "Abliterated Llama", None, True),
    ("mix", "Mix", "An uncensored model", True), ("dolphin-mixtral", "D", None, True),
    ("llama3.1", "Llama 3.1", "A helpful assistant", False),
    ("UNCENSORED-model", "Model", None, True), ("llama3", "Llama 3", None, False),
    ("x", "y", "abundant", True),
])
def test_keyword_flag(spark, key, name, description, expected):
    df = spark.createDataFrame([(key, name, description)], "k string, n string, d string")
    row = df.select(keyword_flag(F.col("k"), F.col("n"), F.col("d")).alias("f")).first()
    assert row["f"] is expected


def test_clean_text(spark):
    values = [None, "", "hello   world\n\nfoo", "x" * 2000, "  a b\x1cc ", "Short text."]
    assert column(spark, values, "string", clean_text) == [
        "N/A", "N/A", "hello world foo", "x" * 1200, "a b c", "Short text."
    ]
    assert column(spark, ["x" * 2000], "string", lambda c: clean_text(c, 500)) == ["x" * 500]


def test_strip_and_keys(spark):
    assert set(SPACE_CHARS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert column(spark, ["  a b\t\n", " \x1d"], "string", strip) == ["a b", ""]
    assert column(
        spark, ["/library/a", "/library/ b "], "string", lambda c: key_from_href(c, "/library/")
    ) == ["a", "b"]
    assert column(spark, ["Unknown", "n/a", "", None, "Org"], "string", null_like) == [
        None, None, None, None, "Org"
    ]


def test_round_tenth_equals_exact_binary_rounding(spark):
    rng = random.Random(7)
    values = [0.35, 6.25, 1.25, 2.675, 0.05, 0.15, 0.25, 0.45, 5.125, 0.0, 1e6 + 0.05]
    values += [n / 20 for n in range(2000)] + [n * 1.25 / 10 for n in range(1, 1500)]
    values += [rng.uniform(0, 500) for _ in range(2000)]
    assert column(spark, values, "double", round_tenth) == [round(v, 1) for v in values]
    assert column(spark, [None], "double", round_tenth) == [None]


def specs_of(spark, text):
    [rows] = column(spark, [text], "string", spec_rows)
    return rows


def test_spec_rows_values(spark):
    first, second = specs_of(spark, "7b 4.1 GB · 4096 context\n13b-Q5_K_M 7.9GB - 128K context")
    assert first.asDict() == {
        "tag": "7b", "size": "4.1 GB", "size_gb": 4.1, "recommended_ram_gb": 5.1,
        "quantization": "q4_k_m", "context": "4096 context", "context_window": None,
    }
    assert second.asDict() == {
        "tag": "13b-Q5_K_M", "size": "7.9GB", "size_gb": 7.9, "recommended_ram_gb": 9.9,
        "quantization": "q5_k_m", "context": "128K context", "context_window": 128000,
    }
    [only] = specs_of(spark, "5b 5.0 GB 1M")
    assert (only["recommended_ram_gb"], only["context_window"]) == (6.2, 1_000_000)
    [only] = specs_of(spark, "x-FP16 1 GB 2m")
    assert (only["recommended_ram_gb"], only["context_window"], only["quantization"]) == (
        1.2, None, "fp16"
    )


def test_spec_rows_order_dependent_dedup(spark):
    # A rejected row blocks nothing: (y, 1) is rejected, so (y, 2) stays.
    rows = specs_of(spark, "x 1 GB 8K\ny 1 GB 8K\ny 2 GB 8K\n")
    assert [(r["tag"], r["size_gb"]) for r in rows] == [("x", 1.0), ("y", 2.0)]


def test_spec_rows_sort_and_filter(spark):
    rows = specs_of(spark, "a 3.0 GB 1K\nb 0.0 GB 2K\nc 1.0 GB 3K\nhttp.x 0.5 GB 4K\nd 1.2.3 GB 5K")
    assert [r["tag"] for r in rows] == ["c", "a", "b", "d"]
    assert rows[2]["recommended_ram_gb"] is None and rows[3]["size_gb"] is None
    assert specs_of(spark, "nothing here") is None
    assert specs_of(spark, None) is None


def test_spec_rows_match_may_start_inside_a_run(spark):
    rows = specs_of(spark, "a 1 GB 4096context8x 3GB 5K")
    assert [(r["tag"], r["context"]) for r in rows] == [("a", "4096context"), ("8x", "5K")]


def test_spec_rows_long_run_is_linear(spark):
    assert specs_of(spark, "x" * 2_000_000 + " 4 GB 8K")[0]["size_gb"] == 4.0
    assert specs_of(spark, "x" * 2_000_000) is None


def test_spec_rows_are_one_arrow_step(spark):
    """No pattern is searched and no array function run by lambdas: these took most of the time."""
    texts = spark.createDataFrame([("a 1 GB 8K",)], "t string").select(spec_rows(F.col("t")).alias("r"))
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and not any(
        word in plan for word in ("lambda", "regexp_", "transform(", "array_sort"))


def test_spec_rows_of_odd_texts(spark):
    [huge] = specs_of(spark, "a 2000000000000000000 GB 8K")
    assert (huge["size_gb"], huge["recommended_ram_gb"]) == (2e18, 2.5e18)
    [row] = specs_of(spark, "a 1 GB 9223372036854775807K")
    assert row["context_window"] is None
    three, k = chr(0x663), chr(0x212A)  # a digit and a K of other scripts are none to a cast
    [row] = specs_of(spark, f"\u00e9 {three} GB\u3000\u00b7\u20038{k}")
    assert (row["tag"], row["size_gb"], row["context"], row["context_window"]) == (
        "\u00e9", None, f"8{k}", None)
    assert specs_of(spark, "a\x1c1 GB 8K") is None
    rows = spark.sql("SELECT CAST(concat(X'FF', encode(t, 'UTF-8')) AS string) AS t FROM "
                     "VALUES ('a 1 GB 8K'), ('a 2 GB'), (NULL), ('') x(t)").select(
        spec_rows(F.col("t")).alias("r")).collect()
    assert [r["r"] and r["r"][0]["tag"] for r in rows] == ["a", None, None, None]


def test_rollup(spark):
    kind = "array<struct<size_gb:double,context_window:bigint>>"
    data = [[(4.14, 8000), (2.45, None), (0.0, 0)], [(0.0, 0)], [], None, [(6.01, None)], [(9.0, 5)]]
    assert column(spark, data, kind, spec_min_gb) == [2.5, None, None, None, 6.0, 9.0]
    assert column(spark, data, kind, spec_max_context) == [8000, None, None, None, None, 5]
    assert column(spark, [2.5, 6.0, 6.1, None], "double", size_tier) == [
        "fast", "medium", "slow", None
    ]


@pytest.mark.parametrize("tokens,expected", [
    (["A", "cmd1", "cmd2", "B"], [("A", "cmd1")]),
    (["A", "cmd1", "cmd2", "cmd3"], [("A", "cmd1"), ("cmd2", "cmd3")]),
    (["cmd1", "cmd2", "A"], [("cmd1", "cmd2")]),
    (["A", "B", "cmd1", "C", "cmd2"], [("B", "cmd1"), ("C", "cmd2")]),
    ([], []),
])
def test_adjacent_pairs(spark, tokens, expected):
    [out] = column(spark, [tokens], "array<string>", lambda c: adjacent_pairs(c, "cmd"))
    assert [tuple(p) for p in out] == expected


def test_badges(spark):
    [out] = column(spark, [["Tools", " 8B ", "", "VISION", "70b"]], "array<string>",
                   lambda c: F.struct(*split_badges(c, fv.CAPABILITY_TAGS)))
    assert list(out) == [["Tools", "Vision"], ["8b", "70b"]]


@pytest.mark.parametrize("build,kind,cases", [
    (vocab.map_domain, "string", [("nlp", "Language"), (" LAW ", "Legal"), ("Math", "Math"),
                                  ("cooking", "General"), ("general", "General")]),
    (vocab.map_complexity, "string", [("Easy", "beginner"), ("expert ", "advanced"),
                                      ("odd", "intermediate")]),
    (vocab.map_family, "string", [("codellama", "Llama"), ("dolphin", "Phi"),
                                  ("Dolphin", "Dolphin"), ("bakllava", "LLaVA"),
                                  ("CodeLlama", "CodeLlama"), ("nothing", "Other")]),
    (vocab.map_languages, "array<string>", [
        (["english"], ["English"]), (["english", "french"], ["French"]),
        (["Mandarin", "chinese", "German"], ["Chinese", "German"]),
        (fv.LANGUAGES, fv.LANGUAGES[:8]), ([], ["English"]),
    ]),
    (vocab.map_use_cases, "array<string>", [
        (["rag", "Math", "mathematics", "x"], ["RAG / Retrieval", "Math"]),
        (["translation"], ["Chat Assistant"]), (fv.USE_CASES, fv.USE_CASES),
    ]),
    (vocab.map_audience, "array<string>", [
        (["devops", "Student", "devop"], ["DevOps", "Students"]),
        (fv.AUDIENCES, fv.AUDIENCES[:4]), (["x"], ["Developers"]),
    ]),
])
def test_vocabularies(spark, build, kind, cases):
    assert column(spark, [v for v, _ in cases], kind, build) == [e for _, e in cases]


def test_vocabulary_sizes():
    assert [len(v) for v in (fv.DOMAINS, fv.USE_CASES, fv.LANGUAGES, fv.AUDIENCES, fv.FAMILIES)] == [
        14, 20, 25, 11, 26
    ]


def test_normalise_by_table_large_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(vocab, "BROADCAST_ROWS", 1)
    terms = spark.createDataFrame([("a", "Alpha"), ("al", "Alpha"), ("b", "Beta")],
                                  "alias string, term string")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(
        ["Alpha", " AL ", "b", "zeta", None, "b", "alpha"])], "i int, v string")
    rows = vocab.normalise_by_table(df, "v", terms, "Other", "t").orderBy("i").collect()
    assert [r["t"] for r in rows] == ["Alpha", "Alpha", "Beta", "Other", "Other", "Beta", "Other"]


def test_arrays_and_substrings_by_table(spark):
    """The table forms give what the inlined ones give, for values that are NULL and short too."""
    rng = random.Random(12)
    pairs = [("dev", "Dev"), ("a", "Ay"), ("developer tools", "Tools"), ("ml", "ML"), ("lop", "Lop")]
    aliases, terms = dict(pairs), sorted({t for _, t in pairs})
    texts = [None, "", "A", " ml ", "Dev", "the developer tools", "xlopx"] + [
        "".join(rng.choice("adevlopm t") for _ in range(rng.randrange(12))) for _ in range(60)]
    rows = [(i, text, [rng.choice(texts) for _ in range(rng.randrange(6))] if i % 9 else None)
            for i, text in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "n int, v string, vs array<string>")
    table = spark.createDataFrame([(a, t, r) for r, (a, t) in enumerate(pairs)],
                                  "alias string, term string, rank int")
    for cap in (None, 2):
        got = normalise_arrays_by_table(df, "n", "vs", table, "none", "got", cap).withColumn(
            "want", canonical_terms(F.col("vs"), terms, aliases, "none", cap)).collect()
        assert len(got) == len(rows) and all(r.got == r.want for r in got)
    got = classify_by_table(df, "v", table, "none", "got").withColumn(
        "want", first_contained(F.col("v"), terms, pairs, "none")).collect()
    assert len(got) == len(rows) and all(r.got == r.want for r in got)


def test_spec_rows_of_a_long_page(spark):
    text = "\n".join(f"t{i} {i + 1} GB · {i % 50}K context" for i in range(20_000))
    start = time.perf_counter()
    [rows] = column(spark, [text], "string", spec_rows)
    assert len(rows) == 20_000 and time.perf_counter() - start < 10


def test_mentions(spark):
    text = (
        "see https://huggingface.co/a/b, https://huggingface.co/a/b> MITx émit Apache 2.0 "
        "CC BY 4.0 MIT 128K context 12 tokens é9 window, MMLU: 85.2% GSM8K 7 "
    )
    assert column(spark, [text], "string", mentions.url_mentions) == [
        ["https://huggingface.co/a/b,", "https://huggingface.co/a/b"]
    ]
    assert column(spark, [text], "string", mentions.license_mentions) == [
        ["MIT", "Apache 2.0", "CC BY 4.0 "]
    ]
    assert column(spark, [text], "string", mentions.context_mentions) == [
        ["128K context", "12 tokens"]
    ]
    assert column(spark, [text], "string", mentions.score_mentions) == [
        ["MMLU: 85.2%", "GSM8K 7 "]
    ]


def test_adjacent_pairs_against_brute_force(spark):
    rng = random.Random(5)
    lists = [[rng.choice(["a", "b", "run x", "run y"]) for _ in range(rng.randint(0, 12))]
             for _ in range(300)]

    def pairs(tokens):
        # A command token is used exactly if the token before it was not.
        used, out = False, []
        for name, token in zip([None, *tokens], tokens):
            used = name is not None and token.startswith("run") and not used
            if used:
                out.append((name, token))
        return out

    got = column(spark, lists, "array<string>", lambda c: adjacent_pairs(c, "run"))
    assert [[tuple(p) for p in row] for row in got] == [pairs(t) for t in lists]


def test_spec_dedup_against_brute_force(spark):
    rng = random.Random(6)
    triples = [[(rng.choice("abcd"), rng.choice([0, 1, 2]), rng.choice("12"))
                for _ in range(rng.randint(1, 9))] for _ in range(300)]
    texts = ["\n".join(f"{t} {g} GB {c}K" for t, g, c in row) for row in triples]

    def kept(row):
        out = []
        for t, g, c in row:
            if all(t != u and (g, c) != (h, d) for u, h, d in out):
                out.append((t, g, c))
        return sorted(out, key=lambda r: r[1] or 999)

    got = column(spark, texts, "string", spec_rows)
    assert [[(r["tag"], int(r["size_gb"]), r["context"]) for r in row] for row in got] == [
        [(t, g, c + "K") for t, g, c in kept(row)] for row in triples
    ]
