"""Declared schemas of the catalog, the extracted records and the six structured answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from stratalog import fixed_values as fv

SPEC_ROW = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("size", T.StringType()),
    T.StructField("size_gb", T.DoubleType()),
    T.StructField("recommended_ram_gb", T.DoubleType()),
    T.StructField("quantization", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("context_window", T.LongType()),
])
APPLICATION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("launch_command", T.StringType()),
])
BENCHMARK_SCORE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    # The object as JSON text: scores are open, so other fields and scores such as "85%" stay.
    T.StructField("given", T.StringType()),
])
STRINGS = T.ArrayType(T.StringType())

# raw_html, the 44th column of the data model, lives in the page archive under the same key:
# scans of the catalog never read it, and a refresh never rewrites it.
CATALOG_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("item_key", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("namespace", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("readme", T.StringType()),
    T.StructField("capability", T.StringType()),
    T.StructField("capabilities", STRINGS),
    T.StructField("labels", STRINGS),
    T.StructField("pulls", T.LongType()),
    T.StructField("tags", T.IntegerType()),
    T.StructField("last_updated", T.DateType()),
    T.StructField("last_updated_str", T.StringType()),
    T.StructField("applications", T.ArrayType(APPLICATION)),
    T.StructField("memory_requirements", T.ArrayType(SPEC_ROW)),
    T.StructField("min_ram_gb", T.DoubleType()),
    T.StructField("context_window", T.LongType()),
    T.StructField("speed_tier", T.StringType()),
    T.StructField("use_cases", STRINGS),
    T.StructField("domain", T.StringType()),
    T.StructField("ai_languages", STRINGS),
    T.StructField("complexity", T.StringType()),
    T.StructField("best_for", T.StringType()),
    T.StructField("license", T.StringType()),
    T.StructField("base_model", T.StringType()),
    T.StructField("model_family", T.StringType()),
    T.StructField("is_fine_tuned", T.BooleanType()),
    T.StructField("is_uncensored", T.BooleanType()),
    T.StructField("is_multimodal", T.BooleanType()),
    T.StructField("creator_org", T.StringType()),
    T.StructField("huggingface_url", T.StringType()),
    T.StructField("benchmark_scores", T.ArrayType(BENCHMARK_SCORE)),
    T.StructField("parameter_sizes", STRINGS),
    T.StructField("strengths", STRINGS),
    T.StructField("limitations", STRINGS),
    T.StructField("target_audience", STRINGS),
    T.StructField("enrich_version", T.IntegerType()),
    T.StructField("validated", T.BooleanType()),
    T.StructField("validation_failed", T.BooleanType()),
    T.StructField("validation_retries", T.IntegerType()),
    T.StructField("timestamp", T.TimestampType()),
])

# A run keeps the long columns apart: they change only when a page is read, while the state of an
# item changes with every crawl, enrichment and validation.
CONTENT_COLUMNS = ["readme", "applications", "memory_requirements"]
ROLLUP_COLUMNS = ["min_ram_gb", "context_window", "speed_tier"]
STATE_SCHEMA = T.StructType([f for f in CATALOG_SCHEMA if f.name not in CONTENT_COLUMNS])
# What the prompts need of a page, stored where the page is read.
SECTIONS_SCHEMA = T.StructType([
    T.StructField("main_content", T.StringType()),
    *[T.StructField(name, STRINGS) for name in (
        "hf_links", "context_mentions", "license_mentions", "benchmark_mentions",
        "applications_raw")],
])
CONTENT_SCHEMA = T.StructType([
    *[CATALOG_SCHEMA[c] for c in ["item_key", *CONTENT_COLUMNS, *ROLLUP_COLUMNS]],
    *SECTIONS_SCHEMA.fields,
])

PAGE_ARCHIVE_SCHEMA = T.StructType([
    T.StructField("item_key", T.StringType()),
    T.StructField("html", T.StringType()),
])

RESPONSES_SCHEMA = T.StructType([
    T.StructField("item_key", T.StringType()),
    T.StructField("responses", T.ArrayType(T.StructType([
        T.StructField("call_no", T.IntegerType()),
        T.StructField("raw", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]))),
])

# Columns an enrichment row brings to the catalog.
ENRICHMENT_COLUMNS = [
    "use_cases", "domain", "ai_languages", "complexity", "best_for", "license", "base_model",
    "model_family", "is_fine_tuned", "is_uncensored", "strengths", "limitations",
    "target_audience", "creator_org", "is_multimodal", "huggingface_url", "benchmark_scores",
    "parameter_sizes",
]

EXPORT_COLUMNS = [
    "id", "item_key", "item_name", "item_type", "namespace", "url",
    "description", "readme", "capabilities", "capability", "labels",
    "applications", "memory_requirements", "min_ram_gb", "context_window", "speed_tier",
    "use_cases", "domain", "ai_languages", "complexity", "best_for", "model_family",
    "base_model", "is_fine_tuned", "is_uncensored", "license", "strengths", "limitations",
    "target_audience", "creator_org", "is_multimodal", "huggingface_url", "benchmark_scores",
    "parameter_sizes", "pulls", "tags", "last_updated", "last_updated_str", "timestamp",
    "enrich_version", "validated", "validation_failed",
]


def export_schema(names: dict[str, str] | None = None) -> T.StructType:
    """Schema of an exported file: export columns, dates as ISO text, export names."""
    names = fv.EXPORT_NAMES if names is None else names
    fields = []
    for name in EXPORT_COLUMNS:
        kind = CATALOG_SCHEMA[name].dataType
        if isinstance(kind, (T.DateType, T.TimestampType)):
            kind = T.StringType()
        fields.append(T.StructField(names.get(name, name), kind))
    return T.StructType(fields)


@dataclass(frozen=True)
class AnswerField:
    """One field of a structured answer and what it must satisfy."""

    name: str
    kind: str  # string | boolean | strings | scores
    nullable: bool = False
    min_len: int | None = None
    max_len: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        return {
            "string": T.StringType(),
            "boolean": T.BooleanType(),
            "strings": STRINGS,
            "scores": T.ArrayType(BENCHMARK_SCORE),
        }[self.kind]


@dataclass(frozen=True)
class Answer:
    """One structured call: its number, whether a failure drops the row, and its fields."""

    call_no: int
    label: str
    fields: tuple[AnswerField, ...]
    required: bool = True

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])


# Call split, field types and length limits.
ANSWERS = (
    Answer(1, "domain_family", (
        AnswerField("domain", "string"),
        AnswerField("model_family", "string"),
    )),
    Answer(2, "use_cases", (
        AnswerField("use_cases", "strings", min_len=1, max_len=5),
    )),
    Answer(3, "basics", (
        AnswerField("languages", "strings", min_len=1, max_len=8),
        AnswerField("complexity", "string"),
        AnswerField("is_fine_tuned", "boolean"),
        AnswerField("is_uncensored", "boolean"),
    )),
    Answer(4, "summary", (
        AnswerField("best_for", "string", min_len=10, max_len=300),
        AnswerField("license", "string", nullable=True),
    )),
    Answer(5, "quality", (
        AnswerField("strengths", "strings", min_len=1, max_len=5),
        AnswerField("limitations", "strings", min_len=0, max_len=5),
        AnswerField("target_audience", "strings", min_len=1, max_len=4),
    )),
    Answer(6, "metadata", (
        AnswerField("creator_org", "string", nullable=True),
        AnswerField("is_multimodal", "boolean"),
        AnswerField("base_model", "string", nullable=True),
        AnswerField("huggingface_url", "string", nullable=True),
        AnswerField("benchmark_scores", "scores", nullable=True),
        AnswerField("parameter_sizes", "strings", nullable=True),
    ), required=False),
)
