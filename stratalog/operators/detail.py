"""Detail pages to main text, specification rows, applications and prompt sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.functions import mentions
from stratalog.functions.amounts import round_tenth
from stratalog.functions.arrays import adjacent_pairs, null_if_empty
from stratalog.functions.markup import read_page
from stratalog.functions.specs import size_tier, spec_max_context, spec_min_gb, spec_rows
from stratalog.functions.text import blank_to_null, squeeze, strip

# Fixed value: where the main text is when no element is marked as such.
_README_SECTION = r"(?isU)Readme\n(.*?)(?:\nModels|\nTags|\z)"


def page_text(
    pages: DataFrame, html: str = "html", readme_id: str = "readme", title: str = "Applications"
) -> DataFrame:
    """Replace the page by its text, one line per text node."""
    detail = read_page(F.col(html), ("detail",), readme_id=readme_id, applications_title=title)
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, detail["detail"]["page_text"].alias("page_text"))


def readme_text(detail: Column) -> Column:
    """Text of the marked element, else of the section the page text shows, at most 10000 chars."""
    node = detail["readme_node"]
    found = F.when(node.isNotNull(), strip(node)).otherwise(
        strip(F.regexp_extract(detail["page_text"], _README_SECTION, 1))
    )
    return F.substring(blank_to_null(found), 1, fv.README_CAP)


def with_rollup(df: DataFrame, specs: str = "memory_requirements") -> DataFrame:
    """Smallest size, largest context and size tier of the specification rows."""
    return (
        df.withColumn("min_ram_gb", spec_min_gb(F.col(specs)))
        .withColumn("context_window", spec_max_context(F.col(specs)))
        .withColumn("speed_tier", size_tier(F.col("min_ram_gb")))
    )


def detail_extract(
    pages: DataFrame,
    command_prefix: str,
    html: str = "html",
    readme_id: str = "readme",
    applications_title: str = "Applications",
) -> DataFrame:
    """Replace the page by what it says; all other columns are passed through.

    One pass per page and no shuffle. NULL or empty pages give NULLs.
    """
    detail = read_page(
        F.col(html), ("detail",), readme_id=readme_id, applications_title=applications_title
    )["detail"]
    rest = [c for c in pages.columns if c != html]
    read = pages.select(*rest, detail.alias("_d"))
    return with_rollup(read.select(*rest, *_detail_columns("_d", command_prefix)))


def _detail_columns(detail: str, command_prefix: str) -> list[Column]:
    pairs = F.flatten(F.transform(
        F.col(f"{detail}.application_tokens"), lambda tokens: adjacent_pairs(tokens, command_prefix)
    ))
    return [
        readme_text(F.col(detail)).alias("readme"),
        spec_rows(F.col(f"{detail}.page_text")).alias("memory_requirements"),
        null_if_empty(pairs).alias("applications"),
    ]


def detail_and_sections(
    pages: DataFrame,
    command_prefix: str,
    html: str = "html",
    readme_id: str = "readme",
    applications_title: str = "Applications",
    main_class: str = "readme|markdown|content",
    heading_word: str = "application",
) -> DataFrame:
    """``detail_extract`` and ``html_sections`` of the same pages in one pass over the markup."""
    read = read_page(
        F.col(html), ("detail", "sections"), readme_id=readme_id,
        applications_title=applications_title, main_id=readme_id, main_class=main_class,
        heading_word=heading_word,
    )
    rest = [c for c in pages.columns if c != html]
    parts = pages.select(*rest, read.alias("_p"))
    return with_rollup(parts.select(
        *rest, *_detail_columns("_p.detail", command_prefix), *_section_columns("_p.sections")
    ))


def rollup_by_key(specs: DataFrame, key: str) -> DataFrame:
    """The roll-up of specification rows held one per row (key, size_gb, context_window)."""
    size, context = F.col("size_gb"), F.col("context_window")
    return (
        specs.groupBy(key)
        .agg(
            F.min(F.when(size > 0, size)).alias("min_ram_gb"),
            F.max(F.when(context != 0, context)).alias("context_window"),
        )
        .withColumn("min_ram_gb", round_tenth(F.col("min_ram_gb")))
        .withColumn("speed_tier", size_tier(F.col("min_ram_gb")))
    )


def html_sections(
    pages: DataFrame,
    html: str = "html",
    main_id: str = "readme",
    main_class: str = "readme|markdown|content",
    heading_word: str = "application",
) -> DataFrame:
    """Replace the page by its main content and five lists of mentions; empty lists are NULL.

    Mentions are looked for in the visible text, so link targets do not count.
    """
    sections = read_page(
        F.col(html), ("sections",),
        main_id=main_id, main_class=main_class, heading_word=heading_word,
    )["sections"]
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, sections.alias("_s")).select(*rest, *_section_columns("_s"))


def _section_columns(sections: str) -> list[Column]:
    text = F.col(f"{sections}.full_text")
    main, headed = F.col(f"{sections}.main_text"), F.col(f"{sections}.headed_texts")
    return [
        F.substring(squeeze(main), 1, fv.SECTION_CAP).alias("main_content"),
        null_if_empty(mentions.url_mentions(text)).alias("hf_links"),
        null_if_empty(mentions.context_mentions(text)).alias("context_mentions"),
        null_if_empty(mentions.license_mentions(text)).alias("license_mentions"),
        null_if_empty(mentions.score_mentions(text)).alias("benchmark_mentions"),
        null_if_empty(F.slice(headed, 1, 8)).alias("applications_raw"),
    ]
