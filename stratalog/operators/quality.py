"""Declarative quality rules and the validation state of every item."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.functions.guarded import Guarded


def _shown(field: str) -> Column:
    """A value as a message shows it: text in quotes, NULL as ``None``."""
    value = F.col(field)
    text = F.expr(f"CASE WHEN typeof(`{field}`) = 'string' THEN \"'\" ELSE '' END")
    return F.coalesce(F.concat(text, value.cast("string"), text), F.lit("None"))


@dataclass(frozen=True)
class Rule:
    """A boolean condition on one field: SQL, or what builds a guarded expression. NULL counts as failed.

    A guarded condition that fails to be evaluated on a row counts as failed there, with a message of its
    own that shows the field. SQL is taken as it is: what raises in it ends the job.
    """

    field: str
    condition: str | Callable[[], Guarded]
    message: str

    def failure(self) -> Column:
        if isinstance(self.condition, str):
            passed, raised = F.expr(self.condition), F.lit(False)
        else:
            guarded = self.condition()
            passed, raised = guarded.value, guarded.failed
        # Fixed value: the message of a rule that raises.
        errored = F.concat(F.lit(f"{self.field}: rule check errored (value="), _shown(self.field),
                           F.lit(")"))
        return F.when(raised, errored).when(
            ~F.coalesce(passed, F.lit(False)), F.lit(f"{self.field}: {self.message}"))


def not_null(field: str) -> Rule:
    return Rule(field, f"{field} IS NOT NULL", f"{field} must not be null")


def not_empty(field: str) -> Rule:
    return Rule(field, f"size({field}) >= 1", f"{field} must have at least 1 item")


def min_chars(field: str, n: int) -> Rule:
    return Rule(field, f"length({field}) >= {n}", f"{field} must be at least {n} chars")


# The rules, in the order in which failures are listed.
DEFAULT_RULES = (
    not_null("domain"),
    not_empty("use_cases"),
    not_empty("ai_languages"),
    not_null("complexity"),
    min_chars("best_for", 10),
    not_empty("strengths"),
    not_null("limitations"),
    not_null("model_family"),
    not_empty("target_audience"),
)


def rule_failures(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    return F.array_compact(F.array(*[r.failure() for r in rules]))


def rule_validate(items: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Add ``failures`` (messages in rule order), ``is_valid`` and the joined message."""
    return (
        items.withColumn("failures", rule_failures(rules))
        .withColumn("is_valid", F.size("failures") == 0)
        .withColumn("failure_text", F.array_join("failures", "; "))
    )


def validation_transition(
    catalog: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    max_retries: int = fv.MAX_VALIDATION_RETRIES,
) -> DataFrame:
    """Next validation state of every item; adds ``outcome`` and ``failures``.

    Items without enrichment pass through with a NULL outcome. Validated and failed items are
    settled. The others pass, or are queued again up to ``max_retries`` times over all runs, or
    fail for good. One projection, no shuffle.
    """
    checked = catalog.withColumn("failures", rule_failures(rules)).withColumn(
        "outcome",
        F.when(F.col("enrich_version").isNull(), F.lit(None).cast("string"))
        .when(F.col("validated"), "skip_valid")
        .when(F.col("validation_failed"), "skip_failed")
        .when(F.size("failures") == 0, "valid")
        .when(F.coalesce("validation_retries", F.lit(0)) < max_retries, "re_queued")
        .otherwise("failed"),
    )
    is_ = {o: F.col("outcome") == o for o in ("valid", "re_queued", "failed")}
    null_bool = F.lit(None).cast("boolean")
    return checked.withColumns({
        "enrich_version": F.when(is_["re_queued"], F.lit(None).cast("int"))
        .otherwise(F.col("enrich_version")),
        "validated": F.when(is_["valid"], True).when(is_["re_queued"], null_bool)
        .when(is_["failed"], False).otherwise(F.col("validated")),
        "validation_failed": F.when(is_["valid"] | is_["re_queued"], null_bool)
        .when(is_["failed"], True).otherwise(F.col("validation_failed")),
        "validation_retries": F.when(is_["valid"], 0)
        .when(is_["re_queued"], F.coalesce("validation_retries", F.lit(0)) + 1)
        .otherwise(F.col("validation_retries")),
    })


def validation_counts() -> list[Column]:
    """Counts over ``outcome``; usable in ``agg`` and in ``observe``."""
    outcome = F.col("outcome")

    def among(name: str, *outcomes: str) -> Column:
        return F.count_if(F.coalesce(outcome.isin(*outcomes), F.lit(False))).alias(name)

    return [
        F.count(outcome).alias("total"),
        among("valid", "skip_valid", "valid"),
        among("invalid", "re_queued", "failed"),
        among("re_queued", "re_queued"),
        among("failed", "skip_failed", "failed"),
    ]


def validation_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(*validation_counts())
