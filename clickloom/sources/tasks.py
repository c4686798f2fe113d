"""Job parameters: one row of the task table holds a JSON object of one-element arrays."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import parsed_document, variant_field

# Keys of the parameter document and the columns they become.
PARAMETERS = {
    "startDate": "start_date",
    "endDate": "end_date",
    "startAge": "start_age",
    "endAge": "end_age",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "categoryIds": "category_ids",
    "targetPageFlow": "target_page_flow",
}


@dataclass(frozen=True)
class JobParams:
    """Parsed parameters; None means the parameter was not given."""

    task_id: int | None = None
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None
    target_page_flow: tuple[int, ...] | None = None


def parse_task_params(tasks: DataFrame) -> DataFrame:
    """One text column per parameter: the first array element, NULL when absent or empty."""
    document = F.from_json("task_param", "map<string,array<string>>")
    first = [
        F.nullif(F.get(F.col("_document")[key], F.lit(0)), F.lit("")).alias(column)
        for key, column in PARAMETERS.items()
    ]
    return tasks.select("task_id", document.alias("_document")).select("task_id", *first)


def parse_task_variants(tasks: DataFrame) -> DataFrame:
    """`parse_task_params` by a VARIANT: a document of any other shape loses only what cannot be read of it."""
    parsed = tasks.select("task_id", parsed_document(F.col("task_param")).alias("_document"))
    first = [
        F.nullif(variant_field(F.col("_document"), f"$.{key}[0]"), F.lit("")).alias(column)
        for key, column in PARAMETERS.items()
    ]
    return parsed.select("task_id", *first)


def load_job_params(tasks: DataFrame, task_id: int) -> JobParams:
    """The parameters of one task, read on the driver because they shape the plan."""
    row = parse_task_params(tasks.where(F.col("task_id") == task_id)).first()
    if row is None:
        raise LookupError(f"no task with id {task_id}")

    def many(text, kind=str):
        return None if text is None else tuple(kind(part) for part in text.split(",") if part)

    def number(text):
        return None if text is None else int(text)

    return JobParams(
        task_id=row.task_id,
        start_date=row.start_date,
        end_date=row.end_date,
        start_age=number(row.start_age),
        end_age=number(row.end_age),
        professionals=many(row.professionals),
        cities=many(row.cities),
        sex=row.sex,
        keywords=many(row.keywords),
        category_ids=many(row.category_ids, int),
        target_page_flow=many(row.target_page_flow, int),
    )
