"""Conversion along a page flow."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.operators.page_flow import conversion_rates, packed_rates
from clickloom.sources.tables import scan_actions, typed_actions
from clickloom.sources.tasks import JobParams


def page_conversion(actions: DataFrame, params: JobParams, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Rate of every hop of the task's page flow over its date range, one row each."""
    if len(params.target_page_flow or ()) < 2:
        raise ValueError("the page flow needs at least two pages")
    actions = typed_actions(scan_actions(actions, params.start_date, params.end_date))
    return conversion_rates(actions, params.target_page_flow, tie_break)


def page_conversion_row(actions: DataFrame, params: JobParams, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The same rates packed into one text, as stored in the result table."""
    return packed_rates(page_conversion(actions, params, tie_break))
