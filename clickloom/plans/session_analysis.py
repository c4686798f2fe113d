"""The session job: every result from two compact tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.operators.categories import (
    category_counts_from_facts,
    facts_from_activity,
    measures_from_activity,
    session_activity,
    top_categories,
    top_session_detail,
    top_sessions,
    within_categories,
)
from clickloom.operators.sampling import sample_sessions
from clickloom.operators.sessions import filter_sessions, observed_sessions, session_rollup, stats_of_observed
from clickloom.schemas import SESSION_DETAIL_COLUMNS
from clickloom.session import shared_table
from clickloom.sources.tables import scan_actions, typed_actions
from clickloom.sources.tasks import JobParams


@dataclass(frozen=True)
class SessionAnalysis:
    """Statistics, sample, top categories and top sessions of the sessions that meet `params`.

    Frames that several results read are written to the shared folder when first asked for, and
    only once: the activity per session and category, the passing sessions, their facts, and the
    small reports. The actions are scanned twice: once for the activity, combined before it is
    shuffled, and once for the whole actions of all sampled and top sessions together.
    """

    actions: DataFrame
    users: DataFrame
    params: JobParams = JobParams()
    sample_size: int = 100
    seed: str = "0"
    top: int = 10

    @cached_property
    def selected(self) -> DataFrame:
        """Typed actions of the date range, which is applied to the stored date."""
        return typed_actions(scan_actions(self.actions, self.params.start_date, self.params.end_date))

    @cached_property
    def activity(self) -> DataFrame:
        """Measures and category counts of all sessions."""
        return shared_table(session_activity(self.selected, self.params.keywords, self.params.category_ids), "activity")

    @cached_property
    def _counted_sessions(self) -> tuple[DataFrame, Observation]:
        """Passing sessions, written once, and the bucket counts gathered by that write."""
        passing = filter_sessions(measures_from_activity(self.activity), self.users, self.params)
        observed, observation = observed_sessions(passing)
        return shared_table(observed, "sessions"), observation

    @property
    def sessions(self) -> DataFrame:
        """Passing sessions."""
        return self._counted_sessions[0]

    @cached_property
    def facts(self) -> DataFrame:
        """Category facts of the passing sessions."""
        ids = self.sessions.select("session_id")
        facts = facts_from_activity(self.activity).join(ids, "session_id", "left_semi")
        return shared_table(facts, "session-facts")

    @cached_property
    def stats(self) -> DataFrame:
        """From the counts of the write: the stored sessions are not read again."""
        sessions, observation = self._counted_sessions
        return stats_of_observed(sessions.sparkSession, observation)

    @cached_property
    def drawn(self) -> DataFrame:
        """Ids of the sampled sessions, `sample_size` at most."""
        sampled = sample_sessions(self.sessions, self.sample_size, self.seed)
        return shared_table(sampled.select("session_id"), "sample")

    @cached_property
    def _listed_actions(self) -> DataFrame:
        """Actions of the sampled and the top sessions: `sample_size` + `top` x `top` sessions at most."""
        ids = self.drawn.union(self.top_sessions.select("session_id")).distinct()
        return shared_table(self.selected.join(ids, "session_id", "left_semi"), "listed-actions")

    @cached_property
    def _drawn_actions(self) -> DataFrame:
        """From the listed actions if the top sessions were asked for as well, else by a scan of its own."""
        asked = "top_sessions" in self.__dict__
        return (self._listed_actions if asked else self.selected).join(self.drawn, "session_id", "left_semi")

    @cached_property
    def sample(self) -> DataFrame:
        """The sampled sessions; an empty keyword or category list is NULL."""
        empty = F.lit("")
        return session_rollup(self._drawn_actions).select(
            "session_id",
            "start_time",
            F.nullif(F.col("search_keywords"), empty).alias("search_keywords"),
            F.nullif(F.col("click_category_ids"), empty).alias("click_category_ids"),
        )

    @cached_property
    def sample_detail(self) -> DataFrame:
        return self._drawn_actions.select(*SESSION_DETAIL_COLUMNS)

    @cached_property
    def top_categories(self) -> DataFrame:
        return shared_table(top_categories(category_counts_from_facts(self.facts), self.top), "top-categories")

    @cached_property
    def top_sessions(self) -> DataFrame:
        clicks = self.facts.where(F.col("click_count") > 0).select("category_id", "session_id", "click_count")
        ranked = top_sessions(within_categories(clicks, self.top_categories), self.top)
        return shared_table(ranked, "top-sessions")

    @cached_property
    def top_session_detail(self) -> DataFrame:
        """Actions of the top sessions, once per category a session is listed under."""
        detail = top_session_detail(self._listed_actions, self.top_sessions)
        return detail.select("category_id", *SESSION_DETAIL_COLUMNS)
