"""What each metric and report means: its family, its rows, what is counted over what, and the function that makes it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from . import metrics, reports

FAMILY_VERSION = {"diagnostics": "3.0.0", "presence_attention": "2.0.0", "perception": "4.0.0", "interaction_structure": "2.0.0"}


@dataclass(frozen=True)
class Contract:
    name: str
    family: str
    #: Columns that name a row; none for a single row.
    grain: tuple[str, ...]
    counted: str
    over: str
    made_by: Callable
    version: str = "2.0.0"
    #: Whether unresolved rows are in the denominator.
    with_unresolved: bool = True


def _table(*rows: Contract) -> dict[str, Contract]:
    return {r.name: r for r in rows}


METRICS = _table(
    Contract("mention_volume", "diagnostics", (), "mentions", "-", metrics.volumes),
    Contract("weighted_volume", "diagnostics", (), "sum of weights", "-", metrics.volumes),
    Contract("duplicate_rate", "diagnostics", (), "mentions in a duplicate cluster", "mentions", metrics.volumes),
    Contract("spam_suspicion_rate", "diagnostics", (), "suspicious mentions", "mentions", metrics.volumes),
    Contract("resolved_entity_mention_rate", "diagnostics", (), "mentions with an entity", "mentions", metrics.target_rates),
    Contract("concept_target_mention_rate", "diagnostics", (), "mentions with a concept", "mentions", metrics.target_rates),
    Contract("reviewable_low_confidence_rate", "diagnostics", (), "mentions with an unsure fact", "mentions", metrics.low_confidence_rate),
    Contract("language_distribution", "diagnostics", ("language",), "mentions", "mentions", metrics.distribution),
    Contract("batch_totals", "diagnostics", (), "candidate clusters, aspect facts", "-", metrics.batch_totals),
    Contract("explicit_language_ratio", "diagnostics", (), "mentions with a given language", "mentions", metrics.source_ratios),
    Contract("share_of_voice", "presence_attention", ("canonical_entity_id",), "mentions with the entity", "mentions, hits or resolved mentions", metrics.share_of_voice, with_unresolved=False),
    Contract("author_concentration", "presence_attention", (), "squared shares of authors", "mentions", metrics.concentration),
    Contract("leading_authors", "presence_attention", ("author_id",), "mentions", "mentions", metrics.leaders),
    Contract("suspicious_author_rate", "presence_attention", (), "authors with a suspicious mention", "authors", metrics.suspicious_authors),
    Contract("target_sentiment", "perception", ("target_key", "sentiment"), "facts", "facts of the target", metrics.target_sentiment, with_unresolved=False),
    Contract("target_sentiment_forensic", "perception", ("target_text", "sentiment"), "facts", "facts of the text", metrics.target_sentiment_forensic),
    Contract("aspect_occurrences", "perception", ("aspect",), "facts", "-", metrics.aspect_occurrences),
    Contract("aspect_targets", "perception", ("aspect", "target_key"), "facts", "-", metrics.aspect_targets, with_unresolved=False),
    Contract("aspect_sentiment", "perception", ("aspect", "sentiment"), "facts", "facts of the aspect", metrics.aspect_sentiment),
    Contract("issue_rate", "perception", ("issue_category",), "mentions with the issue", "mentions", metrics.issue_rates),
    Contract("confirmed_issue_ratio", "perception", ("issue_category",), "facts by direct evidence", "facts of the issue", metrics.confirmed),
    Contract("direct_complaint_ratio", "perception", ("issue_category",), "direct complaints", "facts of the issue", metrics.direct_complaints),
    Contract("uncertain_issue_ratio", "perception", ("issue_category",), "asked or heard", "facts of the issue", metrics.uncertain),
    Contract("severe_issue_ratio", "perception", ("issue_category",), "high or critical", "facts of the issue", metrics.severe),
    Contract("interaction_structure", "interaction_structure", ("root_id",), "replies and depth", "comments", metrics.interaction_structure),
)

REPORTS = _table(
    Contract("sov_report", "share_of_voice", ("canonical_entity_id",), "mentions with the entity", "mentions", reports.share_of_voice, "1.2.0", False),
    Contract("unresolved_summary", "share_of_voice", ("unresolved_reason",), "mentions left open", "mentions", reports.unresolved_summary, "1.2.0"),
    Contract("buzz_report", "buzz", ("canonical_entity_id",), "volume, growth and spread", "mentions", reports.buzz, "1.2.0", False),
    Contract("topic_buzz_report", "buzz", ("topic_key",), "volume, growth and spread", "mentions", reports.topic_buzz, "1.2.0"),
    Contract("emerging_topics", "buzz", ("topic_key",), "growth over the last run", "-", reports.emerging_topics, "1.2.0"),
    Contract("top_issues_report", "issues", ("issue_category",), "severity by evidence by confidence", "-", reports.top_issues, "1.2.0"),
    Contract("controversy_report", "controversy", ("root_id",), "weighted proxies of dispute", "-", reports.controversy, "1.2.0"),
    Contract("creator_breakdown", "breakdown", ("author_id",), "mentions", "mentions", reports.breakdown, "1.2.0"),
    Contract("insight_cards", "insights", ("card",), "the first rows of the reports", "-", reports.insight_cards, "1.2.0"),
)
