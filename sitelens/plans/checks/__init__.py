"""The check families. Each module holds one family."""

from sitelens.plans.checks.concordance import concordance_metadata, domain_concordance
from sitelens.plans.checks.cycle import cycle_metadata, data_cycle_changes
from sitelens.plans.checks.dates import date_plausibility
from sitelens.plans.checks.documentation import (
    VisitClass,
    fact_documentation,
    fact_documentation_by_class,
)
from sitelens.plans.checks.expected import expected_concepts
from sitelens.plans.checks.mapping import best_mapped_concepts
from sitelens.plans.checks.metadata import check_metadata
from sitelens.plans.checks.missing import missing_visit_ids
from sitelens.plans.checks.timeline import attach_denominators, facts_over_time
from sitelens.plans.checks.unmapped import (
    unmapped_by_year,
    unmapped_concepts,
    unmapped_source_values,
)
from sitelens.plans.checks.vocabulary import value_set_conformance, vocabulary_conformance

__all__ = [
    "VisitClass",
    "attach_denominators",
    "best_mapped_concepts",
    "check_metadata",
    "concordance_metadata",
    "cycle_metadata",
    "data_cycle_changes",
    "date_plausibility",
    "domain_concordance",
    "expected_concepts",
    "fact_documentation",
    "fact_documentation_by_class",
    "facts_over_time",
    "missing_visit_ids",
    "unmapped_by_year",
    "unmapped_concepts",
    "unmapped_source_values",
    "value_set_conformance",
    "vocabulary_conformance",
]
