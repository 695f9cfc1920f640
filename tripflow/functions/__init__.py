"""Scalar expressions and declarative rule sets."""

from tripflow.functions.expressions import (  # noqa: F401
    exact, layer_of, payment_label, processing_time,
    reasons_vector, sla_threshold_hours, trip_type_desc,
)
from tripflow.functions.rules import REASONS, RULES, Rule, RuleSet, reasons_from_rules  # noqa: F401
