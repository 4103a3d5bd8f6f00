"""All registered queries."""

from twinledger.plans import q_flatten, q_labels, q_lists, q_quality, q_reconcile, q_requests, q_text  # noqa: F401
from twinledger.plans.registry import ORACLES, QUERIES  # noqa: F401
