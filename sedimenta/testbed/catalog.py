"""All registered queries; importing a section registers its queries."""

from sedimenta.testbed import q_chunks, q_governance, q_history, q_marts, q_metrics, q_reshape, q_vectors  # noqa: F401
from sedimenta.testbed.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
