"""Plans: business rules, the extract, stand-in tables and check queries."""

from .extract import benefit_verification_extract, output_columns, party_dimension, resolved_coverages
from .standins import standin_tables

__all__ = ["benefit_verification_extract", "output_columns", "party_dimension", "resolved_coverages", "standin_tables"]
