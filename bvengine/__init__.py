"""bvengine: benefit-verification extracts as lazy Spark DataFrame plans.

Layout:
  sources/    schemas of the nine domain tables, checked loaders
  functions/  Column expressions (digit cleaning, zip, task key, cutoff clock)
  operators/  generic DataFrame -> DataFrame operators (latest per key,
              has-all, member flags, exclude-unless-stale, role joins, ...)
  plans/      business rules, the 76-column extract, check queries
  llm/        operators for training-data pipelines (optional)
"""

from .config import RULES, Rules, RulesConfig

__all__ = ["RULES", "Rules", "RulesConfig"]
