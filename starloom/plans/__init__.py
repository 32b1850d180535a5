"""Plans: the catalog and load operators, the whole pipeline, fixtures, queries and oracles."""

from starloom.plans.pipeline import RunResult, Sources, run_pipeline
from starloom.plans.tables import Catalog, load_dimension, load_fact, write_table

__all__ = ["Catalog", "RunResult", "Sources", "load_dimension", "load_fact", "run_pipeline", "write_table"]
