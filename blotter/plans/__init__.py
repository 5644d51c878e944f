from blotter.plans.catalog import QUERIES, run
from blotter.plans.build import build_all, quality_report

__all__ = ["QUERIES", "build_all", "quality_report", "run"]
