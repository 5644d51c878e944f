from blotter.operators import coverage, flatten, geo, marts, quality, serving, staging

__all__ = ["coverage", "flatten", "geo", "marts", "quality", "serving", "staging"]
