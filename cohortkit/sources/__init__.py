"""Inputs: fixture views derived from the driver's tables, or named datasets."""

from .fixtures import Inputs
from .named import TableInputs

# Either kind works wherever a plan takes ``inputs``: both expose the same
# attributes (cohort, person_lds, location, manifest, visits, ...).
AnyInputs = Inputs | TableInputs

__all__ = ["AnyInputs", "Inputs", "TableInputs"]
