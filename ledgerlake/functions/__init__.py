"""Column expressions; everything here stays inside Spark's code generation."""

from .ordering import bin_span, linear_bin, log_bin
from .rules import balance_drift, balance_label, outside_domain

__all__ = ["balance_drift", "balance_label", "bin_span", "linear_bin", "log_bin", "outside_domain"]
