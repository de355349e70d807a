"""changemill: apply and publish change data with Spark DataFrames."""

from changemill.spec import ApplySpec, Op, TableSpec

__all__ = ["ApplySpec", "Op", "TableSpec"]
