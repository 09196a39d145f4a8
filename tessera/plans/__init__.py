"""Bindings of the operators to the driver's tables (``bindings``) and the
equivalent DuckDB SQL used as the correctness oracle (``oracle``)."""
